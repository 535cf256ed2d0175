"""The corpus operators against brute force, on small and awkward tables."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sievework.llm import audio, byte_bpe, packing, quality, sharding, simhash, substring, token_counts, topk, toxicity

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
draw = random.Random(3)
VOCABULARY = [f"w{i}" for i in range(400)]
PASSAGE = " ".join(draw.choices(VOCABULARY, k=60))


def _texts():
    prose = [" ".join(draw.choices(VOCABULARY, k=draw.randrange(1, 90))) for _ in range(40)]
    prose += [f"{prose[i]} {PASSAGE} {prose[i + 1]}" for i in range(8)]
    prose += [prose[3]] * 5 + ["same " * 200, "a\x0bb\tc\n\nd  e", "", None, "  \n", "é🙂  x 's don't WE'LL 12,5", "x" * 5000, " ".join(draw.choices(VOCABULARY, k=30_000))]
    return prose


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    """Awkward texts, with columns whose names the operators use themselves."""
    rows = [(i, t, "x", i, i, "r") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, h string, pos long, m long, rid string").repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows(df):
    return df.toPandas()


def _expanded(law, byte):
    """One companded sample by the standard's words: sign, segment and step."""
    if law == 6:
        byte ^= 0x55
        segment, step = byte >> 4 & 7, byte & 15
        size = (step << 4) + 8 if not segment else ((step << 4) + 264) << segment - 1
        return size if byte & 128 else -size
    byte = ~byte & 255
    size = (((byte & 15) << 3) + 132 << (byte >> 4 & 7)) - 132
    return -size if byte & 128 else size


def _adpcm(block):
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for nibble in (byte & 15, byte >> 4):
            step = int(audio._STEPS[index])
            change = (step >> 3) + (step >> 2) * (nibble & 1) + (step >> 1) * (nibble >> 1 & 1) + step * (nibble >> 2 & 1)
            value = max(-32768, min(32767, value - change if nibble & 8 else value + change))
            index = max(0, min(88, index + int(audio._TURN[nibble])))
            out.append(value)
    return out


def _resampled(x):
    at = lambda i: x[max(0, min(len(x) - 1, i))]
    out = []
    for i in range(len(x)):
        out += [x[i], max(-32768, min(32767, 9 * (x[i] + at(i + 1)) - at(i - 1) - at(i + 2) + 8 >> 4))]
    return np.array(out, "<i2").tobytes()


def _feature(payload):
    n = len(payload)
    mu, a = ([_expanded(law, b) for b in payload] for law in (7, 6))
    coded = [v for s in range(0, n, 576) for v in _adpcm(payload[s : s + 576])]
    root = lambda x, k: math.isqrt(sum(v * v for v in x) // k)
    turns = sum((v < 0) != (w < 0) for v, w in zip(mu, mu[1:]))
    return f"mulaw_rms={root(mu, n)};alaw_rms={root(a, n)};adpcm_rms={root(coded, 2 * n)};peak={max(map(abs, mu))};sign_changes={turns};pcm16k_crc32={zlib.crc32(_resampled(mu)):08x};adpcm_crc32={zlib.crc32(np.array(coded, '<i2').tobytes()):08x}"


def test_media(docs, empty):
    for r in rows(audio.media_digest(docs)).itertuples():
        data = (TEXTS[r.doc_id] or "").encode()
        payload = data + b"\xff" * (-len(data) % 576 or (0 if data else 576))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        media = audio.wav(payload)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest()) and bytes(audio.wav_data(media)[1]) == payload
        pcm = audio.pcm_wav(_resampled([_expanded(7, b) for b in payload]))
        assert (r.pcm_bytes, r.pcm_sha256) == (len(pcm), hashlib.sha256(pcm).hexdigest())
        assert r.feature == _feature(payload)
    assert audio.media_digest(empty).count() == 0
    stored = {r["doc_id"]: r for r in audio.stored_media(docs.where("doc_id < 3")).collect()}
    for i, r in stored.items():
        assert bytes(audio.wav_data(bytes(r["media"]))[1])[: r["n_bytes"]] == TEXTS[i].encode() and bytes(r["pcm"]) == audio.to_pcm(bytes(r["media"]))


def test_media_files_do_not_travel_between_workers(docs):
    """The files, five times their texts, are stored and read back chunk by chunk; the result is that of the stored table."""
    got = audio.media_digest(docs)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, audio.stored_media(docs).mapInArrow(audio._digest, audio.DIGEST).collect()))


def test_companding_tables():
    assert audio.MULAW[[0x00, 0x7F, 0x80, 0xFF]].tolist() == [-32124, 0, 32124, 0]
    assert audio.ALAW[[0x2A, 0xAA, 0x55, 0xD5]].tolist() == [-32256, 32256, -8, 8]


def test_adpcm_against_scalar():
    blocks = np.random.default_rng(1).integers(0, 256, (7, 64), np.uint8)
    got = audio.decode_adpcm(blocks)
    for block, samples in zip(blocks, got, strict=True):
        value, index = int(np.frombuffer(block[:2].tobytes(), "<i2")[0]), min(int(block[2]), 88)
        want = [value]
        for byte in block[4:].tolist():
            for nibble in (byte & 15, byte >> 4):
                step = int(audio._STEPS[index])
                change = (step >> 3) + (step >> 2) * (nibble & 1) + (step >> 1) * (nibble >> 1 & 1) + step * (nibble >> 2 & 1)
                value = max(-32768, min(32767, value - change if nibble & 8 else value + change))
                index = max(0, min(88, index + int(audio._TURN[nibble])))
                want.append(value)
        assert samples.tolist() == want


def test_stored_files_as_pcm(spark):
    import struct

    draws = np.random.default_rng(5)
    codes = draws.integers(0, 256, 256 * 3 + 70, np.uint8)
    adpcm = bytearray(audio.wav(codes.tobytes(), 0x11))
    adpcm[32:34] = struct.pack("<H", 256)  # nBlockAlign; the last block is short
    samples = np.concatenate([audio.decode_adpcm(codes[:768].reshape(3, 256)).reshape(-1), audio.decode_adpcm(codes[None, 768:])[0]])
    files = {7: audio.wav(codes.tobytes()), 6: audio.wav(codes.tobytes(), 6), 0x11: bytes(adpcm), 1: audio.wav(codes.tobytes(), 1)}
    df = spark.createDataFrame([*files.items(), (0, None)], "law int, media binary")
    got = {r["law"]: r["pcm"] for r in audio.decode_media(df).collect()}
    for law, x in ((7, audio.MULAW[codes]), (6, audio.ALAW[codes]), (0x11, samples)):
        pcm = np.frombuffer(audio.wav_data(bytes(got[law]))[1], "<i2")
        assert len(pcm) == 2 * len(x) and (pcm[::2] == x).all()
    assert got[1] is None and got[0] is None


def test_features_do_not_depend_on_segments(monkeypatch):
    payload = memoryview(np.random.default_rng(2).integers(0, 256, 576 * 20, np.uint8).tobytes())
    media = audio.wav(bytes(payload))
    pcm = audio.to_pcm(media)
    whole = audio.features([payload], [audio.wav_data(pcm)[1]])
    monkeypatch.setattr(audio, "SEGMENT", 576 * 3)
    assert audio.to_pcm(media) == pcm
    assert audio.features([payload, payload], [audio.wav_data(pcm)[1]] * 2) == whole * 2


def test_bytes_that_are_no_file_give_null(spark):
    bad = [b"", b"RIFF", audio.wav(b"abc")[:20], bytes(60), b"\xff" * 100]
    df = spark.createDataFrame([(i, x, "own") for i, x in enumerate(bad)], "i int, media binary, pcm string")
    assert [r["pcm"] for r in audio.decode_media(df).collect()] == [None] * len(bad)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(packing.pack_documents(docs))
    total = 0
    for doc_id, own in got.groupby("doc_id"):
        ids = np.array([*full.encode(TEXTS[doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        at = 0
        for k, r in enumerate(own.sort_values("piece").itertuples()):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(ids[at : at + r.length])) and (r.length == 2048 or k == 0)
            at += r.length
        assert at == len(ids)
    assert got["doc_id"].nunique() == len(TEXTS)
    for _, own in got.groupby("sequence_id"):
        at = 0
        for r in own.sort_values("offset").itertuples():
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert got["sequence_id"].nunique() <= -(-total // 2048) + 1
    assert packing.pack_documents(empty).count() == 0


def _best_fit(lengths, capacity):
    """Number of sequences of sequential best-fit decreasing."""
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def _table(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["p", "kind", "id", "size", "places"])


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_sweeps_over_partitions_equal_one_stack(parts):
    """Successors and ranks do not depend on how the sorted entries are cut."""
    entries = [(0, i, draw.randrange(1, 60), draw.choice([1, 1, 3])) for i in range(60)] + [(1, i, draw.randrange(1, 60), 1) for i in range(130)]
    entries.sort(key=lambda e: (-e[2], e[0], e[1]))
    stack, want = [], {}
    for kind, i, _, places in entries:
        if kind == 0:
            stack += [i] * places
        elif stack:
            want[i] = stack.pop()
    cuts = [0, *sorted(draw.sample(range(1, len(entries)), parts - 1)), len(entries)]
    out = []
    for p, (s, e) in enumerate(zip(cuts, cuts[1:])):
        rows = [(p, *entry) for entry in entries[s:e]]
        out += [r for batch in packing.sweep(iter([_table(rows[:5])] + ([_table(rows[5:])] if rows[5:] else []))) for r in batch.to_pylist()]
    counts = [(p, sum(r["p"] == p and r["kind"] == 1 for r in out), sum(r["n"] for r in out if r["p"] == p)) for p in range(parts)]
    runs, served = packing.carried(counts)
    got = {r["id"]: r["seq"] for r in out if r["kind"] == 2}
    left = {(r["p"], r["at"] + k): r["id"] for r in out if r["kind"] == 0 for k in range(r["n"])}
    alone = {(r["p"], r["at"]): r["id"] for r in out if r["kind"] == 1}
    for p, first, n, at, top in runs:
        got |= {alone[p, first + k]: left[at, top - 1 - k] for k in range(n)}
    assert got == want
    assert all((at < served[p]) == (i in got) for (p, at), i in alone.items())


@pytest.mark.parametrize("lengths", [[draw.randrange(1, 65) for _ in range(700)], [3] * 500, [draw.randrange(20, 24) for _ in range(300)], [33] * 20 + [2] * 900, [64] * 5, [1]])
def test_rounds_come_near_sequential_best_fit(spark, lengths):
    df = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long").repartition(3)
    got = rows(packing.pack(df, 64))
    assert sorted(got["length"]) == sorted(lengths)
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 64
    assert got["sequence_id"].nunique() <= 1.02 * _best_fit(lengths, 64) + 1


def test_packing_of_long_runs_and_missing_ids(spark):
    """A run of a million blanks or line ends, with and without characters that only one library is asked for."""
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a" + " " * 1_200_000 + "b", "\n" * 1_100_000, "x" * 300_000, "字" + " \t" * 30_000 + "é", "  " * 9000 + "w", "a  b\n\n c" * 5000, "!" * 1_000_001, "'s" * 100_000, " x" * 300_000]
    for t in texts:
        want = np.array(full.encode(t, add_special_tokens=False).ids, np.uint32)
        assert (packing.byte_bpe(t) == want).all()
    df = spark.createDataFrame([(None, texts[0]), (None, texts[0]), (4, None)], "doc_id long, text string")
    got = rows(packing.pack_documents(df))
    assert got["doc_id"].isna().sum() == len(got) - 1 and not got[["sequence_id", "offset"]].duplicated().any()


def test_topk(spark):
    vectors = [[draw.uniform(-1, 1) for _ in range(12)] for _ in range(300)]
    table = [(i, v) for i, v in enumerate(vectors)] + [(400, None), (420, [1.0, None]), (440, [float("nan")]), (460, [1e300, 1.0]), (480, [0.5]), (481, vectors[7])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    floor = {i: [int(np.floor(64 * x)) for x in v] for i, v in table if v and None not in v and np.isfinite(v).all()}
    got = rows(topk.exact_topk(df, 5))
    for q in (i for i in floor if i % 20 == 0):
        best = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(floor[q], v)))), i) for i, v in floor.items() if i != q)[:5]
        own = got[got.query_id == q].sort_values("rank")
        assert own["vec_id"].tolist() == [i for _, i in best] and own["rank"].tolist() == [1, 2, 3, 4, 5]
        assert own["score"].tolist() == [-s for s, _ in best]
    assert topk.exact_topk(df.where("false")).count() == 0
    assert len(topk.exact_topk(df.where("vec_id < 3")).collect()) == 2


def _topk(table, k, every=20):
    floor = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in table]
    out = []
    for q in sorted({i for i, _ in floor if i % every == 0}):
        own = min(v for i, v in table if i == q)
        own = [int(np.floor(64 * x)) for x in own]
        best = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(own, v)))), i) for i, v in floor if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return out


def test_topk_of_repeated_ids_and_large_scores(spark, monkeypatch):
    table = [(20, [0.5, 0.5]), (20, [1.0, 0.0]), (1, [0.3, 0.1]), (3, [0.2, 0.9]), (3, [0.2, 0.9]), (5, [2.0**25, 1.5 * 2.0**24]), (40, [2.0**25, 2.0**24]), (-60, [-(2.0**25), 1.0]), (60, [1.0] * 2), (60, [1.0] * 2)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.exact_topk(df, 3).collect())) == _topk(table, 3)
    assert max(r["score"] for r in topk.exact_topk(df, 3).collect()) > 1 << 62
    monkeypatch.setattr(topk, "QUERY_BYTES", 16)  # a query a round
    assert sorted(map(tuple, topk.exact_topk(df, 20).collect())) == _topk(table, 20)


def test_topk_compacts_candidates_on_mass_bounds():
    """Where masses differ most candidates go before their last dimension, and none that counts."""
    r = np.random.default_rng(4)
    x = np.floor(r.normal(0, 40, (4000, 64)) * np.linspace(2, 0.05, 64))
    q, ids = x[:8], np.arange(4000)
    best = topk.Best(ids[:8], np.ascontiguousarray(q.T), 10)
    whole = topk.mass(np.ascontiguousarray(x.T))
    order = np.argsort(-whole[0], kind="stable")
    for s in range(0, 4000, 500):
        at = order[s : s + 500]
        best.offer(ids[at], np.ascontiguousarray(x[at].T), whole[:, at])
    scores = (q @ x.T).astype(np.int64)
    for k in range(8):
        want = sorted((-s, i) for i, s in enumerate(scores[k].tolist()) if i != k)[:10]
        assert list(zip((-best.score[k]).tolist(), best.vec[k].tolist(), strict=True)) == want
    assert best.dropped > 0.5 * best.seen


def test_sharding(docs, empty):
    got = rows(sharding.shard_digest(docs))
    assert sorted(got["doc_id"]) == list(range(len(TEXTS)))
    for r in got.itertuples():
        data = (TEXTS[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "bytes")
    assert got.assign(t=got["doc_id"].map(lambda i: TEXTS[i] or "")).groupby("t")["shard"].nunique().max() == 1
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert sharding.shard_digest(empty).count() == 0


def test_shard_files_write_every_row(spark, tmp_path):
    table = [(None, "a b"), (None, "a b"), (1, "a b"), (1, "c " * 9), (1, "c " * 9), (2, "c " * 9), (3, None), (None, "d")]
    df = spark.createDataFrame(table, "doc_id long, text string")
    sharding.shard_files(df, str(tmp_path / "out"), 3)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(map(str, table)) == sorted(str((r["doc_id"], r["text"])) for r in got)
    for t in {t for _, t in table}:
        assert len({r["shard"] for r in got if r["text"] == t}) == 1
    assert len({(r["shard"], r["slot"]) for r in got}) == len(table)


def test_schedule_equals_heap():
    import heapq

    for _ in range(30):
        loads = [draw.randrange(50) for _ in range(5)]
        weight, count = draw.randrange(1, 9), draw.randrange(60)
        heap = [(load, j) for j, load in enumerate(loads)]
        heapq.heapify(heap)
        want = [0] * 5
        for _ in range(count):
            load, j = heapq.heappop(heap)
            want[j] += 1
            heapq.heappush(heap, (load + weight, j))
        assert sharding.spread(loads, weight, count) == want


def _fingerprint(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(fps, radius=4):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in fps:
        for j in fps:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in fps}


def test_simhash(docs, empty):
    got = rows(simhash.near_duplicates(docs)).set_index("doc_id")
    fps = {i: _fingerprint(t) for i, t in enumerate(TEXTS)}
    assert {i: f"{f:016x}" for i, f in fps.items()} == got["fingerprint"].to_dict()
    assert _classes(fps) == got["component_id"].to_dict()
    assert simhash.near_duplicates(empty).count() == 0


def test_every_close_pair_meets_and_full_buckets_too(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 3)
    points = []
    for _ in range(60):
        base = draw.getrandbits(64)
        points += [base] + [base ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(1, 7))) for _ in range(4)]
    for a in points[:50]:
        b = a ^ sum(1 << i for i in draw.sample(range(64), 4))
        assert any(a & m == b & m for m in simhash.masks(0)) and any(a & m == b & m for m in simhash.masks(1))
    points = sorted(set(points))
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    want = _classes(dict(enumerate(points)))
    low = {}
    for i, c in want.items():
        low[c] = min(low.get(c, 1 << 70), signed[i])
    assert {signed[i]: low[c] for i, c in want.items()} == {s: roots.get(s, s) for s in signed}


def test_few_edges_take_few_queries_and_give_the_components_of_steps(spark, monkeypatch):
    path = [(i, i + 1) for i in range(60)] + [(1000, -7), (-7, 2000), (5, 5)]
    for kind, name in (("long", int), ("binary", lambda i: f"{i + 7:05}".encode())):
        df = spark.createDataFrame([(name(a), name(b)) for a, b in path], f"a {kind}, b {kind}")
        found = {}
        for most in (1 << 17, 0):
            monkeypatch.setattr(simhash, "TOGETHER", most)
            spark.sparkContext.setJobGroup(f"components-{kind}-{most}", "")
            roots = {_plain(r["node"]): _plain(r["root"]) for r in simhash.components(df).collect()}
            found[most] = roots, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"components-{kind}-{most}"))
        want = {name(i): name(0) for i in range(1, 61)} | {name(1000): name(-7), name(2000): name(-7)}
        assert found[0][0] == found[1 << 17][0] == want
        assert found[1 << 17][1] <= 8 < found[0][1]
        assert simhash.components(df.where("false")).count() == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _plain(x):
    return bytes(x) if isinstance(x, bytearray) else x


def test_stored_tables_trim_the_driver(spark, monkeypatch):
    from sievework.operators import store

    assert "Trim native heap" in store.trimmed_driver(spark)
    seen = []
    monkeypatch.setattr(store, "trimmed_driver", seen.append)
    assert store.stored(spark.range(3), "trim").count() == 3 and seen == [spark]


def _shingles(text):
    words = WORD.findall((text or "").encode().lower())
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _jaccard_kept(texts):
    """Indexes of the first text of each component of pairs with a Jaccard index of 0.8 or more."""
    sets = [_shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                old, new = sorted((root[i], root[j]), reverse=True)
                root = [new if r == old else r for r in root]
    return [i for i, r in enumerate(root) if i == r]


@pytest.mark.parametrize(("counters", "block", "bucket"), [(1 << 20, 2048, 2_000_000), (16, 3, 50)])
def test_representatives_by_jaccard(spark, monkeypatch, counters, block, bucket):
    from sievework.llm import jaccard

    monkeypatch.setattr(jaccard, "COUNTERS", counters)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    r = random.Random(11)
    texts = ["", None, "one two", "ONE  two", "one two three"]
    for k in range(30):
        words = r.choices(VOCABULARY, k=r.randrange(20, 300))
        words = PASSAGE.split()[:50] + words if k % 3 == 0 else words
        texts.append(" ".join(words))
        for _ in range(6):
            changed = list(words)
            for _ in range(r.randrange(1, 2 + len(words) // 40)):
                changed[r.randrange(len(words))] = r.choice(VOCABULARY)
            texts.append(" ".join(changed))
    r.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = _jaccard_kept(texts)
    assert sorted(x["doc_id"] for x in simhash.keep_representatives(df).collect()) == want
    assert want != sorted(i for i, c in _classes({i: _fingerprint(t) for i, t in enumerate(texts)}).items() if i == c)
    assert simhash.keep_representatives(df.where("false")).count() == 0


def _near_copies(r, families, size, length, changes):
    """Texts of few words, each copied with some words changed: many links, many pairs just under the bound."""
    texts = []
    for _ in range(families):
        words = r.choices(VOCABULARY, k=length)
        for _ in range(size):
            changed = list(words)
            for _ in range(r.randrange(changes + 1)):
                changed[r.randrange(length)] = r.choice(VOCABULARY)
            texts.append(" ".join(changed))
    return texts


def test_near_copies_give_no_pairs_to_be_stored(spark, monkeypatch):
    """A family of 300 texts has 44,850 pairs; no table between the steps may grow like that."""
    from sievework.llm import jaccard

    texts = _near_copies(random.Random(5), 1, 300, 120, 5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    made, store = {}, jaccard.materialise

    def counted(table, tag):
        out = store(table, tag)
        made[tag] = out.count()
        return out

    monkeypatch.setattr(jaccard, "materialise", counted)
    assert sorted(x["doc_id"] for x in simhash.keep_representatives(df).collect()) == _jaccard_kept(texts)
    assert max(made.values()) < 20 * len(texts), made


@pytest.mark.parametrize(("hot", "block", "weight"), [(1, 3, 1 << 12), (5, 50, 1 << 14)])
def test_hot_shingles_and_large_families_are_settled_whole(spark, monkeypatch, hot, block, weight):
    from sievework.llm import jaccard

    for name, value in (("HOT", hot), ("BLOCK", block), ("WEIGHT", weight), ("COUNTERS", 1 << 12)):
        monkeypatch.setattr(jaccard, name, value)
    texts = _near_copies(random.Random(6), 6, 25, 60, 3) + [PASSAGE] * 5 + ["", None, "one", "ONE"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert sorted(x["doc_id"] for x in simhash.keep_representatives(df).collect()) == _jaccard_kept(texts)


def test_tasks_of_families_gather_no_more_bytes_than_their_weight(spark, monkeypatch):
    """Texts that repeat a few lines have small sets, by which tasks are dealt; what meets in a task may not be larger."""
    from sievework.llm import jaccard

    r, most, gathered = random.Random(8), [], jaccard._gathered
    lines = [" ".join(r.choices(VOCABULARY, k=12)) + "\n" for _ in range(12)]
    texts = [line * r.randrange(300, 600) + "x " * k for line in lines for k in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)

    def measured(rows, sizes):
        out = gathered(rows, sizes)
        held = sum((F.octet_length(c) for c, kind in rows.dtypes if kind in ("string", "binary")), F.lit(0))
        most.append(out.groupBy("g", "i", "j").agg(F.sum(held).alias("held")).agg(F.max("held")).first()[0] or 0)
        return out

    monkeypatch.setattr(jaccard, "_gathered", measured)
    monkeypatch.setattr(jaccard, "WEIGHT", 1 << 16)
    assert sorted(x["doc_id"] for x in simhash.keep_representatives(df).collect()) == _jaccard_kept(texts)
    assert most and max(most) < 4 << 16, most


def test_near_duplicate_stage_goes_by_fingerprints(spark, monkeypatch):
    """Every text's SimHash of five-word shingles goes through the covering, and what it links is one class."""
    from sievework.llm import jaccard

    texts = _near_copies(random.Random(7), 4, 12, 150, 2)
    sets = [np.unique(jaccard.shingles([t.encode()])[0]) for t in texts]
    want = [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in s) > len(s)) for s in sets]
    bit = lambda x: int.from_bytes(np.packbits(np.unpackbits(np.array([x], "<u8").view(np.uint8), bitorder="little").reshape(8, 8)[:, ::-1].ravel()).tobytes(), "little", signed=True)
    assert [jaccard.simhash(s) for s in sets] == [bit(x) for x in want]
    seen, links = [], jaccard.links
    monkeypatch.setattr(jaccard, "links", lambda points, tag: (seen.append(sorted(r["fp"] for r in points.collect())), links(points, tag))[1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(x["doc_id"] for x in simhash.keep_representatives(df).collect()) == _jaccard_kept(texts)
    assert seen == [sorted({jaccard.simhash(s) for s in sets})]


def test_representatives_with_shared_doc_ids(spark):
    """Unlike texts of one doc_id both stay; the one that repeats an earlier document goes."""
    a, b = PASSAGE, "alpha beta gamma delta epsilon zeta eta"
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (4, "x y"), (4, "z"), (4, "z")], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_representatives(df).collect())) == sorted([(1, a), (2, b), (4, "x y"), (4, "z")])


def test_token_counts(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    vocabulary = token_counts.word_vocabulary(path) | {bytes([b]) for b in range(256)}
    longest = max(map(len, vocabulary))

    def count(word):
        at = n = 0
        while at < len(word):
            at = next(e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in vocabulary)
            n += 1
        return n

    got = rows(token_counts.token_counts(docs, path)).set_index("doc_id")
    for i, t in enumerate(TEXTS):
        words = WORD.findall((t or "").encode().lower())
        assert (got["n_words"][i], got["n_tokens"][i]) == (len(words), sum(map(count, words)))
    assert token_counts.token_counts(empty, path).count() == 0
    small = token_counts.LongestMatch([b"ab", b"abcd", b"bc", b"cde"])
    assert [small.count(w) for w in (b"abce", b"abcd", b"abcde", b"bcde", b"")] == [3, 1, 2, 3, 0]


def test_byte_bpe(docs, empty):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(byte_bpe.encode_digest(docs, path)).set_index("doc_id")
    for i, t in enumerate(TEXTS):
        ids = known.encode_ordinary(t or "")
        assert got["n_tokens"][i] == len(ids) and got["ids_sha256"][i] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got["decoded_sha256"][i] == hashlib.sha256((t or "").encode()).hexdigest()
    bpe = byte_bpe.ByteBpe(path)
    odd = ["".join(draw.choices("ab'slremdtv \n\t12é!　 ", k=draw.randrange(40))) for _ in range(800)] + ["a" * 400 + "!" * 300]
    assert bpe.encode([t.encode() for t in odd]) == [known.encode_ordinary(t) for t in odd]
    assert byte_bpe.encode_digest(empty, path).count() == 0


def test_long_texts_are_encoded_in_parts_and_decoded_by_offsets(spark, monkeypatch):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(byte_bpe, "CHUNK", 64)
    bpe = byte_bpe.ByteBpe(path)
    for text in ["".join(draw.choices("abé's  \n\t1!字 ", k=draw.randrange(900))) for _ in range(60)] + ["a" * 3000, " b" * 900, "\n" * 700, "é" * 900 + " x" * 99]:
        assert b"".join(byte_bpe.parts(text.encode())) == text.encode()
        ids = bpe.encode([text.encode(), b"short"])
        assert ids == [known.encode_ordinary(text), known.encode_ordinary("short")]
        own = np.array(ids[0], np.int64)
        assert bpe.decode(own, bpe.offsets(own)) == text.encode()
    df = spark.createDataFrame([(1, "a 字 b"), (None, ""), (2, None), (1, "a 字 b")], "doc_id long, text string")
    back = byte_bpe.decode_texts(byte_bpe.encode_texts(df, path), path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.fillna("", ["text"]).collect()))


def _windows_removed(texts, size=20):
    seen, out = set(), []
    for t in texts:
        words = WORD.findall((t or "").encode())
        cover = [False] * len(words)
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                cover[k : k + size] = [True] * size
            seen.add(window)
        out.append((len(words), sum(cover), hashlib.sha256(b" ".join(w for w, c in zip(words, cover, strict=True) if not c)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [200_000, 50])
def test_substring(docs, empty, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_WORDS", hot)
    got = rows(substring.dedup_digest(docs)).sort_values("doc_id")
    assert list(got[["n_words", "n_removed", "kept_sha256"]].itertuples(index=False, name=None)) == _windows_removed(TEXTS)
    assert substring.dedup_digest(empty).count() == 0


def test_drop_repeats_keeps_columns(docs):
    cut = substring.drop_repeats(docs)
    assert cut.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in cut.collect()}
    for i, (n, removed, digest) in enumerate(_windows_removed(TEXTS)):
        assert kept[i] == TEXTS[i] if not removed else hashlib.sha256(kept[i].encode()).hexdigest() == digest


def test_repeated_rows_and_missing_ids(spark):
    df = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (None, PASSAGE), (2, PASSAGE)], "doc_id long, text string")
    got = rows(substring.dedup_digest(df))
    assert sorted(zip(got["doc_id"].fillna(-1), got["n_removed"], strict=True)) == [(-1, 0), (1, 0), (1, 0), (2, 60)]
    assert rows(simhash.near_duplicates(df))["component_id"].tolist() == [1] * 4
    assert simhash.keep_representatives(df).where("doc_id is not null").count() == 1
    assert sharding.shard_digest(df).select("shard").distinct().count() == 1


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_quality(docs, real):
    got = rows(quality.score_documents(*real)).merge(real[1].toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.95 and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    odd = rows(quality.score_documents(docs, real[1].where("false")))
    assert (odd["score"] == 0.5).all() and len(odd) == len(TEXTS)
    assert quality.keep_quality(docs, *real).columns == docs.columns
    assert quality.score_documents(real[0].where("false"), real[1]).count() == 0


def test_quality_equals_normal_equations_and_isotonic_regression_worked_out_at_once(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    texts, marks = rows(docs).set_index("doc_id")["text"], rows(labels).set_index("doc_id")["quality"]
    ids = np.array([i for i in marks.index if zlib.crc32(str(i).encode()) % 5])
    y = marks[ids].to_numpy(float)
    stats = quality.statistics([texts[i].encode() for i in ids])
    mean, scale = stats.mean(0), np.maximum(stats.std(0), 1e-6)
    z = quality.fourier(stats, mean, scale)

    def solved(z, y):
        return np.linalg.solve(z.T @ z + quality.RIDGE * max(1.0, len(z)) / quality.FEATURES * np.eye(z.shape[1]), z.T @ y)

    fold = ids * 2654435761 % (1 << 32) % quality.FOLDS
    raw = np.empty(len(y))
    for f in range(quality.FOLDS):
        raw[fold == f] = z[fold == f] @ solved(z[fold != f], y[fold != f])
    order = np.argsort(raw)
    x, t = raw[order], y[order]
    total = np.concatenate([[0], np.cumsum(t)])
    fitted = [max(min((total[k] - total[j]) / (k - j) for k in range(i + 1, len(t) + 1)) for j in range(i + 1)) for i in range(len(t))]
    every = quality.fourier(quality.statistics([texts[i].encode() for i in texts.index]), mean, scale) @ solved(z, y)
    want = dict(zip(texts.index, np.interp(every, x, fitted), strict=True))
    got = rows(quality.score_documents(docs, labels)).set_index("doc_id")["score"]
    assert max(abs(want[i] - got[i]) for i in texts.index) < 1e-6


def test_isotonic():
    x, y = quality.isotonic(np.array([1.0, 2, 2, 3, 4]), np.array([0.0, 1, 0, 0, 1]))
    assert (np.diff(y) >= 0).all() and y[0] == 0 and y[-1] == 1


def test_statistics_of_odd_texts():
    stats = quality.statistics([b"", b" ", b"\n\n", b"a", "é".encode() * 9, b"x " * 9000])
    assert np.isfinite(stats).all() and stats.shape == (6, len(quality.STATISTICS))


def test_toxicity(docs, real):
    got = rows(toxicity.score_documents(*real)).merge(real[1].toPandas(), on="doc_id")
    assert got[got["toxic"] == 1]["predicted"].mean() > 0.8 and got[got["toxic"] == 0]["predicted"].mean() < 0.03
    assert rows(toxicity.score_documents(docs, real[1].where("false")))["predicted"].sum() == 0
    assert toxicity.keep_clean(docs, *real).columns == docs.columns


def test_toxic_rows_that_no_fit_saw_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = rows(toxicity.score_documents(docs, labels)).merge(rows(labels), on="doc_id")
    held = got[[zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]]
    assert held[held["toxic"] == 1]["predicted"].mean() >= 0.9 and held[held["toxic"] == 0]["predicted"].mean() < 0.01
    assert toxicity.score_documents(docs.where("false"), labels).count() == 0


def test_chain_helpers_never_see_the_fold_they_predict():
    """Terms, markers and weights: whatever the labels of a fold are, the probabilities it is trained with stay."""
    r = np.random.default_rng(0)
    x, y, fold = (r.random((120, 9)) < 0.4).astype(np.float32), (r.random(120) < 0.5).astype(float), np.arange(120) % 4
    views = [toxicity.View(np.sort(r.choice(9, 6, False)), np.arange(6) < 3) for _ in range(5)]
    seen = np.zeros((120, 3), np.float32)
    for c in (0, 1):
        for f in range(4):
            left, v = fold == f, views[1 + f]
            held = x[:, v.columns[v.markers]].sum(1)
            target = y * (held >= (1, 3)[c])
            inputs = np.concatenate([x[:, v.columns], seen[:, :c]], 1)
            w = toxicity.logistic(inputs[~left], target[~left], np.arange((~left).sum()))
            seen[left, c] = 1 / (1 + np.exp(-(w[0] + inputs[left] @ w[1:])))
    last = toxicity.logistic(np.concatenate([x[:, views[0].columns], seen[:, :2]], 1), y, np.arange(120))
    assert np.allclose(toxicity.fit_chain(x, y, fold, views[0], views[1:])[2], last, atol=1e-4)


def test_clashing_columns(spark, real, tmp_path):
    """Columns that bear the operators' own names come through; only shard and slot give way to the new ones."""
    names = ["_ranges", "_text", "_doc", "_rid", "row", "ranges", "rid", "shard", "slot", "key", "_row", "_node", "_key", "_score", "_toxic", "pos", "n_chars", "pcm", "media"]
    table = [(i, t, *(f"{n}{i}" for n in names)) for i, t in enumerate([PASSAGE, "x " + PASSAGE, None, "", PASSAGE])]
    df = spark.createDataFrame(table, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    df = df.withColumn("n_chars", F.length("text"))
    for f in (substring.drop_repeats, simhash.keep_representatives, lambda d: quality.keep_quality(d, *real), lambda d: toxicity.keep_clean(d, *real)):
        out = f(df)
        assert out.columns == df.columns
        for r in out.collect():
            assert all(r[n] == f"{n}{r['doc_id']}" for n in names if n != "n_chars")
    sharding.shard_files(df, str(tmp_path / "out"), 2)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(got.columns) == sorted(df.columns) and got.count() == 5 and dict(got.dtypes)["shard"] == "int"


def test_rows_without_ids(spark, real):
    """They are rows like any other: encoded, packed, scored, put in shards."""
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, None), (7, "a b c")], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    for out in (audio.media_digest(df), byte_bpe.encode_digest(df, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), packing.pack_documents(df), sharding.shard_digest(df), token_counts.token_counts(df, path), quality.score_documents(df, real[1]), toxicity.score_documents(df, real[1]), simhash.near_duplicates(df), substring.dedup_digest(df)):
        got = rows(out)
        assert len(got) == 4 and got["doc_id"].isna().sum() == 3
    near = rows(simhash.near_duplicates(df))
    assert near["component_id"].fillna(-1).tolist().count(7) == 3


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null and empty texts, repeated rows, ties, missing ids, long runs, extra columns; and no documents at all."""
    import corpus_pipeline

    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(None, None), (5000, None), (5001, ""), (5002, " \n"), (5003, PASSAGE), (5003, PASSAGE), (5004, PASSAGE), (None, PASSAGE), (5005, "w" * 30_000 + " " * 30_000)]
    extra = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for name, docs in (("odd", base.unionByName(extra).withColumns({"_row": F.lit(1), "row": F.lit("x"), "shard": F.lit(2)})), ("none", base.where("false"))):
        sf = str(tmp_path / name)
        docs.write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        packed = rows(corpus_pipeline.run(spark, sf))
        assert (len(packed) > 0) == (name == "odd") and not packed[["sequence_id", "offset"]].duplicated().any()
        at = spark.read.parquet(f"{sf}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:4]:
            after = stage(spark, at, sf)
            assert after.columns == at.columns and after.count() <= at.count()
            at = after
    assert set(packed.columns) >= {"doc_id", "piece", "sequence_id"}


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    before = rows(docs)
    kept = rows(quality.score_documents(docs, labels))
    clean = rows(toxicity.score_documents(docs, labels))
    left = before[before["doc_id"].isin(kept[kept["predicted"] == 1]["doc_id"]) & before["doc_id"].isin(clean[clean["predicted"] == 0]["doc_id"])].sort_values("doc_id")
    left = left.iloc[_jaccard_kept(left["text"].tolist())]
    want = sum(n - r for n, r, _ in _windows_removed(left["text"].tolist()))
    at = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        at = stage(spark, at, sf)
        assert at.columns == docs.columns, name
    done = rows(at)
    assert sorted(done["doc_id"]) == sorted(left["doc_id"])
    assert sum(len(WORD.findall(t.encode())) for t in done["text"]) == want
    assert (done["n_chars"] == done["text"].str.len()).all()
    packed = rows(corpus_pipeline.run(spark, sf))
    assert set(packed["doc_id"]) == set(left["doc_id"])
