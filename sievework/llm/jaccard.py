"""SimHash near-duplicates of five-word shingles, held to a Jaccard index of 0.8, exact.

Candidates come first. Every text has a SimHash fingerprint of its distinct shingles; fingerprints within the radius
meet by `simhash.links` and put their texts into one class. Texts at an index of 4/5 often lie further apart than a
covering reaches, so a second way completes it: two sets of index 4/5 or more share at least ceil(4n/5) shingles, so
under any one order of all shingles their first n - ceil(4n/5) + 1 have one in common. The order here is by estimated
number of occurrences, rare shingles first, then by hash; the estimate is one table of counters of fixed size over
all documents (a counter shared by several shingles costs time, not pairs). All texts with a common first shingle
belong to the star of the least of them. In each star the classes that SimHash left apart are joined where sizes and
a sketch, whose distance never exceeds the sets' symmetric difference, allow an index of 4/5.

Classes joined so are families, and every link lies inside a family. The set of each text of a family is then shipped
there once, and the sets themselves decide; texts, which may be far longer than their sets, are not shipped. Both in stars and in families a spanning forest is looked for, never all
pairs: what is reached is not looked at again, so a group of n texts gives n - 1 edges at most. Equal word sequences
count as one text. A shingle is a 64-bit hash of its words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import byte_texts, chunks, dropped, joined_unevenly, materialise, settled, trim, trimmed
from sievework.llm.simhash import SEED, components, links

SHINGLE = 5
#: Counters of the estimate (2 ** 20) go to the driver and back as SLICES arrays, 8 MB in all.
COUNTERS, SLICES = 1 << 20, 16
CELLS, MORE_CELLS, LONG = 64, 1024, 800
BUCKET, BLOCK, CHUNK = 500_000, 2048, 1 << 20
#: A shingle that may occur more often than this is gathered in no bucket.
HOT = 50_000
#: Bytes of sketches or of shingle sets that meet in a task, and bits of the filter of texts that families want (1 MB).
WEIGHT, BITS = 8 << 20, 1 << 23
_ODD = np.array([pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) | 1 for j in range(SHINGLE)], np.uint64)


def text_key(text: bytes) -> bytes:
    """128 bits of the lower-cased words; empty texts share one."""
    import xxhash

    return xxhash.xxh3_128_digest(b" ".join(text.lower().split()), SEED)


def _mixed(g: np.ndarray) -> np.ndarray:
    g = (g ^ (g >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return g ^ (g >> np.uint64(29))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, repeats included, and the index of each one's text.

    Fewer words than a shingle has are one shingle, no words give none.
    """
    import xxhash

    words = [t.lower().split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(n.sum()))
    ends = np.cumsum(n)
    owner = np.repeat(np.arange(len(texts)), n)
    whole = np.flatnonzero(np.arange(len(h)) + SHINGLE <= ends[owner])
    g = np.zeros(len(whole), np.uint64)
    for j in range(SHINGLE):
        g += h[whole + j] * _ODD[j]
    few = np.flatnonzero((n > 0) & (n < SHINGLE))
    short = np.array([sum(int(x) * int(o) for x, o in zip(h[ends[i] - n[i] : ends[i]], _ODD, strict=False)) + int(n[i]) & (1 << 64) - 1 for i in few], np.uint64)
    return np.concatenate([_mixed(g), _mixed(short)]), np.concatenate([owner[whole], few])


def shingle_sets(texts: list[bytes], rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, by text and ascending (by their counter in `rank` first), and the bounds of each text's part."""
    g, owner = shingles(texts)
    if rank is None:
        order = np.lexsort((g, owner))
    else:
        order = np.lexsort((g, owner << 40 | np.minimum(rank[(g % np.uint64(len(rank))).astype(np.int64)], (1 << 40) - 1)))
    g, owner = g[order], owner[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
    g, owner = g[new], owner[new]
    return g, np.searchsorted(owner, np.arange(len(texts) + 1))


def _counted(docs: DataFrame) -> np.ndarray:
    """Number of occurrences of the shingles that share a counter. What the driver gets has a fixed size."""
    width = COUNTERS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            texts = byte_texts(batch.column(0))
            for a, b in chunks([len(t) for t in texts], CHUNK):
                total += np.bincount((shingles(texts[a:b])[0] % COUNTERS).astype(np.int64), minlength=COUNTERS)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([np.minimum(x, (1 << 31) - 1).astype("<u4").tobytes() for x in total.reshape(SLICES, width)], pa.binary())], ["slice", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for x in table["counts"]:
            total += np.frombuffer(x.as_buffer(), "<u4")
        return pa.table({"slice": table["slice"][:1], "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    found = docs.select("text").mapInArrow(trimmed(count), "slice int, counts binary").groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()
    out = np.zeros((SLICES, width), np.int64)
    for r in found:
        out[r["slice"]] = np.frombuffer(r["counts"], "<i8")
    return out.ravel()


def simhash(g: np.ndarray) -> int:
    """64 bits, each set in over half of the (distinct) shingle hashes."""
    ones = np.zeros(64, np.int64)
    for s in range(0, len(g), 1 << 16):
        ones += np.unpackbits(g[s : s + (1 << 16)].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(g)).tobytes(), "little", signed=True)


def _marked(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """id, key, n, fp (fingerprint), cells and the first shingles of every text that has words."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(0))
            for a, b in chunks([len(t) for t in texts], CHUNK):
                g, bounds = shingle_sets(texts[a:b], shared.value)
                size = np.diff(bounds)
                owner = np.repeat(np.arange(b - a), size)
                coarse = np.bincount(owner * CELLS + (g % CELLS).astype(np.int64), minlength=(b - a) * CELLS).reshape(-1, CELLS)
                rows = []
                for i in np.flatnonzero(size).tolist():
                    n, s = int(size[i]), int(bounds[i])
                    cells = coarse[i] if n < LONG else np.bincount((g[s : s + n] % MORE_CELLS).astype(np.int64), minlength=MORE_CELLS)
                    key = text_key(texts[a + i])
                    rows.append((_id(key), key, n, simhash(g[s : s + n]), np.minimum(cells, 65535).astype("<u2").tobytes(), g[s : s + n - (4 * n + 4) // 5 + 1].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["id", "key", "n", "fp", "cells", "first"])

    return docs.select("text").mapInArrow(trimmed(run), "id long, key binary, n long, fp long, cells binary, first binary")


def _id(key: bytes) -> int:
    """What stands for a text while candidates are sought; texts are told apart by the whole key."""
    return int.from_bytes(key[:8], "little", signed=True)


def _starred(sig: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all (shingle, id) pairs of some shingles: the least id with each shingle, and the others with it."""
    sig, ids = _distinct(sig, ids)
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    centre = ids[np.flatnonzero(new)][np.cumsum(new) - 1] if len(sig) else ids
    away = centre != ids
    return _distinct(centre[away], ids[away])


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


_WORDS = np.dtype("<u8")


def _stars(marked: DataFrame, counts: np.ndarray) -> DataFrame:
    """Edges (a, b): a star's name and a text in it. Texts with a common first shingle have a star in common.

    A star is named for the least of its texts, which is no edge. Pairs go to buckets as packed arrays. A shingle that
    may occur over HOT times is not gathered: it makes a star of its own, of its own name.
    """
    total = marked.agg(F.sum(F.octet_length("first"))).first()[0] or 0
    buckets = max(1, -(-total // (8 * BUCKET)))
    hot = np.packbits(counts > HOT)
    shared = marked.sparkSession.sparkContext.broadcast((hot, len(counts))) if hot.any() else None

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column(1).to_pylist()
            sig = np.frombuffer(b"".join(first), _WORDS)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(f) // 8 for f in first])
            at = ((sig >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            if shared:
                bits, size = shared.value
                often = np.unpackbits(bits)[(sig % np.uint64(size)).astype(np.int64)].astype(bool)
                at[often] = -1 - ids[often] % buckets
            order = np.argsort(at, kind="stable")
            sig, ids, at = sig[order], ids[order], at[order]
            used, bounds = np.unique(at, return_index=True)
            pack = lambda x: pa.array([p.tobytes() for p in np.split(x, bounds[1:])][: len(used)], pa.binary())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pack(sig), pack(ids)], ["bucket", "sig", "ids"])

    def star(table: pa.Table) -> pa.Table:
        sig, ids = (np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in (("sig", _WORDS), ("ids", "<i8")))
        a, b = _starred(sig, ids) if table["bucket"][0].as_py() >= 0 else _distinct(sig.view("<i8"), ids)
        trim()
        return pa.table({"a": a, "b": b})

    dealt = marked.select("id", "first").mapInArrow(trimmed(deal), "bucket long, sig binary, ids binary")
    return dealt.groupBy("bucket").applyInArrow(star, "a long, b long").distinct()


def close(n: np.ndarray, sketches: list[np.ndarray], folded: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Which of `others` can have an index of 4/5 with set i: at most a ninth of both sizes may differ."""
    apart = np.maximum(np.abs(folded[others] - folded[i]).sum(1), np.abs(n[others] - n[i]))
    near = 9 * apart <= n[others] + n[i]
    if len(sketches[i]) > CELLS:
        for k in np.flatnonzero(near).tolist():
            j = others[k]
            near[k] = len(sketches[j]) == CELLS or 9 * np.abs(sketches[j] - sketches[i]).sum() <= n[i] + n[j]
    return near


def _unpacked(cells: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    sketches = [np.frombuffer(c, "<u2").astype(np.int32) for c in cells]
    return sketches, np.stack([x.reshape(-1, CELLS).sum(0) for x in sketches])


def spanning(root: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """Edges (indexes) of a spanning forest of the links that `near` tells; points of equal root are linked already.

    Each point looks once at those not reached yet.
    """
    left, a, b = np.arange(len(root)), [], []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            i = front.pop()
            same = root[left] == root[i]
            new = near(i, left)
            new[same] = False
            a += [i] * int(new.sum())
            b += left[new].tolist()
            front += left[new | same].tolist()
            left = left[~(new | same)]
    return a, b


def _slices(by: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])).tolist()
    return zip(starts, [*starts[1:], len(by)], strict=True)


def _gathered(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """rows (by, id, ...) with g, i, j, which tell where they meet. sizes: by, size (rows), weight (bytes) of each group.

    Many groups share a task. A group over BLOCK rows or WEIGHT bytes is cut into blocks that meet in pairs, a task
    each, so no task grows with a group and every two of its rows still meet. Both tables are stored ones.
    """
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / WEIGHT)).cast("long")
    sizes = sizes.withColumn("blocks", blocks)
    tasks = max(1, -(-(sizes.where("blocks = 1").agg(F.sum("weight")).first()[0] or 0) // WEIGHT))
    dealt = joined_unevenly(rows, sizes.select("by", "blocks", "size"), "by", "size")
    none = F.lit(-1).cast("long")
    small = dealt.where("blocks = 1").select(F.pmod(F.xxhash64("by"), F.lit(tasks)).alias("g"), none.alias("i"), none.alias("j"), *rows.columns)
    big = dealt.where("blocks > 1").withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("part <> other")
    return small.unionByName(big.select(F.col("by").alias("g"), F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), *rows.columns))


def _joined_classes(stars: DataFrame, about: DataFrame) -> DataFrame:
    """Edges (a, b) of classes whose texts share a star and may have an index of 4/5."""
    places = stars.select(F.col("a").alias("by"), F.col("b").alias("id")).unionByName(stars.select(F.col("a").alias("by"), F.col("a").alias("id")).distinct())
    members = materialise(places.join(about.select("id", "n", "cells", "class"), "id").select("by", "id", "n", "cells", "class"), "jaccard-members")
    sizes = members.groupBy("by").agg(F.min("class").alias("x"), F.max("class").alias("y"), F.count("*").alias("size"), F.sum(F.octet_length("cells") + 16).alias("weight"))
    sizes = materialise(sizes.where("x <> y").select("by", "size", "weight"), "jaccard-sizes")

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("by")
        n, of = table["n"].to_numpy(), table["class"].to_numpy()
        cells, u, v = table["cells"].to_pylist(), [], []
        for s, e in _slices(table["by"].to_numpy()):
            sketches, folded = _unpacked(cells[s:e])
            a, b = spanning(of[s:e], lambda i, left: close(n[s:e], sketches, folded, i, left))  # noqa: B023
            u.append(of[s:e][a])
            v.append(of[s:e][b])
        trim()
        u, v = np.concatenate(u), np.concatenate(v)
        return pa.table(dict(zip("ab", _distinct(np.minimum(u, v), np.maximum(u, v)), strict=True)))

    return _gathered(members, sizes).groupBy("g", "i", "j").applyInArrow(meet, "a long, b long")


def with_key(docs: DataFrame, name: str = "_key") -> DataFrame:
    """docs with `text_key` of each text."""

    @F.arrow_udf("binary")
    def keys(column: pa.Array) -> pa.Array:
        return pa.array([text_key(t) for t in byte_texts(column)], pa.binary())

    return docs.withColumn(name, keys("text"))


def _wanted_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key and shingle set of the documents whose ids are (as far as a filter of fixed size tells) in `wanted`, copies mostly once."""
    bit = F.col("id").bitwiseAND(F.lit(BITS - 1)) + 1
    maps = wanted.groupBy(F.bitmap_bucket_number(bit).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    told = np.zeros((BITS >> 15, 1 << 12), np.uint8)
    for r in maps:
        told[r["at"] - 1] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(told.ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, seen = byte_texts(batch.column(0)), {}
            for r, t in enumerate(texts):
                key = text_key(t)
                x = _id(key) & BITS - 1
                if shared.value[x >> 3] >> (x & 7) & 1:
                    seen.setdefault(key, r)
            keys, texts = list(seen), [texts[r] for r in seen.values()]
            for a, b in chunks([len(t) for t in texts], CHUNK):
                g, bounds = shingle_sets(texts[a:b])
                sets = [g[s:e].tobytes() for s, e in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(keys[a:b], pa.binary()), pa.array(sets, pa.binary())], ["key", "set"])

    return docs.select("text").mapInArrow(trimmed(run), "key binary, set binary")


def _links(families: DataFrame, docs: DataFrame) -> DataFrame:
    """Edges (a, b), keys, of a spanning forest of the links of index 4/5 or more in each family (by, key, id, n)."""
    sizes = families.groupBy("by").agg(F.count("*").alias("size"), F.sum(8 * F.col("n")).alias("weight")).where("size > 1")
    sizes = materialise(sizes, "jaccard-family-sizes")
    wanted = materialise(joined_unevenly(families, sizes.select("by", "size"), "by", "size").select("by", "key", "id"), "jaccard-wanted")
    shipped = _wanted_sets(docs, wanted).join(wanted, "key").groupBy("key").agg(*(F.first(c).alias(c) for c in ("by", "id", "set")))
    shipped = materialise(shipped, "jaccard-shipped")

    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by("by")
        sets, keys = table["set"].to_pylist(), table["key"].to_pylist()
        g, n = np.frombuffer(b"".join(sets), _WORDS), np.array([len(x) // 8 for x in sets], np.int64)
        bounds = np.concatenate([[0], np.cumsum(n)])
        a, b = [], []
        for s, e in _slices(table["by"].to_numpy()):
            code, starts, size = np.unique(g[bounds[s] : bounds[e]], return_inverse=True)[1], bounds[s:e] - bounds[s], n[s:e]
            held = np.zeros(len(code), bool)

            def near(i: int, left: np.ndarray) -> np.ndarray:
                mine = code[starts[i] : starts[i] + size[i]]  # noqa: B023
                held[mine] = True  # noqa: B023
                both = np.add.reduceat(held[code], starts, dtype=np.int64)[left]  # noqa: B023
                held[mine] = False  # noqa: B023
                return 9 * both >= 4 * (size[i] + size[left])  # noqa: B023

            i, j = spanning(np.arange(e - s), near)
            a += [keys[s + k] for k in i]
            b += [keys[s + k] for k in j]
        trim()
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return _gathered(shipped, sizes).groupBy("g", "i", "j").applyInArrow(settle, "a binary, b binary")


def near_classes(docs: DataFrame) -> DataFrame:
    """(node, root): components of the texts linked by an index of 4/5 or more, by `text_key`, for texts with links."""
    return settled(docs.sparkSession, lambda: _near_classes(docs.select("text")), "jaccard-roots")


def _near_classes(docs: DataFrame) -> DataFrame:
    counts = _counted(docs)
    marked = materialise(_marked(docs, counts), "jaccard-marked")
    texts = materialise(marked.groupBy("key").agg(*(F.first(c).alias(c) for c in ("id", "n", "fp"))), "jaccard-texts")
    points = materialise(texts.select("fp").distinct(), "jaccard-points")
    close = components(links(points, "jaccard-simhash"), "jaccard-simhash").select(F.col("node").alias("fp"), F.col("root").alias("class"))
    classed = lambda df: df.join(close, "fp", "left").withColumn("class", F.coalesce("class", "fp"))

    stars = materialise(_stars(marked, counts), "jaccard-stars")
    known = stars.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    about = marked.join(known, "id", "left_semi").groupBy("key").agg(*(F.first(c).alias(c) for c in ("id", "n", "cells", "fp")))
    about = materialise(classed(about), "jaccard-about")
    dropped(marked)
    roots = components(_joined_classes(stars, about), "jaccard-families").select(F.col("node").alias("class"), F.col("root").alias("by"))
    families = classed(texts).join(roots, "class", "left").select(F.coalesce("by", "class").alias("by"), "key", "id", "n")
    return components(_links(materialise(families, "jaccard-families"), docs), "jaccard")
