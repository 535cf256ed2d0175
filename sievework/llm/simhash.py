"""SimHash near-duplicates by covering locality-sensitive hashing.

For radius r every fingerprint bit i gets a vector f(i) of r + 1 bits, none zero, and every nonzero vector v
of r + 1 bits is a table whose mask holds the bits with odd <f(i), v>. Two fingerprints that differ in at most
r bits leave some v orthogonal to all of the differing bits' vectors, so they agree under that mask: every
pair within the radius meets in some table.

Equal fingerprints are merged first. A bucket yields the edges of a spanning forest of its links, not all
pairs. Buckets over a limit are dealt again by a second, independent covering: both masks together fix about
48 of the 64 bits, so such a bucket holds at most some 2**16 distinct fingerprints whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sievework.llm.shared import byte_texts, dropped, joined_unevenly, materialise, trimmed

RADIUS, SHINGLE, SEED = 4, 4, 42
BUCKET = 2048
#: So many edges at most are settled at once in the driver (some 50 MB); more of them step by step in the cluster.
TOGETHER = 1 << 17


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set in over half the XXH64 hashes of the shingles; no words give zero."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
    total, n = np.zeros(64, np.int64), len(starts)
    stops = (ends[shingle - 1 :] - 1).tolist()
    for a in range(0, n, 1 << 16):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[a : a + (1 << 16)], stops[a : a + (1 << 16)], strict=True)], ">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def masks(turn: int, radius: int = RADIUS) -> list[int]:
    """Masks of one covering; `turn` tells independent coverings apart."""
    draw, top = np.random.default_rng(1000 + turn), 1 << (radius + 1)
    vectors = draw.permutation([1 + i % (top - 1) for i in range(64)]).tolist()
    return [sum(1 << i for i, f in enumerate(vectors) if (f & v).bit_count() & 1) for v in range(1, top)]


def forest(points: np.ndarray, radius: int = RADIUS) -> tuple[list[int], list[int]]:
    """Edges (indexes) of a spanning forest of the links among distinct points.

    Each point looks once at those not reached yet, so a dense group costs few looks.
    """
    left, a, b = np.arange(len(points)), [], []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            i = front.pop()
            near = np.bitwise_count(points[left] ^ points[i]) <= radius
            if near.any():
                new = left[near].tolist()
                left = left[~near]
                front += new
                a += [i] * len(new)
                b += new
    return a, b


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (long) of every whole text; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in byte_texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id long, fp long")


def _linked(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """Edges (a, b) of each bucket's forest. Buckets are of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy()).tolist()
            a, b = [], []
            for s, e in zip([0, *ends], ends):
                points = values[s:e]
                i, j = ([0], [1]) if e - s == 2 and ((int(points[0]) ^ int(points[1])) & (1 << 64) - 1).bit_count() <= RADIUS else forest(points.view(np.uint64)) if e - s > 2 else ([], [])
                a.append(points[i])
                b.append(points[j])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], ["a", "b"])

    whole = buckets.groupBy(*keys).agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return whole.select("fps").mapInArrow(trimmed(run), "a long, b long")


def _dealt(points: DataFrame, turn: int, number: str, key: str) -> DataFrame:
    """A row for each point and table of a covering: table number and masked fingerprint."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(turn)]
    table = F.array(*(F.struct(F.lit(i).alias("n"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(signed)))
    return points.withColumn("_t", F.explode(table)).select(*points.columns, F.col("_t.n").alias(number), F.col("_t.k").alias(key))


def links(points: DataFrame, tag: str = "simhash") -> DataFrame:
    """Edges (a, b) that connect exactly what links within the radius connect, among distinct fp values."""
    dealt = _dealt(points.select("fp"), 0, "n1", "k1")
    sizes = materialise(dealt.groupBy("n1", "k1").count().where("count > 1"), f"{tag}-buckets")
    full, small = sizes.where(F.col("count") > BUCKET), sizes.where(F.col("count") <= BUCKET).select("n1", "k1")
    edges = _linked(dealt.join(small, ["n1", "k1"], "left_semi"), ["n1", "k1"])
    if not full.isEmpty():
        again = _dealt(joined_unevenly(dealt, full, ["n1", "k1"], "count"), 1, "n2", "k2")
        edges = edges.unionByName(_linked(again, ["n1", "k1", "n2", "k2"]))
    return edges


def rooted(table: pa.Table) -> pa.Table:
    """(node, root) of `components` for all edges (u, v) of a table; u is the greater node.

    Numbers of the nodes in ascending order stand for them: every root takes the least root that its edges reach,
    until no edge has two.
    """
    values = [x for c in ("u", "v") for x in table[c].to_pylist()]
    nodes = sorted(set(values))
    number = {x: i for i, x in enumerate(nodes)}
    u, v = np.fromiter(map(number.__getitem__, values), np.int64, len(values)).reshape(2, -1)
    root = np.arange(len(nodes))
    while (u != v).any():
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root[root] != root).any():
            root = root[root]
        u, v = root[u], root[v]
    kind, lower = table.schema.field("u").type, np.flatnonzero(root != np.arange(len(nodes))).tolist()
    return pa.table({"node": pa.array([nodes[i] for i in lower], kind), "root": pa.array([nodes[i] for i in root[lower].tolist()], kind)})


def components(edges: DataFrame, tag: str = "simhash") -> DataFrame:
    """(node, root): the smallest node of each connected component, for its other nodes.

    Up to TOGETHER edges are settled in the driver: each step below plans several queries, and what their plans and
    code leave in a driver adds up. Of more edges a step is a large-star and a small-star; it is written out, so lost
    executors cost no more than a step. Steps go on until nothing changes.
    """
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{tag}-edges")
    if edges.count() <= TOGETHER:
        found = rooted(edges.toArrow())
        names = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        dropped(edges)
        return edges.sparkSession.createDataFrame(found, names.schema)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("x"), "u", "m")
        small = small.where("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).distinct()
        seen = Observation()
        state = small.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        old, edges = edges, materialise(state, f"{tag}-step")
        dropped(old)
        now = tuple(seen.get.values())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every document.

    Null texts count as empty: fingerprint zero, linked like any other. A row without a doc_id gets the smallest
    doc_id of its component, null if none has one. Repeated rows each give a row; an empty table gives none; other
    columns are not read. Texts are read once and never shuffled.
    """
    marked = materialise(fingerprints(docs), "simhash-fp")
    points = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")), "simhash-points")
    roots = components(links(points))
    joined = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    joined = materialise(joined, "simhash-rooted")
    lowest = materialise(joined.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("points")), "simhash-lowest")
    classes = materialise(joined_unevenly(joined, lowest, "root", "points").select("fp", "component_id", "rows"), "simhash-classes")
    named = joined_unevenly(marked, classes, "fp", "rows")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates, the one of smallest doc_id, with all its columns.

    Texts that share a doc_id are told apart by their words: a row stays for each group, wherever its doc_id
    stands else, and of equal rows one. Groups are linked by a Jaccard index of 0.8 or more of five-word
    shingles (`jaccard`), not by op5's fingerprints. Rows without a doc_id are kept: nothing identifies them.
    """
    from pyspark.sql import Window

    from sievework.llm import jaccard

    name, key = "_row", "_node"
    while {name, key} & set(docs.columns):
        name, key = f"{name}_", f"{key}_"
    marked = materialise(jaccard.with_key(docs.select("doc_id", "text")).select("doc_id", F.col("_key").alias("node")), "jaccard-keys")
    firsts = marked.where("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    placed = firsts.join(jaccard.near_classes(docs.where("doc_id is not null")), "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = placed.groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("k")).select("k.doc_id", F.col("k.node").alias(key))
    first = F.row_number().over(Window.partitionBy("doc_id", key).orderBy("text"))
    held = jaccard.with_key(docs.where("doc_id is not null"), key).join(kept, ["doc_id", key], "left_semi")
    one = held.withColumn(name, first).where(F.col(name) == 1).select(docs.columns)
    return one.unionByName(docs.where("doc_id is null"))
