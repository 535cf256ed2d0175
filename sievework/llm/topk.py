"""Exact top-k inner products by columnar branch and bound.

Vectors are packed in blocks in vertical layout: one contiguous plane per dimension. Queries go out in blocks of
bounded bytes, and every candidate is read where it lies, once a block: candidates are never shuffled. Scores
accumulate dimension block by dimension block, and after each the candidates that no query of a group can still
use are compacted away: what remains of a score is at most the product of the norms of the dimensions to come
(the remaining mass). Candidates of large norm come first, so bounds rise early, and a block whose norms cannot
reach any bound is left out whole. Arithmetic is on integers held in floats where products cannot lose a bit, on
Python integers otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.shared import materialise, positioned

#: Bound of the queries that are broadcast at a time, at eight bytes a component.
QUERY_BYTES = 32 << 20
CANDIDATES_IN_BLOCK = 4096
QUERY_GROUP = 128
DIMS_AT_ONCE = 16
LEAST, MOST = -(1 << 63), (1 << 63) - 1
_BLOCK = pa.schema([("n", pa.int32()), ("dims", pa.int32()), ("kind", pa.string()), ("ids", pa.binary()), ("planes", pa.binary())])


def quantised(vectors: pa.Array) -> np.ndarray:
    """floor(64 * x) of the components, a row a vector; short ones are filled with 0."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(64 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def pack(ids: np.ndarray, values: np.ndarray) -> dict:
    """A block row in vertical layout."""
    kind = "<i2" if np.abs(values).max(initial=0) < 1 << 15 else "<f8"
    return {"n": len(ids), "dims": values.shape[1], "kind": kind, "ids": ids.astype("<i8").tobytes(), "planes": np.ascontiguousarray(values.T).astype(kind).tobytes()}


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids and planes (dims, n) of a block row."""
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["planes"], row["kind"]).reshape(row["dims"], row["n"]).astype(np.float64)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of vectors too large for floats; what a long cannot hold stays at its limit."""
    ints = lambda a: np.array([[int(v) for v in row] for row in a], object).reshape(a.shape)
    return np.clip(ints(q.T).dot(ints(x)), LEAST, MOST).astype(np.int64)


def mass(planes: np.ndarray) -> np.ndarray:
    """Norm of the dimensions from each one on, by vector; a row more than there are dimensions."""
    tail = np.sqrt(np.cumsum((planes**2)[::-1], 0))[::-1]
    return np.concatenate([tail, np.zeros((1, planes.shape[1]))])


class Best:
    """The k best (score, smaller id first) of each query of a group so far."""

    def __init__(self, ids: np.ndarray, planes: np.ndarray, k: int) -> None:
        self.ids, self.planes, self.k, self.mass = ids, planes, k, mass(planes)
        self.score, self.vec = np.empty((len(ids), 0), np.int64), np.empty((len(ids), 0), np.int64)
        self.held = np.empty((len(ids), 0), bool)  # false: the query itself
        self.seen = self.dropped = 0  # candidates offered, and those compacted away before their last dimension

    def bound(self) -> np.ndarray:
        """Score that a newcomer must reach, by query."""
        full = self.held[:, -1] if self.score.shape[1] >= self.k else np.zeros(len(self.ids), bool)
        return np.where(full, self.score[:, -1].astype(np.float64) if self.score.shape[1] else 0.0, -np.inf)

    def offer(self, ids: np.ndarray, planes: np.ndarray, x_mass: np.ndarray) -> None:
        """Candidates with their planes and `mass`."""
        q, x, q_mass = self.planes, planes, self.mass
        self.seen += len(ids)
        need = self.bound()
        bounded = np.isfinite(need).all()
        if bounded and (q_mass[0] * x_mass[0].max(initial=0) * (1 + 1e-9) < need).all():
            self.dropped += len(ids)
            return
        dims = max(len(q), len(x))
        if len(q) != len(x):
            q, x = (np.pad(a, ((0, dims - len(a)), (0, 0))) for a in (q, x))
            q_mass, x_mass = (np.pad(a, ((0, dims + 1 - len(a)), (0, 0))) for a in (q_mass, x_mass))
        top = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, dims)
        if top >= 1 << 53:
            self.merge(ids, exact_scores(q, x))
            return
        kind = np.float32 if top < 1 << 24 else np.float64
        q, x = q.astype(kind), x.astype(kind)
        partial = np.zeros((q.shape[1], x.shape[1]), kind)
        for d in range(0, dims, DIMS_AT_ONCE):
            partial += q[d : d + DIMS_AT_ONCE].T @ x[d : d + DIMS_AT_ONCE]
            if bounded and (rest := d + DIMS_AT_ONCE) < dims:
                alive = (partial + np.outer(q_mass[rest], x_mass[rest]) * (1 + 1e-9) >= need[:, None]).any(0)
                if (n := int(alive.sum())) < 0.8 * len(alive):
                    self.dropped += len(alive) - n
                    x, x_mass, partial, ids = x[:, alive], x_mass[:, alive], partial[:, alive], ids[alive]
                if not len(ids):
                    return
        self.merge(ids, partial.astype(np.int64))

    def merge(self, ids: np.ndarray, scores: np.ndarray) -> None:
        k, held = self.k, self.ids[:, None] != ids
        if scores.shape[1] > 4 * k:  # what ranks below the k-th best is out, ties stay
            ranked = np.where(held, scores, LEAST)
            cut = np.partition(ranked, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            kept = (ranked >= cut[:, None]).any(0)
            ids, scores, held = ids[kept], scores[:, kept], held[:, kept]
        score = np.concatenate([self.score, scores], 1)
        vec = np.concatenate([self.vec, np.broadcast_to(ids, scores.shape)], 1)
        held = np.concatenate([self.held, held], 1)
        order = np.lexsort((vec, ~score, ~held))[:, :k]
        self.score, self.vec, self.held = (np.take_along_axis(a, order, 1) for a in (score, vec, held))

    def rows(self) -> pa.RecordBatch:
        query = np.repeat(self.ids, self.score.shape[1])
        kept = self.held.ravel()
        return pa.RecordBatch.from_arrays([pa.array(a[kept]) for a in (query, self.vec.ravel(), self.score.ravel())], ["query_id", "vec_id", "score"])


def _usable(vectors: DataFrame) -> DataFrame:
    number = lambda x: x.isNotNull() & (F.abs(x.cast("double") * 64) < float("inf"))  # noqa: E731  # NaN is above infinity
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", number))


def _query_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in range(0, batch.num_rows, QUERY_GROUP):
            part = batch.slice(s, QUERY_GROUP)
            yield pa.RecordBatch.from_pylist([pack(part.column(0).to_numpy(zero_copy_only=False), quantised(part.column(1)))], schema=_BLOCK)


def exact_topk(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """For each vec_id divisible by `every`: the k best integer inner products among all rows of other vec_ids.

    Components become floor(64 * x). Rows whose vector (or vec_id) is null, or holds null or non-finite
    components, take no part; a shorter vector counts as filled up with zeros. Where rows repeat a vec_id each
    of them is a candidate; the query is the least of their vectors, once. Scores are exact in 64 bits; beyond,
    they stay at the limit and count as equal. Ties go to the smaller vec_id. An empty table gives no rows.
    Returns query_id, rank, vec_id, score.
    """
    spark = vectors.sparkSession
    candidates = _usable(vectors)
    chosen = candidates.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    queries = positioned(chosen, ["vec_id"], "topk-queries")
    size = queries.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dims")).first()
    per_round = max(1, QUERY_BYTES // (8 * max(1, size["dims"] or 0)))
    schema = "query_id long, vec_id long, score long"

    def search(first: int) -> tuple[DataFrame, object]:
        own = queries.where((F.col("pos") >= first) & (F.col("pos") < first + per_round)).select("vec_id", "embedding")
        packed = own.mapInArrow(_query_groups, "n int, dims int, kind string, ids binary, planes binary").collect()  # at most QUERY_BYTES
        shared = spark.sparkContext.broadcast([r.asDict() for r in packed])

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            groups = [Best(*unpack(row), k) for row in shared.value]
            for batch in batches:
                ids, x = batch.column(0).to_numpy(zero_copy_only=False), quantised(batch.column(1)).T
                whole = mass(x)
                order = np.argsort(-whole[0], kind="stable")
                for s in range(0, len(order), CANDIDATES_IN_BLOCK):
                    at = order[s : s + CANDIDATES_IN_BLOCK]
                    block, rest = np.ascontiguousarray(x[:, at]), whole[:, at]
                    for g in groups:
                        g.offer(ids[at], block, rest)
            for g in groups:
                yield g.rows()

        met = candidates.mapInArrow(meet, schema)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
        return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), shared

    if (size["n"] or 0) <= per_round:
        return search(0)[0]
    parts = None
    for first in range(0, size["n"], per_round):  # one round's queries are held at a time
        found, shared = search(first)
        found = materialise(found, "topk-round")
        shared.destroy()
        parts = found if parts is None else parts.unionByName(found)
    return parts
