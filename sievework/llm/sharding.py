"""Longest-processing-time scheduling of groups of equal texts onto shards of near-equal bytes.

Groups of one weight are interchangeable, so the schedule is made over weight classes: a heap gives each
class, heaviest first, to the least-loaded shards. Distinct weights w satisfy sum(w) <= total bytes, so
there are at most about sqrt(2 * total * log(total)) classes (weight, copies) however many rows there are.
They stream through the driver in order, CLASSES at a time, and the plan is written as it grows; the driver
keeps the shards' loads. Which group of a class goes where follows from the group's rank.
"""

from __future__ import annotations

import heapq
import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import joined_unevenly, materialise, positioned

#: Weight classes that the driver holds at a time.
CLASSES = 100_000


def spread(loads: list[int], weight: int, count: int) -> list[int]:
    """How many of `count` groups of one weight each shard gets, as the heap would give them one by one.

    Whole levels are filled at once; the heap hands out what is left (fewer than two a shard).
    """
    given = [0] * len(loads)
    lo, hi = min(loads), max(loads) + weight * count
    while lo < hi:  # highest level that the groups can still fill
        mid = (lo + hi + 1) // 2
        if sum(max(0, -((load - mid) // weight)) for load in loads) <= count:
            lo = mid
        else:
            hi = mid - 1
    for j, load in enumerate(loads):
        given[j] = max(0, -((load - lo) // weight))
    heap = [(load + weight * given[j], j) for j, load in enumerate(loads)]
    heapq.heapify(heap)
    for _ in range(count - sum(given)):
        load, j = heapq.heappop(heap)
        given[j] += 1
        heapq.heappush(heap, (load + weight, j))
    return given


class Schedule:
    """Loads and rows of the shards so far; takes classes (size, copies, groups), heaviest first."""

    def __init__(self, shards: int) -> None:
        self.loads, self.rows, self.start = [0] * shards, [0] * shards, 0

    def take(self, classes: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, list[int], list[int]]]:
        """For each class: size, copies, groups, start position, bounds of ranks and first slots by shard."""
        out = []
        for size, copies, groups in classes:
            given = spread(self.loads, size * copies, groups)
            bounds = [0]
            for n in given:
                bounds.append(bounds[-1] + n)
            out.append((size, copies, groups, self.start, bounds, list(self.rows)))
            self.start += groups
            for j, n in enumerate(given):
                self.loads[j] += n * size * copies
                self.rows[j] += n * copies
        return out


def _planned(groups: DataFrame, shards: int) -> DataFrame:
    """The plan by class; classes come to the driver in order, a bounded number at a time."""
    spark = groups.sparkSession
    found = materialise(groups.groupBy("size", "copies").count().orderBy(F.desc(F.col("size") * F.col("copies")), "size"), "shard-classes")
    ordered = found.orderBy(F.desc(F.col("size") * F.col("copies")), "size").toLocalIterator()
    schedule, plan = Schedule(shards), None
    while True:
        part = schedule.take([tuple(r) for r in itertools.islice(ordered, CLASSES)])
        if plan is None or part:
            rows = spark.createDataFrame(part, "size long, copies long, groups long, start long, bounds array<long>, slots array<long>")
            rows = materialise(rows, "shard-plan")
            plan = rows if plan is None else plan.unionByName(rows)
        if len(part) < CLASSES:
            return plan


def _text_key() -> Column:
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))


def assign_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shard and slot of every row: rows of equal text stay together, shards hold near-equal bytes.

    A row's size is its text's UTF-8 bytes plus 1. A null text counts as an empty one, and goes with the
    empty texts. Repeated rows are rows of their group; equal and null doc_ids only share the order of slots.
    An empty table gives no rows. Returns doc_id, size, text_crc32, shard, slot.
    """
    return _assigned(docs, shards).drop("key")


def _assigned(docs: DataFrame, shards: int) -> DataFrame:
    """`assign_shards` with the hash of the text, `key`."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), _text_key().alias("key"))
    rows = positioned(rows, ["key", "doc_id"], "shard-rows")
    groups = rows.groupBy("key").agg(F.count("*").alias("copies"), F.first("size").alias("size"), F.min("pos").alias("first"))
    groups = positioned(groups, [(-F.col("size") * F.col("copies")).alias("w"), "size", "key"], "shard-groups").withColumnRenamed("pos", "at")
    rank = F.col("at") - F.col("start")
    shard = F.size(F.filter("bounds", lambda b: b <= rank)) - 1
    placed = joined_unevenly(groups, _planned(groups, shards), ["size", "copies"], "groups").withColumn("shard", shard)
    placed = placed.select("key", "first", "shard", (F.expr("slots[shard]") + (rank - F.expr("bounds[shard]")) * F.col("copies")).alias("slot0"), "copies")
    met = joined_unevenly(rows, materialise(placed, "shard-placed"), "key", "copies")
    return met.select("key", "doc_id", "size", "text_crc32", "shard", (F.col("slot0") + F.col("pos") - F.col("first")).alias("slot"))


def shard_files(docs: DataFrame, path: str, shards: int = 8) -> DataFrame:
    """Write docs as one folder per shard under `path`; returns the assignment.

    Rows meet their slot by doc_id (null too), text and their number among the rows equal in both, so every row
    is written once and equal texts stay in one shard. Columns of docs called shard or slot give way to the new ones.
    """
    from pyspark.sql import Window

    plan = materialise(_assigned(docs, shards), "shard-assigned")
    others = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(F.struct(*others).alias("row"), _text_key().alias("k"), F.col("doc_id").alias("i"))
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("k", "i").orderBy(F.lit(0))))
    slots = plan.select(F.col("key").alias("_k"), F.col("doc_id").alias("_i"), "shard", "slot").withColumn("_m", F.row_number().over(Window.partitionBy("_k", "_i").orderBy("slot")))
    met = numbered.join(slots, (F.col("k") == F.col("_k")) & F.col("i").eqNullSafe(F.col("_i")) & (F.col("n") == F.col("_m")))
    met.select(*(F.col("row")[c].alias(c) for c in others), "shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
    return plan.drop("key")


def shard_digest(docs: DataFrame) -> DataFrame:
    """`assign_shards` under the law `bytes`, without a grown shard."""
    return assign_shards(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
