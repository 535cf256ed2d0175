"""Best-fit packing of tokenised documents into sequences of bounded length, in bulk-synchronous rounds.

A round range-sorts the longest pieces left together with the gaps of the open sequences, longest first, gaps
before pieces of their size. Each partition sweeps its part: a piece takes its successor, the smallest gap that
holds it; where several pieces have one successor, rank decides, the k-th piece from the end going to the k-th
gap up, which is bracket matching. What a partition cannot match it passes on as two numbers, pieces without a
gap and gaps without a piece; a scan over these numbers tells which pieces of one partition take which gaps of
another, and they meet by a join. Then the gaps are updated, and the next round begins. A gap that holds several
pieces of the round's longest offers as many places. Pieces over half the capacity open their sequences; with
them as many are opened as all tokens need at least, and more only when pieces fit no gap.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.byte_bpe import encoder
from sievework.llm.shared import byte_texts, materialise, trimmed

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Characters on which the two tokenizer libraries' tables agree beyond doubt.
_PLAIN = re.compile("[^\x00-ɏ‐-‧‰-⁞€]|<\\|endoftext\\|>")
#: White space in runs that the fast library's look-ahead cannot walk back over.
_RUN = re.compile(r"\s{4096}")
_LOADED: dict = {}


def byte_bpe(text: str) -> np.ndarray:
    """Token ids of the byte-level vocabulary, as the tokenizers library gives them.

    Plain text goes through the rank file of the same vocabulary, four times as fast with the same ids; with very
    long runs of white space, through the scan of `byte_bpe`, which has no bound.
    """
    import public_tokenizers

    if not _LOADED:
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED["fast"] = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _LOADED["full"] = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    if _PLAIN.search(text):
        return np.array(_LOADED["full"].encode(text, add_special_tokens=False).ids, np.uint32)
    if _RUN.search(text):
        return np.array(encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")).encode([text.encode()])[0], np.uint32)
    return _LOADED["fast"].encode_to_numpy(text, disallowed_special=())


def piece_cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and end of each piece of n tokens; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *((s, s + capacity) for s in range(first, n, capacity))]


def pieces_of(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Tokens of every text plus id 0, cut into pieces of at most `capacity`; null texts are empty."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero = np.zeros(1, np.uint32)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                ids = np.concatenate([byte_bpe(text.decode("utf-8", "replace")), zero]).astype("<u4", copy=False)
                rows += [(doc_id, k, s, e - s, zlib.crc32(ids[s:e])) for k, (s, e) in enumerate(piece_cuts(len(ids), capacity))]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(trimmed(cut), PIECES)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bracket matching of one partition's places (kind 0) and pieces (kind 1), sorted by size from the largest on.

    Takes p (partition), kind, id, size, places; returns p, kind, id, size, at, n, seq: kind 2 for a piece matched
    to seq, 1 for an unmatched piece with its number `at` among them, 0 for n places of a sequence left over, the
    first of them the partition's number `at`.
    """
    stack: list[list[int]] = []
    p = unmatched = 0
    names = ["p", "kind", "id", "size", "at", "n", "seq"]
    kinds = [pa.int32(), pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        rows = []
        for p, kind, i, size, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                stack.append([i, places])
            elif stack:
                top = stack[-1]
                rows.append((p, 2, i, size, 0, 0, top[0]))
                top[1] -= 1
                if not top[1]:
                    stack.pop()
            else:
                rows.append((p, 1, i, size, unmatched, 0, 0))
                unmatched += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    at = 0
    for a in range(0, len(stack), 50_000):
        rows = []
        for i, places in stack[a : a + 50_000]:
            rows.append((p, 0, i, 0, at, places, 0))
            at += places
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def carried(counts: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int]]:
    """Which unmatched pieces take which left places of partitions before theirs.

    From (p, unmatched pieces, places left) in order: runs (p, first piece, pieces, partition of the places, end of
    the places), filled from the end down; and how many pieces of each partition are served. There are at most twice
    as many runs as partitions.
    """
    stack: list[list[int]] = []
    runs, served = [], {}
    for p, pieces, places in counts:
        done = 0
        while done < pieces and stack:
            top = stack[-1]
            n = min(pieces - done, top[1])
            runs.append((p, done, n, top[0], top[1]))
            done += n
            top[1] -= n
            if not top[1]:
                stack.pop()
        served[p] = done
        if places:
            stack.append([p, places])
    return runs, served


def _round(pieces: DataFrame, gaps: DataFrame, longest: int, shortest: int) -> tuple[DataFrame, DataFrame]:
    """One round: (id, size, seq) of the pieces that found a place, and (id, size) of the others."""
    spark = pieces.sparkSession
    places = F.greatest(F.lit(1), F.floor(F.col("gap") / longest))
    open_ = gaps.where(F.col("gap") >= shortest).select(F.lit(0).alias("kind"), F.col("seq").alias("id"), F.floor(F.col("gap") / places).alias("size"), places.alias("places"))
    entries = open_.unionByName(pieces.select(F.lit(1).alias("kind"), "id", "size", F.lit(1).cast("long").alias("places")))
    order = [F.desc("size"), "kind", "id"]
    entries = entries.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("p"), "kind", "id", "size", "places")
    local = materialise(entries.mapInArrow(trimmed(sweep), "p int, kind byte, id long, size long, at long, n long, seq long"), "pack-sweep")
    counts = local.groupBy("p").agg(F.count_if(F.col("kind") == 1).alias("u"), F.sum("n").alias("l")).orderBy("p").collect()  # a row a partition
    runs, served = carried([tuple(r) for r in counts])
    placed = local.where("kind = 2").select("id", "size", "seq")
    alone = local.where("kind = 1").select("p", "id", "size", "at")
    if not runs:
        return placed, alone.select("id", "size")
    plan = F.broadcast(spark.createDataFrame(runs, "rp int, first long, pieces long, sp int, top long"))
    taken = alone.join(plan, (F.col("p") == F.col("rp")) & (F.col("at") >= F.col("first")) & (F.col("at") < F.col("first") + F.col("pieces")))
    taken = taken.select("id", "size", "sp", (F.col("top") - 1 - F.col("at") + F.col("first")).alias("place"))
    left = local.where("kind = 0").select("p", "at", "n", F.col("id").alias("seq"))
    low, high = F.greatest("at", F.col("top") - F.col("pieces")), F.least(F.col("at") + F.col("n"), F.col("top"))
    left = left.join(plan, F.col("p") == F.col("sp")).where(low < high).select("sp", "seq", F.explode(F.sequence(low, high - 1)).alias("place"))
    cross = taken.join(left, ["sp", "place"]).select("id", "size", "seq")
    done = F.broadcast(spark.createDataFrame(list(served.items()), "q int, served long"))
    stuck = alone.join(done, F.col("p") == F.col("q")).where(F.col("at") >= F.col("served")).select("id", "size")
    return placed.unionByName(cross), stuck


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...), each no longer than the capacity.

    Equal pieces and repeated rows each get their own place; an empty table stays empty. A round's pieces are over
    half as long as the longest left, so there are some ten rounds, and each moves a few numbers a piece. The
    driver sees counts by length and by partition.
    """
    spark, name = pieces.sparkSession, "_piece_row"
    numbered = materialise(pieces.withColumn(name, F.monotonically_increasing_id()), "pack-pieces")
    todo = {r["length"]: r["count"] for r in numbered.groupBy("length").count().collect()}  # at most `capacity` rows
    half = capacity // 2
    alone = numbered.where(F.col("length") > half).select(F.col(name).alias("id"), F.col("length").alias("size"), F.col(name).alias("seq"))
    found, opened = [alone.select("id", "seq")], 0

    def opening(n: int) -> DataFrame:
        return spark.range(opened, opened + n).select((-1 - F.col("id")).alias("seq"), F.lit(capacity).cast("long").alias("gap"))

    gaps = alone.select("seq", (F.lit(capacity) - F.col("size")).alias("gap")).where("gap > 0")
    least = max(0, -(-sum(n * c for n, c in todo.items()) // capacity) - sum(c for n, c in todo.items() if n > half))
    gaps, opened = gaps.unionByName(opening(least)), least
    stuck, stuck_sizes, below = None, {}, half
    todo = {n: c for n, c in todo.items() if n <= half}
    while todo or stuck_sizes:
        longest = max([*todo, *stuck_sizes])
        fresh = [n for n in todo if n > longest // 2]
        own = numbered.where((F.col("length") > min(below, longest // 2)) & (F.col("length") <= below)).select(F.col(name).alias("id"), F.col("length").alias("size"))
        below = min(below, longest // 2)
        own = own if stuck is None else own.unionByName(stuck)
        placed, stuck = _round(own, gaps, longest, min([*fresh, *stuck_sizes]))
        placed = materialise(placed, "pack-placed")
        found.append(placed.select("id", "seq"))
        todo = {n: c for n, c in todo.items() if n not in fresh}
        stuck_sizes = {r["size"]: r["count"] for r in stuck.groupBy("size").count().collect()}  # at most `capacity` rows
        if not todo and not stuck_sizes:
            break
        used = placed.groupBy("seq").agg(F.sum("size").alias("used"))
        gaps = gaps.join(used, "seq", "left").select("seq", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")).where("gap > 0")
        gaps = materialise(gaps, "pack-gaps")
        widest = gaps.agg(F.max("gap")).first()[0] or 0 if stuck_sizes else 0
        lost = sum(n * c for n, c in stuck_sizes.items() if n > widest)
        if lost:
            more = -(-lost // capacity)
            gaps, opened = gaps.unionByName(opening(more)), opened + more
    at = found[0]
    for part in found[1:]:
        at = at.unionByName(part)
    rows = numbered.join(at.withColumnsRenamed({"id": name, "seq": "sequence_id"}), name)
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), name).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise docs and pack their pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of one token; a row without a doc_id is packed too; repeated rows each get
    a place; other columns are not read. Whole texts are tokenised once, whatever their length; only piece
    lengths and checksums are written, sorted and shuffled.
    """
    return pack(pieces_of(docs, capacity), capacity)
