"""Substring dedup: words in a window of 20 that also starts earlier in the corpus go.

A window's minimizer is the least hash among its 8-word grams; equal windows have equal minimizers. Only
windows whose minimizer occurs more than once are looked at further: runs of such windows with one minimizer
become segments, equal segments are merged, and what is left is dealt to shards by minimizer, so equal windows
meet in one shard. A shard builds an FM-index over its segments (wavelet matrix over the Burrows-Wheeler
transform of exact words) and streams them through backward search; the matching statistic of a position,
followed up to the window length, tells which windows repeat, and the interval's least position whether an
earlier one exists. A minimizer with more words than a shard may hold is left to grouping by whole windows,
which has no size to outgrow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import byte_texts, joined_unevenly, materialise, settled, trim, trimmed

WINDOW, GRAM = 20, 8
SHARD_WORDS, HOT_WORDS = 400_000, 200_000
ORDER = 32  # symbols by which suffixes are sorted: any power of two from WINDOW on
_ODD = [pow(0x9E3779B97F4A7C15, j, 1 << 64) | 1 for j in range(GRAM)]


def minimizers(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes of a document's words, and the least of each window."""
    import xxhash

    n = len(words)
    if n < WINDOW:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    g = np.zeros(n - GRAM + 1, np.uint64)
    for j, odd in enumerate(_ODD):
        g += h[j : n - GRAM + 1 + j] * np.uint64(odd)
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(29)
    span, low = WINDOW - GRAM + 1, g
    size = 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = span - size
    return g, np.minimum(low[: len(low) - rest], low[rest:])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's minimizers; n is 2 if their gram occurs more than once in it."""
    for batch in batches:
        values, owners, numbers = [], [], []
        for i, text in enumerate(byte_texts(batch.column(2))):
            g, low = minimizers(text.split())
            if len(low):
                own = low[np.concatenate([[True], low[1:] != low[:-1]])]
                own = np.unique(own)
                at = np.searchsorted(own, g)
                at[at == len(own)] = 0
                count = np.bincount(at[own[at] == g], minlength=len(own))
                values.append(own)
                owners.append(np.full(len(own), i))
                numbers.append(np.minimum(count, 2))
        if values:
            at = pa.array(np.concatenate(owners))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(values).view(np.int64)), batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(numbers).astype(np.int8))], ["m", "doc_id", "rid", "n"])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows with one repeated minimizer: their words, and where they start."""
    names = ["m", "doc_id", "rid", "start", "windows", "words", "h"]
    for batch in batches:
        rows = []
        for doc_id, rid, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2)), batch.column(3), strict=True):
            words = text.split()
            _, low = minimizers(words)
            low = low.view(np.int64)
            kept = np.isin(low, wanted.values.to_numpy())
            edge = np.concatenate([[True], (low[1:] != low[:-1])])
            starts = np.flatnonzero(edge)
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(low)]):
                if kept[s]:
                    joined = b" ".join(words[s : e + WINDOW - 1])
                    rows.append((int(low[s]), doc_id, rid, s, e - s, joined, hashlib.md5(joined).digest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for a in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 50_000], strict=True), kinds, strict=True)], names)


class FmIndex:
    """FM-index over a symbol sequence: a wavelet matrix of its Burrows-Wheeler transform, and nothing of the text.

    Symbol 0 separates texts and is in no pattern. Suffixes are sorted by their first ORDER symbols, which is all
    that patterns of that length need. A symbol takes about a bit and a half a level: the packed bits, and a count
    of ones for each word of them.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        self.sigma = int(symbols.max(initial=0)) + 1
        rank, size = symbols.astype(np.int64), 1
        while size < ORDER:
            ahead = np.full(n, -1, np.int64)
            ahead[:-size] = rank[size:] if size < n else ahead[:-size]
            rank = np.unique(rank * (n + 2) + ahead + 1, return_inverse=True)[1]
            size *= 2
        bwt = symbols[np.argsort(rank, kind="stable") - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=self.sigma))])
        self.levels = max(1, (self.sigma - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        start = np.zeros(self.sigma, np.int64)
        every = np.arange(self.sigma)
        for level in reversed(range(self.levels)):
            bit = (bwt >> level & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, bool)
            padded[:n] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.bits.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1].astype(np.uint32))
            self.zeros.append(n - int(bit.sum()))
            start = self._down(len(self.bits) - 1, every >> level & 1, start)
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        self.shift = self.first[:-1] - start

    def _down(self, level: int, bit: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        ones = self.before[level][word].astype(np.int64) + np.bitwise_count(self.bits[level][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
        return np.where(bit, self.zeros[level] + ones, at - ones)

    def back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One step of backward search for one end of many intervals."""
        for level in range(self.levels):
            at = self._down(level, symbol >> (self.levels - 1 - level) & 1, at)
        return at + self.shift[symbol]

    def statistics(self, stream: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of streamed text, up to a threshold: which windows reach it, and their intervals.

        A window's pattern is followed backwards from its end. It is given up where its interval holds it alone, as
        then no other text matches so far; what is left at the front matches `length` symbols somewhere else.
        """
        of = np.arange(len(starts))
        last = stream[starts + length - 1]
        lo, hi = self.first[last], self.first[last + 1]
        for k in range(length - 2, -1, -1):
            alive = hi - lo > 1
            of, lo, hi = of[alive], lo[alive], hi[alive]
            symbol = stream[starts[of] + k]
            lo, hi = self.back(symbol, lo), self.back(symbol, hi)
        alive = hi - lo > 1
        return of[alive], lo[alive], hi[alive]


def _merged(doc: list, rid: list, starts: np.ndarray, owner: np.ndarray) -> list[tuple]:
    """Covered word ranges (doc_id, rid, s, e) of flagged windows sorted by owner and start."""
    if not len(starts):
        return []
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (starts[1:] > starts[:-1] + WINDOW)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return [(doc[o], rid[o], s, e + WINDOW) for o, s, e in zip(owner[first].tolist(), starts[first].tolist(), starts[last].tolist(), strict=True)]


_RANGES = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])


def search_shard(table: pa.Table) -> pa.Table:
    """Ranges of one shard's segments that some earlier window covers.

    The index is built over the segments and forgets them; then they stream through it. Windows that reach the
    same interval are equal, so the least place among them tells which are late.
    """
    table = table.sort_by([("doc_id", "ascending"), ("start", "ascending")])
    doc, rid = table["doc_id"].to_pylist(), table["rid"].to_pylist()
    texts = [t.split(b" ") for t in table["words"].to_pylist()]
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    stream = np.zeros(int(ends[-1]), np.int32)
    inside = np.ones(len(stream), bool)
    inside[ends - 1] = False
    coded = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    stream[inside] = coded.indices.to_numpy() + 1
    del texts, inside, coded
    index = FmIndex(stream)
    windows, starts = table["windows"].to_numpy(), table["start"].to_numpy()
    owner = np.repeat(np.arange(len(windows)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = (np.unique(np.array(doc), return_inverse=True)[1].astype(np.int64) << 40)[owner] + starts[owner] + offset
    of, lo, _ = index.statistics(stream, begins[owner] + offset, WINDOW)
    if not len(of):
        return _RANGES.empty_table()
    _, interval = np.unique(lo, return_inverse=True)
    least = np.full(interval.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, interval, place[of])
    late = np.sort(of[place[of] > least[interval]])
    del index, stream, of, lo
    trim()
    rows = _merged(doc, rid, (starts[owner] + offset)[late], owner[late])
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_RANGES) if rows else _RANGES.empty_table()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a segment on its own."""
    for batch in batches:
        for row in batch.to_pylist():
            words = row["words"].split(b" ")
            n = row["windows"]
            for a in range(0, n, 20_000):
                b = min(n, a + 20_000)
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.md5(b" ".join(words[i : i + WINDOW])).digest() for i in range(a, b)], pa.binary()), pa.array([row["doc_id"]] * (b - a), pa.int64()), pa.array([row["rid"]] * (b - a), pa.int64()), pa.array(range(row["start"] + a, row["start"] + b), pa.int64())], ["w", "doc_id", "rid", "start"])


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, s, e): word ranges covered by windows that also start earlier; rid tells texts of one doc_id apart."""
    return settled(docs.sparkSession, lambda: _repeated_ranges(docs), "substring-ranges")


def _repeated_ranges(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("rid"), "text")
    marks = materialise(keyed.mapInArrow(trimmed(_marks), "m long, doc_id long, rid long, n byte"), "substring-marks")
    again = marks.groupBy("m").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).where("n > 1").select("m", "rows")
    again = materialise(again, "substring-again")
    wanted = joined_unevenly(marks.select("m", "doc_id", "rid"), again, "m", "rows").groupBy("doc_id", "rid").agg(F.collect_set("m").alias("ms"))
    found = keyed.join(wanted, ["doc_id", "rid"]).mapInArrow(trimmed(_segments), "m long, doc_id long, rid long, start long, windows long, words binary, h binary")
    segments = materialise(found, "substring-segments")
    place = F.struct("doc_id", "start")
    first = F.min(F.struct("doc_id", "start", "rid")).alias("f")
    distinct = segments.groupBy("m", "h").agg(first, F.first("windows").alias("windows"), F.first("words").alias("words"), F.count("*").alias("copies"))
    distinct = materialise(distinct.select("m", "h", "copies", "f.doc_id", "f.start", "f.rid", "windows", "words"), "substring-distinct")
    origin = distinct.where("copies > 1").select("m", "h", F.struct("doc_id", "start").alias("f"), "copies")
    copies = joined_unevenly(segments.select("m", "h", "doc_id", "rid", "start", "windows"), origin, ["m", "h"], "copies").where(place > F.col("f"))
    ranges = copies.select("doc_id", "rid", F.col("start").alias("s"), (F.col("start") + F.col("windows") + WINDOW - 1).alias("e"))

    length = F.col("windows") + WINDOW - 1
    sizes = distinct.groupBy("m").agg(F.sum(length).alias("n"), F.count("*").alias("c"), F.max("windows").alias("w"))
    sizes = materialise(sizes, "substring-sizes")
    hot = sizes.where(F.col("n") > HOT_WORDS)
    alone = F.expr("c = 1 and w = 1")  # nothing else to match
    total = sizes.where((F.col("n") <= HOT_WORDS) & ~alone).agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    dealt = distinct.join(sizes.where((F.col("n") <= HOT_WORDS) & ~alone).select("m"), "m", "left_semi").withColumn("shard", F.pmod(F.xxhash64("m"), F.lit(shards)))
    searched = dealt.select("shard", "doc_id", "rid", "start", "windows", "words").groupBy("shard").applyInArrow(search_shard, "doc_id long, rid long, s long, e long")
    ranges = ranges.unionByName(searched)
    if not hot.isEmpty():
        windows = materialise(distinct.join(hot.select("m"), "m", "left_semi").mapInArrow(trimmed(_windows), "w binary, doc_id long, rid long, start long"), "substring-windows")
        earliest = materialise(windows.groupBy("w").agg(F.min(place).alias("f"), F.count("*").alias("n")).where("n > 1"), "substring-earliest")
        late = joined_unevenly(windows, earliest, "w", "n").where(place > F.col("f"))
        ranges = ranges.unionByName(late.select("doc_id", "rid", F.col("start").alias("s"), (F.col("start") + WINDOW).alias("e")))
    return ranges


def _joined_ranges(docs: DataFrame, columns: list[str]) -> DataFrame:
    ranges = repeated_ranges(docs).groupBy("doc_id", "rid").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    keyed = docs.select(*columns).withColumn("rid", F.xxhash64("text"))
    return keyed.join(ranges, ["doc_id", "rid"], "left")


def keep_mask(n: int, ranges: list[dict] | None) -> np.ndarray:
    """Which of n words no range covers."""
    depth = np.zeros(n + 1, np.int64)
    for r in ranges or ():
        depth[r["s"]] += 1
        depth[r["e"]] -= 1
    return np.cumsum(depth)[:-1] == 0


def dedup_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document.

    Null and empty texts have no words; rows without a doc_id keep all words; rows repeating a doc_id and its
    text get the same result, and neither counts as earlier. An empty table gives none. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = text.split()
                kept = [w for w, k in zip(words, keep_mask(len(words), ranges).tolist(), strict=True) if k] if ranges else words
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True))], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _joined_ranges(docs, ["doc_id", "text"]).select("doc_id", "text", "ranges").mapInArrow(trimmed(run), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """docs with the repeated words cut from the text (kept words joined by one space), all columns.

    A text without repeats stays as it is, null and empty ones too; n_chars, where there is such a column, follows
    the text. Rows without a doc_id stay whole. Columns may have any names.
    """

    @F.arrow_udf("string")
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        out = []
        for text, of in zip(byte_texts(texts), ranges.to_pylist(), strict=True):
            words = text.split()
            out.append(b" ".join([w for w, k in zip(words, keep_mask(len(words), of).tolist(), strict=True) if k]).decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    ranges = repeated_ranges(docs).groupBy("doc_id", "rid").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    rows = docs.select(F.struct(*docs.columns).alias("row"))  # one name, so none can clash
    met = rows.join(ranges, (F.col("row.doc_id") == F.col("doc_id")) & (F.xxhash64("row.text") == F.col("rid")), "left")
    text = F.when(F.col("ranges").isNull(), F.col("row.text")).otherwise(cut("row.text", F.coalesce("ranges", F.array().cast("array<struct<s: long, e: long>>"))))
    new = met.select("row", text.alias("text"))
    size = F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    return new.select(*(F.col("text") if c == "text" else size.alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns))
