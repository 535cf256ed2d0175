"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

The features approximate a Gaussian kernel. Partitions sum their normal equations fold by fold; leaving a
fold out is a subtraction, so out-of-fold scores cost no further pass, and isotonic regression of the labels
on them calibrates the score. Labels enter only through the fit.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import byte_texts, chunks, materialise, trim, trimmed

#: Bound of the labelled rows that a fit uses, taken in hash order.
FIT_ROWS = 20_000
FEATURES, FOLDS, RIDGE, SEED = 256, 4, 1e-2, 7
THRESHOLD = 0.3
CHUNK = 8 << 20

_GROUPS = np.zeros(256, np.uint8)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:'\"-()", b"!?", b"|#$%&*@^~<>=_+/\\{}[]`", bytes(range(128, 256))), 1):
    _GROUPS[list(_chars)] = _i
STATISTICS = ["log_bytes", "lower", "upper", "digit", "space", "line", "stop", "shout", "symbol", "wide", "word_bytes", "distinct", "top_word", "same_word", "same_line", "deflate"]


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of STATISTICS for each whole text; all are defined, and finite, for empty texts too."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for a, b in chunks([len(t) for t in texts], CHUNK):
        part = texts[a:b]
        kinds = _GROUPS[np.frombuffer(b"\0".join(part) + b"\0", np.uint8)]
        sizes = np.array([len(t) for t in part])
        starts = np.cumsum(sizes + 1) - sizes - 1
        per = 1 / np.maximum(sizes, 1)
        for g in range(1, 10):
            out[a:b, g] = np.add.reduceat(kinds == g, starts, dtype=np.int64) * per
        out[a:b, 0] = np.log1p(sizes)
        for i, text in enumerate(part, a):
            words = text.lower().split()
            n = len(words)
            if n:
                seen = Counter(words)
                lines = [x for x in text.split(b"\n") if x.strip()]
                out[i, 10:] = (
                    min(50.0, len(text) / n),
                    np.log1p(len(seen)) / np.log1p(n),
                    max(seen.values()) / (n + 10),
                    sum(map(eq, words, words[1:])) / n,
                    1 - len(set(lines)) / len(lines),
                    len(zlib.compress(text, 1)) / (len(text) + 60),
                )
    return out


@dataclass
class Model:
    """Standardisation, frequencies and phases, ridge weights, and the calibration's steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray
    values: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        raw = np.zeros(len(stats)) if self.weights is None else fourier(stats, self.mean, self.scale) @ self.weights
        return np.clip(np.interp(raw, self.knots, self.values), 0.0, 1.0)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, with a constant."""
    draw = np.random.default_rng(SEED)
    x = np.clip((stats - mean) / scale, -6, 6)
    w = draw.standard_normal((x.shape[1], FEATURES)) / np.sqrt(x.shape[1])
    z = np.sqrt(2 / FEATURES) * np.cos(x @ w + draw.uniform(0, 2 * np.pi, FEATURES))
    return np.concatenate([z, np.ones((len(z), 1))], 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and non-decreasing values; rows of equal x are pooled first."""
    knots, inverse, n = np.unique(x, return_inverse=True, return_counts=True)
    total = np.bincount(inverse, y)
    blocks: list[list[float]] = []  # first knot, last knot, sum, count
    for k, s, c in zip(knots.tolist(), total.tolist(), n.tolist()):
        blocks.append([k, k, s, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, end, s2, c2 = blocks.pop()
            blocks[-1][1:] = [end, blocks[-1][2] + s2, blocks[-1][3] + c2]
    points = [(p, b[2] / b[3]) for b in blocks for p in dict.fromkeys(b[:2])]
    return np.array([p for p, _ in points]), np.array([v for _, v in points])


def held_out() -> Column:
    """Rows on which no fit may look."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def labelled(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most `rows` labelled documents (doc_id, y, text) in hash order, none of them held out.

    One label a document (the largest, if rows repeat), one text (the first in order).
    """
    known = labels.where(F.col(label).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Model:
    """Fit on at most `rows` labelled documents. Without any, all scores are 0.5."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics(byte_texts(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(stats.tolist(), pa.list_(pa.float64()))], ["doc_id", "y", "stats"])

    sample = materialise(labelled(documents, labels, label, rows).mapInArrow(trimmed(describe), "doc_id long, y double, stats array<double>"), "quality-sample")
    width = len(STATISTICS)
    moments = sample.agg(F.count("*").alias("n"), *(f(F.col("stats")[i]).alias(f"{f.__name__}{i}") for i in range(width) for f in (F.avg, F.stddev_pop))).first()
    if not moments["n"]:
        return Model(np.zeros(width), np.ones(width), None, np.array([0.0]), np.array([0.5]))
    mean = np.array([moments[f"avg{i}"] for i in range(width)])
    scale = np.maximum([moments[f"stddev_pop{i}"] for i in range(width)], 1e-6)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = fourier(np.array(batch.column(2).to_pylist()).reshape(-1, width), mean, scale)
            y, fold = batch.column(1).to_numpy(), batch.column(0).to_numpy() * 2654435761 % (1 << 32) % FOLDS
            for f in range(FOLDS):
                own = z[fold == f]
                total[f] += own.T @ np.concatenate([own, y[fold == f, None]], 1)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    # The sample is bounded, so eight tasks are enough at any size of the corpus; each sends its sums of 2 MB.
    sums = sum(np.frombuffer(r["sums"]).reshape(FOLDS, FEATURES + 1, FEATURES + 2) for r in sample.coalesce(8).mapInArrow(equations, "sums binary").collect())
    solve = lambda g: np.linalg.solve(g[:, :-1] + RIDGE * max(1.0, g[-1, -2]) / FEATURES * np.eye(FEATURES + 1), g[:, -1])
    folds = [solve(sums.sum(0) - sums[f]) for f in range(FOLDS)]
    weights = solve(sums.sum(0))

    def out_of_fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = fourier(np.array(batch.column(2).to_pylist()).reshape(-1, width), mean, scale)
            fold = batch.column(0).to_numpy() * 2654435761 % (1 << 32) % FOLDS
            raw = np.einsum("ij,ij->i", z, np.array(folds)[fold])
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column(1)], ["raw", "y"])

    pairs = sample.mapInArrow(out_of_fold, "raw double, y double").toPandas()  # bounded by `rows`
    return Model(mean, scale, weights, *isotonic(pairs["raw"].to_numpy(), pairs["y"].to_numpy()))


def score_column(model: Model, text: Column) -> Column:
    """The calibrated score of a text column; null counts as empty."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        found = pa.array(model.scores(statistics(byte_texts(column))))
        trim()
        return found

    return score(text)


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    The score sees only the text. Null texts count as empty and are scored; a row without a doc_id is scored too
    (held_out is null: no label can name it); repeated rows each give a row;
    an empty table gives none. Two passes over the text: the sample's, and the scoring.
    """
    model = fit(documents, labels)
    scored = documents.select("doc_id", held_out().alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_quality(docs: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier does not reject, with all their columns, whatever their names.

    Null texts count as empty; repeated rows are judged alike; an empty table stays empty.
    """
    model = fit(documents, labels)
    name = "_score"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, score_column(model, F.col("text"))).where(F.col(name) >= THRESHOLD).drop(name)
