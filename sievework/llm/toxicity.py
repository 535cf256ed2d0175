"""Classifier chain for toxicity categories.

Features are the presence of words and word beginnings that the labelled rows tie to toxicity. The chain
predicts `marked` (toxic and holds a marker), then `repeated` (toxic and holds three or more), then `toxic`;
each linear model sees the probabilities of the categories before it, in training those of models that did
not see the row's fold, neither in their weights nor in the choice of their terms and markers. There is one label;
the first two categories are derived from it.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.quality import labelled
from sievework.llm.shared import materialise, trim, trimmed

#: Bounds of the labelled rows, taken in hash order, and of the vocabulary that a fit uses.
FIT_ROWS, TERMS, BLOCK = 12_000, 512, 1024  # at most 32,767 rows: their counts by fold are packed
FOLDS, THRESHOLD = 4, 0.3
CATEGORIES = ("marked", "repeated", "toxic")
BEGINNINGS = (4, 5, 6)
#: A marker stands in toxic rows so many times as often as in others, at least.
MARKER_RATIO = 20.0
_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str) -> set[str]:
    """The text's words in lower case, and their beginnings as `abcd-`."""
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for n in BEGINNINGS:
        out |= {w[:n] + "-" for w in words if len(w) > n}
    return out


@dataclass
class Chain:
    """Vocabulary and the weights of each category's model: bias, terms, earlier probabilities."""

    index: dict[str, int]
    weights: list[np.ndarray]

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        """A row of category probabilities for each list of term numbers."""
        out = np.zeros((len(rows), len(CATEGORIES)))
        owner = np.repeat(np.arange(len(rows)), [len(at) for at in rows])
        flat = np.concatenate([*rows, np.empty(0, np.int64)])
        for c, w in enumerate(self.weights):
            held = np.bincount(owner, w[1 + flat], len(rows)) if len(flat) else np.zeros(len(rows))
            out[:, c] = sigmoid(w[0] + held + out[:, :c] @ w[1 + len(self.index) :])
        return out

    def numbers(self, text: str) -> np.ndarray:
        index, n = self.index, len(self.lengths)
        words = set(_WORD.findall(text.lower()))
        found = {index[w] for w in words & index.keys()}
        for k in range(n):
            length = self.lengths[k]
            for begin in {w[:length] for w in words if len(w) > length}:
                if (i := index.get(begin + "-")) is not None:
                    found.add(i)
        return np.array(sorted(found), np.int64)

    @functools.cached_property
    def lengths(self) -> list[int]:
        """Lengths of the beginnings that the vocabulary has."""
        return sorted({len(t) - 1 for t in self.index if t.endswith("-")})


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray | Inputs, y: np.ndarray, rows: np.ndarray, penalty: float = 0.3, steps: int = 30) -> np.ndarray:
    """Ridge-penalised logistic regression on these rows by Newton steps; the bias is free, the first weight.

    Sums go over blocks of rows, so no copy of x is made.
    """
    n = x.shape[1] + 1
    w, ridge = np.zeros(n), np.full(n, penalty)
    ridge[0] = 1e-3
    for _ in range(steps):
        gradient, hessian = ridge * w, np.diag(ridge)
        for a in range(0, len(rows), BLOCK):
            part = rows[a : a + BLOCK]
            z = np.concatenate([np.ones((len(part), 1), x.dtype), x[part]], 1)
            p = sigmoid(z @ w)
            gradient += (p - y[part]) @ z
            z_weighted = z * (p * (1 - p)).astype(x.dtype)[:, None]
            hessian += z_weighted.T @ z
        move = np.linalg.solve(hessian, gradient)
        move *= min(1.0, 5 / max(1e-9, np.abs(move).max()))
        w -= move
        if np.abs(move).max() < 1e-3:
            break
    return w


@dataclass
class View:
    """What a set of rows selects: columns of the terms, and which of them are markers."""

    columns: np.ndarray
    markers: np.ndarray

    def targets(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        held = x[:, self.columns[self.markers]].sum(1, dtype=np.int64)
        return np.stack([y * (held >= 1), y * (held >= 3), y], 1)


class Inputs:
    """Rows of a view's terms and of the earlier probabilities, put together for the rows that are asked for."""

    dtype = np.dtype(np.float32)

    def __init__(self, x: np.ndarray, view: View, seen: np.ndarray) -> None:
        self.x, self.columns, self.seen, self.shape = x, view.columns, seen, (len(x), len(view.columns) + seen.shape[1])

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.x[np.ix_(rows, self.columns)].astype(self.dtype), self.seen[rows].astype(self.dtype)], 1)


def fit_chain(x: np.ndarray, y: np.ndarray, fold: np.ndarray, every: View, without: list[View]) -> list[np.ndarray]:
    """Weights by category, for the terms of `every`.

    The probability of an earlier category that a row is trained with comes from a model that has not seen the
    row's fold: neither its weights nor its terms and markers, which are those of `without` that fold.
    """
    weights, rows, seen = [], np.arange(len(x)), np.zeros((len(x), len(CATEGORIES)))
    own = every.targets(x, y)
    for c in range(len(CATEGORIES)):
        weights.append(logistic(Inputs(x, every, seen[:, :c]), own[:, c], rows))
        for f, view in enumerate(without if c + 1 < len(CATEGORIES) else []):
            left = rows[fold == f]
            if len(left) and len(left) < len(rows):
                inputs = Inputs(x, view, seen[:, :c])
                w = logistic(inputs, view.targets(x, y)[:, c], rows[fold != f])
                seen[left, c] = sigmoid(w[0] + inputs[left] @ w[1:])
    return weights


def _chosen(counts: DataFrame, t: Column, c: Column, n_toxic: int, n_clean: int) -> list:
    """The TERMS terms (term, ratio) that tell most about toxicity, by likelihood ratio, of those in three toxic rows or more."""
    cell = lambda seen, expected: seen * F.log(F.greatest(seen, F.lit(1e-9)) / expected)
    share = (t + c) / (n_toxic + n_clean)
    surprise = cell(t, share * n_toxic + 1e-9) + cell(c, share * n_clean + 1e-9) + cell(n_toxic - t, (1 - share) * n_toxic + 1e-9) + cell(n_clean - c, (1 - share) * n_clean + 1e-9)
    ratio = ((t + 0.5) / (n_toxic + 1)) / ((c + 0.5) / (n_clean + 1))
    return counts.where(t >= 3).select("term", surprise.alias("g"), ratio.alias("ratio")).orderBy(F.desc("g"), "term").limit(TERMS).collect()


def fit(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Chain:
    """Fit the chain on at most `rows` labelled documents. Without toxic ones among them, nothing is toxic."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that hold a term, toxic and clean: sixteen bits a fold, as `rows` allows, flushed before they grow large."""
        toxic, clean = {}, {}

        def flushed() -> pa.RecordBatch:
            names = list({**toxic, **clean})
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic.get(t, 0) for t in names], pa.int64()), pa.array([clean.get(t, 0) for t in names], pa.int64())], ["term", "t", "c"])
            toxic.clear()
            clean.clear()
            return out

        for batch in batches:
            for y, fold, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                held = toxic if y else clean
                for t in terms(text or ""):
                    held[t] = held.get(t, 0) + (1 << 16 * fold)
                if len(toxic) + len(clean) > 200_000:
                    yield flushed()
        yield flushed()

    fold = (F.floor(F.crc32(F.col("doc_id").cast("string")) / 5) % FOLDS).cast("int")
    sample = materialise(labelled(documents, labels, "toxic", rows).select("y", fold.alias("fold"), "text"), "toxicity-sample")
    sizes = {(r["y"] > 0, r["fold"]): r["count"] for r in sample.groupBy("y", "fold").count().collect()}
    total = {y: sum(n for (z, _), n in sizes.items() if z == y) for y in (True, False)}
    empty = Chain({}, [np.array([-10.0, *[0.0] * c]) for c in range(len(CATEGORIES))])
    if not total[True]:
        return empty
    parts = [F.sum(F.shiftrightunsigned(k, 16 * f).bitwiseAND(F.lit(65535))).alias(f"{k}{f}") for f in range(FOLDS) for k in "tc"]
    counts = materialise(sample.mapInArrow(trimmed(count), "term string, t long, c long").groupBy("term").agg(*parts), "toxicity-terms")
    chosen = []
    for left in (None, *range(FOLDS)):
        t, c = (sum((F.col(f"{k}{f}") for f in range(FOLDS) if f != left), F.lit(0)) for k in "tc")
        n_toxic, n_clean = (total[y] - sizes.get((y, left), 0) for y in (True, False))
        chosen.append(_chosen(counts, t, c, n_toxic, n_clean) if n_toxic else [])
    if not chosen[0]:
        return empty
    index = {t: i for i, t in enumerate(dict.fromkeys(r["term"] for rows in chosen for r in rows))}
    views = [View(np.array([index[r["term"]] for r in rows], np.int64), np.array([r["ratio"] >= MARKER_RATIO for r in rows], bool)) for rows in chosen]
    chain = Chain(index, [])

    @F.arrow_udf("array<long>")
    def number(column: pa.Array) -> pa.Array:
        return pa.array([chain.numbers(x or "").tolist() for x in column.to_pylist()], pa.list_(pa.int64()))

    found = sample.select("y", "fold", number("text").alias("at")).toPandas()  # bounded by `rows`
    x = np.zeros((len(found), len(index)), np.uint8)
    for i, at in enumerate(found["at"]):
        x[i, np.asarray(at, np.int64)] = 1
    weights = fit_chain(x, found["y"].to_numpy(), found["fold"].to_numpy(), views[0], views[1:])
    return Chain({r["term"]: i for i, r in enumerate(chosen[0])}, weights)


def probabilities_column(chain: Chain, text: Column) -> Column:
    """Struct of the categories' probabilities; null counts as empty."""

    @F.arrow_udf("struct<marked: double, repeated: double, toxic: double>")
    def chained(column: pa.Array) -> pa.Array:
        p = chain.probabilities([chain.numbers(x or "") for x in column.to_pylist()])
        trim()
        return pa.StructArray.from_arrays([pa.array(p[:, c]) for c in range(len(CATEGORIES))], list(CATEGORIES))

    return chained(text)


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the categories' probabilities p_marked, p_repeated, p_toxic, and predicted (1: toxic) of every document.

    Whole texts are read; null texts count as empty and are scored; a null doc_id stays; repeated rows each give a
    row; an empty table gives none; other columns are not read. One pass for the sample, one for the scores, no shuffle of texts outside the sample.
    """
    chain = fit(documents, labels)
    p = documents.select("doc_id", probabilities_column(chain, F.col("text")).alias("p"))
    return p.select("doc_id", *(F.col(f"p.{c}").alias(f"p_{c}") for c in CATEGORIES), (F.col("p.toxic") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the chain does not call toxic, with all their columns, whatever their names.

    Null texts count as empty; repeated rows are judged alike; an empty table stays empty.
    """
    chain = fit(documents, labels)
    name = "_toxic"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, probabilities_column(chain, F.col("text"))).where(F.col(f"{name}.toxic") < THRESHOLD).drop(name)
