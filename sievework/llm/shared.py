"""Plumbing of the corpus operators: durable intermediate tables, dense positions, Arrow batch helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

from sievework.functions.batches import trim
from sievework.operators.store import dropped, joined_unevenly, positioned, scratch, settled, shared_root
from sievework.operators.store import stored as materialise

__all__ = ["byte_texts", "chunks", "dropped", "joined_unevenly", "materialise", "positioned", "scratch", "settled", "shared_root", "trim", "trimmed"]


def byte_texts(column: pa.Array) -> list[bytes]:
    """A string column's values as UTF-8 bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes add up to about `limit`, at least one index each."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, and `trim` at its end: Python workers outlive their tasks, and an executor holds several of them."""

    def then_trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return then_trim
