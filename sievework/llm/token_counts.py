"""Greedy longest-match token counts in linear time, without building the pieces.

A trie over the vocabulary carries a failure link and a popped-token count at every node: when no edge
fits, the count is added and the link followed, so each byte is looked at once (LinMaxMatch). The count
of a word is kept for its next occurrence.
"""

from __future__ import annotations

import functools
import json
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sievework.llm.shared import byte_texts

CACHED = 400_000
LONGEST_CACHED = 64
COUNTS = "doc_id long, n_bytes long, n_words long, n_tokens long, longest_word_tokens long"


class LongestMatch:
    """Automaton over byte strings; every single byte counts as a token of the vocabulary."""

    def __init__(self, vocabulary: Iterable[bytes]) -> None:
        edges: dict[int, int] = {}  # node * 256 + byte: node
        final, children = [False], [[]]
        for token in {*vocabulary, *(bytes([b]) for b in range(256))} - {b""}:
            node = 0
            for b in token:
                key = node << 8 | b
                child = edges.get(key)
                if child is None:
                    child = edges[key] = len(final)
                    final.append(False)
                    children.append([])
                    children[node].append(b)
                node = child
            final[node] = True
        link, popped = [-1] * len(final), [0] * len(final)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for b in children[node]:
                child = edges[node << 8 | b]
                queue.append(child)
                if final[child]:
                    link[child], popped[child] = 0, 1
                    continue
                at, count = link[node], popped[node]
                while at >= 0 and (at << 8 | b) not in edges:
                    count += popped[at]
                    at = link[at]
                link[child], popped[child] = edges[at << 8 | b], count  # some link ends at a single byte
        self.edges, self.link, self.popped = edges, link, popped
        self.cache: dict[bytes, int] = {}

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces of one word."""
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for b in word:
            while (then := edges.get(node << 8 | b)) is None:
                total += popped[node]
                node = link[node]
            node = then
        while node:
            total += popped[node]
            node = link[node]
        return total

    def counts(self, words: list[bytes]) -> list[int]:
        cache = self.cache
        found = list(map(cache.get, words))
        for i, n in enumerate(found):
            if n is None:
                word = words[i]
                if (n := cache.get(word)) is None:
                    n = self.count(word)
                    if len(word) <= LONGEST_CACHED:
                        if len(cache) >= CACHED:
                            cache.clear()
                        cache[word] = n
                found[i] = n
        return found


def _byte_of() -> dict[str, int]:
    """Inverse of the byte-level alphabet of vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def word_vocabulary(path: str) -> set[bytes]:
    """Byte strings of a vocabulary file's tokens, without their end-of-word marks and the special tokens."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special, byte_of = {t["content"] for t in model.get("added_tokens", [])}, _byte_of()
    return {bytes(byte_of[c] for c in t.removesuffix("</w>")) for t in model["model"]["vocab"] if t not in special}


@functools.cache
def automaton(path: str) -> LongestMatch:
    return LongestMatch(word_vocabulary(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """Words and greedy longest-match tokens of every whole text, A-Z in lower case, words split at white space.

    A null text counts as empty: no words, no tokens; a null doc_id stays. Repeated rows each give a row, an empty table gives
    none, other columns of docs are not read. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = automaton(path)
        for batch in batches:
            rows = []
            for text in byte_texts(batch.column(1)):
                counts = match.counts(text.lower().split())
                rows.append((len(text), len(counts), sum(counts), max(counts, default=0)))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], [x.split()[0] for x in COUNTS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, COUNTS)
