"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Boundaries are found without regular expressions. Every code point maps to a class; looking one to three
characters ahead by array shifts gives it one of eleven symbols; a symbol is a transition function on the
eight states of the pattern's automaton. Composition of functions is associative, so the scan runs over
blocks in parallel: first the function of each block, then the state at each block's start, then the
boundaries inside all blocks at once. The functions that occur are numbered and their compositions kept in
a table. The slices between boundaries go through cached pair merging; their byte offsets are kept.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievework.llm.shared import byte_texts, chunks

CHUNK = 2 << 20
CACHED = 400_000
LONGEST_CACHED = 64
LANE = 256

# Classes of code points.
OTHER, LETTER, NUMBER, BREAK, SPACE, MARK, END = range(7)  # BREAK: white space but U+0020; MARK: apostrophe
# States: nothing open, inside letters, numbers, others or white space, a space waiting for its word, and one or two letters of a contraction to come.
Z, IN_L, IN_N, IN_O, IN_W, WAIT, ONE, TWO = range(8)
# Symbols.
S_O, S_L, S_N, S_BREAK, S_SPACE, S_MORE, S_MARK2, S_MARK3, S_END = range(9)

_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point; one past the last is the end of a text."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)] + [END], np.uint8)
    table[_WHITE], table[32], table[39] = BREAK, SPACE, MARK
    return table


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and boundary flag by symbol and state."""
    step, cut = np.zeros((9, 8), np.uint8), np.zeros((9, 8), bool)
    for symbol, inside in ((S_L, IN_L), (S_N, IN_N), (S_O, IN_O)):
        step[symbol] = inside
        cut[symbol] = True
        cut[symbol, [inside, WAIT]] = False
    step[S_L, TWO], step[S_L, ONE] = ONE, Z
    cut[S_L, [TWO, ONE]] = False
    for symbol, then in ((S_MARK2, ONE), (S_MARK3, TWO)):
        step[symbol] = then
        cut[symbol] = True
        step[symbol, [IN_O, WAIT]] = IN_O
        cut[symbol, [IN_O, WAIT]] = False
    step[S_BREAK], cut[S_BREAK] = Z, True
    step[S_SPACE], cut[S_SPACE] = WAIT, True
    step[S_MORE], cut[S_MORE] = IN_W, True
    cut[S_MORE, IN_W] = False
    return step, cut  # S_END: back to Z, no boundary


@functools.cache
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each symbol's function, the composition table (first, then second), and the functions' values."""
    step, _ = automaton()
    functions = {tuple(range(8)): 0}
    for row in step:
        functions.setdefault(tuple(row.tolist()), len(functions))
    todo = list(functions)
    while todo:
        f = todo.pop()
        for row in step:
            g = tuple(int(row[x]) for x in f)
            if g not in functions:
                functions[g] = len(functions)
                todo.append(g)
    values = np.array(list(functions), np.uint8)
    numbers = np.array([functions[tuple(row.tolist())] for row in step], np.uint16)
    compose = np.array([[functions[tuple(g[f].tolist())] for g in values] for f in values], np.uint16)
    return numbers, compose, values


def boundaries(points: np.ndarray) -> np.ndarray:
    """Indexes in code points at which a pre-token starts; texts end with the code point sys.maxunicode + 1."""
    n = len(points)
    kind = classes()[points]
    symbol = np.array([S_O, S_L, S_N, S_BREAK, S_SPACE, S_O, S_END], np.uint8)[kind]
    ahead = np.concatenate([kind[1:], [END]])
    white = (kind == BREAK) | (kind == SPACE)
    symbol[white & ((ahead == BREAK) | (ahead == SPACE) | (ahead == END))] = S_MORE
    marks = np.flatnonzero(kind == MARK)
    if len(marks):
        after = points.take(np.minimum(marks[:, None] + [1, 2], n - 1))
        one, two = after[:, 0], after[:, 1]
        symbol[marks[np.isin(one, [ord(c) for c in "stmd"])]] = S_MARK2
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        symbol[marks[long]] = S_MARK3
    lanes = -(-n // LANE)
    grid = np.full(lanes * LANE, S_END, np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(lanes, LANE).T)
    numbers, compose, values = monoid()
    whole = np.zeros(lanes, np.uint16)
    flat, width = compose.ravel(), compose.shape[1]
    for row in grid:
        whole = flat.take(whole.astype(np.int64) * width + numbers[row])
    state, starts = 0, np.empty(lanes, np.uint8)
    for k, f in enumerate(whole.tolist()):
        starts[k] = state
        state = values[f, state]
    step, cut = automaton()
    flat_step, flat_cut = step.ravel(), cut.ravel()
    marked = np.empty((LANE, lanes), bool)
    for k, row in enumerate(grid):
        at = row.astype(np.intp) * 8 + starts
        marked[k] = flat_cut.take(at)
        starts = flat_step.take(at)
    return np.flatnonzero(marked.T.ravel()[:n])


def pretokens(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Slices of all texts, their byte offsets in the joined texts, and the index of each text's first slice."""
    joined = b"".join(texts)
    end = np.array([sys.maxunicode + 1], np.uint32)
    points = np.concatenate([x for t in texts for x in (np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le"), np.uint32), end)])
    starts = boundaries(points)
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    width[points > sys.maxunicode] = 0
    at = np.cumsum(width) - width
    offsets = np.append(at[starts], len(joined))
    ends = np.cumsum([len(t) for t in texts])
    firsts = np.searchsorted(offsets[:-1], np.concatenate([[0], ends]))
    where = offsets.tolist()
    return [joined[s:e] for s, e in zip(where, where[1:])], offsets, firsts


#: A blank before a visible ASCII character: a pre-token starts at the blank, whatever stands around it.
_CUT = re.compile(rb" [!-~]")


def parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about CHUNK bytes that end where pre-tokens end for certain."""
    start = 0
    while start < len(text):
        found = _CUT.search(text, start + CHUNK) if len(text) - start > 2 * CHUNK else None
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


class ByteBpe:
    """Encoder and decoder of a rank file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.digits = [str(i) for i in range(len(self.bytes_of))]
        self.lengths = np.array([len(t) for t in self.bytes_of], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one slice: the lowest-ranked pair merges first, leftmost among equals."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return (whole,)
        if len(piece) > LONGEST_CACHED:
            return self.merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        scores = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        while scores and (low := min(scores)) < 1 << 60:
            i = scores.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
            if i < len(scores):
                scores[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
        return tuple(map(ranks.__getitem__, parts))

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """As `merge`, with a heap and linked parts: n log n for runs of any length."""
        ranks, n = self.ranks, len(piece)
        part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or len(part[i]) + len(part[j]) != size:
                continue
            part[i] += part[j]
            part[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(pair := part[i] + part[k])) is not None:
                    heapq.heappush(heap, (r, i, len(pair)))
            if (h := before[i]) >= 0 and (r := ranks.get(pair := part[h] + part[i])) is not None:
                heapq.heappush(heap, (r, h, len(pair)))
        return tuple(ranks[p] for p in part if p is not None)

    def encode_slices(self, slices: list[bytes]) -> list[tuple[int, ...]]:
        cache = self.cache
        found = list(map(cache.get, slices))
        for i, ids in enumerate(found):
            if ids is None:
                piece = slices[i]
                if (ids := cache.get(piece)) is None:
                    ids = self.merge(piece)
                    if len(piece) <= LONGEST_CACHED:
                        if len(cache) >= CACHED:
                            cache.clear()
                        cache[piece] = ids
                found[i] = ids
        return found

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of every text; the arrays of the scan are made for about CHUNK bytes at a time, however long a text."""
        if any(len(t) > 2 * CHUNK for t in texts):
            return [[i for part in parts(t) for i in self._encode([part])[0]] if t else [] for t in texts]
        return self._encode(texts)

    def _encode(self, texts: list[bytes]) -> list[list[int]]:
        slices, _, firsts = pretokens(texts)
        ids = self.encode_slices(slices)
        return [[i for piece in ids[a:b] for i in piece] for a, b in zip(firsts, firsts[1:])]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The text of the ids: every token's bytes are copied to its offset, all at once."""
        out = []
        for a in range(0, len(ids), CHUNK):
            own, to = ids[a : a + CHUNK], offsets[a : a + CHUNK + 1]
            out.append(self.flat[np.repeat(self.starts[own] - to[:-1], np.diff(to)) + np.arange(to[0], to[-1])].tobytes())
        return b"".join(out)

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of every token in the text, and the end."""
        return np.concatenate([[0], np.cumsum(self.lengths[ids])])


@functools.cache
def encoder(path: str) -> ByteBpe:
    return ByteBpe(path)


def _encoded(batches: Iterator[pa.RecordBatch], bpe: ByteBpe) -> Iterator[tuple[pa.Array, list[np.ndarray], list[np.ndarray]]]:
    """doc_ids, ids and byte offsets of the tokens, some texts at a time."""
    for batch in batches:
        texts = byte_texts(batch.column(1))
        for a, b in chunks([len(t) for t in texts], CHUNK):
            ids = [np.array(x, np.int64) for x in bpe.encode(texts[a:b])]
            yield batch.column(0)[a:b], ids, [bpe.offsets(x) for x in ids]


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and offsets (byte offsets of the tokens, and the end) of every text.

    Null texts are empty; a null doc_id stays; repeated rows each give a row; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids, offsets in _encoded(batches, encoder(path)):
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(ids, pa.list_(pa.int32())), pa.array(offsets, pa.list_(pa.int64()))], ["doc_id", "ids", "offsets"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>")


def decode_texts(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of `encode_texts`' rows, by their offsets; null ids or offsets give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = [None if i is None or o is None else bpe.decode(np.array(i, np.int64), np.array(o, np.int64)).decode("utf-8", "replace") for i, o in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids", "offsets").mapInArrow(run, "doc_id long, text string")


def encode_digest(docs: DataFrame, path: str) -> DataFrame:
    """Encode every whole text and decode it by the offsets kept: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null text counts as empty (no tokens), a null doc_id stays; repeated rows each give a row; an empty table
    gives none; other columns of docs are not read. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        digit = bpe.digits.__getitem__
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for doc_ids, ids, offsets in _encoded(batches, bpe):
            rows = [(len(i), sha(",".join(map(digit, i.tolist())).encode()), sha(bpe.decode(i, o))) for i, o in zip(ids, offsets, strict=True)]
            yield pa.RecordBatch.from_arrays([doc_ids, *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
