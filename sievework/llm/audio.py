"""Telephony audio columns: mu-law, A-law and IMA ADPCM decoding, 8 kHz to 16 kHz PCM.

Companded samples expand through 256-entry tables. ADPCM is sequential inside a block, so the decoder
walks the nibbles of a block once and treats all blocks of a chunk as one numpy vector. All arithmetic
is on integers: a payload's features never depend on the batch it came in.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import byte_texts, chunks, trimmed

BLOCK = 576
#: Bytes of payload that are worked on at once; the files of a chunk and their samples take some forty times that.
CHUNK = 1 << 20
SEGMENT = BLOCK * 1820

_STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    np.int32,
)
_TURN = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)


def _mulaw_table() -> np.ndarray:
    u = ~np.arange(256) & 0xFF
    t = (((u & 15) << 3) + 132) << ((u & 0x70) >> 4)
    return np.where(u & 0x80, 132 - t, t - 132).astype(np.int16)


def _alaw_table() -> np.ndarray:
    a = np.arange(256) ^ 0x55
    part, low = (a & 0x70) >> 4, (a & 15) << 4
    t = np.where(part == 0, low + 8, (low + 0x108) << np.maximum(part - 1, 0))
    return np.where(a & 0x80, t, -t).astype(np.int16)


MULAW, ALAW = _mulaw_table(), _alaw_table()


def _adpcm_tables() -> tuple[np.ndarray, np.ndarray]:
    """Change of the predictor and next step index, by step index * 16 + nibble."""
    step, nibble = np.repeat(_STEPS, 16), np.tile(np.arange(16, dtype=np.int32), 89)
    change = (step >> 3) + np.where(nibble & 1, step >> 2, 0) + np.where(nibble & 2, step >> 1, 0) + np.where(nibble & 4, step, 0)
    return np.where(nibble & 8, -change, change).astype(np.int32), np.clip(np.repeat(np.arange(89), 16) + _TURN[nibble], 0, 88).astype(np.int32) * 16


_CHANGE, _NEXT = _adpcm_tables()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """IMA ADPCM: uint8 (n, size) blocks to int16 (n, 1 + 2 * (size - 4)) samples.

    A block opens with the first sample (int16, little-endian), the step index and a spare byte; an
    index over 88 counts as 88. Low nibbles come first.
    """
    n, size = blocks.shape
    out = np.empty((1 + 2 * (size - 4), n), np.int16)
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.int32) * 16
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    k = 1
    for row in codes:
        for nibble in (row & 15, row >> 4):
            at = index + nibble
            value += _CHANGE.take(at)
            np.clip(value, -32768, 32767, out=value)
            index = _NEXT.take(at)
            out[k] = value
            k += 1
    return np.ascontiguousarray(out.T)


def resample_2x(padded: np.ndarray) -> np.ndarray:
    """Double the rate with a half-band filter (-1, 9, 9, -1) / 16; one sample stands before and two after."""
    x = padded.astype(np.int32)
    between = np.clip((9 * (x[1:-2] + x[2:-1]) - x[:-3] - x[3:] + 8) >> 4, -32768, 32767)
    return np.stack([x[1:-2], between], 1).astype("<i2")


def wav(payload: bytes, law: int = 7, rate: int = 8000) -> bytes:
    """RIFF file of 8-bit companded samples: law 7 is mu-law, 6 is A-law."""
    fmt = struct.pack("<HHIIHHH", law, 1, rate, rate, 1, 8, 0)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, len(payload)) + b"data" + struct.pack("<I", len(payload)) + payload
    return b"RIFF" + struct.pack("<I", len(body)) + body


def pcm_wav(pcm: bytes, rate: int = 16000) -> bytes:
    """RIFF file of 16-bit PCM."""
    fmt = struct.pack("<HHIIHH", 1, 1, rate, 2 * rate, 2, 16)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(pcm)) + pcm
    return b"RIFF" + struct.pack("<I", len(body)) + body


def wav_block(media: bytes) -> int:
    """nBlockAlign of a RIFF file's format chunk."""
    view, at = memoryview(media), 12
    while at + 8 <= len(media):
        size = struct.unpack_from("<I", media, at + 4)[0]
        if bytes(view[at : at + 4]) == b"fmt ":
            return struct.unpack_from("<H", media, at + 20)[0]
        at += 8 + size + (size & 1)
    raise ValueError("no format chunk")


def wav_data(media: bytes) -> tuple[int, memoryview]:
    """Format code and data chunk of a RIFF file."""
    view, at, law = memoryview(media), 12, 0
    while at + 8 <= len(media):
        name, size = bytes(view[at : at + 4]), struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            law = struct.unpack_from("<H", media, at + 8)[0]
        if name == b"data":
            return law, view[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


class Tally:
    """Sums over the segments of one payload."""

    def __init__(self) -> None:
        self.n = self.mulaw = self.alaw = self.peak = self.turns = self.pcm_crc = self.adpcm_crc = self.adpcm = 0

    def text(self) -> str:
        root = lambda total: math.isqrt(total // max(1, self.n))
        return f"mulaw_rms={root(self.mulaw)};alaw_rms={root(self.alaw)};adpcm_rms={math.isqrt(self.adpcm // max(1, self.n * 2))};peak={self.peak};sign_changes={self.turns};pcm16k_crc32={self.pcm_crc:08x};adpcm_crc32={self.adpcm_crc:08x}"


def features(payloads: list[memoryview], sounds: list[memoryview]) -> list[str]:
    """Loudness, peak, sign changes and the checksums of the stored 16 kHz PCM and of the ADPCM reading of each payload.

    Payloads are multiples of BLOCK bytes. Long ones go through in segments, so memory is bounded by CHUNK.
    """
    tallies = [Tally() for _ in payloads]
    pieces = [(k, s, min(s + SEGMENT, len(p))) for k, p in enumerate(payloads) for s in range(0, len(p), SEGMENT)]
    for a, b in chunks([e - s for _, s, e in pieces], CHUNK):
        group = pieces[a:b]
        codes = np.concatenate([np.frombuffer(payloads[k], np.uint8, e - s, s) for k, s, e in group])
        ends = np.cumsum([e - s for _, s, e in group])
        starts = ends - [e - s for _, s, e in group]
        linear, other = MULAW[codes].astype(np.int64), ALAW[codes].astype(np.int64)
        negative = np.signbit(linear.astype(np.float32)).view(np.int8)
        turns = np.zeros(len(codes), np.int64)
        turns[1:] = negative[1:] != negative[:-1]
        turns[starts] = [s > 0 and (MULAW[payloads[k][s - 1]] < 0) != (MULAW[payloads[k][s]] < 0) for k, s, _ in group]
        sums = [np.add.reduceat(x, starts) for x in (linear * linear, other * other, turns)]
        peaks = np.maximum.reduceat(np.abs(linear), starts)
        samples = decode_adpcm(codes.reshape(-1, BLOCK))
        loud = (samples.astype(np.int64) ** 2).sum(1)
        for j, (k, s, e) in enumerate(group):
            t = tallies[k]
            t.n += e - s
            t.mulaw, t.alaw, t.turns = t.mulaw + int(sums[0][j]), t.alaw + int(sums[1][j]), t.turns + int(sums[2][j])
            t.peak = max(t.peak, int(peaks[j]))
            of = slice(starts[j] // BLOCK, ends[j] // BLOCK)
            t.adpcm_crc = zlib.crc32(samples[of], t.adpcm_crc)
            t.adpcm += int(loud[of].sum())
    for t, sound in zip(tallies, sounds, strict=True):
        t.pcm_crc = zlib.crc32(sound)
    return [t.text() for t in tallies]


def _linear(law: int, data: memoryview, block: int) -> np.ndarray | None:
    """Samples of a mu-law (7), A-law (6) or mono IMA ADPCM (0x11) data chunk; None for any other format.

    A short last ADPCM block gives what it holds; under its four bytes of header, nothing.
    """
    codes = np.frombuffer(data, np.uint8)
    if law in (6, 7):
        return (MULAW if law == 7 else ALAW)[codes]
    if law != 0x11 or block < 4:
        return None
    whole = len(codes) // block * block
    parts = [decode_adpcm(codes[:whole].reshape(-1, block)).reshape(-1)] if whole else []
    if len(codes) - whole >= 4:
        parts.append(decode_adpcm(codes[None, whole:])[0])
    return np.concatenate(parts) if parts else np.empty(0, np.int16)


def to_pcm(media: bytes) -> bytes | None:
    """A stored mono mu-law, A-law or IMA ADPCM file of 8 kHz as a 16 kHz PCM file; None for any other format or bytes."""
    try:
        law, data = wav_data(media)
        block = wav_block(media) if law == 0x11 else 1
    except (ValueError, struct.error):
        return None
    x = _linear(law, data, block)
    if x is None:
        return None
    out = []
    for s in range(0, len(x), SEGMENT):
        e = min(s + SEGMENT, len(x))
        around = x[[max(s - 1, 0), min(e, len(x) - 1), min(e + 1, len(x) - 1)]]
        out.append(resample_2x(np.concatenate([around[:1], x[s:e], around[1:]])).tobytes())
    return pcm_wav(b"".join(out))


def decode_media(df: DataFrame, media: str = "media") -> DataFrame:
    """Every row of df with `pcm`: its stored mu-law, A-law or IMA ADPCM file as 16 kHz PCM.

    Null, other formats and bytes that are no such file give null. A column `pcm` of df gives way to the new one.
    """

    @F.arrow_udf("binary")
    def pcm(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else to_pcm(x) for x in column.to_pylist()], pa.binary())

    return df.withColumn("pcm", pcm(media))


STORED = "doc_id long, n_bytes long, media binary, pcm binary"


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), byte_texts(batch.column(1))
        for a, b in chunks([len(x) for x in texts], CHUNK):
            media = [wav(x + b"\xff" * (-len(x) % BLOCK or (0 if x else BLOCK))) for x in texts[a:b]]
            yield pa.RecordBatch.from_arrays([ids[a:b], pa.array([len(x) for x in texts[a:b]], pa.int64()), pa.array(media, pa.binary()), pa.array([to_pcm(m) for m in media], pa.binary())], [x.split()[0] for x in STORED.split(", ")])


def stored_media(docs: DataFrame) -> DataFrame:
    """The media columns of docs: each text's bytes as a mu-law file at 8 kHz, and resampled as a 16 kHz PCM file.

    Bytes 255 fill the payload up to a positive multiple of 576. A null text counts as empty, a null doc_id stays;
    repeated rows each give a row; an empty table gives none; other columns are not read.
    """
    return docs.select("doc_id", "text").mapInArrow(trimmed(_store), STORED)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm_bytes long, pcm_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        files, pcm = batch.column(2), batch.column(3)
        sizes = [len(x.as_buffer()) for x in files]
        for a, b in chunks(sizes, CHUNK):
            media = [memoryview(x.as_buffer()) for x in files[a:b]]
            payloads = [wav_data(m)[1] for m in media]
            sounds = [memoryview(x.as_buffer()) for x in pcm[a:b]]
            told = features(payloads, [wav_data(x)[1] for x in sounds])
            sha = lambda x: hashlib.sha256(x).hexdigest()
            rows = [(len(p), sha(p), zlib.crc32(p[-32:]), len(m), sha(m), f, len(x), sha(x)) for p, m, f, x in zip(payloads, media, told, sounds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(1)[a:b], *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], [x.split()[0] for x in DIGEST.split(", ")])


def media_digest(docs: DataFrame) -> DataFrame:
    """`stored_media`, read back from its bytes and described: the payload, the stored files and how they sound.

    Equal texts give equal values. One pass, no shuffle: a worker stores a chunk's files and reads them back before
    it goes on, so the files of ten thousand texts never wait in one batch.
    """
    return docs.select("doc_id", "text").mapInArrow(trimmed(lambda batches: _digest(_store(batches))), DIGEST)
