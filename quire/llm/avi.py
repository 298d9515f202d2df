"""AVI motion-JPEG columns: payloads stored losslessly as 8-bit samples, read back by their RIFF index, cut into shots.

A frame is a grey 24 x 24 picture in lossless JPEG (SOF3, predictor 1). Its Huffman table gives difference category s a
code of 9 - s bits, so code and extra bits of a sample take 9 bits together and a whole column of frames is coded and
decoded by array operations. Every frame is an intra frame with its own table and can be decoded alone.

Shots are cut where the histogram difference of neighbouring frames stands out from the differences just before: over
`floor` and over their mean plus `k` standard deviations.

Cases: a null text counts as empty; an empty payload takes one frame of padding; a null media value gives no clip; bytes
that are no AVI of such frames (other programs write lossy frames) give none either and "unreadable" as their feature;
null ids stay null; repeated rows give repeated rows; equal texts give equal media; empty tables give empty results;
texts of any length are stored whole, in further AVIX segments nothing is written but they are read; columns beside id
and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm import common
from quire.llm import kernels as K

SIDE = 24
SAMPLES = SIDE * SIDE
PADDING = 255
FRAMES_PER_S = 25
CODED = SAMPLES * 9 // 8

MEDIA = "doc_id long, media binary"
DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
CLIPS = "doc_id long, clip int, first_frame int, last_frame int, start_s double, end_s double, brightness double"

#: Code lengths 1 to 9 hold one category each, from 8 down to 0.
_TABLE = struct.pack(">HHB16B9B", 0xFFC4, 2 + 17 + 9, 0, *[1] * 9, *[0] * 7, *range(8, -1, -1))
_FRAME = struct.pack(">HHBHHBBBB", 0xFFC3, 11, 8, SIDE, SIDE, 1, 1, 0x11, 0)
_SCAN = struct.pack(">HHBBBBBB", 0xFFDA, 8, 1, 1, 0, 1, 0, 0)
HEAD, TAIL = b"\xff\xd8" + _TABLE + _FRAME + _SCAN, b"\xff\xd9"


def _codes() -> np.ndarray:
    out = np.empty(511, np.uint16)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        ones = ((1 << (8 - s)) - 1) << 1  # 8 - s ones and a zero
        out[d + 255] = ones << s | (d if d > 0 else d + (1 << s) - 1)
    return out


_CODE = _codes()
_DIFFERENCE = np.zeros(512, np.int16)
_DIFFERENCE[_CODE] = np.arange(-255, 256)


def coded_frames(samples: np.ndarray) -> list[bytes]:
    """JPEG files of n x 576 samples."""
    x = samples.reshape(-1, SIDE, SIDE).astype(np.int16)
    d = x.copy()
    d[:, :, 1:] -= x[:, :, :-1]
    d[:, 1:, 0] -= x[:, :-1, 0]
    d[:, 0, 0] -= 128
    c = _CODE[d + 255].reshape(-1, SAMPLES // 8, 8)
    out = np.empty((*c.shape[:2], 9), np.uint8)
    out[..., 0] = c[..., 0] >> 1
    for i in range(1, 8):
        out[..., i] = (c[..., i - 1] & ((1 << i) - 1)) << (8 - i) | c[..., i] >> (1 + i)
    out[..., 8] = c[..., 7] & 0xFF
    raw = out.tobytes()
    return [HEAD + raw[i : i + CODED].replace(b"\xff", b"\xff\x00") + TAIL for i in range(0, len(raw), CODED)]


def decoded_frames(frames: list[bytes]) -> np.ndarray:
    """n x 576 samples of JPEG files as coded_frames makes them."""
    parts = []
    for f in frames:
        scan = f[len(HEAD) : -2].replace(b"\xff\x00", b"\xff")
        if not f.startswith(HEAD) or not f.endswith(TAIL) or len(scan) != CODED:
            raise ValueError("not a lossless 24 x 24 frame with the fixed table")
        parts.append(scan)
    b = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, SAMPLES // 8, 9).astype(np.uint16)
    c = np.empty((*b.shape[:2], 8), np.uint16)
    for i in range(8):
        c[..., i] = (b[..., i] & ((1 << (8 - i)) - 1)) << (1 + i) | b[..., i + 1] >> (7 - i)
    x = _DIFFERENCE[c].reshape(-1, SIDE, SIDE).astype(np.int32)
    x[:, 0, 0] += 128
    x[:, :, 0] = np.cumsum(x[:, :, 0], axis=1)
    return np.cumsum(x, axis=2).astype(np.uint8).reshape(-1, SAMPLES)


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)


def written_avi(frames: list[bytes]) -> bytes:
    size = max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // FRAMES_PER_S, size * FRAMES_PER_S, 0, 0x10, len(frames), 0, 1, size, SIDE, SIDE, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, FRAMES_PER_S, 0, len(frames), size, 0, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", SAMPLES, 0, 0, 0, 0)
    head = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    index = np.zeros(len(frames), [("id", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")])
    index["id"], index["flags"] = b"00dc", 0x10
    index["size"] = sizes = np.fromiter(map(len, frames), np.int64, len(frames))
    padded = 8 + sizes + (sizes & 1)
    index["at"] = 4 + np.cumsum(padded) - padded
    body = head + _chunk(b"LIST", b"movi" + b"".join([_chunk(b"00dc", f) for f in frames])) + _chunk(b"idx1", index.tobytes())
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"AVI " + body


def _chunks(raw: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        name, size = struct.unpack_from("<4sI", raw, at)
        yield name, at + 8, size
        at += 8 + size + (size & 1)


def _frame_chunks(raw: bytes, base: int, size: int) -> list[bytes]:
    return [raw[a : a + n] for name, a, n in _chunks(raw, base + 4, base + size) if name[2:] in (b"dc", b"db")]


def frames_of(raw: bytes) -> tuple[list[bytes], float]:
    """Frames of the first video stream, by the idx1 index or, where there is none, chunk by chunk; frames a second."""
    if raw[:4] != b"RIFF" or raw[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    movi, index, rate = None, None, float(FRAMES_PER_S)
    todo = [(12, min(len(raw), 8 + struct.unpack_from("<I", raw, 4)[0]))]
    while todo:
        at, end = todo.pop()
        for name, start, size in _chunks(raw, at, end):
            if name == b"LIST" and raw[start : start + 4] in (b"hdrl", b"strl"):
                todo.append((start + 4, start + size))
            elif name == b"LIST" and raw[start : start + 4] == b"movi":
                movi = (start, size)
            elif name == b"idx1":
                index = raw[start : start + size]
            elif name == b"strh" and raw[start : start + 4] == b"vids":
                scale, ticks = struct.unpack_from("<II", raw, start + 20)
                rate = ticks / scale if scale else rate
    if movi is None:
        raise ValueError("an AVI file without movi list")
    # Segments after the first have no index of their own kind: their frames are found chunk by chunk.
    later, at = [], 8 + struct.unpack_from("<I", raw, 4)[0]
    while raw[at : at + 4] == b"RIFF" and raw[at + 8 : at + 12] == b"AVIX":
        end = at + 8 + struct.unpack_from("<I", raw, at + 4)[0]
        for name, start, size in _chunks(raw, at + 12, min(end, len(raw))):
            if name == b"LIST" and raw[start : start + 4] == b"movi":
                later += _frame_chunks(raw, start, size)
        at = end + (end & 1)
    base, size = movi
    if index is None:
        return _frame_chunks(raw, base, size) + later, rate
    found = np.frombuffer(index, [("id", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")])
    # Places count from the movi list's name, or in some files from the start of the file.
    shift = base if not len(found) or found["at"][0] < base else 0
    mine = np.isin(found["id"], [b"00dc", b"00db"])
    return [raw[shift + a + 8 : shift + a + 8 + n] for a, n in zip(found["at"][mine].tolist(), found["size"][mine].tolist(), strict=True)] + later, rate


def cuts(samples: np.ndarray, floor: float = 0.25, k: float = 2.0, window: int = 8) -> list[int]:
    """First frames of all shots."""
    n = len(samples)
    if n < 2:
        return [0] * min(n, 1)
    bins = (samples >> 3).astype(np.int64) + 32 * np.arange(n)[:, None]
    h = np.bincount(bins.ravel(), minlength=32 * n).reshape(n, 32)
    d = np.abs(np.diff(h, axis=0)).sum(axis=1) / (2 * SAMPLES)
    sums, squares = np.concatenate([[0], np.cumsum(d)]), np.concatenate([[0], np.cumsum(d * d)])
    at = np.arange(n - 1)
    first = np.maximum(0, at - window)
    m = np.maximum(1, at - first)
    mean = (sums[at] - sums[first]) / m
    spread = np.sqrt(np.maximum(0, (squares[at] - squares[first]) / m - mean * mean))
    return [0, *(np.flatnonzero(d > np.maximum(floor, mean + k * spread)) + 1).tolist()]


def payload_of(text: bytes) -> bytes:
    return text + bytes([PADDING]) * (-len(text) % SAMPLES if text else SAMPLES)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and media: each text's UTF-8 bytes, padded with 255, as an AVI file."""
    common.bounded_batches(common.session(docs))
    schema = common.struct(MEDIA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 4 << 20):
            buf, at = K.buffer_of(b.column("text"))
            texts = [payload_of(buf[i:j].tobytes()) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            frames = coded_frames(np.frombuffer(b"".join(texts), np.uint8))
            ends = np.cumsum([len(t) // SAMPLES for t in texts]).tolist()
            media = [written_avi(frames[i:j]) for i, j in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(media, pa.binary())], schema=common.arrow_schema(schema))

    return common.texts_of(docs, id_col, text_col).mapInArrow(common.tidied(run), schema)


def _read(media: bytes | None) -> tuple[np.ndarray, float, list[tuple[int, int]], bool]:
    """Samples, frames a second, the first and last frame of each shot, and whether the value is null or can be read."""
    if media is None:
        return np.zeros((0, SAMPLES), np.uint8), FRAMES_PER_S, [], True
    try:
        frames, rate = frames_of(media)
        samples = decoded_frames(frames)
    except (ValueError, struct.error):
        return np.zeros((0, SAMPLES), np.uint8), FRAMES_PER_S, [], False
    firsts = cuts(samples)
    return samples, rate, [(a, b - 1) for a, b in zip(firsts, [*firsts[1:], len(samples)], strict=False)], True


def clips(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row per shot: its number, frames, times and mean brightness."""
    schema = common.struct(CLIPS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            rows = []
            for i, m in zip(b.column("id").to_pylist(), b.column("media").to_pylist(), strict=True):
                samples, rate, shots, _ = _read(m)
                for c, (a, e) in enumerate(shots):
                    rows.append({"doc_id": i, "clip": c, "first_frame": a, "last_frame": e, "start_s": a / rate, "end_s": (e + 1) / rate, "brightness": float(samples[a : e + 1].mean())})
            yield pa.RecordBatch.from_pylist(rows, schema=common.arrow_schema(schema))

    return common.source_rows(media, id_col, (media_col, "media", "binary")).mapInArrow(common.tidied(run), schema)


def media_digests(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Digests of each media value and of the payload decoded from it, and its shots as "first-last" frames."""
    schema = common.struct(DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            rows = []
            for i, m in zip(b.column("id").to_pylist(), b.column("media").to_pylist(), strict=True):
                samples, rate, shots, known = _read(m)
                payload = samples.tobytes()
                spans = ",".join(f"{a}-{e}" for a, e in shots)
                n = len(payload.rstrip(bytes([PADDING])))  # no UTF-8 text ends in byte 255
                rows.append((i, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m or b""), hashlib.sha256(m or b"").hexdigest(), f"{len(samples)} frames at {rate:g}/s: {spans}" if known else "unreadable"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(common.arrow_schema(schema))], schema=common.arrow_schema(schema))

    return common.source_rows(media, id_col, (media_col, "media", "binary")).mapInArrow(common.tidied(run), schema)
