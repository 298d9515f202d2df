"""Whole-batch byte kernels: spans of words and pieces in a column of texts, and 64-bit hashes of spans."""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pyarrow as pa

BLANK, LETTER, NUMBER, OTHER, ODD = 0, 1, 2, 3, 4


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a column of texts, one after the other, and where each starts (one more than rows); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, at - at[0]


def _table(kind) -> np.ndarray:
    return np.array([kind(i) for i in range(256)], np.uint8)


def _kind(c: int) -> int:
    if c in (9, 10, 11, 12, 13, 32):
        return BLANK
    if c < 32 or c == 127:
        return ODD
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)


_ASCII = _table(lambda i: _kind(i) if i < 128 else ODD)
#: Kinds of U+0080 to U+00FF by second byte, after lead byte C2 and C3. U+0080 to U+00A0 hold controls and blanks.
_SECOND = np.array([[(_kind(0x80 + 64 * lead + (b & 63)) if lead or b > 0xA0 else ODD) if 0x80 <= b < 0xC0 else ODD for b in range(256)] for lead in (0, 1)], np.uint8)
LOWER = _table(lambda i: i + 32 if 65 <= i <= 90 else i)
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def lowered(buf: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of U+00C0 to U+00DE."""
    low = LOWER[buf]
    after = np.flatnonzero(buf[:-1] == 0xC3) + 1
    after = after[(buf[after] >= 0x80) & (buf[after] <= 0x9E) & (buf[after] != 0x97)]
    low[after] += 32
    return low


def kinds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kind of each byte's character, ODD beyond U+00FF, and the positions of second bytes."""
    kind = _ASCII[buf]
    lead = np.flatnonzero((buf[:-1] == 0xC2) | (buf[:-1] == 0xC3))
    of = _SECOND[buf[lead] & 1, buf[lead + 1]]
    kind[lead] = of
    kind[lead + 1] = of
    return kind, lead + 1


def counts_in(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many set positions each text holds."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), at))


def odd_texts(buf: np.ndarray, at: np.ndarray, kind: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """Texts that hold an ODD character or the first two bytes of a mark."""
    odd = kind == ODD
    for m in {x[:2] for x in marks if len(x) > 1}:
        odd[:-1] |= (buf[:-1] == m[0]) & (buf[1:] == m[1])
    return counts_in(odd, at) > 0


def _before(x: np.ndarray, at: np.ndarray, first: int) -> np.ndarray:
    out = np.empty_like(x)
    out[1:] = x[:-1]
    starts = at[:-1]
    out[starts[starts < len(x)]] = first
    return out


def _contractions(buf: np.ndarray, at: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Of the apostrophes, those that begin one of 's 't 're 've 'm 'll 'd, with its length."""
    end = at[np.searchsorted(at, where, "right")]
    padded = np.concatenate([buf, np.zeros(2, np.uint8)])
    one, two = padded[where + 1], padded[where + 2]
    short = np.isin(one, list(b"stmd")) & (where + 2 <= end)
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & (where + 3 <= end)
    size = np.where(short, 2, np.where(long, 3, 0))
    return np.stack([where, size])[:, size > 0]


def _after_contractions(start: np.ndarray, kind: np.ndarray, at: np.ndarray, found: np.ndarray) -> None:
    where, size = found
    start[where + 1] = False
    then = where + size
    then = then[(then < at[np.searchsorted(at, where, "right")])]
    start[then[kind[then] != BLANK]] = True


def word_pieces(low: np.ndarray, at: np.ndarray, kind: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of contractions, letter runs, single digits and runs of other signs, in lower-cased bytes."""
    before = _before(kind, at, BLANK)
    start = (kind != BLANK) & ((kind != before) | (kind == NUMBER))
    start[second] = False
    found = _contractions(low, at, np.flatnonzero((low == 39) & (before != OTHER)))
    _after_contractions(start, kind, at, found)
    return _spans(start, kind != BLANK, at)


def _spans(start: np.ndarray, inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    last = np.ones(len(start) + 1, bool)
    last[1:-1] = ~inside[1:] | start[1:]
    last[at] = True
    return np.flatnonzero(start), np.flatnonzero(inside & last[1:]) + 1


def byte_pieces(buf: np.ndarray, at: np.ndarray, kind: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of byte-level pre-tokens: contractions, runs of a kind with the space before, and runs of blanks."""
    before, byte_before = _before(kind, at, 255), _before(buf, at, 0)
    start = (kind != before) & (kind != BLANK)
    start[second] = False
    spaced = byte_before == 32
    found = _contractions(buf, at, np.flatnonzero((buf == 39) & (before != OTHER) & ~spaced))
    _after_contractions(start, kind, at, found)
    start &= ~spaced
    blank = kind == BLANK
    start |= blank & (before != BLANK)
    last = np.zeros(len(buf), bool)
    last[:-1] = blank[:-1] & ~blank[1:]
    ends = at[1:] - 1
    last[ends[ends >= 0]] = False
    start |= last
    return _spans(start, np.ones(len(buf), bool), at)


def words(buf: np.ndarray, at: np.ndarray, blank: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the runs of bytes that aren't blank; no run goes from one text into the next."""
    inside = ~blank[buf]
    before = _before(inside, at, False)
    return _spans(inside & ~before, inside, at)


_WIDE = 64
_SUMS = np.random.Generator(np.random.PCG64(20_240_501)).integers(0, 1 << 64, _WIDE * 256, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers whose every bit depends on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """64-bit hashes of spans: sums of random numbers by place and byte; of spans over 64 bytes, BLAKE2."""
    size = ends - starts
    out = np.empty(len(starts), np.uint64)
    long = np.flatnonzero(size > _WIDE)
    taken = np.minimum(size, _WIDE)
    before = np.concatenate([[0], np.cumsum(taken)])
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(before, before[i] + block, "right")) - 1)
        first = (before[i:j] - before[i]).astype(np.int32)
        total = int(before[j] - before[i])
        steps = np.ones(total, np.int32)
        steps[0] = 0
        steps[first[1:]] = 1 - taken[i : j - 1]
        place = np.cumsum(steps, dtype=np.int32)
        if j - i > 1:
            steps[first[1:]] = starts[i + 1 : j] - starts[i : j - 1] - taken[i : j - 1] + 1
        at = np.cumsum(steps, dtype=np.int32)
        out[i:j] = np.add.reduceat(_SUMS[(place << 8) + buf[starts[i] :][at]], first)
        i = j
    out = mixed(out + size.astype(np.uint64))
    for k in long.tolist():
        out[k] = int.from_bytes(hashlib.blake2b(buf[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start : start + size] of each row, one after the other."""
    first = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))]
