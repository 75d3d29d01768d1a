"""Words of many texts at once, as arrays: helpers for the operators that scan whole texts.

A batch of texts is one byte array with offsets. Words, their hashes and the windows over them are
computed with array operations, a few bytes of memory per byte of text, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)  # multiplier of the hash of a word's bytes
_MIX = np.uint64(0xD6E8FEB86659FD93)
_ROLL = np.uint64(0xA0761D6478BD642F)  # base of the hash of a window's words
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def white_space_words() -> np.ndarray:
    """Which bytes belong to words that are cut at space and the controls 9 to 13."""
    member = np.ones(256, bool)
    member[[0x20, *range(0x09, 0x0E)]] = False
    return member


def alphanumeric_words() -> np.ndarray:
    """Which bytes belong to words of ASCII letters, digits and all characters beyond ASCII."""
    member = np.ones(256, bool)
    for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        member[low : high + 1] = False
    return member


def lower_ascii() -> np.ndarray:
    """A table that maps A-Z to a-z and leaves the other bytes."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a column of texts into blocks: the first row, the offsets and the UTF-8 bytes of each.

    A null counts as empty. A block has about ``block_bytes`` at most, or one text that is longer.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, places, body = texts.buffers()
    offsets = np.frombuffer(places, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + block_bytes, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, offsets[row : end + 1] - offsets[row], data[offsets[row] : offsets[end]]
        row = end


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        base = _ODD if kind == "up" else np.uint64(pow(int(_ODD), -1, 1 << 64))
        factors = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        factors[0] = 1
        have = _powers[kind] = np.cumprod(factors)
    return have[:n]


#: Words of more bytes have a hash of another kind, as sums of powers modulo 2**64 coincide for some long strings.
LONG = 64


def _long_hashes(code: np.ndarray, body: np.ndarray, start: np.ndarray, end: np.ndarray, longest: int) -> None:
    """Set the hashes of the ranges that are longer than ``longest`` anew."""
    rows = np.flatnonzero(end - start > longest)
    if len(rows):
        data = memoryview(np.ascontiguousarray(body))
        places = zip(start[rows].tolist(), end[rows].tolist(), strict=True)
        code[rows] = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in places]


@dataclass
class Words:
    """Words in text order: the row of the block, byte range and 64-bit hash of each."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    body: np.ndarray
    rows: int

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)


def words_of(
    offsets: np.ndarray, data: np.ndarray, member: np.ndarray, table: np.ndarray | None = None
) -> Words:
    """Words of a block: maximal runs of ``member`` bytes of one text, mapped by ``table``."""
    n, rows = len(data), len(offsets) - 1
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64), data, rows)
    body = data if table is None else table[data]
    inside = member[body]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _power("up", n), out=sums[1:])
    code = (sums[end] - sums[start]) * _power("down", n)[start] + (end - start).astype(np.uint64)
    row = np.searchsorted(offsets, start, "right") - 1
    code = scramble(code)
    _long_hashes(code, body, start, end, LONG)
    return Words(row, start, end, code, body, rows)


def word_codes(body: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two 64-bit values that tell byte strings of ``body`` apart, for ranges in ascending order.

    The first is a hash, of another kind for strings of more than sixteen bytes; the second mixes the
    length with the first and last eight bytes, all there is of shorter ones.
    """
    low = int(start[0]) if len(start) else 0
    body = body[low : int(end[-1]) if len(end) else 0]
    start, end = start - low, end - low
    n = len(body)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _power("up", n), out=sums[1:])
    length = end - start
    out = np.empty((len(start), 2), np.uint64)
    out[:, 0] = scramble((sums[end] - sums[start]) * _power("down", n + 1)[start] + length.astype(np.uint64))
    _long_hashes(out[:, 0], body, start, end, 16)
    padded = np.concatenate([np.zeros(8, np.uint8), body, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(padded) - 7, np.dtype("<u8"), padded.tobytes(), 0, (1,))
    spare = (8 * (8 - np.minimum(length, 8))).astype(np.uint64)
    short = length == 0
    spare[short] = 0
    head = eights[start + 8] << spare
    tail = eights[end] >> spare
    head[short] = tail[short] = 0
    out[:, 1] = scramble(head ^ (length.astype(np.uint64) * _ROLL)) ^ (tail * _MIX)
    return out


def scramble(code: np.ndarray, factor: np.uint64 = _MIX) -> np.ndarray:
    """Spread a hash over all 64 bits."""
    code = (code ^ (code >> np.uint64(32))) * factor
    return (code ^ (code >> np.uint64(29))) * _ODD


def window_hashes(hashes: np.ndarray, length: int, base: np.uint64 = _ROLL) -> np.ndarray:
    """Rabin-Karp hash of each window of ``length`` words, modulo 2**64, by its first word.

    Windows that reach over the end of a row are for the caller to leave out.
    """
    n = max(0, len(hashes) - length + 1)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * base + hashes[k : k + n]
    return out


def in_one_row(row: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` words from each word on belong to its row."""
    n = max(0, len(row) - length + 1)
    return row[:n] == row[length - 1 : length - 1 + n]


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``length`` words from one of ``starts`` on."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + length, -1)
    return np.cumsum(depth[:-1]) > 0
