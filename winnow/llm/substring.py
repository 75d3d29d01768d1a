"""Removal of passages that repeat across documents.

Every window of ``WINDOW`` words gets a Rabin-Karp hash of 64 bits and a check of 15 more. Documents
are dealt into chunks by doc_id. A chunk sends each of its distinct windows once, with the least
doc_id that holds it, to the bucket of its hash; the bucket finds windows that two documents share, and
tells each chunk which of its windows are such and the least doc_id of all. The chunk then reads its
texts again: windows that a smaller doc_id holds too are repeats, and windows in a row that overlap
merge into intervals of words to remove.

Texts are shuffled once, for both readings. A window that a third of all documents hold is one row in
each chunk. Hashes travel sorted, as packed differences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.arrays import (
    blocks, covered, in_one_row, scramble, white_space_words, window_hashes, words_of,
)
from winnow.llm.shared import shuffle_partitions, text_bytes

WINDOW = 13
#: Text of a chunk, and windows of a bucket, about. Both stay in one task's memory.
CHUNK_BYTES, BUCKET_WINDOWS = 16 << 20, 4_000_000

_MEMBER = white_space_words()
_SECOND, _THIRD = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SENT = "bucket int, chunk int, n int, hashes binary, checks binary, doc_ids binary"
_TOLD = "chunk int, n int, hashes binary, checks binary, doc_ids binary"
#: Stands for a missing doc_id, which comes after all others.
_LAST = np.iinfo(np.int64).max


def _shrink(values: np.ndarray) -> bytes:
    """Bytes of an integer array, its low bytes first, then the next: zeros pack to nothing."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _expand(data: bytes, n: int, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(-1, n).T).view(kind).reshape(-1)


def _pack_sorted(hashes: np.ndarray) -> bytes:
    steps = hashes.copy()
    steps[1:] -= hashes[:-1]
    return _shrink(steps)


def _windows(texts: pa.ChunkedArray, window: int) -> Iterator[tuple]:
    """Per block: first row, words, first words of the windows, their hashes and checks."""
    for row, offsets, data in blocks(texts):
        words = words_of(offsets, data, _MEMBER)
        at = np.flatnonzero(in_one_row(words.row, window))
        hashes = scramble(window_hashes(words.hash, window))[at]
        checks = window_hashes(scramble(words.hash, _SECOND), window, _THIRD)[at]
        yield row, offsets, data, words, at, hashes, (scramble(checks) >> np.uint64(49)).astype(np.uint16)


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(_LAST).to_numpy()


def _send(table: pa.Table, window: int, bits: int) -> pa.Table:
    """A chunk's distinct windows by bucket. The lowest bit of a check: two of its documents hold it."""
    chunk, ids = table["chunk"][0].as_py(), _ids(table["doc_id"])
    hashes, checks, holders = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
    for row, _, _, words, at, h, c in _windows(table["text"], window):
        hashes.append(h)
        checks.append(c)
        holders.append(ids[row + words.row[at]])
    h, c, holder = np.concatenate(hashes), np.concatenate(checks), np.concatenate(holders)
    order = np.argsort(h)
    h, c, holder = h[order], c[order], holder[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    if (~new[1:] & (c[1:] != c[:-1])).any():
        order = np.lexsort((c, h))
        h, c, holder = h[order], c[order], holder[order]
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(new)
    if len(first):
        least, most = np.minimum.reduceat(holder, first), np.maximum.reduceat(holder, first)
        h, c = h[first], (c[first] << np.uint16(1)) | (least < most).astype(np.uint16)
    else:
        least = holder
    edges = np.searchsorted(h, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
    starts, ends = [0, *edges], [*edges, len(h)]
    rows = []
    for bucket, (a, b) in enumerate(zip(starts, ends, strict=True)):
        if b > a:
            rows.append((bucket, chunk, b - a, _pack_sorted(h[a:b]), _shrink(c[a:b]), _shrink(least[a:b])))
    return _table(rows, _SENT_ARROW)


def _tell(table: pa.Table) -> pa.Table:
    """A bucket's shared windows, for each chunk that holds them, with the least doc_id of all."""
    rows = table.to_pylist()
    chunk = np.repeat(np.array([r["chunk"] for r in rows], np.int32), [r["n"] for r in rows])
    h = np.concatenate([np.cumsum(_expand(r["hashes"], r["n"], "<u8"), dtype=np.uint64) for r in rows])
    c = np.concatenate([_expand(r["checks"], r["n"], "<u2") for r in rows])
    holder = np.concatenate([_expand(r["doc_ids"], r["n"], "<i8") for r in rows])
    order = np.argsort(h)
    h, c, holder, chunk = h[order], c[order], holder[order], chunk[order]
    mixed = c >> np.uint16(1)
    if ((h[1:] == h[:-1]) & (mixed[1:] != mixed[:-1])).any():
        order = np.lexsort((mixed, h))
        h, c, mixed, holder, chunk = h[order], c[order], mixed[order], holder[order], chunk[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (mixed[1:] != mixed[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(h)))
    least = np.repeat(np.minimum.reduceat(holder, first), size)
    # A chunk that alone holds the window, in one document, or holds it first there, is told nothing.
    tell = ((c & np.uint16(1)) == 1) | (least < holder)
    h, mixed, least, chunk = h[tell], mixed[tell], least[tell], chunk[tell]
    order = np.argsort(chunk, kind="stable")
    h, mixed, least, chunk = h[order], mixed[order], least[order], chunk[order]
    starts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(chunk) else np.zeros(0, int)
    out = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(chunk)], strict=False):
        out.append((int(chunk[a]), b - a, _pack_sorted(h[a:b]), _shrink(mixed[a:b]), _shrink(least[a:b])))
    return _table(out, _TOLD_ARROW)


def _mark(table: pa.Table, told: pa.Table, window: int) -> pa.Table:
    """Per document of a chunk: words, removed words, checksum of those kept, and the intervals."""
    ids = _ids(table["doc_id"])
    rows = told.to_pylist()
    none = np.zeros(0, np.uint64)
    h = np.concatenate([none, *(np.cumsum(_expand(r["hashes"], r["n"], "<u8"), dtype=np.uint64) for r in rows)])
    c = np.concatenate([np.zeros(0, np.uint16), *(_expand(r["checks"], r["n"], "<u2") for r in rows)])
    least = np.concatenate([np.zeros(0, np.int64), *(_expand(r["doc_ids"], r["n"], "<i8") for r in rows)])
    order = np.lexsort((c, h))
    h, c, least = h[order], c[order], least[order]
    deepest = int(np.bincount(np.cumsum(np.append(True, h[1:] != h[:-1]))).max()) if len(h) else 0
    out = []
    for row, offsets, data, words, at, hashes, checks in _windows(table["text"], window):
        repeat = np.zeros(len(hashes), bool)
        if len(h):
            own = ids[row + words.row[at]]
            place = np.searchsorted(h, hashes)
            for k in range(deepest):  # windows of equal hash and unequal check are next to each other
                here = np.minimum(place + k, len(h) - 1)
                repeat |= (h[here] == hashes) & (c[here] == checks) & (least[here] < own)
        gone = covered(at[repeat], window, len(words.row))
        edges = np.searchsorted(words.row, np.arange(len(offsets)))
        removed = np.bincount(words.row[gone], minlength=words.rows).tolist()
        for k in range(words.rows):
            a, b = int(edges[k]), int(edges[k + 1])
            text = data[offsets[k] : offsets[k + 1]].tobytes()
            kept = _split(text)
            spans = []
            if removed[k]:
                flags = gone[a:b]
                step = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
                spans = [{"start": s, "end": e} for s, e in zip(step[::2].tolist(), step[1::2].tolist(), strict=True)]
                kept = [w for w, g in zip(kept, flags.tolist(), strict=True) if not g]
            digest = hashlib.sha256(b" ".join(kept)).hexdigest()
            out.append((table["doc_id"][row + k].as_py(), b - a, removed[k], digest, spans))
    return _table(out, _MARKED_ARROW)


def _split(text: bytes) -> list[bytes]:
    return text.split()  # at the same six bytes


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_BLOBS = [("n", pa.int32()), ("hashes", pa.binary()), ("checks", pa.binary()), ("doc_ids", pa.binary())]
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), *_BLOBS])
_TOLD_ARROW = pa.schema([("chunk", pa.int32()), *_BLOBS])
_MARKED_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


def repeated_passages(
    docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, bucket_windows: int = BUCKET_WINDOWS
) -> DataFrame:
    """Every row of ``docs`` as doc_id, n_words, n_removed, kept_sha256, removed (intervals of words).

    ``docs`` has doc_id and text; other columns are ignored. A word is removed if a window over it also
    starts in a document with a smaller doc_id, judged on the texts as they come. Rows without a doc_id
    come after all others, and those that share one remove nothing for each other. A null text has no words.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    size = text_bytes(rows)
    chunks = max(shuffle_partitions(spark), -(-size // chunk_bytes))
    # At least 32 windows of a chunk in a bucket, or rows would cost more than hashes.
    buckets = min(max(shuffle_partitions(spark), size // 6 // bucket_windows), max(1, chunk_bytes // 6 // 32))
    bits = max(0, buckets - 1).bit_length()
    # Rows without a doc_id are dealt by their text: there may be many.
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    dealt = rows.withColumn("chunk", F.pmod(key, F.lit(chunks)).cast("int"))
    sent = dealt.groupBy("chunk").applyInArrow(lambda t: _send(t, window, bits), _SENT)
    told = sent.groupBy("bucket").applyInArrow(_tell, _TOLD)
    return (
        dealt.groupBy("chunk")
        .cogroup(told.groupBy("chunk"))
        .applyInArrow(
            lambda t, u: _mark(t, u, window),
            "doc_id long, n_words long, n_removed long, kept_sha256 string, "
            "removed array<struct<start: long, end: long>>",
        )
    )
