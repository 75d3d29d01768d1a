"""Token ids as patched frame-of-reference blocks.

Ids are cut into blocks of ``BLOCK`` ids. A block is stored as its minimum, a width and the offsets
from the minimum packed at that width; the width is the smallest that holds a given percentile of the
offsets. Offsets that do not fit are exceptions: their places in the block and their high bits follow
in a list of their own. An index holds where each block starts, so a block can be read alone.

A segment is the blocks of whole documents in a row. Its bytes, all little-endian:

    u32 number of ids, u32 number of blocks, u32[blocks + 1] starts (from the end of the index on)
    a block: u32 minimum, u8 width, u8 exceptions, packed offsets, u8[] places, u32[] high bits
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from winnow.llm.shared import text_bytes, texts_of
from winnow.llm.tokens import encoder
from winnow.sources.tables import shared_dir

BLOCK, PERCENTILE = 128, 95
SEGMENT_IDS = 1 << 16
SHARD_BYTES = 64 << 20

SEGMENTS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("data", T.BinaryType()),
    ]
)
READ = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("shard_start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """One segment. ``ids``: unsigned 32-bit integers, as many as are wanted, none too."""
    ids = np.asarray(ids, np.uint32)
    n, blocks = len(ids), -(-len(ids) // block)
    if not n:
        return np.zeros(3, "<u4").tobytes()
    grid = np.empty(blocks * block, np.uint32)
    grid[:n], grid[n:] = ids, ids[-1]
    grid = grid.reshape(blocks, block)
    least = grid.min(axis=1)
    over = grid - least[:, None]
    rank = min(block - 1, int(np.ceil(block * percentile / 100)) - 1)
    widths = _bits(np.partition(over, rank, axis=1)[:, rank])
    bodies: list[bytes] = [b""] * blocks
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        part = over[rows]
        low = part & np.uint32((1 << width) - 1) if width < 32 else part
        packed = _packed(low, width)
        high = part >> np.uint32(width) if width < 32 else np.zeros_like(part)
        at, place = np.nonzero(high)
        count = np.bincount(at, minlength=len(rows))
        heads, body, size = least[rows].astype("<u4").tobytes(), packed.tobytes(), packed.shape[1]
        places, highs = place.astype(np.uint8).tobytes(), high[at, place].astype("<u4").tobytes()
        for k, (row, c, z) in enumerate(zip(rows.tolist(), count.tolist(), np.cumsum(count).tolist(), strict=True)):
            a = z - c
            head = heads[4 * k : 4 * k + 4] + bytes((width, c))
            bodies[row] = head + body[size * k : size * (k + 1)] + places[a:z] + highs[4 * a : 4 * z]
    starts = np.zeros(blocks + 1, "<u4")
    np.cumsum([len(b) for b in bodies], out=starts[1:])
    return np.array([n, blocks], "<u4").tobytes() + starts.tobytes() + b"".join(bodies)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values as rows of bytes, ``width`` bits each, the lowest first."""
    rows = len(values)
    if not 0 < width <= 16 or values.shape[1] % 8:
        bits = (values[:, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
        return np.packbits(bits.astype(np.uint8).reshape(rows, -1), axis=1, bitorder="little")
    # Eight values fill ``width`` bytes: two sums of four, side by side.
    four = values.astype(np.uint64).reshape(rows, -1, 2, 4)
    sums = four[..., 0]
    for k in range(1, 4):
        sums = sums | four[..., k] << np.uint64(k * width)
    both = np.zeros((*sums.shape[:2], 2), "<u8")
    both[..., 0], both[..., 1] = sums[..., 0], sums[..., 1] >> np.uint64(64 - 4 * width)
    if width < 16:
        both[..., 0] |= sums[..., 1] << np.uint64(4 * width)
    return np.ascontiguousarray(both.view(np.uint8).reshape(rows, -1, 16)[..., :width]).reshape(rows, -1)


def _unpacked(data: np.ndarray, starts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Rows of ``n`` values of ``width`` bits; ``data`` goes on for eight bytes behind the last row."""
    at = np.arange(n) * width
    eights = np.ndarray(len(data) - 7, np.dtype("<u8"), data, 0, (1,))
    found = eights[starts[:, None] + (at >> 3)] >> (at & 7).astype(np.uint64)
    return (found & np.uint64((1 << width) - 1)).astype(np.uint32)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each unsigned 32-bit value takes."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def unpack(segment: bytes, block: int = BLOCK) -> np.ndarray:
    """The ids of a segment."""
    n, blocks = np.frombuffer(segment, "<u4", 2).tolist()
    if not n:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(segment + bytes(8), np.uint8)
    starts = np.frombuffer(segment, "<u4", blocks, 8).astype(np.int64) + 8 + 4 * (blocks + 1)
    heads = data[starts[:, None] + np.arange(6)]
    least = np.ascontiguousarray(heads[:, :4]).view("<u4").reshape(-1)
    widths, exceptions = heads[:, 4].astype(np.int64), heads[:, 5].astype(np.int64)
    out = np.empty((blocks, block), np.uint32)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        out[rows] = _unpacked(data, starts[rows] + 6, block, width)
    row = np.repeat(np.arange(blocks), exceptions)
    at = (starts + 6 + block * widths // 8)[row]
    k = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    high = data[(at + exceptions[row] + 4 * k)[:, None] + np.arange(4)].view("<u4").reshape(-1)
    out[row, data[at + k]] |= high << widths[row].astype(np.uint32)
    out += least[:, None]
    return out.reshape(-1)[:n]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, in ascending doc_id order.

    ``docs`` has doc_id and text; other columns are ignored. A null text counts as empty; rows
    without a doc_id come first; rows that share one are in the order of a hash of their texts. The
    folder holds Parquet files of ``SEGMENTS``; ``first`` counts the ids before a segment in its shard.
    Shards are ranges of doc_id, and of hash and place within one, so that a doc_id or a row that
    a third of all rows repeat fills many shards. The texts are shuffled once, the ids never.
    """
    rows = texts_of(docs).select("doc_id", "text")
    shards = max(1, -(-text_bytes(rows) // shard_bytes), _cores(docs.sparkSession))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        first, held, size = 0, [], 0
        shard = 0

        def close():
            nonlocal first, held, size
            ids = np.concatenate([x for _, _, x in held])
            out = pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": shard, "first": first, "n_ids": len(ids),
                        "doc_ids": [d for d, _, _ in held], "counts": [c for _, c, _ in held],
                        "data": pack(ids),
                    }
                ],
                schema=_SEGMENTS,
            )
            first, held, size = first + len(ids), [], 0
            return out

        for batch in batches:
            if not len(batch):
                continue
            shard = batch.column(2)[0].as_py()
            doc_ids = batch.column(0).to_pylist()
            for row, counts, ids in encode(batch.column(1)):
                ends = np.cumsum(counts)
                for k, (count, end) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True)):
                    own = np.append(ids[end - count : end], np.uint32(end_id))
                    held.append((doc_ids[row + k], count + 1, own))
                    size += count + 1
                    if size >= SEGMENT_IDS:
                        yield close()
        if held:
            yield close()

    order = ["doc_id", "hash", "place"]
    (
        rows.withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
        .repartitionByRange(shards, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("shard"))
        .mapInArrow(segments, SEGMENTS)
        .write.mode("overwrite")
        .parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold, per document: its place, number of ids and their checksum."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = memoryview(unpack(row["data"]).astype("<u4").tobytes())
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                places = zip((ends - counts).tolist(), ends.tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["shard"]] * len(counts), pa.int32()),
                        pa.array(row["first"] + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(ids[4 * a : 4 * b]) for a, b in places], pa.int64()),
                    ],
                    names=READ.names,
                )

    segments = spark.read.schema(SEGMENTS).parquet(path)
    # One row a shard: the ids before it.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    return (
        segments.mapInArrow(documents, READ)
        .join(shards, "shard")
        .select(
            "doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
        )
    )


_SEGMENTS = pa.schema(
    [
        ("shard", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("data", pa.binary()),
    ]
)


def _cores(spark: SparkSession) -> int:
    return 2 * spark.sparkContext.defaultParallelism


def round_trip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write to a new shared folder, read back."""
    spark = docs.sparkSession
    path = shared_dir(spark)
    write(docs, path, tokenizer, end_id)
    return read(spark, path)
