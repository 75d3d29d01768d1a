"""Best-fit packing of documents into sequences, with lower bounds as certificates.

Documents are encoded and cut into pieces no longer than a sequence. Pieces are dealt at random into
partitions, and each is packed by best-fit decreasing. Dual-feasible functions give a lower bound on
the sequences a partition needs: one that meets it is certified and keeps its sequences. Partitions
with a gap exchange their pieces, and every certified one adds its emptiest sequence, which rounding up
leaves: all of these are dealt anew into fewer partitions and packed again. That goes on until a round
does not save a sequence, and that one is not taken. ``certificate`` holds the sequences used against the bound of
all pieces at once, which follows from how many there are of each length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.shared import stored, texts_of
from winnow.llm.tokens import encoder

SEQUENCE = 2048
#: Pieces of a partition, about.
PARTITION = 4000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, part long, bin long, offset long, bins long, bound long, open boolean"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of every whole text's ids, ``end_id`` after each text; only longer ones are cut.

    ``docs`` has doc_id and text. A null text counts as empty and is the end id alone. Rows that
    share a doc_id, and rows without one, are documents of their own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for row, counts, ids in encode(batch.column(1)):
                data, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(counts)
                out: list[tuple] = []
                for k, (n, stop) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True)):
                    for piece, start in enumerate(range(0, n + 1, sequence)):
                        upto = min(n, start + sequence)
                        crc = zlib.crc32(data[4 * (stop - n + start) : 4 * (stop - n + upto)])
                        length = upto - start
                        if upto == n and length < sequence:
                            crc, length = zlib.crc32(end, crc), length + 1
                        out.append((doc_ids[row + k], piece, start, length, crc))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts_of(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, _PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: the bin and offset of each length, and the number of bins.

    Free space is kept as one bit for each amount that some bin has, so the fullest bin that still
    has room is the lowest bit from the length on.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, n = 0, 0
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        room = free >> length
        if room:
            left = length + (room & -room).bit_length() - 1
            b = stacks[left].pop()
            if not stacks[left]:
                free ^= 1 << left
        else:
            left, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - left
        left -= length
        if left:
            stacks[left].append(b)
            free |= 1 << left
    return bins, offsets, n


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual-feasible functions.

    Cut-offs: lengths over capacity - a count as the capacity, those under a as nothing, for every a
    up to half the capacity. Roundings: (k + 1) * length / capacity rounded down to k-ths, for k up
    to 20; whole values stay as they are.
    """
    return _bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def _bound_of_counts(counts: np.ndarray, capacity: int) -> int:
    """``lower_bound`` of ``counts[n]`` pieces of each length n up to the capacity."""
    sizes = np.arange(capacity + 1)
    mass, many = np.cumsum(counts * sizes), np.cumsum(counts)
    a = np.arange(capacity // 2 + 1)
    under = np.where(a > 0, mass[np.maximum(a - 1, 0)], 0)
    total = (mass[capacity - a] - under) + capacity * (many[-1] - many[capacity - a])
    best = -(-int(total.max()) // capacity)
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        whole = scaled % capacity == 0
        value = np.where(whole, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def _pack_round(rows: DataFrame, n: int, sequence: int) -> DataFrame:
    """Deal the rows into ``n`` partitions at random and pack each."""
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(n)), F.lit(n))

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]
        )
        lengths = table["length"].to_numpy()
        bins, offsets, count = best_fit(lengths, sequence)
        bound = lower_bound(lengths, sequence)
        filled = np.bincount(bins, weights=lengths, minlength=count)
        emptiest = int(np.argmin(filled))
        spare = count > bound or filled[emptiest] < sequence
        opened = np.full(len(bins), True) if count > bound else (bins == emptiest) & spare
        for name, values in (
            ("bin", bins),
            ("offset", offsets),
            ("bins", np.full(len(bins), count)),
            ("bound", np.full(len(bins), bound)),
        ):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table.append_column("open", pa.array(opened))

    return rows.withColumn("part", part).groupBy("part").applyInArrow(pack, _PACKED)


def pack(rows: DataFrame, sequence: int = SEQUENCE, partition: int = PARTITION) -> DataFrame:
    """Give each piece (``pieces``) a sequence_id and an offset there. No rows: none come back.

    Each round deals the open pieces into fewer partitions, so the rounds come to an end.
    """
    rows = stored(rows)
    names = rows.columns
    key = F.struct("part", "bin")
    done, n, before = [], max(1, -(-rows.count() // partition)), 0
    packed = stored(_pack_round(rows, n, sequence))
    while True:
        opened = packed.where("open")
        pool, old = opened.agg(F.count("*"), F.count_distinct(key)).first()
        fewer = max(1, min(n - 1, -(-pool // partition)))
        again = None
        if n > 1 and old > 1:
            again = stored(_pack_round(opened.select(*names), fewer, sequence))
            if again.agg(F.count_distinct(key)).first()[0] >= old:
                again = None
        kept = packed if again is None else packed.where("not open")
        done.append(kept.withColumn("part", F.col("part") + F.lit(before)))
        if again is None:
            break
        packed, before, n = again, before + n, fewer
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    # Parts count on from round to round; bins of a part stay below 2**28, as its pieces fit one task.
    number = F.col("part") * F.lit(1 << 28) + F.col("bin")
    return out.select(*names, number.alias("sequence_id"), "offset")


def certificate(packed: DataFrame, sequence: int = SEQUENCE) -> tuple[int, int]:
    """Sequences that ``packed`` uses, and how many its pieces need at least, however they are packed.

    The driver gets one count for each length, so as many as a sequence has tokens at most. A second
    figure equal to the first proves the packing best. No rows: none and none.
    """
    used = packed.select("sequence_id").distinct().count()
    counts = np.zeros(sequence + 1, np.int64)
    for length, many in packed.groupBy("length").count().collect():
        counts[length] = many
    return used, _bound_of_counts(counts, sequence)
