"""Quality by importance resampling with hashed n-gram models.

A text is a bag of hashed n-grams: words and pairs of words, and runs of one to three word shapes
(letter case, digits, marks, length, and whether the word repeats the one before). Counts of all texts
give the raw model, counts of labelled good ones the target model. A text's log weight is the sum over
its n-grams of log(target / raw), how much likelier the target model makes it, where raw is the count to
be expected in the target and both counts leave the text itself out. Documents are drawn
without replacement by Gumbel top-k: noise that depends on the doc_id alone is added to the log weights
and the k largest stay. k is the number of documents whose log weight reaches the cut that best parts
the labelled rows.

The key space of either sort of n-grams is the least power of two from eight times the number of distinct
ones on, as a sketch of least hashes estimates it, so it grows with the corpus. No model is held whole:
texts are packed into chunks as they are read, a chunk sends its distinct keys with their counts to the bucket of
their range, the bucket sums them and answers each chunk, and the chunk weighs its texts with the answers. A key of
one text alone weighs nothing, as its counts leave that text out, so no answer is sent for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.llm.arrays import blocks, scramble, white_space_words, words_of
from winnow.llm.shared import fresh, shuffle_partitions, stored, text_bytes, texts_of

#: Text of a chunk, its rows, and keys of a bucket, about. All stay in one task's memory.
CHUNK_BYTES, CHUNK_ROWS, BUCKET_KEYS = 8 << 20, 1 << 15, 4_000_000
#: Keys of a chunk that are weighed at once.
STRETCH = 1 << 18
#: Least hashes that the number of distinct n-grams is estimated from.
SKETCH = 4096
#: Labelled rows of either class that are looked at, at most: those with the least hash of the doc_id.
FIT_ROWS = 20_000
#: Added to every count, and the largest weight of one n-gram.
SMOOTHING, CLIP = 1.0, 8.0
SEED = 17

_MEMBER = white_space_words()
_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 lower, 3 digit, 4 mark, 5 beyond ASCII
_KIND[0x21:0x7F] = 4
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x30:0x3A], _KIND[0x80:] = 1, 2, 3, 5


def _grams(offsets: np.ndarray, data: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of every word n-gram of a block, and of every shape n-gram."""
    words = words_of(offsets, data, _MEMBER)
    if not len(words.row):
        return [(np.zeros(0, np.int64), np.zeros(0, np.uint64))] * 2
    row, hashes = words.row, words.hash
    kinds = _KIND[data]
    shape = np.zeros(len(row), np.uint64)
    for k in range(1, 6):
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kinds == k, out=sums[1:])
        n = sums[words.end] - sums[words.start]
        level = np.minimum(n, 2) + (n > 3) if k == 4 else np.minimum(n, 2)
        shape = shape * np.uint64(4) + level.astype(np.uint64)
    first, last = kinds[words.start].astype(np.uint64), kinds[words.end - 1].astype(np.uint64)
    mark = np.where(last == 4, data[words.end - 1], 0).astype(np.uint64)
    size = np.minimum(np.log2(words.end - words.start + 1).astype(np.int64), 7).astype(np.uint64)
    same = np.zeros(len(row), np.uint64)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    shape = ((((shape * np.uint64(8) + first) * np.uint64(8) + last) * np.uint64(256) + mark) * np.uint64(8) + size)
    shape = scramble(shape * np.uint64(2) + same)
    inside = row[1:] == row[:-1]
    inside2 = row[2:] == row[:-2]
    pair = scramble(hashes[:-1] * np.uint64(3) + hashes[1:])[inside]
    two = scramble(shape[:-1] * np.uint64(3) + shape[1:])[inside]
    three = scramble((shape[:-2] * np.uint64(3) + shape[1:-1]) * np.uint64(3) + shape[2:])[inside2]
    one, both = row[:-1][inside], row[:-2][inside2]
    return [
        (np.concatenate([row, one]), np.concatenate([hashes, pair])),
        (np.concatenate([row, one, both]), np.concatenate([shape, two, three])),
    ]


def labelled_ids(labels: DataFrame, fit_rows: int = FIT_ROWS, quality: str = "quality") -> dict[int, list[int]]:
    """doc_ids labelled 0 and 1, ``fit_rows`` of each at most. Null ids and labels do not count."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(quality).alias("label"))
    rows = rows.where("doc_id is not null and label in (0, 1)").distinct()
    out = {}
    for label in (0, 1):
        own = rows.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        out[label] = [r.doc_id for r in own.select("doc_id").collect()]
    return out


def _measured(docs: DataFrame, good: list[int], sketch: int = SKETCH) -> list[tuple[int, int, int]]:
    """Per sort of n-grams: distinct ones, about, all, and those in the labelled good texts."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.array(sorted(good), np.int64)
        least, raw, target = [np.zeros(0, np.uint64)] * 2, [0, 0], [0, 0]
        for batch in batches:
            is_good = _is_one_of(batch.column(0), ids)
            for first, offsets, data in blocks(batch.column(1)):
                for part, (row, code) in enumerate(_grams(offsets, data)):
                    raw[part] += len(row)
                    target[part] += int(is_good[first + row].sum())
                    if len(least[part]) == sketch:
                        code = code[code < least[part][-1]]
                    least[part] = np.unique(np.concatenate([least[part], code]))[:sketch]
        for part in (0, 1):
            codes = np.append((least[part] >> np.uint64(1)).astype(np.int64), -1)
            zeros = np.zeros(len(codes) - 1, np.int64)
            arrays = [np.full(len(codes), part, np.int32), codes, np.append(zeros, raw[part]), np.append(zeros, target[part])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["part", "code", "raw", "target"])

    rows = texts_of(docs).select(F.col("doc_id").cast("long"), "text")
    told = stored(rows.mapInArrow(measure, "part int, code long, raw long, target long"))
    out = []
    for part in (0, 1):
        own = told.where(F.col("part") == part)
        raw, target = own.agg(F.sum("raw"), F.sum("target")).first()
        codes = own.where("code >= 0").select("code").distinct().orderBy("code").limit(sketch).collect()
        n = len(codes) if len(codes) < sketch else int((sketch - 1) * 2.0**63 / (codes[-1].code + 1))
        out.append((n, raw or 0, target or 0))
    return out


def key_bits(distinct: int) -> int:
    """Bits of the key space for so many distinct n-grams: eight keys or more for each."""
    return max(1, (8 * distinct - 1).bit_length())


def _is_one_of(doc_ids: pa.Array | pa.ChunkedArray, ids: np.ndarray) -> np.ndarray:
    return np.isin(doc_ids.fill_null(-(1 << 62)).to_numpy(zero_copy_only=False), ids) & ~np.asarray(doc_ids.is_null())


_ID, _TEXT = "id of the row", "text of the row"
_SENT = "bucket int, chunk long, n int, keys binary, counts binary"
_TOLD = "chunk long, bucket int, n int, shared binary, counts binary"


def _shrink(values: np.ndarray) -> bytes:
    """Bytes of 64-bit integers, all lowest bytes first, packed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _expand(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(kind).reshape(-1)


def _chunks(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """Rows as they are read, packed: a chunk is some rows in a row of a partition, about ``chunk_bytes`` of them.

    So rows that share an id or a text lie in many chunks, and texts travel compressed.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))) as out:
                for batch in held:
                    out.write_batch(batch)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["rows"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.nbytes for b in held) >= chunk_bytes or sum(b.num_rows for b in held) >= CHUNK_ROWS:
                yield close()
        if held:
            yield close()

    packed = rows.mapInArrow(pack, "rows binary")
    return packed.select(F.monotonically_increasing_id().alias("chunk"), "rows")


def _unpacked(table: pa.Table) -> pa.Table:
    (rows,) = table["rows"].to_pylist()
    return pa.ipc.open_stream(rows).read_all()


def _counted(table: pa.Table, bits: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per sort of n-grams: key, row and count of each key in each text of a chunk, by key and then by row.

    Key and row are sorted as one number. One sort is unpacked at a time.
    """
    room = max(1, (table.num_rows - 1).bit_length())
    if max(bits) + room > 64:
        raise ValueError("keys and rows of a chunk do not fit 64 bits")
    found: list[list[np.ndarray]] = [[] for _ in bits]
    for first, offsets, data in blocks(table[_TEXT]):
        for part, (row, code) in enumerate(_grams(offsets, data)):
            keys = code >> np.uint64(64 - bits[part])
            found[part].append((keys << np.uint64(room)) | (first + row).astype(np.uint64))
    while found:
        both = np.concatenate([np.zeros(0, np.uint64), *found.pop(0)])
        both.sort()
        at = _firsts(both)
        n = np.diff(np.append(at, len(both))).astype(np.int32)  # fewer than a chunk has bytes
        both = both[at]
        del at
        keys, row = both >> np.uint64(room), (both & np.uint64((1 << room) - 1)).astype(np.int32)
        del both
        yield keys, row, n
        del keys, row, n


def _firsts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def _send(table: pa.Table, bits: list[int], good: np.ndarray, split: int) -> pa.Table:
    """A chunk's distinct keys and their counts, by bucket: 2**split ranges of either sort's keys.

    The lowest bit of a key's count in all texts tells that one text alone holds it here.
    """
    chunk, table = table["chunk"][0].as_py(), _unpacked(table)
    is_good, out = _is_one_of(table[_ID], good), []
    for part, (keys, row, n) in enumerate(_counted(table, bits)):
        first = _firsts(keys)
        counts = np.zeros((len(first), 2), np.int64)
        if len(first):
            alone = np.diff(np.append(first, len(keys))) == 1
            counts[:, 0] = 2 * np.add.reduceat(n, first, dtype=np.int64) + alone
            counts[:, 1] = np.add.reduceat(n * is_good[row], first, dtype=np.int64)
        keys = keys[first]
        step = min(split, bits[part])
        edges = np.searchsorted(keys >> np.uint64(bits[part] - step), np.arange((1 << step) + 1, dtype=np.uint64))
        for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if b > a:
                steps = np.diff(keys[a:b], prepend=np.uint64(0))
                out.append(((part << split) + i, chunk, b - a, _shrink(steps), _shrink(counts[a:b])))
    return _rows(out, ("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()))


def _rows(rows: list[tuple], *columns: tuple[str, pa.DataType]) -> pa.Table:
    values = list(zip(*rows, strict=True)) or [()] * len(columns)
    return pa.table([pa.array(list(v), kind) for v, (_, kind) in zip(values, columns, strict=True)], names=[c for c, _ in columns])


def _tell(table: pa.Table) -> pa.Table:
    """To each chunk, which of the keys it sent two texts or more hold, and their counts over all chunks."""
    rows = table.to_pylist()
    keys = np.concatenate([np.cumsum(_expand(r["keys"], "<u8"), dtype=np.uint64) for r in rows])
    counts = np.concatenate([_expand(r["counts"], "<i8").reshape(-1, 2) for r in rows])
    order = np.argsort(keys, kind="stable")
    first = _firsts(keys[order])
    sums = np.empty((len(first), 2), np.int64)
    sums[:, 0] = np.add.reduceat(counts[order, 0] >> 1, first)
    sums[:, 1] = np.add.reduceat(counts[order, 1], first)
    size = np.diff(np.append(first, len(keys)))
    place = np.empty(len(keys), np.int64)
    place[order] = np.repeat(np.arange(len(first)), size)
    shared = (size[place] > 1) | (counts[:, 0] & 1 == 0)
    del counts, order
    out, at = [], 0
    for r in rows:
        own = shared[at : at + r["n"]]
        marks = zstandard.ZstdCompressor(level=1).compress(np.packbits(own).tobytes())
        out.append((r["chunk"], r["bucket"], r["n"], marks, _shrink(sums[place[np.flatnonzero(own) + at]])))
        at += r["n"]
    return _rows(out, ("chunk", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("shared", pa.binary()), ("counts", pa.binary()))


def _marks(row: dict) -> np.ndarray:
    """Which of the keys a chunk sent to a bucket are shared."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["shared"]), np.uint8)
    return np.unpackbits(raw, count=row["n"]).astype(bool)


def _weigh(table: pa.Table, told: pa.Table, bits: list[int], totals: list, good: np.ndarray, split: int) -> np.ndarray:
    """Log weights of a chunk's texts, each against the counts without itself; keys not told of weigh nothing."""
    is_good, out = _is_one_of(table[_ID], good), np.zeros(table.num_rows)
    answers = sorted(told.to_pylist(), key=lambda r: r["bucket"])
    for part, (keys, row, n) in enumerate(_counted(table, bits)):
        own = [r for r in answers if r["bucket"] >> split == part]
        if not own:
            continue
        # The chunk's distinct keys are those it sent, in the same order: marks and counts need no keys.
        shared = np.concatenate([_marks(r) for r in own])
        sums = np.concatenate([_expand(r["counts"], "<i8").reshape(-1, 2) for r in own])
        size = np.bincount(row, weights=n, minlength=len(out)).astype(np.int64)
        all_raw, all_target = totals[part][0] - size, totals[part][1] - size * is_good
        share = all_target / np.maximum(all_raw, 1)
        at, sums_before, weights = -1, np.cumsum(shared) - 1, np.zeros(len(out))
        for a in range(0, len(keys), STRETCH):  # a stretch at a time, as the steps take many times the keys' memory
            z = min(a + STRETCH, len(keys))
            new = keys[a:z] != (keys[a - 1 : z - 1] if a else np.append(~keys[:1], keys[: z - 1]))
            key = np.cumsum(new) + at
            at = int(key[-1])
            hit = shared[key]
            place, of, times = sums_before[key[hit]], row[a:z][hit], n[a:z][hit].astype(np.int64)
            raw, target = sums[place, 0] - times, sums[place, 1] - times * is_good[of]
            weight = np.clip(np.log((target + SMOOTHING) / (raw * share[of] + SMOOTHING)), -CLIP, CLIP)
            np.add.at(weights, of, weight * times)
        out += weights
        del keys, row, n, shared, sums, sums_before
    return out


def _scored(docs: DataFrame, good: list[int], columns: list[str], chunk_bytes: int, bucket_keys: int) -> DataFrame | None:
    """``columns`` of every row, and log_weight; None if no text is labelled good.

    A text without n-grams weighs 0.
    """
    measured = _measured(docs, good)
    if not any(target for _, _, target in measured):
        return None
    bits, totals = [key_bits(n) for n, _, _ in measured], [m[1:] for m in measured]
    size = text_bytes(docs)
    # A chunk's distinct keys are fewer than half its bytes; a bucket has at least 64 of them.
    buckets = min(max(shuffle_partitions(docs.sparkSession), size // 2 // bucket_keys), max(1, chunk_bytes // 128))
    split, ids = max(0, buckets - 1).bit_length(), np.array(sorted(good), np.int64)
    extra = [F.col("doc_id").cast("long").alias(_ID), F.col("text").alias(_TEXT)]
    others = [c for c in columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("carried"), *extra)
    dealt = _chunks(texts_of(rows), chunk_bytes)
    (weight,) = fresh(docs.select(*columns), "log_weight")
    fields = [("carried", rows.schema["carried"].dataType), (_TEXT, T.StringType()), (weight, T.DoubleType())]
    kept = fields if "text" in columns else [fields[0], fields[2]]

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        own = _unpacked(left)
        weights = pa.array(_weigh(own, right, bits, totals, ids, split))
        return own.append_column(weight, weights).select([name for name, _ in kept])

    sent = dealt.groupBy("chunk").applyInArrow(lambda t: _send(t, bits, ids, split), _SENT)
    told = sent.groupBy("bucket").applyInArrow(_tell, _TOLD)
    found = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        weigh, T.StructType([T.StructField(name, kind) for name, kind in kept])
    )
    return found.select(*(F.col(_TEXT).alias(c) if c == "text" else F.col(f"carried.{c}") for c in columns), weight)


def _best_cut(scored: list[tuple[float, bool]]) -> float:
    """The cut with the fewest labelled rows on the wrong side; in the middle of the gap there."""
    if all(good for _, good in scored) or not scored:
        return float("-inf")
    scored.sort()
    values = np.array([s for s, _ in scored])
    good = np.array([g for _, g in scored])
    lost = np.concatenate([[0], np.cumsum(good)])  # good ones below a cut before each row
    passed = (~good).sum() - np.concatenate([[0], np.cumsum(~good)])
    edges = np.concatenate([[True], values[1:] > values[:-1], [True]])
    wrong = np.where(edges, lost + passed, len(values) + 1)
    at = int(np.argmin(wrong))
    if at == 0:
        return float("-inf")
    return float("inf") if at == len(values) else float((values[at - 1] + values[at]) / 2)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise of the standard Gumbel distribution, fixed by the doc_id."""
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11)
    uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column of doubles, by counting in ever narrower steps.

    ``rows`` should be stored. At most 4,096 counts come to the driver at once.
    """
    if k <= 0:
        return float("inf")
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return float("-inf")
    # Narrow [low, high] by counting in equal steps until it holds one distinct value.
    left = k
    while low < high:
        step = (high - low) / 4096
        if not step or low + step == low or high - step == high:
            values = rows.where(F.col(column).between(low, high)).groupBy(column).count().collect()
            for value, n in sorted(((r[0], r[1]) for r in values), reverse=True):
                if n >= left:
                    return value
                left -= n
        inside = rows.where(F.col(column).between(low, high))
        slot = F.least(F.lit(4095), F.floor((F.col(column) - F.lit(low)) / F.lit(step)).cast("int"))
        found = inside.groupBy(slot.alias("slot")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for r in sorted(found.collect(), key=lambda r: -r.slot):
            if r.n >= left:
                low, high = r.low, r.high
                break
            left -= r.n
    return low


def _keys(
    docs: DataFrame, labels: DataFrame, fit_rows: int, columns: list[str], chunk_bytes: int, bucket_keys: int
) -> tuple[DataFrame, str, str, float] | None:
    """Rows with their log weight and key, the names of these two columns, and the least key that stays."""
    ids = labelled_ids(labels, fit_rows)
    scored = _scored(docs, ids[1], columns, chunk_bytes, bucket_keys) if ids[1] else None
    if scored is None:
        return None
    weight = scored.columns[-1]
    (key,) = fresh(scored, "gumbel_key")
    rows = stored(scored.withColumn(key, F.col(weight) + gumbel(F.col("doc_id"))))
    k = rows.where(F.col(weight) >= _cut(rows, weight, ids)).count()
    return rows, weight, key, kth_largest(rows, key, k)


def _cut(rows: DataFrame, weight: str, ids: dict[int, list[int]]) -> float:
    """The log weight that parts the labelled rows. Without one labelled bad, all pass."""
    spark, bad = rows.sparkSession, set(ids[0])
    wanted = spark.createDataFrame([(i,) for i in sorted(bad | set(ids[1]))], "id long")
    own = rows.select(F.col("doc_id").cast("long").alias("id"), F.col(weight).alias("score")).join(F.broadcast(wanted), "id")
    # One row an id, however many rows share it: the ids are bounded, their rows are not.
    own = own.groupBy("id").agg(F.min("score").alias("score"))
    return _best_cut([(r.score, r.id not in bad) for r in own.collect()])


def weigh(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, chunk_bytes: int = CHUNK_BYTES, bucket_keys: int = BUCKET_KEYS
) -> DataFrame:
    """Every row of ``docs`` as doc_id, log_weight, gumbel_key and keep.

    Texts without words, null ones too, weigh 0. Rows that share a doc_id share their noise; rows that
    tie with the last one kept stay too. Without a labelled good document all rows are kept, unweighed.
    """
    found = _keys(docs, labels, fit_rows, ["doc_id"], chunk_bytes, bucket_keys)
    if found is None:
        none = F.lit(None).cast("double")
        return docs.select("doc_id", none.alias("log_weight"), none.alias("gumbel_key"), F.lit(True).alias("keep"))
    rows, weight, key, least = found
    return rows.select("doc_id", weight, key, (F.col(key) >= least).alias("keep"))


def resample(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, chunk_bytes: int = CHUNK_BYTES, bucket_keys: int = BUCKET_KEYS
) -> DataFrame:
    """``docs`` without the rows that the Gumbel top-k leaves out; all columns are kept."""
    found = _keys(docs, labels, fit_rows, docs.columns, chunk_bytes, bucket_keys)
    if found is None:
        return docs
    rows, _, key, least = found
    return rows.where(F.col(key) >= least).select(*docs.columns)
