"""Draws the documents that look most like a target: importance resampling over hashed n-grams.

Separators are collapsed to single spaces, and an overlapped regular expression whose lookarounds hold it
to whole words emits the span of every n-gram of each order; a feature's bucket is the CRC of its bytes.
Bucket counts of all documents and of all target texts give each bucket's gain, the scaled log ratio
of the two smoothed shares. A document weighs the sum of the gains of its features; noise of the
Gumbel distribution, fixed by its doc_id, is added, and the highest scores are drawn.

Texts are scanned once: each document's buckets are stored, two bytes or so a feature. Counts are summed
where they arise, a row per bucket and task is shuffled, and one per bucket comes to the driver.
Ranks come from one distributed sort of narrow rows, told apart by their place in the stored table, and
the sizes of its partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.shared import stored, texts_of

#: Orders of the n-grams, buckets, salt of the noise, least words of a document that may be drawn, percent drawn.
ORDERS, BUCKETS, SALT, MIN_WORDS, PERCENT = (1, 1), 10_000, "2024", 20, 10
#: Features of one batch that a worker hands back, about.
BATCH_FEATURES = 1 << 19

# Letters A-Z to lower case, all other ASCII that is neither a lower-case letter nor a digit to a space.
_FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
_SPACES = regex.compile(rb" +")


def grams(n: int) -> regex.Pattern:
    """Matches ``n`` words joined by single spaces, from the start of a word to the end of one."""
    return regex.compile(rb"(?<![^ ])[^ ]+" + rb"(?: [^ ]+)" * (n - 1) + rb"(?![^ ])")


def buckets_of(text: bytes, orders: tuple[int, int], buckets: int) -> tuple[int, list[int]]:
    """Words of a UTF-8 text, and the bucket of each n-gram of the orders, by order and place."""
    line = _SPACES.sub(b" ", text.translate(_FOLD)).strip(b" ")
    words = line.count(b" ") + 1 if line else 0
    out: list[int] = []
    for n in range(orders[0], min(orders[1], words) + 1):
        found = grams(n).finditer(line, overlapped=True)
        out += [crc32(line[a:b]) % buckets for a, b in (m.span() for m in found)]
    return words, out


def features(docs: DataFrame, orders: tuple[int, int] = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, n_words, buckets)`` of every whole text; null has neither words nor features."""
    if not 1 <= orders[0] <= orders[1]:
        raise ValueError("orders must be a range of positive numbers")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            first, words, ends, found = 0, [], [0], []
            for row in range(len(texts)):
                n, own = buckets_of(texts[row].as_py() or b"", orders, buckets)
                words.append(n)
                found.append(np.array(own, np.int32))
                ends.append(ends[-1] + len(own))
                if ends[-1] >= BATCH_FEATURES or row == len(texts) - 1:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
                    arrays = [ids.slice(first, len(words)), pa.array(words, pa.int64()), lists]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "buckets"])
                    first, words, ends, found = row + 1, [], [0], []

    rows = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_words long, buckets array<int>")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all rows: combined in each task before a row per bucket is shuffled."""
    counts = np.zeros(buckets, np.int64)
    for r in found.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: a thousand times the log of the smoothed target share over the smoothed raw share, rounded down."""
    all_raw, all_target, n = float(raw.sum()), float(target.sum()), len(raw)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_raw + n) / ((s + 1.0) * (all_target + n))))
            for s, t in zip(raw.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: Column, salt: str = SALT) -> Column:
    """A thousand times Gumbel noise fixed by the doc_id, rounded down."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), doc_id.cast("string")), 256), 1, 8)
    uniform = (F.conv(head, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """Stored ``features`` as ``(place, doc_id, n_words, n_features, weight)``; no features weigh 0."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sums = np.concatenate([[0], np.cumsum(gain[lists.flatten().to_numpy()])])
            sizes = lists.value_lengths().to_numpy()
            ends = np.cumsum(sizes)
            weights = sums[ends] - sums[ends - sizes]
            arrays = [batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64()), pa.array(weights)]
            yield pa.RecordBatch.from_arrays(arrays, names=["place", "doc_id", "n_words", "n_features", "weight"])

    schema = "place long, doc_id long, n_words long, n_features long, weight long"
    return texts_of(found).select("place", "doc_id", "n_words", "buckets").mapInArrow(weigh, schema)


@dataclass(frozen=True)
class Ranked:
    rows: DataFrame  # the rows with ``rank``, from 1
    n: int


def ranked(rows: DataFrame, *order: Column) -> Ranked:
    """Number rows by ``order``, which must tell all of them apart: one sort in ranges, no single task.

    The sorted rows are stored with their place in their partition; the partitions' sizes, a row each,
    give the ranks before them.
    """
    place = F.monotonically_increasing_id()
    part = F.shiftright(place, 33)
    ordered = rows.orderBy(*order).withColumn("part", part).withColumn("pos", place - F.shiftleft(part, 33))
    ordered = stored(ordered)
    sizes = sorted((r.part, r.n) for r in ordered.groupBy("part").agg(F.count("*").alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    starts = rows.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, before, strict=False)], "part long, before long"
    )
    out = ordered.join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + F.col("pos") + 1)
    return Ranked(out.drop("part", "pos", "before"), before[-1])


def resample(
    docs: DataFrame,
    target: DataFrame,
    orders: tuple[int, int] = ORDERS,
    buckets: int = BUCKETS,
    salt: str = SALT,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every row of ``docs``; rank is null unless drawn.

    ``target`` has a text column. Of the N rows of at least ``min_words`` words, floor(percent * N / 100) are drawn,
    by score and then by smaller doc_id. A null text, in either table, has no features; a row without a doc_id
    has no noise and so no score, is never drawn and is not one of the N. Rows that share a doc_id share
    their noise and are drawn one by one. Empty tables give no rows, or gains against no target.
    """
    found = stored(features(docs, orders, buckets).withColumn("place", F.monotonically_increasing_id()))
    wanted = bucket_counts(features(target.select(F.lit(0).alias("doc_id"), "text"), orders, buckets), buckets)
    rows = weighed(found, gains(bucket_counts(found, buckets), wanted))
    rows = stored(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), salt)))
    eligible = F.col("doc_id").isNotNull() & (F.col("n_words") >= min_words)
    listed = ranked(rows.where(eligible), F.desc("score"), F.asc("doc_id"), F.asc("place"))
    drawn = F.when(F.col("rank") <= percent * listed.n // 100, F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    others = rows.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return listed.rows.select(*columns, drawn.alias("rank")).unionByName(others)
