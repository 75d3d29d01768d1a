"""Toxic passages as maximum-scoring segments of word weights, and a calibrated score of each text.

A word's weight is its log-odds ratio between texts labelled toxic and clean, under Dirichlet priors in
the proportions of the words of all documents, drawn in by ``CAUTION`` standard errors; every word costs
``DRIFT``, so that passages end. For the ratio a word counts once a text, as texts repeat their words. A linear-time scan finds all maximal-scoring segments of a text: no part
of one scores more, and no two can be joined for more.

The best segment of n words that are not toxic follows an extreme-value law: it reaches x by chance
K * n * exp(-lambda * x) times. Lambda solves sum p(word) * exp(lambda * weight) = 1 over the words of all
documents, K is fitted to clean labelled texts. A segment that chance gives once or less is significant.
A text's evidence is the sum of -log(expected times) over its significant segments, or the greatest one if
there are none, and a logistic curve fitted to labelled texts maps it to the score.

Weights come from three fifths of the ids, K and the curve from another, the last fifth is held out:
by crc32 of the doc_id modulo 5. The fit looks at a bounded sample of labelled texts (``FIT_ROWS``,
``FIT_BYTES``), so the table of weights has a bounded size and is sent to every task; words that are
not in it have no label to tell them apart. Prior counts cover all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.arrays import Words, alphanumeric_words, blocks, lower_ascii, words_of
from winnow.llm.shared import stored, texts_of

#: Labelled texts looked at, at most: those with the least hash of the doc_id, of each class; and their bytes.
#: A text has fewer than half as many words as bytes, so there are FIT_BYTES weights of 12 bytes at most.
FIT_ROWS, FIT_BYTES = 20_000, 16 << 20
#: Weight of the prior, against a class's own counts; standard errors that a log-odds ratio is drawn in by.
PRIOR, CAUTION = 0.1, 2.0
#: What each word costs, and the unit of all weights. Weights are whole numbers of units, so sums are exact.
DRIFT, UNIT = 0.1, 0.001
FOLDS, HELD_OUT, CURVE_FOLD = 5, 0, 4

_MEMBER, _LOWER = alphanumeric_words(), lower_ascii()

SEGMENTS = "array<struct<start: long, end: long, weight: double, evidence: double>>"
_SEGMENT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("weight", pa.float64()), ("evidence", pa.float64())])


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def maximal_segments(before: list[int], after: list[int]) -> list[tuple[int, int]]:
    """All maximal-scoring segments of runs of positive weights, as first and last run.

    ``before`` and ``after`` are the sums of all weights up to the start and the end of each run. Every
    segment remembers the nearest one that starts lower, so each is looked at a bounded number of times.
    """
    first: list[int] = []
    last: list[int] = []
    low: list[int] = []
    high: list[int] = []
    lower: list[int] = []  # place of the nearest earlier segment that starts lower, -1 for none
    for run, (a, b) in enumerate(zip(before, after, strict=True)):
        start = run
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= a:
                j = lower[j]
            if j < 0 or high[j] >= b:
                break
            start, a = first[j], low[j]
            del first[j:], last[j:], low[j:], high[j:], lower[j:]
        first.append(start)
        last.append(run)
        low.append(a)
        high.append(b)
        lower.append(j)
    return list(zip(first, last, strict=True))


@dataclass(frozen=True)
class Model:
    """Weights of words by hash, in units; those that are not listed weigh ``-DRIFT``."""

    words: np.ndarray
    weights: np.ndarray
    rate: float = 1.0  # lambda
    log_k: float = 0.0
    intercept: float = 0.0
    slope: float = 0.0

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -round(DRIFT / UNIT), np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            out = np.where(self.words[at] == hashes, self.weights[at], out)
        return out

    def evidence(self, weight: float, n: int) -> float:
        """-log of the number of segments of such a weight to be expected by chance in ``n`` words."""
        return self.rate * weight - self.log_k - math.log(max(n, 1))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * evidence, -30, 30)))


def _scan(model: Model, texts: pa.Array) -> Iterator[tuple[int, float, float, list[tuple[int, int, float, float]]]]:
    """Per text: words, weight of the best segment, evidence, and the significant segments in order."""
    for _, offsets, data in blocks(texts):
        words = words_of(offsets, data, _MEMBER, _LOWER)
        weights = model.of(words.hash)
        sums = np.concatenate([[0], np.cumsum(weights)])
        plus = weights > 0
        starts = np.concatenate([[0], np.cumsum(words.per_row())])
        edge = np.ones(len(plus), bool)
        edge[1:] = ~plus[:-1] | (words.row[1:] != words.row[:-1])
        head = np.flatnonzero(plus & edge)
        edge = np.ones(len(plus), bool)
        edge[:-1] = ~plus[1:] | (words.row[1:] != words.row[:-1])
        tail = np.flatnonzero(plus & edge) + 1
        runs = np.searchsorted(head, starts)
        before, after = sums[head].tolist(), sums[tail].tolist()
        head, tail, runs, starts = head.tolist(), tail.tolist(), runs.tolist(), starts.tolist()
        for row in range(len(starts) - 1):
            at, n = starts[row], starts[row + 1] - starts[row]
            a, b = runs[row], runs[row + 1]
            best, total, found = 0.0, None, []
            for i, j in maximal_segments(before[a:b], after[a:b]) if b > a else ():
                weight = (after[a + j] - before[a + i]) * UNIT
                best = max(best, weight)
                evidence = model.evidence(weight, n)
                if evidence >= 0:
                    found.append((head[a + i] - at, tail[a + j] - at, weight, evidence))
                    total = evidence + (total or 0.0)
            yield n, best, model.evidence(best, n) if total is None else total, found


def _sample(docs: DataFrame, labels: DataFrame, label: str, fit_rows: int, fit_bytes: int) -> DataFrame:
    """``(doc_id, toxic, curve, text)``: labelled texts to fit to, one of each id, stored.

    Of texts that share a doc_id the least one counts, of labels the greatest. A class's texts are taken
    by the hash of their ids as long as their bytes add up to ``fit_bytes``.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("toxic"))
    ids = ids.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.where(fold(F.col("doc_id")) != HELD_OUT)
    near = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [ids.where(F.col("toxic") == c).orderBy(*near).limit(fit_rows) for c in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Ids and classes of 2 * fit_rows rows at most: broadcast, so that no other text is shuffled.
    texts = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min(F.coalesce("text", F.lit(""))).alias("text")
    )
    found = stored(texts.withColumn("curve", fold(F.col("doc_id")) == CURVE_FOLD))
    left, taken = [fit_bytes, fit_bytes], []
    for r in found.select("doc_id", "toxic", F.octet_length("text").alias("size")).orderBy(*near).collect():
        left[r.toxic] -= r.size
        if left[r.toxic] >= 0:
            taken.append((r.doc_id,))
    return found.join(F.broadcast(docs.sparkSession.createDataFrame(taken, "doc_id long")), "doc_id", "left_semi")


def _once(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct words of each row."""
    order = np.lexsort((words.hash, words.row))
    row, hashes = words.row[order], words.hash[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return row[new], hashes[new]


def _word_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the sample's texts for the weights, and how many clean and toxic ones hold them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy()
            for first, offsets, data in blocks(batch.column(1)):
                row, hashes = _once(words_of(offsets, data, _MEMBER, _LOWER))
                distinct, place = np.unique(hashes, return_inverse=True)
                sums = [np.bincount(place[toxic[first + row] == c], minlength=len(distinct)).astype(np.int64) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), *map(pa.array, sums)], names=["word", "clean", "toxic"])

    rows = texts_of(sample.where("not curve")).select("toxic", "text")
    found = rows.mapInArrow(count, "word long, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    table = found.toArrow()
    words = table["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], np.stack([table[c].to_numpy()[order] for c in ("clean", "toxic")], axis=1)


def _prior_counts(docs: DataFrame, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each of ``words``, and all other words, occur in all documents, and in how many texts, summed over words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(words) + 1, 2), np.int64)
        for batch in batches:
            for _, offsets, data in blocks(batch.column(0)):
                found = words_of(offsets, data, _MEMBER, _LOWER)
                for column, hashes in enumerate((found.hash, _once(found)[1])):
                    at = np.searchsorted(words, hashes)
                    known = np.append(words, np.uint64(0))[at] == hashes
                    at[~known | (at == len(words))] = len(words)
                    counts[:, column] += np.bincount(at, minlength=len(words) + 1)
        some = np.flatnonzero(counts[:, 0])
        arrays = [pa.array(some), pa.array(counts[some, 0]), pa.array(counts[some, 1])]
        yield pa.RecordBatch.from_arrays(arrays, names=["place", "n", "texts"])

    rows = texts_of(docs).select(F.col("text").cast("string").alias("text")).mapInArrow(count, "place long, n long, texts long")
    table = rows.groupBy("place").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")).toArrow()
    out = np.zeros((len(words) + 1, 2), np.int64)
    out[table["place"].to_numpy()] = np.stack([table["n"].to_numpy(), table["texts"].to_numpy()], axis=1)
    return out[:, 0], out[:, 1]


def log_odds(own: np.ndarray, prior: np.ndarray, words: int) -> np.ndarray:
    """Log-odds ratio of each word, toxic against clean, drawn in by ``CAUTION`` standard errors.

    ``own`` has the counts in clean and in toxic texts. Each class's prior holds ``PRIOR`` times its own
    words in the proportions of all texts, so a word that is in neither class has a ratio of nothing.
    """
    totals = own.sum(axis=0)
    alpha = np.maximum(prior, 1)[:, None] / max(words, 1) * PRIOR * totals
    count = own + alpha
    with np.errstate(divide="ignore", invalid="ignore"):
        logit = np.log(count) - np.log(totals * (1 + PRIOR) - count)
        error = np.sqrt((1 / count).sum(axis=1))
    ratio = logit[:, 1] - logit[:, 0]
    out = np.sign(ratio) * np.maximum(np.abs(ratio) - CAUTION * error, 0)
    return np.where(np.isfinite(out), out, 0.0)


def extreme_rate(weights: np.ndarray, shares: np.ndarray) -> float:
    """The positive solution of sum(shares * exp(rate * weights)) = 1; 1 where chance cannot gain at all."""
    if not (weights[shares > 0] > 0).any() or (shares * weights).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (shares * np.exp(high * weights)).sum() < 1:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (shares * np.exp(middle * weights)).sum() < 1 else (low, middle)
    return high


def _curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of the logistic curve, by Newton's method with targets drawn in from 0 and 1."""
    ones, zeros = toxic.sum(), (~toxic).sum()
    if not ones or not zeros:
        return math.log((ones + 1) / (zeros + 1)), 0.0
    goal = np.where(toxic, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([np.ones(len(evidence)), evidence], axis=1)
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (goal - p) - 1e-6 * at)
        at += step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def _judged(sample: DataFrame, model: Model) -> pa.Table:
    """Label, words, best weight and evidence of the sample's texts for the curve."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row[:3] for row in _scan(model, batch.column(1))]
            columns = [list(c) for c in zip(*rows, strict=True)] or [[], [], []]
            kinds = (pa.int64(), pa.float64(), pa.float64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["toxic", "n", "best", "evidence"])

    rows = texts_of(sample.where("curve")).select(F.col("toxic").cast("int"), "text")
    return rows.mapInArrow(judge, "toxic int, n long, best double, evidence double").toArrow()


#: Evidence beyond this counts as this for the curve: some texts would outweigh all others.
MOST = 20.0


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> Model:
    """A model of ``label`` (0 or 1 by doc_id). Of the labels only ids whose fold is not held out are read.

    Null ids and labels do not count. Without words of both classes no word has a weight, and without
    texts of both classes for the curve the score is their share, a half if there are none.
    """
    sample = _sample(docs, labels, label, fit_rows, fit_bytes)
    words, own = _word_counts(sample)
    n, texts = _prior_counts(docs, words)
    ratio = log_odds(own, texts[:-1], int(texts.sum())) if own.sum(axis=0).all() else np.zeros(len(words))
    units = np.rint((ratio - DRIFT) / UNIT).astype(np.int64)
    listed = units != -round(DRIFT / UNIT)
    rate = extreme_rate(np.append(units * UNIT, -DRIFT), n / max(int(n.sum()), 1))
    model = Model(words[listed], units[listed], rate)

    seen = _judged(sample, model)
    clean = seen["toxic"].to_numpy() == 0
    n, top = np.maximum(seen["n"].to_numpy()[clean], 1), seen["best"].to_numpy()[clean]
    chance = float((n * np.exp(-rate * top)).sum())
    log_k = math.log(len(n) / chance) if chance else 0.0
    seen = _judged(sample, replace(model, log_k=log_k))
    evidence = np.clip(seen["evidence"].to_numpy(), -MOST, MOST)
    intercept, slope = _curve(evidence, seen["toxic"].to_numpy() == 1)
    return replace(model, log_k=log_k, intercept=intercept, slope=slope)


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_words, evidence, score, passages)`` of every whole text; null and empty ones have no words.

    A passage is a significant segment: the words from ``start`` up to ``end``, its weight and its evidence.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, evidence, found = [], [], []
            for words, _, total, segments in _scan(model, batch.column(1)):
                n.append(words)
                evidence.append(total)
                found.append([dict(zip(("start", "end", "weight", "evidence"), s, strict=True)) for s in segments])
            scores = model.score(np.clip(np.array(evidence, float), -MOST, MOST))
            arrays = [pa.array(n, pa.int64()), pa.array(evidence, pa.float64()), pa.array(scores), pa.array(found, pa.list_(_SEGMENT))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n_words", "evidence", "score", "passages"])

    rows = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, n_words long, evidence double, score double, passages {SEGMENTS}")


def detect(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> DataFrame:
    """Every row of ``docs`` as ``passages`` of a model fitted to it, with ``held_out`` and ``predicted``.

    Rows are judged one by one, repeated ones too; one without a doc_id is not held out. Label, language,
    source and id are no inputs of the score.
    """
    found = passages(docs, fit(docs, labels, label, fit_rows, fit_bytes))
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return found.withColumns({"held_out": held_out, "predicted": (F.col("score") >= 0.5).cast("int")})
