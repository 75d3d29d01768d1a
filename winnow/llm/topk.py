"""Exact top-k inner products from an impact-ordered index, score at a time.

Vectors are integers. The index holds postings: for each shard of vectors, impact level and dimension,
the vectors whose component there has that level, and the components. Levels are powers of two of the
component's size, so segments come in descending quantised impact.

Queries work through a shard's segments from the highest level down and add to the scores of the
candidates that have postings there. After a level, what a candidate may still gain or lose is at most
the norm of its postings to come times the query's norm. The k-th largest score that is certain is a
bound: once few enough candidates can still reach it, the query is done with the shard, and every
candidate that can reach it is scored exactly from its whole vector; else it goes on until no segment is
left. Stopping early costs nothing in exactness.

A task holds one shard and lets a span of queries pass through it in blocks, so the index is sent once
a span, the queries once a shard, and no more than a shard and a block is in memory.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from winnow.llm.shared import stored, texts_of

#: Vectors of a shard and queries of a block, about: what one task holds. Queries of a task, about.
SHARD, BLOCK, SPAN = 16_384, 512, 16_384
SCALE = 64

POSTINGS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("dim", T.IntegerType()),
        T.StructField("vec_ids", T.BinaryType()),
        T.StructField("impacts", T.BinaryType()),
    ]
)


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and vector: floor(scale * x) of every component x, as double.

    Rows with a null vec_id, a null vector, or a null or non-finite component are left out. Rows that
    share a vec_id stay apart, as vectors of their own; vectors may differ in length, and what a shorter
    one lacks counts as 0.
    """
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = embeddings.select(F.col("vec_id").cast("long"), x.alias("x"), bad.alias("bad"))
    rows = rows.where("vec_id is not null and x is not null and not bad")
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(float(scale)))).alias("vector"))


def _matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of integers, the shorter ones filled up with noughts."""
    rows = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = pc.list_value_length(rows).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(rows), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = rows.flatten().to_numpy()
    return out


def _levels(values: np.ndarray) -> np.ndarray:
    """Bits that the size of a component takes, 0 for nought."""
    return np.ceil(np.log2(np.abs(values).astype(np.float64) + 1)).astype(np.int32)


def build_index(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """Posting segments of every vector, in ``POSTINGS``; store them before they are read twice.

    ``vectors`` is a stored table: rows are dealt by their place in it, so that many equal ones part.
    """
    shards = max(1, -(-vectors.count() // shard))
    place = F.xxhash64("vec_id", F.monotonically_increasing_id())
    dealt = vectors.withColumn("shard", F.pmod(place, F.lit(shards)).cast("int"))

    def post(table: pa.Table) -> pa.Table:
        number = table["shard"][0].as_py()
        # Repeated vec_ids are told apart by their place: postings name rows by id and place.
        ids, values = table["vec_id"].to_numpy(), _matrix(table["vector"])
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        rows = [(number, -1, values.shape[1], ids.astype("<i8").tobytes(), b"")]
        levels = _levels(values)
        for level in sorted(set(np.unique(levels).tolist()) - {0}, reverse=True):
            hit = levels == level
            for dim in np.flatnonzero(hit.any(axis=0)).tolist():
                at = np.flatnonzero(hit[:, dim])
                rows.append(
                    (number, level, dim, at.astype("<i4").tobytes(), values[at, dim].astype("<i8").tobytes())
                )
        columns = [pa.array(list(c), f) for c, f in zip(zip(*rows, strict=True), _KINDS, strict=True)]
        return pa.table(columns, names=POSTINGS.names)

    return dealt.groupBy("shard").applyInArrow(post, POSTINGS)


_KINDS = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())


class _Shard:
    """A shard's segments by level, highest first: of each level, the rows and dimensions that have postings."""

    def __init__(self, postings: list[pa.RecordBatch]) -> None:
        levels: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for batch in postings:
            columns = (batch.column(name).to_pylist() for name in ("level", "dim", "vec_ids", "impacts"))
            for level, dim, at, impacts in zip(*columns, strict=True):
                if level < 0:
                    self.ids, width = np.frombuffer(at, "<i8"), dim
                else:
                    levels.setdefault(level, []).append(
                        (dim, np.frombuffer(at, "<i4"), np.frombuffer(impacts, "<i8"))
                    )
        n = len(self.ids)
        self.values = np.zeros((n, width), np.int64)
        self.layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for level in sorted(levels, reverse=True):
            segments = sorted(levels.pop(level), key=lambda segment: segment[0])
            rows = np.unique(np.concatenate([at for _, at, _ in segments]))
            layer = np.zeros((len(rows), len(segments)))
            for j, (dim, at, impacts) in enumerate(segments):
                layer[np.searchsorted(rows, at), j] = impacts
                self.values[at, dim] = impacts
            self.layers.append((rows, np.array([dim for dim, _, _ in segments]), layer))
        # Squared norms of the postings to come after each layer, summed up from the last: no differences.
        rest = np.zeros(n)
        self.rests: list[np.ndarray] = []
        for rows, _, layer in reversed(self.layers):
            self.rests.insert(0, rest.copy())
            rest[rows] += (layer * layer).sum(axis=1)
        #: Queries that were done before the last layer.
        self.proven = 0

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """query_id, vec_ids and scores of each query's k best here; all ties of the last are kept."""
        n, width = self.values.shape
        if queries.shape[1] < width:
            queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
        queries = queries[:, :width]
        sizes = np.abs(queries).astype(float).sum(axis=1).max(initial=0)
        if sizes * max(1, int(np.abs(self.values).max(initial=0))) >= 2**53:
            yield from self._all(query_ids, queries.astype(object) @ self.values.astype(object).T, k)
            return
        q = queries.astype(np.float64)
        scores = np.zeros((len(q), n))
        norms = np.sqrt((q * q).sum(axis=1))
        for i, (rows, dims, layer) in enumerate(self.layers):
            if not len(q):
                return
            scores[:, slice(None) if len(rows) == n else rows] += q[:, dims] @ layer.T
            # With hardly more than k candidates there is nothing to prove, but every level counts.
            if i + 1 == len(self.layers) or n <= k + 1:
                continue
            slack = norms[:, None] * np.sqrt(self.rests[i])[None, :] * (1 + 1e-9)
            own = self.ids[None, :] == query_ids[:, None]
            certain = np.where(own, -np.inf, scores - slack)
            bound = np.partition(certain, n - k, axis=1)[:, n - k]
            possible = (scores + slack >= bound[:, None]) & ~own
            few = possible.sum(axis=1) <= 4 * k
            if few.any():
                self.proven += int(few.sum())
                yield from self._rescored(query_ids[few], q[few], possible[few], k)
                query_ids, q, scores, norms = query_ids[~few], q[~few], scores[~few], norms[~few]
        # Every segment is done: the scores are exact.
        yield from self._all(query_ids, scores, k)

    def _rescored(self, query_ids, q, possible, k):
        values = self.values.astype(np.float64)
        for i, query_id in enumerate(query_ids.tolist()):
            at = np.flatnonzero(possible[i])
            yield query_id, *_best(self.ids[at], values[at] @ q[i], k)

    def _all(self, query_ids, scores, k):
        for i, query_id in enumerate(query_ids.tolist()):
            at = np.flatnonzero(self.ids != query_id)
            yield query_id, *_best(self.ids[at], scores[i][at], k)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best, ties to smaller ids; ids come in ascending order."""
    if len(ids) > k and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        ids, scores = ids[at], scores[at]
    order = np.argsort(-scores, kind="stable")[:k]
    return ids[order], scores[order]


_FOUND = "query_id long, vec_id long, score long"


def search(index: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, span: int = SPAN) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest scores, ties to the smaller vec_id.

    ``queries`` has vec_id and vector; a query is no candidate of its own, by vec_id. Queries are dealt
    into spans; each span meets each shard of the index in a task of its own, where it passes through
    in blocks. A vec_id asks once: of several vectors with it the least one counts. With fewer
    candidates, all are returned.
    """
    queries = texts_of(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    spans = max(1, -(-queries.count() // span))
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    told = index.withColumn("span", every(spans))
    asked = queries.withColumn("span", F.pmod(F.xxhash64("vec_id"), F.lit(spans)).cast("int"))
    asked = asked.withColumn("shard", every(shards))
    task = (F.col("shard") * F.lit(spans) + F.col("span")).alias("task")
    rows = told.select(task, F.lit(False).alias("asks"), *POSTINGS.names[1:]).unionByName(
        asked.select(task, F.lit(True).alias("asks"), "vec_id", "vector"), allowMissingColumns=True
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, postings = None, None, []
        for batch in batches:
            tasks, asks = batch["task"].to_numpy(), batch["asks"].to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(tasks) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
            for start, stop in itertools.pairwise([0, *turns.tolist(), len(tasks)]):
                if at != tasks[start]:
                    at, held, postings = tasks[start], None, []
                if not asks[start]:
                    postings.append(batch.slice(start, stop - start))
                    continue
                if postings:
                    held, postings = _Shard(postings), []
                for first in range(start, stop, block) if held else ():
                    part = batch.slice(first, min(block, stop - first))
                    yield _answers(held, part["vec_id"].to_numpy(), _matrix(part["vector"]), k)

    # One task a partition, postings before queries.
    placed = rows.repartitionById(shards * spans, F.col("task")).sortWithinPartitions("task", "asks")
    found = placed.mapInArrow(meet, _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _answers(held: _Shard, ids: np.ndarray, vectors: np.ndarray, k: int) -> pa.RecordBatch:
    out = [np.zeros((0, 3), np.int64)]
    for query_id, vec_ids, scores in held.top(ids, vectors, k):
        scores = np.array([int(s) for s in scores], np.int64)
        out.append(np.column_stack([np.full(len(vec_ids), query_id), vec_ids, scores]))
    found = np.concatenate(out)
    return pa.record_batch([pa.array(found[:, i], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])


def top_k(embeddings: DataFrame, queries, k: int, scale: int = SCALE, shard: int = SHARD) -> DataFrame:
    """Index all vectors and search with those that ``queries``, a condition on vec_id, picks."""
    vectors = stored(quantised(embeddings, scale))
    return search(stored(build_index(vectors, shard)), vectors.where(queries), k)
