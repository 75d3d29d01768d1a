"""The queries of this package against their SQL, and the pipeline against its stages' promises."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from winnow.llm import decontam, pii, queries, simhash, topk

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)


def test_all_are_registered():
    names = entry_point.queries()
    assert [f"op{n}_" for n in range(1, 14)] == [next(q for q in names if q.startswith(f"op{n}_")).split("_")[0] + "_" for n in range(1, 14)]
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op3_simhash", "op4_pii", "op6_quality", "op8_token_counts", "op10_secrets"])
def test_query_covers_the_table(spark, name):
    rows = queries.QUERIES[name](spark, SF)
    if name != "op8_token_counts":
        assert rows.count() == 200
    else:
        assert rows.agg({"n_docs": "sum"}).first()[0] == 200


def test_vectors_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -0.3]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (20, [1.0, 2.0]), (20, [0.0, 0.1]), (None, [1.0, 1.0]), (5, [1.0]), (6, [])]
    frame = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int, shard int")
    found = topk.top_k(frame, F.col("vec_id") == 0, k=3)
    assert [tuple(r) for r in found.orderBy("rank").collect()] == [(0, 1, 20, 20480), (0, 2, 5, 4096), (0, 3, 20, 768)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") == 0, k=3).count() == 0


@pytest.mark.parametrize("n, k, shard", [(5, 20, 16_384), (21, 20, 16_384), (60, 8, 4)])
def test_fewer_vectors_than_k_over_several_levels(spark, n, k, shard):
    draw = random.Random(n)
    vectors = [[draw.choice([-1, 1]) * draw.randint(0, 4 ** draw.randint(0, 4)) for _ in range(6)] for _ in range(n)]
    vectors[0] = vectors[1] = [64, 128, 0, 0, 0, 0]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = topk.top_k(frame, F.col("vec_id") % 3 == 0, k=k, scale=1, shard=shard)
    want = []
    for q in range(0, n, 3):
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in enumerate(vectors) if i != q)
        want += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    assert (0, 20480) in {(q, s) for q, _, i, s in want if i == 1}
    assert sorted(map(tuple, found.collect())) == sorted(want)


def heavy_tailed(spark, n, width, seed):
    draw = random.Random(seed)
    size = lambda: int(draw.choice([-1, 1]) * draw.paretovariate(0.6))
    vectors = [[min(size(), 5000) for _ in range(width)] for _ in range(n)]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    return vectors, frame


def best(vectors, q, k):
    scores = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in enumerate(vectors) if i != q)
    return [(i, -s) for s, i in scores[:k]]


def test_queries_pass_through_shards_in_spans_and_blocks(spark):
    vectors, frame = heavy_tailed(spark, 300, 7, 1)
    stored = topk.stored(topk.quantised(frame, 1))
    index = topk.stored(topk.build_index(stored, 40))
    found = topk.search(index, stored.where("vec_id % 4 = 0"), 5, block=3, span=10)
    want = [(q, r + 1, i, s) for q in range(0, 300, 4) for r, (i, s) in enumerate(best(vectors, q, 5))]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_most_queries_stop_on_proof(spark):
    vectors, frame = heavy_tailed(spark, 2000, 8, 2)
    index = topk.build_index(topk.stored(topk.quantised(frame, 1)))
    held = topk._Shard(index.drop("shard").toArrow().to_batches())
    ask = list(range(0, 2000, 50))
    found = {}
    for query_id, ids, scores in held.top(np.array(ask), np.array([vectors[q] for q in ask]), 5):
        found[query_id] = list(zip(ids.tolist(), scores.astype(int).tolist(), strict=True))
    assert found == {q: best(vectors, q, 5) for q in ask}
    assert held.proven > len(ask) // 2
    assert len(held.layers) > 5


def test_equal_vectors_part(spark):
    """A third of all rows are one row: it does not fill one shard."""
    frame = spark.range(0, 3000, 1, 8).selectExpr(
        "if(id % 3 = 0, 7, id) as vec_id", "array(double(if(id % 3 = 0, 7, id)), 1D) as embedding"
    )
    index = topk.stored(topk.build_index(topk.stored(topk.quantised(frame, 1)), 300))
    sizes = [len(r.vec_ids) // 8 for r in index.where("level = -1").collect()]
    assert sum(sizes) == 3000 and max(sizes) < 450


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SF).cache())
    good, single, clean, private, packed = tables[1:]
    for table in (good, single, clean, private):
        assert table.columns == docs.columns and table.count() > 100
    components = simhash.near_duplicates(good).select("component_id").distinct()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in components.collect()}
    assert decontam.find_hits(clean, benchmark).where("n_hit > 0").count() == 0
    assert pii.find_pii(private).where("size(spans) > 0").count() == 0
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in private.collect()}
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
