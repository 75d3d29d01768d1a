"""Terms of a table of any size against the same terms as a list."""

import random

from pyspark.sql import functions as F

from winnow.operators.vocabulary import _prepared, skill_tags, skill_tags_joined, term_table

TERMS = {
    "code": ["C++", "C", "c#", ".NET", "CI/CD", "node.js", "Python", "python", "R&D", "é", "É", "naïve bayes", "a  b", "++", "+", "--"],
    "other": ["C++", "co-op", "K8s", "(x)", "x", "漢字", "_id", "id_", "/", "machine learning", "learning"],
}
PARTS = [
    "C++", "c", "C#", ".net", "net", "CI/CD", "ci", "/", "cd", "Node.JS", "PYTHON", "r&d", "é", "É", "naïve", "Bayes", "a", "b", "+", "++", "-",
    "co-op", "co", "op", "k8s", "(x)", "x", "漢字", "漢", "_id", "id_", "id", "machine", "learning", " ", "  ", "\n", ",", "_", "9",
]


def tags(df, *key):
    return sorted((*(r[k] for k in key), r.group, tuple(r.skills)) for r in df.collect())


def test_joined_terms_equal_listed_terms(spark):
    draw = random.Random(9)
    texts = ["".join(draw.choice(PARTS) + draw.choice(["", " "]) for _ in range(draw.randrange(14))) for _ in range(400)]
    texts += [None, "", " ", "C++", "CI/CD", "+", "C++ and C#.", "xCI/CD", "CI/CD9", "C+++", ".NET", "a.NET", "..NET", "A  B", "naïve BAYES", "c# ++ + R&D"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    want = tags(skill_tags(rows, "text", TERMS), "i")
    got = tags(skill_tags_joined(rows, ["i"], "text", term_table(spark, TERMS)), "i")
    assert got == want and {s for *_, skills in got for s in skills} >= {"C++", "CI/CD", "c#", ".NET", "+", "++", "a  b", "naïve bayes"}


def test_odd_terms_and_keys(spark):
    terms = spark.createDataFrame([("g", "x y"), ("g", "x y"), ("g", None), (None, "x"), ("g", ""), ("h", "x")], "group string, term string")
    rows = spark.createDataFrame(
        [(1, None, "x Y"), (1, None, "x"), (None, "b", "X"), (2, "c", "y"), (2, "c", None)], "id int, core string, text string"
    )
    found = skill_tags_joined(rows, ["id", "core"], "text", terms)
    assert found.columns == ["id", "core", "group", "skills"]
    got = {(r.id, r.core, r.group): r.skills for r in found.collect()}
    assert got == {
        (1, None, "g"): ["x y"], (1, None, None): ["x"], (1, None, "h"): ["x"], (None, "b", None): ["x"], (None, "b", "h"): ["x"],
    }
    assert skill_tags_joined(rows, ["id"], "text", terms.limit(0)).count() == 0
    assert skill_tags_joined(rows.limit(0), ["id"], "text", terms).count() == 0


def test_a_large_vocabulary_is_joined_and_not_walked(spark):
    """A hundred thousand terms, one of them in a third of the texts: an equi-join that may be split."""
    terms = spark.range(100_000).select(F.lit("g").alias("group"), F.concat(F.lit("t"), F.col("id")).alias("term"))
    rows = spark.range(6_000).select("id", F.concat_ws(" ", F.when(F.col("id") % 3 == 0, "t7"), F.concat(F.lit("T"), F.col("id") * 10)).alias("text"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = skill_tags_joined(rows, ["id"], "text", terms)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r.id: r.skills for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert got == {i: sorted((["t7"] if i % 3 == 0 else []) + [f"t{10 * i}"]) for i in range(6_000)}


def test_terms_and_places_are_cut_once(spark):
    """Terms are cut after they are told apart, texts once; spans, which no table's size tells of, are not broadcast."""
    words = spark.range(300_000).select(F.lit("g").alias("group"), F.concat(F.lit("t"), F.col("id") % 60_000).alias("term")).distinct()
    cut = _prepared(words)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in cut and "regexp_extract_all" not in cut.partition("Aggregate")[2].partition("\n")[2]
    rows = spark.createDataFrame([(i, f"T{i} t{i}, t{i + 1}") for i in range(50)], "id int, text string")
    found = skill_tags_joined(rows, ["id"], "text", words)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in plan.partition("Join")[2].partition("Generate")[0]
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.skills for r in found.collect()} == {i: sorted([f"t{i}", f"t{i + 1}"]) for i in range(50)}
