"""Toxicity, importance resampling and the filter audit against plain versions."""

import itertools
import math
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.llm import filter_audit, target_sampling, toxicity

SF = "/root/testdata/sf0.01"


# --- filter audit


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs),
        }
        rows.append((source or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone), f,
                ]
        for (p, _, _), v in out.items():
            if p == part:
                v[-1] = shapley[v[-1]]
    return out


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(*d, 7, 1) for d in docs], "doc_id long, text string, source string, mask int, n long")
    flags = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(frame, flags).collect()
    return {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in found
    }


def test_audit_of_odd_rows(spark):
    draw = random.Random(3)
    texts = [
        None, "", "a b", "A B C", "x " * 300, "word%d " * 5, " ".join(f"w{i}" for i in range(250)),
        " ".join(f"W{i}" for i in range(250)), "# " + " ".join(f"w{i}" for i in range(220)), "é\xa0É \x1f|", "same", "same",
    ]
    docs = [(draw.choice([None, *range(30)]), draw.choice(texts), draw.choice([None, "", "s", "t"])) for _ in range(150)]
    docs += [(500, "same", "s")] * 40 + [(None, "same", "s")] * 3 + [(501, " ".join(f"long{i}" for i in range(60_000)), "t")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(20)] + [(None, 1, 1), (3, 1, 0), (500, 1, 1)]
    assert audited(spark, docs, labels) == plain_audit(docs, labels)


def test_audit_of_nothing(spark):
    assert audited(spark, [], []) == {}
    assert audited(spark, [(1, "a", "s")], []) == plain_audit([(1, "a", "s")], [])


def test_a_third_of_rows_with_one_text(spark):
    """Copies are settled by aggregates: no row of the plan brings the rows of a text together."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"),
        F.lit("s").alias("source"),
    )
    labels = spark.createDataFrame([(0, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    counted, names = filter_audit.cells(docs, labels)
    rows = {r["mask"]: (r.docs, r.good, r.toxic) for r in counted.collect()}
    assert names == "ABCDE" and "Window" not in counted._jdf.queryExecution().toString()
    assert {m: r for m, r in rows.items() if r[0]} == {1: (2001, 1, 1), 17: (999, 1, 0)}


def test_survivors_of_every_set():
    draw = np.random.default_rng(1)
    counts = draw.integers(0, 9, (32, 3))
    state = filter_audit.survivors(counts)
    for active in range(32):
        want = sum((counts[m] for m in range(32) if not m & active), np.zeros(3, int))
        assert (state[active] == want).all()


# --- importance resampling


def plain_features(text, orders):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + n]) for n in range(orders[0], orders[1] + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def plain_resample(docs, target, orders, min_words=20, percent=10):
    found = [(i, *plain_features(t, orders)) for i, t in docs]
    raw, wanted = np.zeros(10_000), np.zeros(10_000)
    for _, _, own in found:
        np.add.at(raw, own, 1)
    for t in target:
        np.add.at(wanted, plain_features(t, orders)[1], 1)
    gain = [
        math.floor(1000 * math.log((t + 1) * (raw.sum() + 10_000) / ((s + 1) * (wanted.sum() + 10_000))))
        for s, t in zip(raw, wanted, strict=True)
    ]
    rows = []
    for i, n, own in found:
        weight, score = sum(gain[b] for b in own), None
        if i is not None:
            h = int(sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, n, len(own), weight, score, None])
    listed = sorted((r for r in rows if r[0] is not None and r[1] >= min_words), key=lambda r: (-r[4], r[0]))
    for rank, r in enumerate(listed[: percent * len(listed) // 100], 1):
        r[5] = rank
    return sorted((tuple([r[0], *r[2:]]) for r in rows), key=str)


@pytest.mark.parametrize("orders, min_words, percent", [((1, 1), 20, 10), ((1, 3), 2, 60), ((2, 2), 1, 100)])
def test_resampling(spark, make_docs, orders, min_words, percent):
    draw = random.Random(5)
    words = ["Éa", "tHe", "of", "x1", "naïve", "__", "-", "漢字", "\xa0b", " ", "\x00", "z" * 400]
    docs = [(i, draw.choice([" ", ".", "\n"]).join(draw.choices(words, k=draw.randrange(60)))) for i in range(120)]
    docs += [(None, "the of " * 20), (7, None), (8, ""), (9, " \n"), (200, "the " * 90_000)] + [(300, "the x1 of " * 12)] * 60
    target = ["the of THE", None, "", "x1 naïve " * 9]
    frame = make_docs(*docs)
    benchmark = spark.createDataFrame([(t, 1) for t in target], "text string, place long")
    found = target_sampling.resample(frame, benchmark, orders, min_words=min_words, percent=percent)
    assert sorted(map(tuple, found.collect()), key=str) == plain_resample(docs, target, orders, min_words, percent)


def test_resampling_of_nothing(spark, make_docs):
    none = spark.createDataFrame([], "text string")
    assert target_sampling.resample(make_docs().limit(0), none).count() == 0
    rows = [(i, "a b c " * 9) for i in range(20)]
    assert sorted(map(tuple, target_sampling.resample(make_docs(*rows), none).collect()), key=str) == plain_resample(rows, [], (1, 1))


def test_ranks_of_equal_rows_are_dealt_over_tasks(spark):
    rows = spark.range(0, 5000, 1, 8).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("x"), F.col("id").alias("place"))
    found = target_sampling.ranked(rows, F.desc("x"), F.asc("place"))
    assert found.n == 5000
    got = [(r.x, r.place) for r in found.rows.orderBy("rank").collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1]))
    assert [r.rank for r in found.rows.select("rank").orderBy("rank").collect()] == list(range(1, 5001))


# --- toxicity


def plain_segments(weights):
    """Ruzzo and Tompa's definition: the best segment, then those of what lies on either side of it."""
    if not any(w > 0 for w in weights):
        return []
    spans = [(sum(weights[a:b]), -(b - a), -a, a, b) for a in range(len(weights)) for b in range(a + 1, len(weights) + 1)]
    _, _, _, a, b = max(spans)
    right = [(x + b, y + b) for x, y in plain_segments(weights[b:])]
    return plain_segments(weights[:a]) + [(a, b)] + right


def test_maximal_segments():
    draw = random.Random(2)
    for _ in range(400):
        weights = [draw.choice([-7, -4, -3, -1, 2, 3, 5, 8]) + draw.random() / 8 for _ in range(draw.randrange(14))]
        heads = [i for i, w in enumerate(weights) if w > 0 and (i == 0 or weights[i - 1] <= 0)]
        tails = [i + 1 for i, w in enumerate(weights) if w > 0 and (i + 1 == len(weights) or weights[i + 1] <= 0)]
        sums = list(itertools.accumulate(weights, initial=0.0))
        found = toxicity.maximal_segments([sums[i] for i in heads], [sums[i] for i in tails])
        assert [(heads[i], tails[j]) for i, j in found] == plain_segments(weights)


def test_segments_take_linear_time():
    n = 200_000
    rising = list(range(n))
    assert len(toxicity.maximal_segments(rising, [r + 3 for r in rising])) == 1
    falling = [-2 * r for r in rising]
    assert len(toxicity.maximal_segments(falling, [r + 1 for r in falling])) == n


def test_extreme_rate():
    """Weights that are log ratios of two distributions have a rate of one."""
    clean, toxic = np.array([0.7, 0.2, 0.1]), np.array([0.2, 0.3, 0.5])
    assert toxicity.extreme_rate(np.log(toxic / clean), clean) == pytest.approx(1)
    assert toxicity.extreme_rate(2 * np.log(toxic / clean), clean) == pytest.approx(0.5)
    assert toxicity.extreme_rate(np.array([-1.0]), np.array([1.0])) == 1


def test_words_of_neither_class_have_no_weight():
    own = np.array([[0, 0], [50, 50], [0, 30], [400, 40]])
    ratio = toxicity.log_odds(own, np.array([9, 500, 40, 4000]), 10_000)
    assert ratio[0] == 0 and ratio[2] > 1 and abs(ratio[1]) < ratio[2]


def test_fold(spark):
    rows = spark.range(50).select("id", toxicity.fold(F.col("id")).alias("fold")).collect()
    assert all(r.fold == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_toxicity_of_the_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.detect(docs, labels)
    assert found.count() == docs.count() and found.where("score is null or score < 0 or score > 1").count() == 0
    rows = found.where("held_out").join(labels, "doc_id").select("score", "toxic").collect()
    bad, fine = ([r.score for r in rows if r.toxic == c] for c in (1, 0))
    auc = np.mean([(a > b) + (a == b) / 2 for a in bad for b in fine])
    assert auc > 0.9
    assert np.mean([s >= 0.5 for s in bad]) > 0.85 and np.mean([s < 0.5 for s in fine]) > 0.95


def test_labels_of_the_held_out_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted(map(tuple, toxicity.detect(docs, x).select("doc_id", "score").collect())) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_passages_of_odd_rows(spark, make_docs):
    draw = random.Random(8)
    plain = ["the", "of", "and", "house", "tree", "é", "2"]
    bad = [" ".join([*draw.choices(plain, k=30), "vile", "Scum!", *draw.choices(plain, k=30)]) for _ in range(120)]
    fine = [" ".join(draw.choices(plain, k=60)) for _ in range(240)]
    rows = list(enumerate(bad + fine))
    labels = spark.createDataFrame([(i, int(i < 120), "x") for i, _ in rows] + [(None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string")
    long = " ".join(["tree"] * 300_000 + ["vile", "scum"] + ["tree"] * 9)
    odd = [(900, None), (901, ""), (902, "... !"), (903, long), (904, "vile scum"), (None, "VILE scum"), (0, bad[0]), (0, bad[0])]
    frame = make_docs(*rows, *odd)
    found = toxicity.detect(frame, labels).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in found}
    for i in (900, 901, 902):
        assert (by_id[i].n_words, by_id[i].passages, by_id[i].predicted) == (0, [], 0)
    assert [(p.start, p.end) for p in by_id[903].passages] in ([], [(300_000, 300_002)])
    assert [(p.start, p.end) for p in by_id[904].passages] == [(0, 2)] and by_id[904].predicted == 1
    assert by_id[None].held_out is False and by_id[None].predicted == 1
    assert [(p.start, p.end) for p in by_id[0].passages] == [(30, 32)]
    judged = [(r.predicted, r.doc_id < 120) for r in found if r.doc_id is not None and r.doc_id < 360]
    assert np.mean([p == b for p, b in judged]) > 0.99


def test_toxicity_without_labels_or_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted, r.passages) for r in toxicity.detect(make_docs((1, "a b"), (2, None)), none).collect()] == [(0.5, 1, [])] * 2
    assert toxicity.detect(make_docs().limit(0), none).count() == 0
    one = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, toxic int")
    assert toxicity.detect(make_docs(*((i, "a b") for i in range(9))), one).where("predicted = 0").count() == 0


def test_the_sample_is_bounded_by_bytes(spark, make_docs):
    docs = make_docs(*((i, "word " * 100) for i in range(200)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    taken = toxicity._sample(docs, labels, "toxic", 30, 10_000).collect()
    assert sorted({r.toxic for r in taken}) == [0, 1]
    for c in (0, 1):
        assert sum(len(r.text) for r in taken if r.toxic == c) == 10_000 and sum(r.toxic == c for r in taken) <= 30
