"""Importance weights and the draw against plain versions."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from winnow.llm import quality
from winnow.llm.arrays import blocks


def plain_weights(texts, good):
    """Log weights by counting every n-gram of every text in dictionaries."""
    grams = []
    for text in texts:
        ((_, offsets, data),) = blocks(pa.array([text], pa.string()))
        grams.append([code.tolist() for _, code in quality._grams(offsets, data)])
    out = np.zeros(len(texts))
    for part in (0, 1):
        bits = quality.key_bits(len({c for g in grams for c in g[part]}))
        own = [Counter(c >> (64 - bits) for c in g[part]) for g in grams]
        raw, target = Counter(), Counter()
        for i, c in enumerate(own):
            raw.update(c)
            if i in good:
                target.update(c)
        for i, c in enumerate(own):
            all_raw = raw.total() - c.total()
            all_target = target.total() - c.total() * (i in good)
            for key, n in c.items():
                t, r = target[key] - n * (i in good), raw[key] - n
                weight = math.log((t + 1) / (r * all_target / max(all_raw, 1) + 1))
                out[i] += n * min(max(weight, -quality.CLIP), quality.CLIP)
    return out


@pytest.mark.parametrize("chunk_bytes, bucket_keys", [(quality.CHUNK_BYTES, quality.BUCKET_KEYS), (1 << 10, 50)])
def test_weights(spark, make_docs, chunk_bytes, bucket_keys):
    """In one chunk and one bucket, and in many of either; rows repeat, a third of them are one text."""
    draw = random.Random(11)
    words = ["Alpha", "beta,", "GAMMA!", "delta", "é", "x1", "...", "漢字", "w" * 30]
    texts = [" ".join(draw.choices(words[i % 3 * 2 :], k=draw.randrange(1, 40))) for i in range(80)] + ["the same text again"] * 40
    good = set(range(0, 120, 3))
    docs = make_docs(*enumerate(texts)).repartition(5)
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(120)], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.weigh(docs, labels, chunk_bytes=chunk_bytes, bucket_keys=bucket_keys).collect()}
    want = plain_weights(texts, good)
    assert len(found) == 120
    for i in range(120):
        assert found[i].log_weight == pytest.approx(want[i], abs=1e-6)
    # As many rows stay as weigh no less than the cut, those with the greatest keys.
    kept = [r for r in found.values() if r.keep]
    cut = quality._best_cut([(found[i].log_weight, i in good) for i in range(120)])
    assert 0 < len(kept) == sum(r.log_weight >= cut for r in found.values())
    assert min(r.gumbel_key for r in kept) >= max((r.gumbel_key for r in found.values() if not r.keep), default=-math.inf)
    noise = np.array([r.gumbel_key - r.log_weight for r in found.values()])
    assert abs(noise.mean() - 0.5772) < 0.5 and 0.9 < noise.std() < 1.7


def test_rows_of_one_labelled_id(spark, make_docs):
    """A third of the rows share a labelled id: they count as one label."""
    docs = make_docs(*[(7, f"GOOD words here {i}") for i in range(300)], *[(100 + i, f"plain words {i % 7}") for i in range(600)])
    labels = spark.createDataFrame([(7, 1)] + [(100 + i, i % 2) for i in range(40)], "doc_id long, quality int")
    found = quality.resample(docs, labels, chunk_bytes=1 << 12)
    assert found.columns == docs.columns and found.count() <= 900
    ids = quality.labelled_ids(labels)
    rows = quality._scored(docs, ids[1], ["doc_id"], 1 << 12, 1000)
    assert rows.count() == 900 and isinstance(quality._cut(rows, rows.columns[-1], ids), float)


def test_a_chunk_is_weighed_in_stretches(monkeypatch):
    """The same weights whatever the stretch, and far less memory than all keys at once take."""
    draw = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 30_000, 2_500)) for _ in range(400)]
    rows = pa.table({quality._ID: pa.array(range(400), pa.int64()), quality._TEXT: texts})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    packed = pa.table({"chunk": pa.array([0], pa.int64()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
    good, bits = np.arange(0, 400, 3), [24, 20]
    told = quality._tell(quality._send(packed, bits, good, 0).slice(0, 1))

    def weighed(stretch):
        monkeypatch.setattr(quality, "STRETCH", stretch, raising=False)
        tracemalloc.start()
        try:
            return quality._weigh(rows, told, bits, [(10**6, 10**5)] * 2, good, 0).tolist(), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    (all_at_once, whole), (few, least) = weighed(1 << 30), weighed(1_000)
    assert few == all_at_once and len(set(few)) > 300
    assert least < 0.9 * whole, (least, whole)
