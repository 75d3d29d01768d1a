"""Very long texts, long words and hot keys: linear time, right results."""

import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from winnow.llm import secrets

KEYS = string.ascii_letters + string.digits + "+/"


def test_a_long_candidate_takes_linear_time(spark, make_docs):
    draw = random.Random(1)

    def seconds(n):
        docs = make_docs((1, "data:image/png;base64," + "".join(draw.choices(KEYS, k=n)) + " end"))
        start = time.perf_counter()
        (row,) = secrets.find_secrets(docs).collect()
        assert [(s.start, s.end) for s in row.random] == [(22, 22 + n)]
        return time.perf_counter() - start

    seconds(100)
    assert seconds(1_000_000) < seconds(10_000) + 25


def test_many_matches_take_linear_time(spark, make_docs):
    draw = random.Random(2)
    key = lambda n: "".join(draw.choices(KEYS, k=n))
    docs = make_docs((1, " ".join(f"token={key(28)} {key(30)}" for _ in range(20_000))))
    start = time.perf_counter()
    (row,) = secrets.find_secrets(docs).collect()
    assert len(row.base) == 20_000 and len(row.random) > 19_000
    assert all(b.start % 66 == 0 and b.end == b.start + 34 for b in row.base)
    assert time.perf_counter() - start < 40


def test_candidates_clear_of_spans(spark):
    draw = random.Random(3)
    rows = []
    for i in range(60):
        spans = sorted((a := draw.randrange(60), a + draw.randrange(1, 12)) for _ in range(draw.randrange(9)))
        at, candidates = 0, []
        for _ in range(draw.randrange(9)):
            at += draw.randrange(1, 6)
            candidates.append((at, at := at + draw.randrange(1, 6)))
        rows.append((i, [tuple(s) for s in candidates], spans))
    span = "array<struct<start: long, end: long>>"
    frame = spark.createDataFrame(rows, f"i int, candidates {span}, base {span}")
    found = frame.select("i", secrets._clear_of(F.col("candidates"), F.col("base")).alias("clear")).collect()
    for r in found:
        _, candidates, spans = rows[r.i]
        want = [c for c in candidates if not any(s[0] < c[1] and c[0] < s[1] for s in spans)]
        assert [tuple(c) for c in r.clear] == want


def twins(head="x", tail="y"):
    """Two long words whose sums of powers modulo 2**64 are equal for every odd base."""
    bits = [0]
    while len(bits) < 2048:
        bits += [1 - b for b in bits]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    return (f"{head * 8}{w}{tail * 8}" for w in (one, two))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_long_pieces_that_sums_of_powers_confuse(name):
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    from winnow.llm.tokens import encoder

    path, texts = public_tokenizers.path(name), list(twins())
    whole = Tokenizer.from_file(path)
    for batch in (texts, texts[::-1], [" ".join(texts)]):
        got = [(int(n), i.tolist()) for _, counts, i in encoder(path).encode(pa.array(batch)) for n in counts]
        ids = [whole.encode(t, add_special_tokens=False).ids for t in batch]
        assert [n for n, _ in got] == [len(i) for i in ids] and got[0][1] == sum(ids, [])


def test_windows_that_sums_of_powers_confuse(make_docs):
    from winnow.llm import substring

    one, two = twins()
    same = " ".join(f"w{i}" for i in range(12))
    docs = make_docs((1, f"{one} {same}"), (2, f"{two} {same}"), (3, f"{one} {same} more"))
    found = {r.doc_id: (r.n_words, r.n_removed) for r in substring.repeated_passages(docs).collect()}
    assert found == {1: (13, 0), 2: (13, 0), 3: (14, 13)}


def test_long_words_are_told_apart():
    import numpy as np

    from winnow.llm.arrays import white_space_words, words_of

    data = np.frombuffer(" ".join(twins()).encode(), np.uint8)
    words = words_of(np.array([0, len(data)]), data, white_space_words())
    assert len(set(words.hash.tolist())) == 2
