import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from winnow.llm import lengths, packing, pfor, tokens

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
PIECES = [
    "a", "b", " ", "  ", "\n", "\t", "\r\n", " \n", "'s", "don't", ".", "!", "22", "é", "é", "́",
    " 　", "\xa0", "\x1c", "\x85", "<|endoftext|>", "<", "ß", "İ", "Σ", "漢字",
    "\U0001f600", "||", "foo", "Bar,", "x).", "​", "\x00", "×.", "é.",
]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_encode_as_whole_texts(path):
    draw = random.Random(7)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 14))) for _ in range(5000)] + [None, ""]
    plain = Tokenizer.from_file(path)
    got = []
    for first, counts, ids in tokens.encoder(path).encode(pa.array(texts, pa.string())):
        assert first == len(got)
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("high", [1, 2, 50257, 2**32 - 1])
def test_blocks_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n, dtype=np.uint32)
    ids[::50] = 2**32 - 1  # exceptions
    assert np.array_equal(pfor.unpack(pfor.pack(ids)), ids)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_every_document_in_order(documents):
    plain, at, want = Tokenizer.from_file(BYTES), 0, []
    for r in documents.orderBy("doc_id").collect():
        ids = [*plain.encode(r.text, add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(map(tuple, pfor.round_trip(documents, BYTES, 2).collect())) == want


def test_files_of_odd_rows(make_docs):
    rows = pfor.round_trip(make_docs((3, None), (None, "a"), (3, ""), (1, "b c")), BYTES, 2).collect()
    found = sorted((r.start, r.doc_id, r.n_tokens) for r in rows)
    assert [(i, n) for _, i, n in found] == [(None, 2), (1, 3), (3, 1), (3, 1)]
    assert pfor.round_trip(make_docs(), BYTES, 2).count() == 0


def test_a_doc_id_of_a_third_of_rows_fills_many_shards(spark, tmp_path):
    n, kind = 3000, F.col("id") % 3
    doc_id = F.when(kind == 0, 700).when(kind == 1, 2000).otherwise(F.col("id"))
    text = F.when(kind == 1, "the same row").otherwise(F.concat(F.lit("row "), "id"))
    docs = spark.range(n).select(doc_id.alias("doc_id"), text.alias("text"))
    path = str(tmp_path / "hot")
    pfor.write(docs, path, BYTES, 2, shard_bytes=2000)
    held = spark.read.parquet(path).select("shard", F.explode("doc_ids").alias("doc_id"))
    assert {r.doc_id: r.n > 3 for r in held.where("doc_id in (700, 2000)").groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).collect()} == {700: True, 2000: True}
    rows = sorted((r.start, r.doc_id, r.n_tokens) for r in pfor.read(spark, path).collect())
    assert [i for _, i, _ in rows] == sorted(r.doc_id for r in docs.collect())
    assert all(a + k == b for (a, _, k), (b, _, _) in zip(rows, rows[1:], strict=False))
    plain = Tokenizer.from_file(BYTES)
    assert sum(k for _, _, k in rows) == sum(len(plain.encode(r.text).ids) + 1 for r in docs.collect())


def test_limits(documents, make_docs):
    plain = Tokenizer.from_file(BYTES)
    sizes = [len(plain.encode(r.text, add_special_tokens=False).ids) for r in documents.collect()]
    limits = lengths.by_limit(lengths.histogram(lengths.encoded_lengths(documents, BYTES))).cache()
    for r in limits.collect():
        limit = r.context_limit
        assert r.n_docs == sizes.count(limit)
        assert r.docs_within == sum(s <= limit for s in sizes) == len(sizes) - r.docs_over
        assert r.ids_within == sum(s for s in sizes if s <= limit) == sum(sizes) - r.ids_over
        assert r.ids_truncated == sum(min(s, limit) for s in sizes)
    assert lengths.quantile(limits, 0.5).first()[0] == sorted(sizes)[(len(sizes) + 1) // 2 - 1]
    assert tuple(lengths.at_limit(limits, 777).first()) == (sum(s <= 777 for s in sizes), sum(min(s, 777) for s in sizes))
    empty = lengths.by_limit(lengths.histogram(lengths.encoded_lengths(make_docs(), BYTES)))
    assert empty.count() == 0
    odd = lengths.encoded_lengths(make_docs((None, None), (1, ""), (1, "")), BYTES)
    assert lengths.by_limit(lengths.histogram(odd)).first().n_docs == 3


def check_packing(packed, docs, sequence):
    plain = Tokenizer.from_file(WORDS)
    rows = packed.collect()
    want = []
    for r in docs.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 0]
        want += [
            (r.doc_id, k, a, len(ids[a : a + sequence]), crc(ids[a : a + sequence]))
            for k, a in enumerate(range(0, len(ids), sequence))
        ]
    key = lambda x: (x[0] is not None, x)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= sequence
    return len(places), packing.lower_bound(np.array([w[3] for w in want], int), sequence)


def test_packing_is_whole_and_tight(documents):
    rows = packing.pieces(documents, WORDS, 0, 256)
    used, bound = check_packing(packing.pack(rows, 256, partition=60), documents, 256)
    assert bound <= used <= bound * 1.02 + 1


def test_rounds_go_on_until_none_saves_a_sequence(spark):
    """Pieces a little over a third or under a half waste much in small partitions: exchanges win it back."""
    rows = spark.range(0, 6000, 1, 8).selectExpr(
        "id as doc_id", "0 as piece", "0L as start", "cast(300 + xxhash64(id) % 280 as long) as length", "0L as ids_crc32"
    )
    rows = rows.withColumn("length", F.greatest("length", F.lit(1)).cast("long"))
    packed = packing.stored(packing.pack(rows, 1000, partition=40))
    used, bound = packing.certificate(packed, 1000)
    lengths_ = np.array([r.length for r in packed.select("length").collect()])
    assert bound == packing.lower_bound(lengths_, 1000) and bound <= used <= bound * 1.05
    ends = packed.groupBy("sequence_id").agg(F.sum("length").alias("sum"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert packed.count() == 6000 and ends.where("sum != end or end > 1000").count() == 0
    assert packing.certificate(packing.pack(rows.limit(0), 1000), 1000) == (0, 0)


def test_packing_odd_rows(make_docs):
    docs = make_docs((None, "a"), (1, None), (1, ""), (1, ""), (2, "a " * 511), (3, "a " * 512), (4, "a " * 2000))
    check_packing(packing.pack(packing.pieces(docs, WORDS, 0, 512), 512), docs, 512)
    assert packing.pack(packing.pieces(make_docs(), WORDS, 0)).count() == 0


def test_bounds_hold():
    draw = random.Random(3)
    for _ in range(200):
        sizes = np.array([draw.randint(1, 30) for _ in range(draw.randint(1, 40))])
        bins, offsets, n = packing.best_fit(sizes, 30)
        assert packing.lower_bound(sizes, 30) <= n == len(set(bins.tolist()))
        assert max(np.bincount(bins, weights=sizes)) <= 30
    assert packing.lower_bound(np.array([16] * 9), 30) == 9  # no two fit together


def test_no_column_of_the_result_is_missing(documents):
    assert packing.pack(packing.pieces(documents, WORDS, 0)).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ]
    assert documents.where(F.col("text").isNull()).count() == 0


def test_exceptions_are_packed_for_many_blocks_at_once():
    """A few calls a block, though each has exceptions; reading takes none for a block."""
    ids = np.random.default_rng(2).integers(0, 200, 128 * 400).astype(np.uint32)
    ids[::50] += 40_000

    def calls(f, *args):
        count = 0

        def seen(frame, event, arg):
            nonlocal count
            count += event in ("call", "c_call")

        sys.setprofile(seen)
        try:
            return f(*args), count
        finally:
            sys.setprofile(None)

    segment, packing = calls(pfor.pack, ids)
    found, reading = calls(pfor.unpack, segment)
    assert (found == ids).all() and packing < 4 * 400 and reading < 400
