"""Near duplicates by SimHash, found with BK-trees.

A fingerprint is 64 majority bits of the hashes of a text's shingles. Equal fingerprints are one node.
Nodes that differ in no more than ``radius`` bits share at least two of ``radius + 2`` blocks of bits,
so each node goes to one shard per pair of blocks, named by their values; a pair within the radius meets
in at least one shard. A shard shares 32 bits of 64 if the radius is 2. One that holds more than
``SHARD`` nodes all the same, as texts from one template may make it, is split by pairs of blocks of the
bits that its nodes need not share, in the same way, and a part that is still too large once more: such
a part shares 56 bits, so it has 256 nodes at most at any size of the corpus, and one that is not split has
``SHARD``. The distinct fingerprints of a shard form a BK-tree: a child hangs at
the edge of its Hamming distance to the parent, and a search follows only edges whose distance is within
the radius of its own. Links inside a shard are united there, so a shard sends at most one edge per
member, however dense it is.

Trees are not broadcast: all fingerprints would have to be. They are shuffled to their shards instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.components import components
from winnow.llm.shared import fresh, stored, texts_of

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Nodes of a shard that is searched as it is; larger ones are split.
SHARD = 1 << 13
#: How often nodes are dealt by pairs of blocks: all of them once, the parts that are too large again.
_LEVELS = 3
#: Shingle hashes that are unpacked to bits at once.
_STEP = 1 << 16
#: Stands for a missing doc_id, which comes after all others.
_LAST = (1 << 63) - 1


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text; 0 if it has no words. A null counts as empty."""
    words = (text or "").encode().lower().split()  # both know ASCII alone
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(64, np.int64)
    for low in range(0, n, _STEP):
        high = min(n, low + _STEP)
        hashes = np.array([digest(join(words[i : i + shingle]), SEED) for i in range(low, high)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints of a column of texts, as signed 64-bit integers."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint_of(t, shingle) for t in texts.to_pylist()], np.uint64)
        return pa.array(found.view(np.int64))

    return of.asNondeterministic()(text)


def _shard_keys(bits: Column, width: int, radius: int) -> tuple[Column, int]:
    """One key per pair of blocks of the ``width`` low bits: the pair's number, the values of its
    blocks, and the bits of the others put together; and how many those are, at most."""
    blocks = radius + 2
    edges = [width * i // blocks for i in range(blocks + 1)]
    widths = [b - a for a, b in zip(edges, edges[1:], strict=False)]

    def value(i: int) -> Column:
        return F.shiftrightunsigned(bits, edges[i]).bitwiseAND(F.lit((1 << widths[i]) - 1))

    keys, most = [], 0
    for p, pair in enumerate(combinations(range(blocks), 2)):
        rest, used = F.lit(0).cast("long"), 0
        for k in range(blocks):
            if k not in pair:
                rest, used = rest.bitwiseOR(F.shiftleft(value(k), used)), used + widths[k]
        one, two = (value(i).alias(name) for i, name in zip(pair, ("one", "two"), strict=True))
        keys.append(F.struct(F.lit(p).alias("pair"), one, two, rest.alias("rest")))
        most = max(most, used)
    return F.array(*keys), most


class BKTree:
    """Fingerprints by Hamming distance: ``children[node]`` maps a distance to the child there."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Nodes within the radius: only edges within it of the distance to their parent are followed."""
        found, left = [], [0] if self.values else []
        while left:
            node = left.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            edges = self.children[node]
            if len(edges) > 2 * radius:
                left += [
                    edges[d] for d in range(distance - radius, distance + radius + 1) if d in edges
                ]
            else:
                left += [c for d, c in edges.items() if -radius <= d - distance <= radius]
        return found

    def add(self, value: int) -> int:
        """Hang a value that is not in the tree yet below the last node on its path."""
        self.values.append(value)
        self.children.append({})
        new, node = len(self.values) - 1, 0
        while new:
            distance = (self.values[node] ^ value).bit_count()
            child = self.children[node].get(distance)
            if child is None:
                self.children[node][distance] = new
                break
            node = child
        return new


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Edges that unite the linked among distinct values: from each one to the least of its group."""
    tree, group = BKTree(), list(range(len(values)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for value in values:
        near = tree.near(value, radius)
        new = tree.add(value)
        for node in near:
            a, b = root(node), root(new)
            group[max(a, b)] = min(a, b)
    return [(values[i], values[root(i)]) for i in range(len(values)) if root(i) != i]


def links(nodes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` of ``nodes`` within the radius of each other.

    Shards of more than ``shard`` nodes are split, which changes the edges but not what they connect.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        key = None

        def edges(of: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*of, strict=True) if of else ((), ())
            both = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)]
            return pa.RecordBatch.from_arrays(both, names=["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            keys, fps = batch["key"].to_numpy(), batch["fp"].to_numpy().view(np.uint64)
            changes = np.ones(len(batch), bool)
            changes[1:] = keys[1:] != keys[:-1]
            changes[0] = keys[0] != key
            starts = np.flatnonzero(changes)
            out: list[tuple[int, int]] = []
            if not len(starts):
                held += fps.tolist()
                continue
            held += fps[: starts[0]].tolist()
            if len(held) > 1:
                out += shard_links(held, radius)
            ends = np.append(starts[1:], len(fps))
            inner = (ends - starts)[:-1] > 1
            for a, b in zip(starts[:-1][inner].tolist(), ends[:-1][inner].tolist(), strict=True):
                out += shard_links(fps[a:b].tolist(), radius)
            held, key = fps[starts[-1] :].tolist(), keys[-1]
            yield edges(out)
        if len(held) > 1:
            yield edges(shard_links(held, radius))

    # A shard is named by a hash of all that its nodes share. Should two names coincide, their nodes are
    # searched together, and every distance is worked out, so nothing is linked that should not be.
    rows = nodes.select("fp", F.col("fp").alias("rest"), F.lit(0).cast("long").alias("key"), F.lit(True).alias("split"))
    width = 64
    for level in range(_LEVELS):
        parts, left = _shard_keys(F.col("rest"), width, radius)
        parts = F.transform(
            parts,
            lambda k: F.struct(
                F.xxhash64(F.col("key"), k["pair"], k["one"], k["two"]).alias("key"),
                k["rest"].cast("long").alias("rest"),
                F.lit(True).alias("split"),
            ),
        )
        if level:
            sizes = rows.where("split").groupBy("key").agg(F.count("*").alias("n"))
            large = stored(sizes.where(F.col("n") > shard).select("key", F.lit(True).alias("large")))
            whole = F.array(F.struct(F.col("key"), F.col("rest"), F.lit(False).alias("split")))
            rows = rows.join(large, "key", "left")
            parts = F.when(F.col("large") & F.col("split"), parts).otherwise(whole)
        rows = rows.select("fp", F.explode(parts).alias("part")).select("fp", "part.*")
        width = left
    dealt = rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Every row of ``docs`` as doc_id, fp and component_id.

    ``docs`` has doc_id and text; other columns are ignored. Fingerprints of ``radius`` or fewer
    differing bits are linked; component_id is the least doc_id that can be reached over links, the
    row's own included. Texts without words, null ones too, have fingerprint 0 and are linked like any
    other. Rows without a doc_id take part; a component of such rows alone has a null component_id.
    """
    rows = stored(texts_of(docs).select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")))
    named = _labelled(rows, radius).select(
        "fp", F.nullif("least", F.lit(_LAST)).alias("component_id")
    )
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _labelled(rows: DataFrame, radius: int) -> DataFrame:
    """fp, label (of its component), least (doc_id of the component) of each distinct fingerprint."""
    least = F.min(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).alias("least")
    nodes = stored(rows.groupBy("fp").agg(least))
    groups = components(links(nodes, radius)).select(F.col("node").alias("fp"), "label")
    named = stored(nodes.join(groups, "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    names = named.groupBy("label").agg(F.min("least").alias("least"))
    return named.select("fp", "label").join(names, "label")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of its least doc_id.

    All columns are kept. If several rows have that doc_id, or no row has one, the one that is stored
    first stays. Decisions are made on narrow rows; the texts are shuffled once, to apply them.
    """
    fp, row = fresh(docs, "fp", "row")
    marked = texts_of(docs).withColumn(fp, fingerprint(F.col("text"), shingle))
    marked = stored(marked.withColumn(row, F.monotonically_increasing_id()))
    narrow = marked.select(
        F.col(row).alias("row"), F.col(fp).alias("fp"), F.col("doc_id").cast("long").alias("doc_id")
    )
    groups = _labelled(narrow, radius)
    mine = F.coalesce("doc_id", F.lit(_LAST))
    first = narrow.join(groups, "fp").where(mine == F.col("least"))
    first = first.groupBy("label").agg(F.min("row").alias(row))
    return marked.join(first.select(row), row, "left_semi").select(*docs.columns)
