"""What each of several filters removes, and what it takes from the others, in every order of applying them.

A document fails some set of the filters, its mask. All that an audit needs is how many documents,
good ones and toxic ones among them, each part of the table has of each mask: 2**k cells for k filters.
The survivors of every set of active filters then come from one walk over the sets in Gray-code order:
each step toggles one filter, keeps for each cell the number of active filters that its documents
fail, and adjusts the running survivors by the cells that enter or leave. The states of the walk are
stored, and a filter's step in any order is the difference of two of them.

Texts are measured where they are read and never shuffled: from there on a row is a digest and a few
numbers. Copies are found without bringing the rows of a text together: the least doc_id of a digest
is an aggregate, and the rows that hold it are taken out of the cells of the failing ones.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.text import let
from winnow.llm.shared import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Name of the filter that takes out copies of a text of a smaller doc_id.
COPIES = "E"
COUNTS = ("docs", "good", "toxic")
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def measures(text: Column) -> Column:
    """What the default filters look at, of a whole text; null is empty."""
    text = F.coalesce(text, F.lit(""))
    words = let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")),
    )
    return F.struct(
        words.alias("words"),
        F.size(F.regexp_extract_all(text, F.lit("[A-Z]"), F.lit(0))).alias("capitals"),
        F.char_length(text).alias("chars"),
        text.rlike("[#$%&*|]").alias("marked"),
    )


def default_filters(m: Column) -> dict[str, Column]:
    """Failure conditions over ``measures``, by name: short, repetitive, loud, marked up."""
    return {
        "A": m["words"]["n"] < 200,
        "B": F.lit(100).cast("long") * m["words"]["distinct"] < F.lit(50).cast("long") * m["words"]["n"],
        "C": F.lit(100).cast("long") * m["capitals"] > F.lit(2).cast("long") * m["chars"],
        "D": m["marked"],
    }


def cells(docs: DataFrame, labels: DataFrame, filters=default_filters, copies: str = COPIES) -> tuple[DataFrame, str]:
    """``(part, mask, docs, good, toxic)``, and the filters' names in the order of the mask's bits.

    ``part`` is the source, empty for null. A null text is an empty one. A row fails ``copies`` if a row
    of a smaller doc_id has its text; one without doc_id never does, nor is it smaller than any. Rows that
    share a doc_id all count, and share its labels: a doc_id is good (toxic) if any label says 1.
    """
    measured = docs.select(
        F.col("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), measures(F.col("text")).alias("m"),
    )
    conditions = filters(F.col("m"))
    bits = [F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(conditions.values())]
    mask = reduce(Column.__add__, bits, F.lit(0)).alias("mask")
    flags = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    narrow = measured.select("doc_id", "part", "digest", mask).join(flags, "doc_id", "left")
    flagged = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    kind = ["part", "mask", "good", "toxic"]
    rows = stored(
        narrow.select("doc_id", "digest", "part", "mask", *flagged).groupBy("doc_id", "digest", *kind).agg(F.count("*").alias("n"))
    )

    # One row a digest and part: hot texts are reduced where they lie. A text has one mask, a doc_id one set of labels.
    least = rows.where("doc_id is not null").groupBy("digest", "part").agg(
        F.min(F.struct("doc_id", "mask", "good", "toxic", "n")).alias("least")
    )
    of_text = least.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    first = least.join(of_text, "digest").where(F.col("least.doc_id") == F.col("first")).select("part", "least.*")
    passed = first.select(*kind, "n").unionByName(rows.where("doc_id is null").select(*kind, "n"))
    copied = F.col("mask") + F.lit(1 << len(conditions))
    parts = [
        rows.select(*kind, "n").withColumn("mask", copied),
        passed.withColumn("mask", copied).withColumn("n", -F.col("n")),
        passed,
    ]
    n = F.col("n")
    counted = reduce(DataFrame.unionByName, parts).groupBy("part", "mask").agg(
        F.sum(n).alias("docs"),
        F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
    )
    return counted, "".join([*conditions, copies])


def survivors(counts: np.ndarray) -> np.ndarray:
    """Sums of ``counts``, a row per mask, over the masks that no active filter hits: a row per set of active filters.

    Walks the sets in Gray-code order, one filter toggled at a time.
    """
    masks = np.arange(len(counts))
    failing = np.zeros(len(counts), np.int64)  # active filters that a cell's documents fail
    running, active = counts.sum(axis=0), 0
    out = np.zeros_like(counts)
    out[0] = running
    for i in range(1, len(counts)):
        bit = i & -i
        active ^= bit
        hit = masks & bit > 0
        if active & bit:
            running = running - counts[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            running = running + counts[hit & (failing == 0)].sum(axis=0)
        out[active] = running
    return out


def _steps(part: str, counts: np.ndarray, names: str) -> Mapping[str, list]:
    """All orders of the filters and what happens at each step, column by column."""
    state, masks = survivors(counts), np.arange(len(counts))
    failing = [int(counts[masks >> f & 1 == 1, 0].sum()) for f in range(len(names))]
    shapley = [0] * len(names)
    rows = []
    for order in permutations(range(len(names))):
        active, name = 0, "".join(names[f] for f in order)
        for step, f in enumerate(order, 1):
            after = active | 1 << f
            removed, good, toxic = (state[active] - state[after]).tolist()
            shapley[f] += removed
            rows.append((f, name, step, int(state[after, 0]), removed, failing[f] - removed, int(counts[1 << f, 0]), good, toxic))
            active = after
    filters, *columns = zip(*rows, strict=True)
    return dict(zip(_STEPS.names, [[part] * len(rows), *map(list, columns), [shapley[f] for f in filters]], strict=True))


_STEPS = pa.schema(
    [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
    + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
)


def audit(docs: DataFrame, labels: DataFrame, filters=default_filters, copies: str = COPIES) -> DataFrame:
    """A row per part, order of the filters and step; see ``cells`` for nulls, copies and repeated rows.

    ``kept`` documents are left after the step's filter, ``removed`` go there, ``redundant`` fail it but went
    before, ``unique_fails`` fail no other; ``good_lost`` and ``toxic_lost`` are labelled and go there;
    ``shapley`` is what the filter removes over all orders. An empty table has no parts and no rows.
    """
    counted, names = cells(docs, labels, filters, copies)

    def walk(table: pa.Table) -> pa.Table:
        counts = np.zeros((1 << len(names), len(COUNTS)), np.int64)
        counts[table["mask"].to_numpy()] = np.stack([table[c].to_numpy() for c in COUNTS], axis=1)
        return pa.table(_steps(table["part"][0].as_py(), counts, names), schema=_STEPS)

    # A group has 2**k rows at most.
    return counted.groupBy("part").applyInArrow(walk, STEPS)
