"""Word lists of the configuration applied to rows: as columns, without a join or a shuffle, or, for
vocabularies of any size, as a table that texts are joined to."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow import defaults
from winnow.functions.text import contains_any, let, skill_hits
from winnow.sources.tables import stored


def skill_tags(
    rows: DataFrame, text: str, groups: Mapping[str, Iterable[str]] = defaults.SKILL_GROUPS
) -> DataFrame:
    """A row per input row and group with a hit: its columns but ``text``, ``group``, ``skills``."""
    rest = [c for c in rows.columns if c != text]
    found = F.array(
        *[
            F.struct(F.lit(g).alias("group"), hits.alias("skills"))
            for g, hits in skill_hits(F.col(text), groups).items()
        ]
    )
    return (
        rows.select(*rest, F.filter(found, lambda f: F.size(f["skills"]) > 0).alias("found"))
        .select(*rest, F.explode_outer("found").alias("f"))
        .where(F.col("f").isNotNull())
        .select(*rest, "f.group", "f.skills")
    )


def role_rules(
    rows: DataFrame,
    title: str,
    include: Iterable[str] = defaults.ROLES_INCLUDE,
    soft_exclude: Iterable[str] = defaults.ROLES_SOFT_EXCLUDE,
) -> DataFrame:
    """Flags ``role_included`` and ``role_soft_excluded``; case does not matter."""

    def listed(words):
        return contains_any(F.col(title), words, any_case=True)

    return rows.withColumn("role_included", listed(include)).withColumn(
        "role_soft_excluded", listed(soft_exclude)
    )


#: Terms of so many bytes in all, at most, are sent to every task; a term has its text twice and some more.
SENT_BYTES, TERM_BYTES = 1 << 20, 100

_RUN = r"[\p{L}\p{N}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def term_table(spark: SparkSession, groups: Mapping[str, Iterable[str]] = defaults.SKILL_GROUPS) -> DataFrame:
    """``(group, term)`` of a list of terms."""
    return spark.createDataFrame([(g, t) for g, terms in groups.items() for t in terms], "group string, term string")


def _cut(text: Column) -> Column:
    """``struct(runs, gaps)``: maximal runs of letters and digits, and what lies before, between and behind them."""
    return let(
        F.translate(text, _UPPER, _LOWER),
        lambda t: F.struct(F.regexp_extract_all(t, F.lit(_RUN), F.lit(0)).alias("runs"), F.split(t, _RUN, -1).alias("gaps")),
    )


def _span(cut: Column, start: Column, n: Column) -> Column:
    """The text from the ``start``-th run on over ``n`` runs."""
    rest = F.zip_with(
        F.slice(cut["gaps"], start + 2, n - 1), F.slice(cut["runs"], start + 2, n - 1), lambda gap, run: F.concat(gap, run)
    )
    return F.concat(F.get(cut["runs"], start), F.array_join(rest, ""))


def _prepared(terms: DataFrame) -> DataFrame:
    """Terms by what stands between their first and last letter or digit, and the marks on either side of that.

    Those of marks alone have no such part: they are found within runs of marks. Terms that come more than
    once are cut once: a distinct behind the cut would make the optimizer drop the one before it.
    """
    own = terms.where(F.col("term") != "").select("group", "term").distinct().withColumn("cut", _cut(F.col("term")))
    n = F.size("cut.runs")
    core = F.when(n > 0, _span(F.col("cut"), F.lit(0), n)).otherwise(F.get("cut.gaps", F.lit(0)))
    return own.select(
        "group", "term", core.alias("core"), n.alias("n"),
        F.when(n > 0, F.get("cut.gaps", F.lit(0))).otherwise("").alias("head"),
        F.when(n > 0, F.element_at("cut.gaps", -1)).otherwise("").alias("tail"),
    )


def _places(cut: Column, counts: list[int], marks: list[int], heads: int, tails: int) -> Column:
    """All that may be a term: spans of as many runs as some term has, and as many marks in a row.

    Each with the marks on either side, as many as the longest ``heads`` and ``tails`` of terms and one more
    tell apart, and whether the text begins, or ends, there; where no term looks at a side, it says nothing. Each
    comes once a text: sorted, so n log n.
    """
    size = F.size(cut["runs"])
    before, after = (lambda gap: F.right(gap, F.lit(heads + 1))), (lambda gap: F.left(gap, F.lit(tails + 1)))

    def spans(n: int) -> Column:
        starts = F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts,
            lambda i: F.struct(
                _span(cut, i, F.lit(n)).alias("core") if n > 1 else F.get(cut["runs"], i).alias("core"),
                (before(F.get(cut["gaps"], i)) if heads else F.lit("")).alias("before"),
                (after(F.get(cut["gaps"], i + n)) if tails else F.lit("")).alias("after"),
                ((i == 0) if heads else F.lit(False)).alias("opens"), ((i + n == size) if tails else F.lit(False)).alias("closes"),
                F.lit(n).alias("n"),
            ),
        )

    def of_marks(length: int) -> Column:
        def within(gap: Column, i: Column) -> Column:
            fits = F.length(gap) >= length
            starts = F.when(fits, F.sequence(F.lit(1), F.length(gap) - (length - 1))).otherwise(F.array().cast("array<int>"))
            return F.transform(
                starts,
                lambda at: F.struct(
                    F.substring(gap, at, F.lit(length)).alias("core"),
                    before(F.substring(gap, F.lit(1), at - 1)).alias("before"),
                    F.substring(gap, at + length, F.lit(tails + 1)).alias("after"),
                    (i == 0).alias("opens"), (i == size).alias("closes"), F.lit(0).alias("n"),
                ),
            )

        return F.flatten(F.transform(cut["gaps"], within))

    if counts == [1] and not (marks or heads or tails):  # plain words: told apart by a hash
        nothing = (F.lit("").alias("before"), F.lit("").alias("after"), F.lit(False).alias("opens"), F.lit(False).alias("closes"))
        return F.transform(F.array_distinct(cut["runs"]), lambda run: F.struct(run.alias("core"), *nothing, F.lit(1).alias("n")))
    found = [spans(n) for n in counts] + [of_marks(length) for length in marks]
    return let(
        F.sort_array(F.concat(*found)), lambda all_: F.filter(all_, lambda x, i: (i == 0) | (F.get(all_, i - 1) != x))
    )


def skill_tags_joined(rows: DataFrame, key: Iterable[str], text: str, terms: DataFrame) -> DataFrame:
    """``(*key, group, skills)``: the terms of each group in a row's text, sorted, where there are any.

    The same hits as ``skill_tags`` gives, for a table ``(group, term)`` of any size: a text is cut once into
    spans of as many words as some term has, spans are joined to terms by what they say, and the marks on
    either side are compared. Only spans and keys are shuffled, and where the terms are few (``SENT_BYTES``) they
    are broadcast instead. ``key`` names the columns that tell rows apart; rows that share one, null or
    not, count as one text. Null and empty texts have no spans, null and empty terms match none.
    """
    key = list(key)
    prepared = stored(_prepared(terms))
    # As many rows as there are lengths of terms.
    sizes = (
        prepared.groupBy("n", F.when(F.col("n") == 0, F.length("core")).alias("marks"))
        .agg(F.max(F.length("head")).alias("head"), F.max(F.length("tail")).alias("tail"), F.sum(F.octet_length("term")).alias("size"), F.count("*").alias("terms"))
        .collect()
    )
    counts = sorted({r.n for r in sizes if r.n})
    marks = sorted({r.marks for r in sizes if not r.n})
    heads, tails = max([r["head"] for r in sizes], default=0), max([r["tail"] for r in sizes], default=0)
    kept = [F.col(c).alias(f"key{i}") for i, c in enumerate(key)]
    if not counts and not marks:
        none = rows.limit(0).select(*kept, F.lit("").alias("group"), F.array().cast("array<string>").alias("skills"))
        return none.select(*[F.col(f"key{i}").alias(c) for i, c in enumerate(key)], "group", "skills")
    cut = rows.where(F.col(text) != "").select(*kept, _cut(F.col(text)).alias("cut"))
    spans = cut.select(*[f"key{i}" for i in range(len(key))], F.explode_outer(_places(F.col("cut"), counts, marks, heads, tails)).alias("p"))
    # Outer, as the plain form makes the optimizer put all places together twice.
    spans = spans.where("p is not null")
    # No letter or digit may touch the term: there is a mark more beside it, or the text ends there.
    head = (F.col("head") == "") & (F.col("n") > 0) | F.endswith("p.before", F.col("head")) & (
        (F.length("p.before") > F.length("head")) | F.col("p.opens")
    )
    tail = (F.col("tail") == "") & (F.col("n") > 0) | F.startswith("p.after", F.col("tail")) & (
        (F.length("p.after") > F.length("tail")) | F.col("p.closes")
    )
    # Spans are far larger than the table they come from lets Spark guess, so it must not choose to broadcast them.
    few = sum(2 * r["size"] + TERM_BYTES * r["terms"] for r in sizes) <= SENT_BYTES
    hits = spans.join(prepared.hint("broadcast" if few else "merge"), (F.col("p.core") == F.col("core")) & (F.col("p.n") == F.col("n"))).where(head & tail)
    found = hits.groupBy(*[f"key{i}" for i in range(len(key))], "group").agg(F.array_sort(F.collect_set("term")).alias("skills"))
    return found.select(*[F.col(f"key{i}").alias(c) for i, c in enumerate(key)], "group", "skills")
