"""Secrets in texts, with DataFrame functions alone.

Three kinds have a form of their own: ``assign`` (a value after a key word), ``access`` (key ids) and
``hex`` (long runs of hexadecimal digits). Beyond those, every run of 20 or more characters that keys
are made of is a candidate, and a battery of randomness tests tells keys from names and prose:

- its encoding is inferred, the smallest alphabet that holds it: digits, hex in either case, small letters,
  base32, letters and digits, base64;
- chi-squared of its characters against the uniform distribution over that alphabet;
- the number of runs of symbols above and below the middle of the alphabet (Wald-Wolfowitz);
- the serial correlation of neighbouring symbols.

The last two must not refute randomness. The first gives a p-value under the hypothesis that the
candidate is written like text, whose characters collide more often: the chi-squared of text grows with
the length, so a long candidate is judged more sharply than a short one. Candidates are grouped by
encoding and length, and in each group the false discoveries are held at a rate by the step-up
procedure of Benjamini and Hochberg, over counts of binned p-values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from winnow.functions.text import let
from winnow.llm.shared import stored

#: The kinds with a form of their own: pattern, the group whose length counts, and its least length.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (
    ("assign", ASSIGN, 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)
#: What a text must hold to be looked at for a kind; quick to test.
_QUICK = {
    "assign": "(?i:passw|secret|token|api_?key)",
    "access": "AKIA",
    "hex": "[0-9a-f]{24}",
    "random": "[A-Za-z0-9+/_=-]{20}",
}
CANDIDATE, LEAST = "[A-Za-z0-9+/_=-]+", 20
#: name, alphabet, share of pairs of characters that are equal in text written in it.
ENCODINGS = (
    ("digits", "0123456789", 0.2),
    ("hex", "0123456789abcdef", 0.125),
    ("upper_hex", "0123456789ABCDEF", 0.125),
    ("lower", "abcdefghijklmnopqrstuvwxyz", 0.065),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.065),
    ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 0.055),
    ("base64", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_=", 0.055),
)
#: Rate of false discoveries; level of the tests that must not refute randomness.
RATE, LEVEL = 0.05, 0.001
#: p-values are counted in bins of a tenth of a power of ten, down to this many.
_BINS = 200

_SPAN = "struct<start: long, end: long, valid: boolean, value: string>"


def _normal(z: Column) -> Column:
    """The normal distribution function, to about two parts in ten thousand."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-1.5976) * z - F.lit(0.07056) * z * z * z))


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or other combinations) of an array, doubling the reach each round: n log n."""

    def widen(at: Column, k: Column) -> Column:
        reach = F.pow(F.lit(2), k).cast("int")
        return F.transform(at, lambda x, i: F.when(i >= reach, combine(x, F.get(at, i - reach))).otherwise(x))

    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size(values)))), values, widen)


def _matches(text: Column, pattern: str, group: int, least: int, quick: str) -> Column:
    """Leftmost matches that do not overlap: start, end in code points, whether long enough, value.

    What lies between matches is what splitting at them leaves, so lengths alone give the places.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), values.alias("value"))
    # The last gap has no match after it.
    sized = F.transform(
        F.filter(rows, lambda r: r["hit"].isNotNull()),
        lambda r: F.struct(
            F.length(r["gap"]).cast("long").alias("gap"), F.length(r["hit"]).cast("long").alias("hit"), r["value"].alias("value")
        ),
    )

    def placed(sized: Column) -> Column:
        steps = F.transform(sized, lambda r: r["gap"] + r["hit"])
        spans = let(
            _running(steps, lambda x, y: x + y),
            lambda ends: F.transform(
                sized,
                lambda r, i: F.struct(
                    (F.get(ends, i) - r["hit"]).alias("start"), F.get(ends, i).alias("end"),
                    (F.length(r["value"]) >= least).alias("valid"), r["value"].alias("value"),
                ),
            ),
        )
        return F.filter(spans, lambda s: s["valid"])

    none = F.array().cast(f"array<{_SPAN}>")
    found = let(sized, placed).cast(f"array<{_SPAN}>")
    return F.when(F.coalesce(text.rlike(quick), F.lit(False)), found).otherwise(none)


def _clear_of(candidates: Column, base: Column) -> Column:
    """The candidates that overlap no span of ``base``, which is in the order of starts.

    A candidate overlaps one if, of the spans that start before its end, the greatest end lies behind its
    start; how many start there is found by bisection.
    """

    def clear(reach: Column) -> Column:
        def before(end: Column) -> Column:
            def halve(n: Column, k: Column) -> Column:
                more = n + F.pow(F.lit(2), k).cast("int")
                return F.when((more <= F.size(base)) & (F.get(base, more - 1)["start"] < end), more).otherwise(n)

            return F.aggregate(F.sequence(F.length(F.bin(F.size(base))), F.lit(0), F.lit(-1)), F.lit(0), halve)

        return F.filter(candidates, lambda c: F.coalesce(F.get(reach, before(c["end"]) - 1) <= c["start"], F.lit(True)))

    ends = F.transform(base, lambda b: b["end"])
    return F.when(F.size(base) == 0, candidates).otherwise(let(_running(ends, F.greatest), clear))


def _statistics(value: Column) -> Column:
    """Encoding, length, p-value of being text, and whether runs or serial correlation refute chance.

    Each step takes the values of the last one, worked out once for the candidate and not for each of its characters.
    """
    encoding = None
    for label, letters, share in (*ENCODINGS, ("none", "", 0.0)):
        found = F.struct(
            F.lit(label).alias("name"), F.lit(letters).alias("letters"), F.lit(float(len(letters))).alias("size"), F.lit(share).alias("equal")
        )
        if not letters:
            encoding = encoding.otherwise(found)
            continue
        inside = value.rlike(f"^[{letters.replace('-', '')}{'-' * ('-' in letters)}]+$")
        encoding = F.when(inside, found) if encoding is None else encoding.when(inside, found)
    zero = F.lit(0.0)
    start = F.struct(
        F.lit(True).alias("first"), zero.alias("high"), zero.alias("d"), zero.alias("runs"),
        zero.alias("highs"), zero.alias("cross"), zero.alias("power"),
    )

    def counted(of: Column) -> Column:
        """The codes of the characters, their mean and the sum of the squares of their counts."""
        squares = F.aggregate(
            F.array_distinct(of["chars"]),
            F.lit(0.0),
            lambda s, c: s + F.pow(of["n"] - F.length(F.replace(value, c, F.lit(""))), F.lit(2.0)),
        )
        codes = F.transform(of["chars"], lambda c: F.instr(of["encoding"]["letters"], c).cast("double"))
        return let(
            F.struct(codes.alias("codes"), squares.alias("squares")),
            lambda w: let(F.aggregate(w["codes"], F.lit(0.0), lambda s, c: s + c) / of["n"], lambda middle: judged(of, w, middle)),
        )

    def judged(of: Column, w: Column, middle: Column) -> Column:
        n, size, equal = of["n"], of["encoding"]["size"], of["encoding"]["equal"]
        chi = w["squares"] * size / n - n
        # Text: non-central, each symbol as often as the share of equal pairs says.
        extra = size * equal - 1
        mean = size * (1 + (n - 1) * equal) - n
        sd = F.sqrt(2 * (size - 1) + 4 * n * F.greatest(extra, F.lit(0.1)))

        def walk(state: Column, c: Column) -> Column:
            high = (c > middle).cast("double")
            d = c - middle
            return F.struct(
                F.lit(False).alias("first"), high.alias("high"), d.alias("d"),
                (state["runs"] + F.when(state["first"] | (state["high"] != high), 1.0).otherwise(0.0)).alias("runs"),
                (state["highs"] + high).alias("highs"),
                (state["cross"] + F.when(state["first"], 0.0).otherwise(state["d"] * d)).alias("cross"),
                (state["power"] + d * d).alias("power"),
            )

        def refuted(s: Column) -> Column:
            a, b = s["highs"], n - s["highs"]
            expected = 2 * a * b / n + 1
            spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
            runs = F.abs(s["runs"] - expected) / spread
            serial = F.when(s["power"] > 0, F.abs(s["cross"] / s["power"]) * F.sqrt(n)).otherwise(F.lit(99.0))
            # Two tests, each on both sides.
            return 4 * _normal(-F.greatest(runs, serial)) < F.lit(LEVEL)

        return F.struct(
            of["encoding"]["name"].alias("encoding"), _normal((chi - mean) / sd).alias("p"),
            (~F.aggregate(w["codes"], start, walk, refuted)).alias("chance"),
        )

    of = F.struct(F.split(value, "").alias("chars"), F.length(value).cast("double").alias("n"), encoding.alias("encoding"))
    return let(of, counted)


def _length_class(length: Column) -> Column:
    """Lengths in steps of half a power of two, up to 2**10."""
    return F.least(F.floor(F.log2(length.cast("double")) * 2), F.lit(20)).cast("int")


def _bin(p: Column) -> Column:
    return F.least(F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-30)))), F.lit(_BINS)).cast("int")


def _named(rank: int, kind: str):
    """A span as a struct that sorts by start, then by the order of the kinds."""

    def name(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")
        )

    return name


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Every row of ``docs`` as doc_id, base and random: arrays of (kind, start, end).

    ``docs`` has doc_id and text; other columns are ignored. Places are code points, ends exclusive.
    ``base`` is in the order of start, then of kind. ``random`` holds candidates the battery finds, but
    for those that overlap one of ``base``. A null or empty text has none; repeated rows stay.
    """
    text = F.col("text")
    none = F.array().cast("array<struct<start: long, rank: int, kind: string, end: long>>")
    spans = [
        F.transform(
            _matches(text, pattern, group, least, _QUICK[kind]),
            _named(rank, kind),
        )
        for rank, (kind, pattern, group, least) in enumerate(BASE)
    ]
    base = F.sort_array(F.concat(none, *spans))
    candidates = _matches(text, CANDIDATE, 0, LEAST, _QUICK["random"])
    rows = docs.select("doc_id", base.alias("base"), candidates.alias("candidates"))
    judged = F.transform(
        _clear_of(F.col("candidates"), F.col("base")),
        lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"),
            (c["end"] - c["start"]).alias("length"), _statistics(c["value"]).alias("test"),
        ),
    )
    rows = stored(rows.select("doc_id", "base", judged.alias("candidates")))
    limits = discoveries(rows.select(F.explode("candidates").alias("c")), rate)

    def found(c: Column) -> Column:
        group = F.concat_ws("/", c["test"]["encoding"], _length_class(c["length"]).cast("string"))
        least = F.element_at(F.map_from_arrays(*map(F.lit, map(list, zip(*limits.items(), strict=True)))), group)
        return F.coalesce(c["test"]["chance"] & (_bin(c["test"]["p"]) >= least), F.lit(False))

    kept = F.filter("candidates", found) if limits else F.filter("candidates", lambda c: F.lit(False))
    random = F.transform(kept, lambda c: F.struct(F.lit("random").alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    plain = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    return rows.select("doc_id", plain.alias("base"), random.alias("random"))


def discoveries(candidates: DataFrame, rate: float = RATE) -> dict[str, int]:
    """The least bin of p-values that is a discovery, for each group of encoding and length with one.

    Benjamini and Hochberg: the largest p with p * candidates <= rate * candidates of that p or less. A
    bin counts as its largest p. There are at most 7 times 21 groups, so the result is small.
    """
    group = F.concat_ws("/", "c.test.encoding", _length_class(F.col("c.length")).cast("string"))
    counts = candidates.groupBy(group.alias("group"), _bin(F.col("c.test.p")).alias("bin")).agg(F.count("*").alias("n"))
    below = Window.partitionBy("group").orderBy(F.desc("bin"))
    whole = Window.partitionBy("group")
    p = F.pow(F.lit(10.0), -F.col("bin") / 10)
    ranked = counts.select(
        "group", "bin", (p * F.sum("n").over(whole) <= F.lit(rate) * F.sum("n").over(below)).alias("held")
    )
    least = ranked.where("held").groupBy("group").agg(F.min("bin").alias("bin"))
    return {r.group: r.bin for r in least.collect()}
