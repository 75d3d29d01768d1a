"""Text functions: Column in, Column out."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space when text is trimmed.
WHITESPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ),
    )
)
WORD = r"\p{L}\p{N}_"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lits(values: Iterable[str]) -> Column:
    values = list(values)
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def quoted(text: str) -> str:
    """A pattern that matches ``text`` literally, in Java and RE2 alike."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def any_of(words: Iterable[str]) -> str:
    """A pattern that matches any of ``words`` literally."""
    return "|".join(quoted(w) for w in words)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def contains_any(text: Column, words: Iterable[str], any_case: bool = False) -> Column:
    """True if any of ``words`` is a substring; null text is no text, no words match nothing."""
    words = list(words)
    if not words:
        return F.lit(False)
    return F.coalesce(text, F.lit("")).rlike("(?i)" * any_case + any_of(words))


def matches_role(title: Column, keywords: Iterable[str]) -> Column:
    return contains_any(F.lower(title), keywords)


def tokenize(text: Column) -> Column:
    """Distinct lower-case word tokens; null text has none."""
    return F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"[{WORD}]+"), F.lit(0))
    )


def classify(title: Column, positive: Iterable[str], negative: Iterable[str]) -> Column:
    """``struct(status, score, reason)`` of a title; a negative token outweighs all others."""

    def reason(label: str, hits: Column) -> Column:
        return F.concat(F.lit(f"{label} match: "), F.array_join(F.sort_array(hits), ", "))

    def verdict(status: str, score: Column, why: Column) -> Column:
        return F.struct(
            F.lit(status).alias("status"),
            score.cast("int").alias("score"),
            why.alias("reason"),
        )

    def decide(hits: Column) -> Column:
        return (
            F.when(F.size(hits["neg"]) > 0, verdict("ignored", F.lit(0), reason("Negative", hits["neg"])))
            .when(F.size(hits["pos"]) > 0, verdict("approved", F.size(hits["pos"]), reason("Positive", hits["pos"])))
            .otherwise(verdict("ignored", F.lit(0), F.lit("No keywords matched")))
        )

    return let(
        let(
            tokenize(title),
            lambda t: F.struct(
                F.array_intersect(t, lits(negative)).alias("neg"),
                F.array_intersect(t, lits(positive)).alias("pos"),
            ),
        ),
        decide,
    )


def sanitize_filename(text: Column) -> Column:
    clean = F.regexp_replace(text, rf"[^{WORD}\-]", "_")
    clean = F.btrim(F.regexp_replace(clean, "_+", "_"), F.lit("_"))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("Unknown")).otherwise(clean)


def raw_filename(company: Column, title: Column, location: Column, id_: Column) -> Column:
    return F.concat(
        F.concat_ws(
            "__",
            sanitize_filename(company),
            sanitize_filename(title),
            sanitize_filename(location),
            F.substring(id_, 1, 6),
        ),
        F.lit(".html"),
    )


def output_folder(company: Column, title: Column, id_: Column | None = None) -> Column:
    """Folder of a row's documents; pass ``id_`` to keep equal names apart."""
    name = F.concat(
        F.coalesce(company, F.lit("None")), F.lit("_"), F.coalesce(title, F.lit("None"))
    )
    folder = F.regexp_replace(name, rf"[^{WORD}\-]+", "_")
    return folder if id_ is None else F.concat(folder, F.lit("_"), F.substring(id_, 1, 6))


def detect_country(
    location: Column,
    description: Column,
    rules: Iterable[tuple[str, Iterable[str]]],
    other: str,
) -> Column:
    text = F.lower(F.concat_ws(" ", location, description))
    country = None
    for code, places in rules:
        hit = contains_any(text, places)
        country = F.when(hit, code) if country is None else country.when(hit, code)
    return F.lit(other) if country is None else country.otherwise(F.lit(other))


def language(country: Column) -> Column:
    return F.when(country == "FR", "FR").otherwise("EN")


# How each special character is written in a TeX document.
TEX = {
    "\\": r"\textbackslash{}",
    "&": r"\&",
    "%": r"\%",
    "$": r"\$",
    "#": r"\#",
    "_": r"\_",
    "{": r"\{",
    "}": r"\}",
    "~": r"\textasciitilde{}",
    "^": r"\textasciicircum{}",
}
_MARK = "\x01"


def escape_tex(text: Column) -> Column:
    """Text with TeX's special characters written out; null is empty.

    Backslashes go through a mark, so that those the other rules put in stay as they are.
    Text that holds the mark itself is treated between the marks.
    """

    def chain(part: Column) -> Column:
        part = F.replace(part, F.lit("\\"), F.lit(_MARK))
        part = F.regexp_replace(part, r"([&%$#_{}])", r"\\$1")
        for char in "~^":
            part = F.replace(part, F.lit(char), F.lit(TEX[char]))
        return F.replace(part, F.lit(_MARK), F.lit(TEX["\\"]))

    def between_marks(text: Column) -> Column:
        return F.array_join(F.transform(F.split(text, _MARK), chain), _MARK)

    return let(
        F.coalesce(text, F.lit("")),
        lambda t: F.when(F.contains(t, F.lit(_MARK)), between_marks(t)).otherwise(chain(t)),
    )


def escaped_lit(text: str) -> Column:
    """A parameter, trimmed and escaped, as a literal: no work per row."""
    return F.lit(text.strip().translate(str.maketrans(TEX)))


def whole_word(term: str) -> str:
    """Pattern for a literal, case-insensitive term not flanked by letters or digits."""
    return rf"(?i)(^|[^\p{{L}}\p{{N}}]){quoted(term)}($|[^\p{{L}}\p{{N}}])"


def skill_hits(text: Column, groups: Mapping[str, Iterable[str]]) -> dict[str, Column]:
    """Per group, the sorted array of its terms found in the text.

    A plain substring test on the lower-case text comes first: it is much cheaper than the
    pattern and rules out most terms.
    """
    text = F.coalesce(text, F.lit(""))
    lower = F.lower(text)

    def hit(term: str) -> Column:
        return F.contains(lower, F.lit(term.lower())) & text.rlike(whole_word(term))

    return {
        group: F.array_compact(F.array(*[F.when(hit(t), F.lit(t)) for t in sorted(set(terms))]))
        for group, terms in groups.items()
    }
