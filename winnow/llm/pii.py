"""Personal data in texts, by anchor expansion.

An Aho-Corasick automaton runs over the text once and finds anchors: at-signs, plus signs, digits,
schemes and identifier cues. From an anchor, a parser of its kind expands to the boundaries of what it
may belong to and validates that. Within a kind, matches are the leftmost ones that do not overlap, and
one that does not validate is dropped without another try in its text.

Kinds, in order: email, ip, card, phone; and those that need a cue or scheme: ``address`` (mailto:, tel:
and sip: addresses, and the user part of a URL), ``account`` (an IBAN by its check digits after "iban",
a social security number after "ssn" or "social security", 6 to 17 digits after "account" or "acct").
"""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.shared import fresh, texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")

Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|\+?[0-9][0-9.()-]{5,}[0-9]")
_USER = re.compile(r"[A-Za-z0-9._~!$&'()*+,;=%-]+(?::[A-Za-z0-9._~!$&'()*+,;=%-]*)?@(?=[A-Za-z0-9\[])")
_GAP = re.compile(r"(?:\x20?(?:number|no\.?|nr\.?|code))?[\x20\t]*[:#=]?[\x20\t]*", re.IGNORECASE | re.ASCII)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"([0-9]{3})([\x20-])([0-9]{2})\2([0-9]{4})(?![0-9])")
_ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,16}(?![\x20-]?[0-9])")
#: Schemes and cues, in lower case; the automaton runs over a lower-case copy of the same length.
SCHEMES = ("mailto:", "tel:", "sip:")
CUES = ("iban", "ssn", "social security", "account", "acct")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _iban(text: str) -> bool:
    text = text.replace(" ", "")
    if not 15 <= len(text) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in (
        ("@", "at"), ("+", "plus"), *((d, "digit") for d in "0123456789"), ("://", "url"),
        *((s, "scheme") for s in SCHEMES), *((c, "cue") for c in CUES),
    ):
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


_LOWER = {c: c + 32 for c in range(65, 91)}
_made: list[ahocorasick.Automaton] = []


def spans_of(text: str | None) -> list[Span]:
    """All spans as (kind, start, end) in code points, by kind as listed, then by start."""
    if not text:
        return []
    if not _made:
        _made.append(_automaton())
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    past = dict.fromkeys(KINDS, 0)  # no match of a kind starts before this place
    number = -1  # end of the run of digits seen last

    def keep(kind: str, start: int, end: int, valid: bool) -> None:
        past[kind] = end
        if valid:
            found[kind].append((kind, start, end))

    def at_sign(at: int) -> None:
        start, least = at, past["email"]
        while start > least and _LOCAL.match(text, start - 1):
            start -= 1
        domain = start < at and _DOMAIN.match(text, at)
        if domain:
            keep("email", start, domain.end(), True)

    def digits(at: int) -> None:
        if at >= past["ip"] and (m := _IP.match(text, at)):
            keep("ip", at, m.end(), all(_small(p) for p in m.groups()))

    def card(at: int) -> None:
        if at >= past["card"] and (m := _CARD.match(text, at)):
            only = re.sub(r"[\x20-]", "", m[0]) if m.end() - at <= 64 else ""
            keep("card", at, m.end(), 16 <= len(only) <= 19 and _luhn(only))

    def plus(at: int) -> None:
        if at >= past["phone"] and (m := _PHONE.match(text, at)):
            n = sum(map(len, _DIGITS.findall(m[0])))
            keep("phone", at, m.end(), 8 <= n <= 15)

    def scheme(end: int) -> None:
        if end >= past["address"] and (m := _ADDRESS.match(text, end)):
            keep("address", end, m.end(), True)

    def url(end: int) -> None:
        if end >= past["address"] and (m := _USER.match(text, end)):
            keep("address", end, m.end() - 1, True)

    def cue(start: int, end: int) -> None:
        word = text[start:end].lower()
        if start and text[start - 1].isalnum():
            return
        at = _GAP.match(text, end).end()
        if at < past["account"]:
            return
        if word == "iban":
            m = _IBAN.match(text, at)
            while m and not _iban(m[0]):  # letters of a word after it may have been taken in
                cut = m[0].rfind(" ")
                m = _IBAN.fullmatch(text, at, at + cut) if cut > 0 else None
        elif word in ("ssn", "social security"):
            m = _SSN.match(text, at)
            if m and (m[1] in ("000", "666") or m[1] >= "900" or m[3] == "00" or m[4] == "0000"):
                m = None
        else:
            m = _ACCOUNT.match(text, at)
        if m:
            keep("account", at, m.end(), True)

    for last, (kind, size) in _made[0].iter(text.translate(_LOWER)):
        start = last - size + 1
        if kind == "digit":
            if start >= number:
                number = _DIGITS.match(text, start).end()
                digits(start)
                card(start)
        elif kind == "at":
            at_sign(start)
        elif kind == "plus":
            plus(start)
        elif kind == "scheme":
            scheme(last + 1)
        elif kind == "url":
            url(last + 1)
        else:
            cue(start, last + 1)
    return [s for kind in KINDS for s in found[kind]]


def _small(part: str) -> bool:
    """At most 255, whatever the number of digits."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SPANS_SQL = "array<struct<kind: string, start: long, end: long>>"


def spans(text: Column) -> Column:
    """Spans of a column of texts; a null has none."""

    @F.arrow_udf(_SPANS_SQL)
    def find(texts: pa.Array) -> pa.Array:
        rows = [
            [{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t)] for t in texts.to_pylist()
        ]
        return pa.array(rows, pa.list_(_SPAN))

    return find.asNondeterministic()(text)


def find_pii(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as doc_id and spans. Other columns are ignored, repeated rows are kept."""
    return texts_of(docs).select("doc_id", spans(F.col("text")).alias("spans"))


def placeholder(kind: str) -> str:
    return f"[{kind.upper()}]"


def redacted(text: str, found: list[Span], name: Callable[[str], str] = placeholder) -> str:
    """A text with each span replaced by its kind's name; overlapping ones by that of the first."""
    out, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += (text[at:start], name(kind))
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by the names of its kinds, and n_chars set anew there.

    All rows and columns are kept; null and empty texts and those without personal data stay as they are.
    """

    @F.arrow_udf("string")
    def replace(texts: pa.Array) -> pa.Array:
        out = [redacted(t, s) if t and (s := spans_of(t)) else t for t in texts.to_pylist()]
        return pa.array(out, pa.string())

    (now,) = fresh(docs, "text_now")
    out = texts_of(docs).withColumn(now, replace.asNondeterministic()(F.col("text")))
    changed = F.coalesce(F.col(now) != F.col("text"), F.lit(False))
    columns = []
    for c in docs.columns:
        if c == "n_chars":
            n = F.when(changed, F.length(now)).otherwise(F.col(c)).cast(docs.schema[c].dataType)
            columns.append(n.alias(c))
        else:
            columns.append(F.col(now).alias(c) if c == "text" else F.col(c))
    return out.select(*columns)
