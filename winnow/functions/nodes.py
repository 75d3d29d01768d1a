"""Navigation over a page's node array (see ``winnow.sources.html``).

``nodes`` is the array column, ``node`` one of its elements. A subtree is a contiguous
slice, so its cost is its own size and not that of the page.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnow.functions.text import WHITESPACE, let, quoted

_WS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"


@dataclass(frozen=True)
class Select:
    """A test on one element: every given part must hold."""

    tags: tuple[str, ...] = ()
    class_token: str | None = None
    class_pattern: str | None = None
    attr: tuple[str, str] | None = None
    has_attr: str | None = None
    attr_pattern: tuple[str, str] | None = None

    def attributes(self) -> set[str]:
        """Names of the attributes the test looks at."""
        names = {a[0] for a in (self.attr, self.attr_pattern) if a is not None}
        names |= {self.has_attr} if self.has_attr is not None else set()
        return names | ({"class"} if self.class_token or self.class_pattern else set())

    def test(self, node: Column) -> Column:
        attrs = node["attrs"]
        checks = []
        if self.tags:
            checks.append(node["tag"].isin(*self.tags))
        if self.class_token is not None:
            checks.append(
                attrs["class"].rlike(rf"(?:^|{_WS}){quoted(self.class_token)}(?:{_WS}|$)")
            )
        if self.class_pattern is not None:
            checks.append(attrs["class"].rlike(self.class_pattern))
        if self.attr is not None:
            checks.append(attrs[self.attr[0]] == self.attr[1])
        if self.has_attr is not None:
            checks.append(attrs[self.has_attr].isNotNull())
        if self.attr_pattern is not None:
            checks.append(attrs[self.attr_pattern[0]].rlike(self.attr_pattern[1]))
        out = checks[0]
        for check in checks[1:]:
            out = out & check
        return out


def first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def subtree(nodes: Column, node: Column) -> Column:
    """Descendants of ``node`` in document order."""
    return F.slice(nodes, node["pre"] + 2, node["last"] - node["pre"])


def find(nodes: Column, node: Column, select: Select) -> Column:
    """First descendant that passes, or null."""
    return first(F.filter(subtree(nodes, node), select.test))


def find_any(nodes: Column, node: Column, selects: tuple[Select, ...]) -> Column:
    """First descendant for the first of ``selects`` that has one, or null."""
    return let(
        subtree(nodes, node),
        lambda below: F.coalesce(*[first(F.filter(below, s.test)) for s in selects]),
    )


def _followed(pointers: Column, stops: Column, longest: Column) -> Column:
    """Per position, the first stop on the way along ``pointers``, -1 if there is none.

    ``stops`` tells of each position whether it is one, ``longest`` bounds the ways' lengths. Every round
    replaces a pointer by that of its target and so doubles its reach: n log n for all positions.
    """

    def leap(at: Column, _: Column) -> Column:
        return F.transform(at, lambda p: F.when((p < 0) | F.get(stops, p), p).otherwise(F.get(at, p)))

    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(longest))), pointers, leap)


def enclosing(nodes: Column, tag: str) -> Column:
    """Per node the position of its nearest ancestor with this tag, -1 if it has none."""
    return let(
        F.transform(nodes, lambda n: n["tag"] == tag),
        lambda stops: _followed(
            F.transform(nodes, lambda n: n["parent"]),
            stops,
            F.coalesce(F.array_max(F.transform(nodes, lambda n: n["depth"])), F.lit(0)),
        ),
    )


def next_match(nodes: Column, select: Select) -> Column:
    """Per position that of the first node from there on that passes, -1 if there is none."""
    return let(
        F.transform(nodes, lambda n: F.coalesce(select.test(n), F.lit(False))),
        lambda stops: _followed(
            F.transform(
                stops, lambda hit, i: F.when(hit, i).when(i + 1 < F.size(stops), i + 1).otherwise(F.lit(-1))
            ),
            stops,
            F.size(stops),
        ),
    )


def first_below(nodes: Column, node: Column, matches: Iterable[Column]) -> Column:
    """First descendant of ``node`` for the first of ``matches`` (``next_match``) that has one, or null.

    Two look-ups each, whatever the size of the subtree.
    """

    def within(match: Column) -> Column:
        at = F.get(match, node["pre"] + 1)
        return F.when((at >= 0) & (at <= node["last"]), F.get(nodes, at))

    return F.coalesce(*[within(m) for m in matches])


def pieces(array: Column) -> Column:
    """Texts of an array of nodes, each trimmed and none empty."""
    return F.transform(F.filter(array, lambda n: n["tag"] == "#text"), lambda n: n["text"])


def text(nodes: Column, node: Column, sep: str = "") -> Column:
    return F.array_join(pieces(subtree(nodes, node)), sep)


def page_text(nodes: Column) -> Column:
    return F.array_join(pieces(nodes), "\n")


def keep_first(rows: Column, key: Callable[[Column], Column]) -> Column:
    """The first row of each key, in order. Sorts inside the array: no shuffle, n log n."""

    def firsts(all_rows: Column) -> Column:
        keyed = F.sort_array(
            F.transform(all_rows, lambda r, i: F.struct(key(r).alias("key"), i.alias("at")))
        )
        heads = let(
            keyed,
            lambda s: F.filter(
                s, lambda x, i: (i == 0) | (F.get(s, i - 1)["key"] != x["key"])
            ),
        )
        return F.transform(
            F.sort_array(F.transform(heads, lambda h: h["at"])), lambda at: F.get(all_rows, at)
        )

    return let(rows, firsts)
