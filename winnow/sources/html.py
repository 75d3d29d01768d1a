"""HTML pages to node arrays.

The one place where Python touches the rows: markup has to be scanned character by
character, which no built-in expression does. Each page becomes one array of nodes in
document order, so all later steps are native expressions over that array and nothing
has to be regrouped. The module is pickled by value, so executors need no install.
"""

from __future__ import annotations

import html as _html
import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from html.entities import html5

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from winnow.schemas import NODES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ATTR = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?>[\s/]++|" + _ATTR + r")*+)(>|\Z)"  # end, tag, attributes, close
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRS = re.compile(
    r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+"""
)
# Four tags or more in a row, all begins or all ends, with nothing in them or between them.
_RUN = re.compile(r"(?:<[A-Za-z][A-Za-z0-9]*+>){4,128}+|(?:</[A-Za-z][A-Za-z0-9]*+>){4,128}+")
_CHARREF = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)(;|=|)")

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset(("script", "style"))
_RCDATA = frozenset(("title", "textarea"))
# Elements whose text is not part of the page's text.
_SILENT = frozenset(("script", "style", "template", "rt", "rp"))
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in _RAW | _RCDATA}

_CELLS = frozenset(("td", "th", "caption", "table", "template"))
_TABLE_ENDS = frozenset("table caption colgroup thead tbody tfoot tr td th template".split())
_LISTS = frozenset(("ul", "ol", "menu", "dl")) | _CELLS
_P_SCOPE = frozenset(("button", "object", "marquee")) | _CELLS
_P_ENDERS = (
    "address article aside blockquote center details dialog dir div dl dt dd fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p "
    "pre search section summary table ul"
).split()
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# start tag -> [(open tags it ends, tags that shield them)]
_IMPLIED_ENDS: dict[str, list[tuple[frozenset, frozenset]]] = {}
for _tag in _P_ENDERS:
    _IMPLIED_ENDS.setdefault(_tag, []).append((frozenset(("p",)), _P_SCOPE))
for _tag, _ends, _shield in (
    ("a", ("a",), _CELLS),
    ("li", ("li",), _LISTS),
    ("dd", ("dd", "dt"), _LISTS),
    ("dt", ("dd", "dt"), _LISTS),
    ("option", ("option",), frozenset(("select",))),
    ("optgroup", ("option", "optgroup"), frozenset(("select",))),
    ("td", ("td", "th"), frozenset(("table", "tr"))),
    ("th", ("td", "th"), frozenset(("table", "tr"))),
    ("tr", ("tr",), frozenset(("table",))),
    ("thead", ("thead", "tbody", "tfoot", "caption"), frozenset(("table",))),
    ("tbody", ("thead", "tbody", "tfoot", "caption"), frozenset(("table",))),
    ("tfoot", ("thead", "tbody", "tfoot", "caption"), frozenset(("table",))),
):
    _IMPLIED_ENDS.setdefault(_tag, []).append((frozenset(_ends), _shield))
# start tag -> open tags that it may end
_MAY_END = {tag: frozenset().union(*(ends for ends, _ in rules)) for tag, rules in _IMPLIED_ENDS.items()}
for _tag in _HEADINGS:
    _MAY_END[_tag] |= _HEADINGS
_NOT_IN_RUNS = _VOID | _SILENT | _RCDATA


def _attr_text(value: str) -> str:
    def decode(m: re.Match) -> str:
        ref = m.group()
        if ref.endswith(";") or ref.startswith("&#"):
            return _html.unescape(ref)
        # An unterminated name before "=" is a query parameter, not a character.
        return html5[ref[1:]] if not m.group(1) and ref[1:] in html5 else ref

    return _CHARREF.sub(decode, value)


class _NodeColumns:
    """Node fields of a run of pages, gathered column by column for Arrow."""

    def __init__(self, wanted: frozenset[str] | None = None) -> None:
        self.wanted = wanted  # names of the attributes to keep, None for all
        self.parent, self.last, self.depth, self.tag, self.text = [], [], [], [], []
        self.keys, self.values, self.attr_ends = [], [], [0]
        self.page_ends, self.failed = [0], []

    def add_page(self, page: str | None) -> None:
        base, attrs = len(self.last), len(self.keys)
        try:
            self._scan(page or "", base)
            self.failed.append(None)
        except Exception as e:  # one bad page must not fail the task
            for column in (self.parent, self.last, self.depth, self.tag, self.text):
                del column[base:]
            del self.attr_ends[base + 1 :], self.keys[attrs:], self.values[attrs:]
            self.failed.append(f"{type(e).__name__}: {e}")
        self.page_ends.append(len(self.last))

    def _scan(self, page: str, base: int) -> None:
        last, keys, values, wanted = self.last, self.keys, self.values, self.wanted
        no_attrs = wanted is not None and not wanted
        add_parent, add_last, add_depth = self.parent.append, last.append, self.depth.append
        add_tag, add_text, add_attr_end = self.tag.append, self.text.append, self.attr_ends.append
        names: list[str] = []  # open elements
        pres: list[int] = [-1]  # their positions, below them the page itself
        open_at: dict[str, list[int]] = {}  # levels of the open elements of a tag
        silent = 0  # open elements whose text does not count
        chars: list[str] = []  # text since the last piece of markup
        at = 0  # position of the next node

        def add(tag: str, text: str | None) -> None:
            nonlocal at
            add_parent(pres[-1])
            add_last(at)
            add_depth(len(names))
            add_tag(tag)
            add_text(text)
            add_attr_end(len(keys))
            at += 1

        def flush() -> None:
            text = "".join(chars) if len(chars) > 1 else chars[0]
            chars.clear()
            if not silent:
                text = (_html.unescape(text) if "&" in text else text).strip()
                if text:
                    add("#text", text)

        def close_to(level: int) -> None:
            nonlocal silent
            if chars:
                flush()
            while len(names) > level:
                name = names.pop()
                open_at[name].pop()
                if name in _SILENT:
                    silent -= 1
                last[base + pres.pop()] = at - 1

        def innermost(tags) -> int:
            return max([levels[-1] for t in tags if (levels := open_at.get(t))], default=-1)

        def close_open(ends, shield) -> None:
            """Close the innermost of ``ends`` that ``shield`` does not protect; looks at no other element."""
            level = innermost(ends)
            if level >= 0 and level >= innermost(shield):
                close_to(level)

        def open_run(tags: list[str]) -> int:
            """Open elements each within the last; none if one of them may be void, silent or end another."""
            nonlocal at
            kinds = set(tags)
            if not kinds.isdisjoint(_NOT_IN_RUNS):
                return 0
            for tag in kinds & _MAY_END.keys():
                if any(t in kinds or open_at.get(t) for t in _MAY_END[tag]):
                    return 0
            if chars:
                flush()
            n, level, new = len(tags), len(names), range(at, at + len(tags))
            add_parent(pres[-1])
            self.parent.extend(new[:-1])
            last.extend(new)
            self.depth.extend(range(level, level + n))
            self.tag.extend(tags)
            self.text.extend([None] * n)
            self.attr_ends.extend([len(keys)] * n)
            names.extend(tags)
            pres.extend(new)
            if len(kinds) == 1:
                open_at.setdefault(tags[0], []).extend(range(level, level + n))
            else:
                for i, tag in enumerate(tags, level):
                    open_at.setdefault(tag, []).append(i)
            at += n
            return n

        def close_run(tags: list[str]) -> int:
            """Close the innermost elements, as long as these are their ends."""
            nonlocal silent
            if names[-len(tags) :] != tags[::-1]:
                same = next((i for i, (a, b) in enumerate(zip(tags, reversed(names))) if a != b), len(names))  # noqa: B905
                tags = tags[:same]
            n = len(tags)
            if not n:
                return 0
            if chars:
                flush()
            for pre in pres[-n:]:
                last[base + pre] = at - 1
            del names[-n:], pres[-n:]
            kinds = set(tags)
            for tag, k in Counter(tags).items() if len(kinds) > 1 else [(tags[0], n)]:
                del open_at[tag][-k:]
                if tag in _SILENT:
                    silent -= k
            return n

        pos, size, search, run = 0, len(page), _MARKUP.search, _RUN.match
        tried, wait = 0, 1  # where to look for a run again; further on each time that there was little to take
        while pos < size:
            if pos >= tried and page[pos] == "<" and (m := run(page, pos)):
                found = m.group().lower()
                if found[1] == "/":
                    n = close_run(ends := found[2:-1].split("></"))
                    pos += len(found) if n == len(ends) else sum(map(len, ends[:n])) + 3 * n
                elif n := open_run(found[1:-1].split("><")):
                    pos += len(found)
                wait = 1 if n > 3 else 2 * wait
                tried = pos + wait if wait > 1 else pos
                if n:
                    continue
            m = search(page, pos)
            if m is None:
                chars.append(page[pos:])
                break
            start, stop = m.span()
            if start > pos:
                chars.append(page[pos:start])
            pos = stop
            end, tag, attrs, close = m.groups()
            if tag is None:  # comment, doctype or processing instruction
                if chars:
                    flush()
                continue
            if not close:
                break
            tag = tag.lower()
            if end:
                if names and names[-1] == tag:
                    close_to(len(names) - 1)
                elif open_at.get(tag):
                    close_open((tag,), () if tag in _TABLE_ENDS else _CELLS)
                continue

            if tag in _IMPLIED_ENDS:
                for ends, shield in _IMPLIED_ENDS[tag]:
                    close_open(ends, shield)
                if tag in _HEADINGS and names and names[-1] in _HEADINGS:
                    close_to(len(names) - 1)
            if chars:
                flush()

            if len(attrs) > 1 and not no_attrs:
                seen = set()
                for name, dq, sq, bare in _ATTRS.findall(attrs):
                    name = name.lower()
                    if name not in seen and (wanted is None or name in wanted):
                        seen.add(name)
                        keys.append(name)
                        value = dq or sq or bare
                        values.append(_attr_text(value) if "&" in value else value)
            add(tag, None)
            if tag in _VOID:
                continue
            names.append(tag)
            pres.append(at - 1)
            if tag in open_at:
                open_at[tag].append(len(names) - 1)
            else:
                open_at[tag] = [len(names) - 1]
            if tag in _SILENT:
                silent += 1
            if tag in _RAW_END:  # no markup inside: take the text up to the end tag
                m = _RAW_END[tag].search(page, pos)
                body = page[pos : m.start() if m else size]
                if body and tag in _RCDATA:
                    chars.append(body)
                close_to(len(names) - 1)
                if m is None:
                    break
                pos = page.find(">", m.end()) + 1 or size
        close_to(0)

    def arrays(self) -> tuple[pa.Array, pa.Array]:
        i32, text = pa.int32(), pa.string()
        ends = np.asarray(self.page_ends, dtype=np.int32)
        starts, sizes = ends[:-1], np.diff(ends)
        pre = np.arange(ends[-1], dtype=np.int32) - np.repeat(starts, sizes)
        attrs = pa.MapArray.from_arrays(
            pa.array(self.attr_ends, i32), pa.array(self.keys, text), pa.array(self.values, text)
        )
        nodes = pa.StructArray.from_arrays(
            [
                pa.array(pre),
                pa.array(self.parent, i32),
                pa.array(self.last, i32),
                pa.array(self.depth, i32),
                pa.array(self.tag, text),
                attrs,
                pa.array(self.text, text),
            ],
            names=["pre", "parent", "last", "depth", "tag", "attrs", "text"],
        )
        return pa.ListArray.from_arrays(pa.array(ends), nodes), pa.array(self.failed, text)


_CHUNK_CHARS = 4_000_000  # markup per output batch, keeps worker and JVM buffers small


def _scan_batches(
    batches: Iterator[pa.RecordBatch], wanted: frozenset[str] | None
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.num_rows
        column = batch.schema.get_field_index("html")
        kept = [i for i in range(batch.num_columns) if i != column]
        names = [batch.schema.names[i] for i in kept]
        start, size, nodes = 0, 0, _NodeColumns(wanted)
        for row in range(rows):
            page = batch.column(column)[row].as_py()
            nodes.add_page(page)
            size += len(page or "")
            if size >= _CHUNK_CHARS or row == rows - 1:
                part = batch.slice(start, row + 1 - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in kept] + list(nodes.arrays()),
                    names=names + ["nodes", "error"],
                )
                start, size, nodes = row + 1, 0, _NodeColumns(wanted)


def html_nodes(
    pages: DataFrame, *keep: str, html: str = "html", attributes: Iterable[str] | None = None
) -> DataFrame:
    """``keep`` columns plus ``nodes`` and ``error`` (null unless the page failed).

    Name the ``attributes`` that are needed: the others, inlined images and styles among
    them, are often the larger part of a page, and then never leave the scan. What has been
    scanned already, ``nodes`` instead of markup, is not scanned again and keeps its attributes.
    """
    if "nodes" in pages.columns and html not in pages.columns:
        return pages.select(*keep, "nodes", "error")
    wanted = None if attributes is None else frozenset(attributes)
    kept = [pages.schema[c] for c in keep]
    schema = T.StructType(
        kept + [T.StructField("nodes", NODES, False), T.StructField("error", T.StringType())]
    )
    narrow = pages.select(*keep, pages[html].alias("html"))
    return narrow.mapInArrow(lambda batches: _scan_batches(batches, wanted), schema)
