"""Text templates turned into one string expression, once, on the driver.

``<< name >>`` stands for a value, ``<% for x in name %> … <% endfor %>`` repeats its body
for a list, ``<% for k, v in name.items() %>`` for a map, ``<# … #>`` is left out. Unknown
names are empty, or what ``otherwise`` gives for them. One line break at the very end of a template is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARKS = re.compile(r"<#.*?#>|<<\s*(?P<name>\w+)\s*>>|<%[-+]?\s*(?P<block>.*?)\s*[-+]?%>", re.S)
_FOR = re.compile(r"for\s+(\w+)(?:\s*,\s*(\w+))?\s+in\s+(\w+)(\.items\(\))?$")


def _steps(template: str):
    at = 0
    for m in _MARKS.finditer(template):
        yield "text", template[at : m.start()]
        if m["name"]:
            yield "value", m["name"]
        elif m["block"] is not None:
            yield "block", m["block"]
        at = m.end()
    yield "text", template[at:]


def _body(steps, values: Mapping[str, Column], otherwise, nested: bool) -> Column:
    parts = []
    for kind, what in steps:
        if kind == "text":
            if what:
                parts.append(F.lit(what))
        elif kind == "value":
            value = values[what] if what in values else otherwise(what)
            if value is not None:
                parts.append(F.coalesce(value.cast("string"), F.lit("")))
        elif what == "endfor" and nested:
            break
        elif loop := _FOR.match(what):
            first, second, name, items = loop.groups()
            inner = list(_until_end(steps))
            if name not in values:
                continue
            rows = F.map_entries(values[name]) if items else values[name]
            each = _each(inner, values, otherwise, first, second)
            parts.append(F.coalesce(F.array_join(F.transform(rows, each), ""), F.lit("")))
        else:
            raise ValueError(f"unsupported template block: {what!r}")
    return F.concat(*parts) if parts else F.lit("")


def _each(inner, values: Mapping[str, Column], otherwise, first: str, second: str | None):
    """Lambda that renders a loop body for one list item, or one key and value."""

    def one(x: Column) -> Column:
        bound = {first: x} if second is None else {first: x["key"], second: x["value"]}
        return _body(iter(inner), {**values, **bound}, otherwise, True)

    return one


def _until_end(steps):
    depth = 1
    for kind, what in steps:
        if kind == "block":
            depth += -1 if what == "endfor" else 1
            if depth == 0:
                return
        yield kind, what
    raise ValueError("template loop without an end")


def render(
    template: str,
    values: Mapping[str, Column],
    otherwise: Callable[[str], Column | None] = lambda name: None,
) -> Column:
    """The template as a string column over ``values`` (name to column)."""
    template = template[:-1] if template.endswith("\n") else template
    return _body(_steps(template), values, otherwise, nested=False)
