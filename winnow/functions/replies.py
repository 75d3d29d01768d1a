"""Semi-structured replies: text with a JSON object somewhere in it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnow.functions.text import escape_tex, let, strip


def reply_object(raw: Column) -> Column:
    """The object from the first ``{`` to the last ``}`` as a variant; null if unusable.

    The parser stops at the end of the first value and would accept whatever follows it.
    Inside brackets that is an error, except for a closing bracket; inside braces that one
    is an error too. The second parse is made only where such a bracket occurs.
    """

    def checked(body: Column, listed: Column) -> Column:
        alone = F.try_variant_get(listed, "$[1]", "variant").isNull()
        closed = ~body.rlike(r"\}\s*\]") | F.try_parse_json(
            F.concat(F.lit('{"r":'), body, F.lit("}"))
        ).isNotNull()
        return F.when(alone & closed, F.try_variant_get(listed, "$[0]", "variant"))

    def parse(body: Column) -> Column:
        listed = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
        filled = (body != "") & ~body.rlike(r"^\{\s*\}$")
        return F.when(filled, let(listed, lambda v: checked(body, v)))

    return let(F.regexp_extract(raw, r"(?s)\{.*\}", 0), parse)


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def cover_body(value: Column) -> Column:
    """One text of a string, a list, or ``{paragraphs: list}``; anything else is empty."""

    def paragraphs(listed: Column) -> Column:
        text = F.transform(
            _items(listed),
            lambda p: strip(F.coalesce(F.try_variant_get(p, "$", "string"), F.lit("null"))),
        )
        return F.array_join(text, "\n\n")

    def listed_or_empty(listed: Column) -> Column:
        return F.when(F.startswith(_kind(listed), F.lit("ARRAY<")), paragraphs(listed)).otherwise("")

    def body(v: Column) -> Column:
        inner = F.try_variant_get(v, "$.paragraphs", "variant")
        return (
            F.when(_kind(v) == "STRING", strip(F.try_variant_get(v, "$", "string")))
            .when(F.startswith(_kind(v), F.lit("OBJECT<")), let(inner, listed_or_empty))
            .otherwise(listed_or_empty(v))
        )

    return let(value, body)


def bullets(value: Column) -> Column:
    """Escaped list items, non-text ones empty; a lone text is a list of one."""
    item = lambda v: F.when(
        _kind(v) == "STRING", escape_tex(F.try_variant_get(v, "$", "string"))
    ).otherwise(F.lit(""))
    return (
        F.when(F.startswith(_kind(value), F.lit("ARRAY<")), F.transform(_items(value), item))
        .when(
            _kind(value) == "STRING",
            F.array(escape_tex(strip(F.try_variant_get(value, "$", "string")))),
        )
        .otherwise(F.array().cast("array<string>"))
    )


def text_field(reply: Column, name: str) -> Column:
    """A reply's text field, trimmed and escaped; missing is empty, other kinds as they are."""
    path = f"$.{name}"
    text = F.try_variant_get(reply, path, "string")
    return F.when(
        _kind(F.try_variant_get(reply, path, "variant")) == "STRING", escape_tex(strip(text))
    ).otherwise(F.coalesce(text, F.lit("")))
