"""Loose JSON values as columns over VARIANT: truthiness, text and numbers the way
model replies need them (a missing key, null, false, 0 and '' all mean 'absent')."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift.functions.scalars import NUMBER_PATTERN, bound, trim_blank


_END = "\u0003end"


def parse_whole(text: Column) -> Column:
    """VARIANT of a text that is one JSON value and nothing else, NULL otherwise.

    `try_parse_json` stops after the first value, so the text is parsed as the first
    element of a list that must end with a known mark right after it.
    """
    framed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"\\u0003end"]')))

    def only_value(v: Column) -> Column:
        ends = (F.try_variant_get(v, "$[1]", "string") == _END) & F.try_variant_get(v, "$[2]", "variant").isNull()
        return F.when(ends, F.try_variant_get(v, "$[0]", "variant"))

    return bound(framed, only_value)


def field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    """'ARRAY', 'OBJECT', 'STRING', 'BOOLEAN', 'VOID', a number type, or NULL when missing."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def is_array(value: Column) -> Column:
    return F.coalesce(kind(value) == "ARRAY", F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value) == "OBJECT", F.lit(False))


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def exists(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def truthy(value: Column) -> Column:
    """False for missing, null, false, 0 and ''; True for everything else."""
    k = kind(value)
    return F.coalesce(
        F.when(k == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(k == "STRING", as_text(value) != "")
        .when(k.isin("ARRAY", "OBJECT"), F.lit(True))
        .when(k == "VOID", F.lit(False))
        .otherwise(F.try_variant_get(value, "$", "double") != 0),
        F.lit(False),
    )


def text_or_null(value: Column) -> Column:
    """Text of a truthy value, else NULL."""
    return F.when(truthy(value), as_text(value))


def string_equals(value: Column, word: str) -> Column:
    return F.coalesce((kind(value) == "STRING") & (as_text(value) == word), F.lit(False))


def string_in(value: Column, words) -> Column:
    return F.coalesce((kind(value) == "STRING") & as_text(value).isin(list(words)), F.lit(False))


def number(value: Column) -> Column:
    """Number of a value: numeric strings count, true is 1, false, null and blank text are 0,
    anything else is NULL."""
    k = kind(value)
    text = trim_blank(as_text(value))
    return (
        F.when(k == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double"))
        .when(k == "VOID", F.lit(0.0))
        .when(
            k == "STRING",
            F.when(text == "", F.lit(0.0)).when(text.rlike(NUMBER_PATTERN), text.try_cast("double")),
        )
        .when(k.isin("ARRAY", "OBJECT"), F.lit(None).cast("double"))
        .otherwise(F.try_variant_get(value, "$", "double"))
    )
