"""Header access on `headers ARRAY<STRUCT<name, value>>`.

An array, not a map: names may repeat, the first match wins, and names compare
without regard to case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift.functions.scalars import trim_blank


def header(headers: Column, name: str) -> Column:
    """Value of the first header with this name, else ''."""
    wanted = F.lit(name.lower())
    matches = F.filter(headers, lambda h: F.lower(h["name"]) == wanted)
    return F.coalesce(F.get(matches, F.lit(0))["value"], F.lit(""))


def has_header(headers: Column, *names: str) -> Column:
    """Whether any header has one of these names."""
    return F.exists(headers, lambda h: F.lower(h["name"]).isin([n.lower() for n in names]))


def address(sender: Column) -> Column:
    """Lower-case address of a From value: inside the first <...>, else all of it."""
    inside = F.regexp_extract(sender, "<([^>]+)>", 1)
    return F.lower(trim_blank(F.when(inside != "", inside).otherwise(sender)))


def display_name(sender: Column) -> Column:
    """Text before '<' with one quote stripped at each end; '' without '<'."""
    before = trim_blank(F.regexp_extract(sender, r"^(.+?)\s*<", 1))
    return F.regexp_replace(before, r"^[\"']|[\"']$", "")


def mail_date(text: Column) -> Column:
    """Timestamp of an ISO or mail-style date text, NULL if it is neither."""
    plain = F.regexp_replace(trim_blank(text), r"^[A-Za-z]{3},\s*|\s*\([^)]*\)$", "")
    numeric_zone = F.regexp_replace(plain, r"\s(GMT|UTC|UT|Z)$", " +0000")
    return F.coalesce(
        F.try_to_timestamp(plain),
        F.try_to_timestamp(numeric_zone, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(numeric_zone, F.lit("d MMM yyyy HH:mm Z")),
    )
