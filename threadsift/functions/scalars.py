"""Small column helpers shared by all jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed

# Everything a mail client treats as blank, not only the space Spark trims.
BLANKS = " \t\n\r\f\v\u00a0\u1680\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(
    chr(code) for code in range(0x2000, 0x200B)
)

NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def trim_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    """Empty string becomes NULL; other values stay as they are."""
    return F.nullif(text, F.lit(""))


def straight_quotes(text: Column) -> Column:
    """Curly quotes become straight ones, NULL becomes ''."""
    source = fixed.CURLY_SINGLE_QUOTES + fixed.CURLY_DOUBLE_QUOTES
    target = "'" * len(fixed.CURLY_SINGLE_QUOTES) + '"' * len(fixed.CURLY_DOUBLE_QUOTES)
    return F.translate(F.coalesce(text, F.lit("")), source, target)


def straight_quotes_in_json(json: Column) -> Column:
    """`straight_quotes` for JSON text: double quotes are escaped, so the text still parses."""
    plain = F.translate(json, fixed.CURLY_SINGLE_QUOTES, "'" * len(fixed.CURLY_SINGLE_QUOTES))
    return F.regexp_replace(plain, f"[{fixed.CURLY_DOUBLE_QUOTES}]", r'\\"')


def nullable_text(text: Column) -> Column:
    """Text ready to store: straight quotes, empty becomes NULL."""
    return blank_to_null(straight_quotes(text))


def is_valid_id(identifier: Column) -> Column:
    return F.coalesce(identifier.rlike(fixed.ID_PATTERN), F.lit(False))


def split_by_valid_id(rows: DataFrame, *id_columns: str) -> tuple[DataFrame, DataFrame]:
    """(usable rows, quarantined rows): rows whose ids have the wrong shape are set aside."""
    usable = F.lit(True)
    for name in id_columns:
        usable = usable & is_valid_id(F.col(name))
    return rows.filter(usable), rows.filter(~usable)


def number_or_zero(value: Column) -> Column:
    """Finite number of a value, else 0."""
    number = value.cast("string").try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    return F.when(finite, number).otherwise(F.lit(0.0))


def rounded_between(value: Column, low: int, high: int) -> Column:
    """Half rounds up, then the number is moved inside the bounds."""
    return F.floor(F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), value + 0.5))).cast("int")


def first_given(*values: Column, default: str) -> Column:
    """The first value that is neither NULL nor empty, as text."""
    return F.coalesce(*[F.nullif(v.cast("string"), F.lit("")) for v in values], F.lit(default))


def stable_id(*parts: Column | str) -> Column:
    """The same natural key always gives the same id, so reruns are repeatable."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def bound(value: Column, body) -> Column:
    """Evaluate `value` once and use it several times inside `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Items of an array that `scan` passes between two additions to its result.
_SCAN_CHUNK = 64


def scan(items: Column, start: Column, step, output_type: str) -> Column:
    """Walk an array with a state: `step(state, item)` gives (next state, output); the outputs, in order.

    `start` is the first state. Outputs are gathered in chunks, so the work grows with the
    array and not with its square. The array must not be empty.
    """

    def outputs(acc: Column, item: Column) -> Column:
        state, output = step(acc["state"], item)
        return F.struct(state.alias("state"), F.concat(acc["out"], F.array(output)).alias("out"))

    def chunk(acc: Column, number: Column) -> Column:
        none = F.array().cast(f"array<{output_type}>")
        part = F.slice(items, number * _SCAN_CHUNK + 1, F.lit(_SCAN_CHUNK))
        walked = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), outputs)
        return bound(walked, lambda w: F.struct(w["state"].alias("state"), F.concat(acc["out"], F.array(w["out"])).alias("out")))

    none = F.array().cast(f"array<array<{output_type}>>")
    last = F.floor((F.size(items) - 1) / F.lit(_SCAN_CHUNK)).cast("int")
    walked = F.aggregate(F.sequence(F.lit(0), last), F.struct(start.alias("state"), none.alias("out")), chunk)
    return F.flatten(walked["out"])


def minutes_before(as_of: Column, minutes: int) -> Column:
    return as_of - F.make_interval(mins=F.lit(minutes))
