"""Looking up the rows of some keys without reading the table.

Tables are written sorted by their main key inside each file, with Parquet Bloom filters on
every column they are looked up by. A filter that names values then skips the row groups
that cannot hold them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter

#: Ids up to this count are named in the filter itself; Parquet tests each against its Bloom filters.
NAMED_IDS = 200
#: The setting that says how many values a pushed filter may name.
IN_THRESHOLD = "spark.sql.parquet.pushdown.inFilterThreshold"

#: Columns by which tables are looked up; rows are sorted by the first.
LOOKUP_COLUMNS = {
    "deal_states": ("batch_id", "thread_id", "message_id", "email_metadata_id"),
    "batch_events": ("batch_id",),
    "messages": ("message_id",),
    "deals": ("thread_id",),
    "email_thread_evaluations": ("thread_id",),
    "ai_evaluation_audits": ("batch_id",),
    "email_metadata": ("thread_id", "id"),
    "email_senders": ("email_metadata_id",),
}


def indexed(rows: DataFrame, columns: Sequence[str]) -> DataFrameWriter:
    """A writer whose files carry Bloom filters on some columns."""
    writer = rows.write.mode("errorifexists")
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


def sorted_and_indexed(rows: DataFrame, name: str) -> DataFrameWriter:
    """A writer of a named table for look-ups; rows are sorted inside each task, none is moved."""
    columns = [c for c in LOOKUP_COLUMNS.get(name, ()) if c in rows.columns]
    return indexed(rows.sortWithinPartitions(columns[0]) if columns else rows, columns)


def with_ids(table: DataFrame, column: str, ids: DataFrame, id_column: str | None = None) -> DataFrame:
    """Rows of a table whose `column` is among some ids; NULL is never among them.

    A short list, of which NAMED_IDS + 1 rows are looked at, becomes part of the scan's own
    filter; a longer one is a semi-join.
    """
    wanted = ids.selectExpr(f"`{id_column or column}` AS `{column}`")
    short = wanted.filter(wanted[column].isNotNull()).distinct().limit(NAMED_IDS + 1).collect()
    if len(short) <= NAMED_IDS:
        return table.filter(table[column].isin([r[0] for r in short]))
    return table.join(wanted, column, "left_semi").select(*table.columns)
