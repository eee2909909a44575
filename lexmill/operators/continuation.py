"""Rows that continue the one before them. There are three definitions, for three uses; see each function.

Every table has an explicit order in ``row_no`` within ``page_id``; windows are partitioned by page, which the store bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.core import is_blank
from lexmill.schema import CASE_COLUMNS, HISTORY_FIELDS, KEY_FIELDS, PARTY_FIELDS, PRIMARY_FIELDS
from lexmill.storage import cut_lineage


def any_filled(df: DataFrame, names) -> Column:
    out = F.lit(False)
    for n in names:
        if n in df.columns:
            out = out | ~is_blank(n)
    return out


def row_groups(rows: DataFrame, page: str = "page_id", row: str = "row_no") -> DataFrame:
    """One row for each group: page, start_row, end_row and the key fields of its first row.

    A row with all key fields blank belongs to the last row before it that has one; rows before the first such row of a page are left out.
    """
    order = Window.partitionBy(page).orderBy(row)
    anchored = rows.withColumn("_anchor", any_filled(rows, KEY_FIELDS))
    owned = anchored.withColumn("_start", F.last(F.when(F.col("_anchor"), F.col(row)), ignorenulls=True).over(order))
    first = [F.max(F.when(F.col("_anchor"), F.col(c))).alias(c) for c in KEY_FIELDS if c in rows.columns]
    extra = [F.max(c).alias(c) for c in ("page_ord", "court") if c in rows.columns and c != page]
    return owned.where(F.col("_start").isNotNull()).groupBy(page, F.col("_start").alias("start_row")).agg(F.max(row).alias("end_row"), *first, *extra)


def hit_rows(rows: DataFrame, matched: Column, page: str = "page_id", row: str = "row_no") -> DataFrame:
    """The first phase of a search: the places of the rows that match, from a scan of the columns that the test reads. They are written, as the second phase reads them twice."""
    return cut_lineage(rows.where(F.coalesce(matched, F.lit(False))).select(page, row))


def marks_of(rows: DataFrame, hits: DataFrame, page: str, row: str, **flags: Column) -> DataFrame:
    """Places with the flags and ``_match``, of the pages that have a hit: the others are not dealt out at all."""
    near = rows.select(page, row, *[c.alias(n) for n, c in flags.items()]).join(hits.select(page).distinct(), page, "left_semi")
    return near.join(hits.select(page, row).withColumn("_hit", F.lit(True)), [page, row], "left").withColumn("_match", F.coalesce("_hit", F.lit(False))).drop("_hit")


def matched_runs(rows: DataFrame, hits: DataFrame, page: str = "page_id", row: str = "row_no") -> DataFrame:
    """The rows at the places ``hits`` and the run of rows that follows each: with a history field and without a primary one. Adds ``_is_continuation``.

    Rows inside a run are not matched anew. A run ends at the first row that is not such a one; that row may match itself. The second phase of a search: flags of the
    pages with a hit are dealt by page, and all columns are then fetched for the places that were found.
    """
    marks = marks_of(rows, hits, page, row, _break=any_filled(rows, PRIMARY_FIELDS) | ~any_filled(rows, HISTORY_FIELDS))
    islands = marks.withColumn("_island", F.sum(F.col("_break").cast("int")).over(Window.partitionBy(page).orderBy(row)))
    first = F.min(F.when(F.col("_match"), F.col(row))).over(Window.partitionBy(page, "_island"))
    places = islands.withColumn("_first", first).where(F.col(row) >= F.col("_first")).select(page, row, (F.col(row) > F.col("_first")).alias("_is_continuation"))
    return rows.join(places, [page, row])


def blank_continuations(rows: DataFrame, query: str) -> DataFrame:
    """On continuation rows all but the history fields are empty; on the others partyName is the query."""
    out = rows
    for c in CASE_COLUMNS:
        if c in rows.columns and c not in HISTORY_FIELDS:
            value = F.lit(query) if c == "partyName" else F.col(c)
            out = out.withColumn(c, F.when(F.col("_is_continuation"), F.lit("")).otherwise(value))
    return out


def carried_fate(rows: DataFrame, hits: DataFrame, page: str = "page_id", row: str = "row_no") -> DataFrame:
    """Rows with a party are kept if they are at one of the places ``hits``; rows without one share the fate of the last row before them that has one, and go if there is none."""
    marks = marks_of(rows, hits, page, row, _party=any_filled(rows, PARTY_FIELDS))
    fate = F.last(F.when(F.col("_party"), F.col("_match")), ignorenulls=True).over(Window.partitionBy(page).orderBy(row))
    return late_rows(rows, marks.withColumn("_kept", fate).where("_kept").select(page, row), [page, row])


def late_rows(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """S3: all columns of the rows whose keys were found in a scan of few columns."""
    return rows.join(keys.select(*on), on, "left_semi")
