"""Search for a party in stored rows, and the filter of exact names after it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import company
from lexmill.functions.core import text
from lexmill.functions.parties import decode_names, matches_any, normalize_party_name
from lexmill.operators.continuation import blank_continuations, carried_fate, hit_rows, matched_runs
from lexmill.schema import PARTY_FIELDS
from lexmill.storage import cut_lineage


def project(rows: DataFrame, wanted) -> DataFrame:
    """The wanted columns, found by their stripped names; one that is not there is empty text."""
    have = {c.strip(): c for c in rows.columns}
    return rows.select(*[text(F.col(f"`{have[w]}`")).alias(w) if w in have else F.lit("").alias(w) for w in wanted])


def party_fields(rows: DataFrame) -> list[str]:
    return [c for c in PARTY_FIELDS if c in rows.columns]


def individual_match(rows: DataFrame, query: str) -> Column:
    """Whether a party field has one of the query's plain patterns."""
    out = F.lit(False)
    for pattern in company.plain_patterns(query):
        out = out | matches_any(party_fields(rows), pattern)
    return out


def search_individual(rows: DataFrame, query: str, page: str = "page_id", row: str = "row_no") -> DataFrame:
    """The rows that mention a person, with their continuation rows, in the shape of a result. The pattern is a literal, so that no Python runs."""
    return blank_continuations(matched_runs(rows, hit_rows(rows, individual_match(rows, query), page, row), page, row), query)


def search_company(rows: DataFrame, query: str, plan: company.Plan | None = None, page: str = "page_id", row: str = "row_no") -> DataFrame:
    """The same for a company. Each distinct cell is decided once; the cells that match find their places, and those their rows.

    Cells that cannot match by a search for plain words are left out before any of them is moved.
    """
    plan = plan or company.make_plan(query)
    names = party_fields(rows)
    listed = F.array_distinct(F.filter(F.array(*[text(c) for c in names]), lambda c: (c != "") & company.worth_a_look(c, plan)))
    cells = rows.select(page, row, F.explode(listed).alias("cell"))
    hits = cut_lineage(cells.join(company.matched_cells(cells, "cell", plan), "cell", "left_semi").select(page, row).distinct())
    return blank_continuations(matched_runs(rows, hits, page, row), query)


def name_in_cell(cell: Column | str, wanted: Column) -> Column:
    """Whether a name of the cell is the wanted one once normalised."""
    return F.exists(decode_names(cell), lambda n: normalize_party_name(n) == wanted)


def filter_exact(rows: DataFrame, query: str, entity: str, page: str = "page_id", row: str = "row_no") -> DataFrame:
    """For an individual, the rows with a party whose normalised name is the normalised query, with the rows that share their fate; else all rows."""
    if entity != "individual":
        return rows
    spark = rows.sparkSession
    wanted = spark.range(1).select(normalize_party_name(F.lit(query)).alias("q")).first()["q"]
    if not wanted:
        return rows
    # No rule makes the letters and digits of a word, but for INDIA: the longest word stands in a cell that has the name, which is cheap to see first.
    word = max((w for w in re.findall("[A-Z0-9]+", wanted) if w != "INDIA"), key=len, default="")
    test = F.lit(False)
    for c in party_fields(rows):
        test = test | (F.upper(text(c)).contains(word) & name_in_cell(c, F.lit(wanted)))
    return carried_fate(rows, hit_rows(rows, test, page, row), page, row)
