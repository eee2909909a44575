"""Hits with their details, lookups, requests and configurations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.cases import is_header_row, header_name, page_id, total_systems
from lexmill.functions.core import is_blank, overlay, strip, text
from lexmill.functions.dates import config_date
from lexmill.schema import SOURCES, dimension


def with_details(hits: DataFrame, details: DataFrame, on: list[str], keep_missing: bool = True) -> DataFrame:
    """Hits with their details; those without one have nulls, or go."""
    return hits.join(details, on, "left" if keep_missing else "inner")


def overlaid(hits: DataFrame, details: DataFrame, on: list[str], names: list[str]) -> DataFrame:
    """Hits in which a detail's value counts unless it is null or blank."""
    own = details.select(*on, *[F.col(n).alias(f"_d_{n}") for n in names])
    joined = hits.join(own, on, "left")
    return joined.select(*[overlay(f"_d_{c}", c).alias(c) if c in names else F.col(c) for c in hits.columns])


def lookup(rows: DataFrame, dim: DataFrame, on: str, value: str, default: Column) -> DataFrame:
    """A code's name from a dimension, or the default. The dimension is sent to all tasks if Spark finds it small enough, else both sides are dealt by the code."""
    return rows.join(dim.select(on, value), on, "left").withColumn(value, F.coalesce(value, default))


def requests(cells: DataFrame) -> DataFrame:
    """Requests to fetch: row, party, entity_type (company or individual, which is the default)."""
    entity = F.lower(strip(text("entity_type")))
    out = cells.select("row", strip(text("party")).alias("party"), F.upper(strip(text("command"))).alias("command"), F.when(entity.isin("company", "individual"), entity).otherwise(F.lit("individual")).alias("entity_type"))
    return out.where((F.col("party") != "") & (F.col("command") == "FETCH")).drop("command")


# Names of courts in a configuration and the sources that each turns on.
CONFIG_SOURCES = (
    ("Party Name | National Company Law Tribunal", "nclt"), ("Party Name | Supreme Court of India", "supreme_court"), ("High Court", "high_court"), ("District Courts of India", "district_court"),
    ("e-Jagriti", "ncdrc"), ("e-Jagriti", "scdrc"), ("e-Jagriti", "dcdrc"), ("Debts Recovery Appellate Tribunals", "drt"), ("Debts Recovery Appellate Tribunals", "drat"),
    ("Debts Recovery Tribunals", "drt"),
)


def output_mode(first_cell: str | None) -> str:
    """Append if the configuration's first cell says so, else overwrite."""
    return "append" if "append" in (first_cell or "").strip().lower() else "overwrite"


def active_sources(config: DataFrame, today: str, names=CONFIG_SOURCES, preferred=SOURCES) -> DataFrame:
    """The active sources in their preferred order, with their dates; ``config`` has row, court_name, is_active, start_date and end_date.

    Only rows after the one whose first cell is "Courts" count; a name may turn on more than one source, and one that is not known turns on none.
    """
    spark = config.sparkSession
    start = config.where(F.col("court_name") == "Courts").agg(F.min("row").alias("_start"))
    rows = config.crossJoin(F.broadcast(start)).where(F.col("row") > F.col("_start"))
    active = rows.where(F.upper(strip(text("is_active"))) == "TRUE").withColumn("name", strip(text("court_name")))
    dim = dimension(spark, names, "name string, source string").drop("ord")
    order = F.array(*[F.lit(s) for s in preferred])
    out = active.join(F.broadcast(dim), "name").groupBy("source").agg(F.min_by("start_date", "row").alias("start_date"), F.min_by("end_date", "row").alias("end_date"))
    return out.select("source", F.array_position(order, F.col("source")).alias("ord"), config_date("start_date", today).alias("date_from"), config_date("end_date", today).alias("date_to"))


def cluster_systems(spark: SparkSession, first_row: tuple[str, ...], second_row: tuple[str, ...]) -> int:
    """The number of systems of a configuration with headers, or of its first cell in the older layout."""
    cells = dimension(spark, list(zip(first_row, second_row, strict=True)), "head string, value string")
    head = spark.createDataFrame([(first_row[0], first_row[1] if len(first_row) > 1 else "")], "a string, b string").select(is_header_row("a", "b").alias("h")).first()["h"]
    if not head:
        return spark.createDataFrame([(first_row[0],)], "a string").select(total_systems("a").alias("n")).first()["n"]
    found = cells.where(header_name("head") == "total_systems").select(total_systems("value").alias("n")).first()
    return found["n"] if found else 1


def page_index(cells: DataFrame) -> DataFrame:
    """Court, page_ord and page_id of an index with the columns court, page_ord, formula and raw; blank cells are no pages."""
    return cells.select("court", "page_ord", page_id("formula", "raw").alias("page_id")).where("page_id is not null")


def union_sources(parts: dict[str, DataFrame], order=SOURCES) -> DataFrame:
    """All rows of the sources, with the source's place in the order."""
    out = None
    for name in [s for s in order if s in parts]:
        part = parts[name].withColumn("source", F.lit(name)).withColumn("source_ord", F.lit(order.index(name)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no known source")
    return out


def districts(states: DataFrame) -> DataFrame:
    """The district commissions of the states; ``states`` has state and districts, an array of maps with one of several names for id and name."""
    one = states.select("state", F.explode("districts").alias("d"))
    pick = lambda *names: F.coalesce(*[F.when(~is_blank(F.try_element_at("d", F.lit(n))), F.try_element_at("d", F.lit(n))) for n in names])
    found = one.withColumn("id", pick("commissionId", "districtCommissionId", "id", "districtId"))
    name = F.coalesce(pick("commissionNameEn", "districtNameEn", "districtName", "name"), F.col("id"))
    return found.where("id is not null").select("id", F.concat(F.lit("DCDRC - "), name, F.lit(" ("), F.col("state"), F.lit(")")).alias("name"))
