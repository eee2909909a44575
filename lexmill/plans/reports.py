"""Counts by court, bench and source, and the cells that a result is reported in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.cases import duration
from lexmill.functions.core import text
from lexmill.schema import SOURCE_KEYWORDS, SOURCES, dimension


def court_counts(rows: DataFrame) -> DataFrame:
    """A1: rows by court; a null court is not counted."""
    return rows.where(F.col("courtType").isNotNull()).groupBy("courtType").agg(F.count("*").alias("cases"))


def bench_counts(rows: DataFrame, court: str = "NCLT") -> DataFrame:
    """A2: rows by bench of one court, with the total under the bench TOTAL; nothing where the court has no row."""
    own = rows.where(F.col("courtType") == court)
    rolled = own.rollup("benchName").agg(F.count("*").alias("cases"), F.grouping("benchName").alias("g"))
    return rolled.where("cases > 0").select(F.when(F.col("g") == 1, F.lit("TOTAL")).otherwise(F.col("benchName")).alias("benchName"), "cases")


def high_court_counts(rows: DataFrame, stored: bool = False) -> DataFrame:
    """A3, O1: rows by high court. Only rows spelled HIGH_COURT (name) count; with ``stored``, those of stored pages, spelled High Court, too."""
    is_own = F.col("courtType").contains("HIGH_COURT")
    if stored:
        is_own = is_own | (F.col("courtType") == "High Court")
    label = F.rtrim(F.replace(F.col("courtType"), F.lit("HIGH_COURT ("), F.lit("")), F.lit(")"))
    return rows.where(is_own).groupBy(label.alias("label")).agg(F.count("*").alias("cases"))


def primary_count(rows: DataFrame) -> DataFrame:
    """A4: rows that continue no other."""
    return rows.agg(F.count_if(~F.coalesce(F.col("_is_continuation"), F.lit(False))).alias("primary_rows"))


def _is_source(name: str) -> Column:
    court = F.upper(text("courtType"))
    out = F.lit(False)
    for k in SOURCE_KEYWORDS[name]:
        out = out | court.contains(k)
    return out


def source_counts(rows: DataFrame) -> DataFrame:
    """A5: in one pass, rows of each source by the words in their court; a row may count for more than one."""
    return rows.agg(*[F.count_if(_is_source(s)).alias(s) for s in SOURCES])


def source_rows(rows: DataFrame) -> DataFrame:
    """A5 as rows: source, its place in the order, n."""
    counts = source_counts(rows)
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.lit(i).alias("ord"), F.col(s).alias("n")) for i, s in enumerate(SOURCES)]))
    return counts.select(pairs.alias("p")).select("p.*")


def result_cells(counts: DataFrame, cells: dict[str, str]) -> DataFrame:
    """For each result cell "no", "yes (n)" or, where several sources share it, "yes(a: n, b: m)" in their order."""
    spark = counts.sparkSession
    dim = dimension(spark, list(cells.items()), "source string, cell string").drop("ord")
    own = counts.join(F.broadcast(dim), "source").groupBy("cell").agg(F.sum("n").alias("total"), F.count("*").alias("many"), F.sort_array(F.collect_list(F.struct("ord", "source", "n"))).alias("each"))
    listed = F.array_join(F.transform("each", lambda x: F.concat(x["source"], F.lit(": "), x["n"].cast("string"))), ", ")
    shown = F.when(F.col("total") == 0, F.lit("no")).when(F.col("many") > 1, F.concat(F.lit("yes("), listed, F.lit(")"))).otherwise(F.concat(F.lit("yes ("), F.col("total").cast("string"), F.lit(")")))
    return own.select("cell", shown.alias("result"))


def run_times(runs: DataFrame, source: str = "source", start: str = "started", end: str = "ended") -> DataFrame:
    """Start, end and duration of each source's run, the duration as shown in reports."""
    spanned = runs.groupBy(source).agg(F.min(start).alias("started"), F.max(end).alias("ended"))
    seconds = F.timestamp_diff("SECOND", F.col("started").cast("timestamp"), F.col("ended").cast("timestamp"))
    return spanned.withColumn("seconds", seconds.cast("long")).withColumn("shown", duration(F.col("seconds"), hours=False))


def run_counters(df: DataFrame, name: str, state: str = "state") -> DataFrame:
    """The table itself; while it runs, it observes how many rows started, succeeded, failed and were duplicates."""
    c = F.col(state)
    return df.observe(name, F.count(F.lit(1)).alias("started"), F.count_if(c == "success").alias("success"), F.count_if(c == "failure").alias("failure"), F.count_if(c == "duplicate").alias("duplicate"))
