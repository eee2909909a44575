"""Shards, grids of work and how far each has come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.operators.layout import number_rows
from lexmill.schema import NCLT_BENCHES, NCLT_PARTY_TYPES, NCLT_STATUSES, dimension


def assign_shards(items: DataFrame, order: list[str], total: int, by: list[str] | None = None) -> DataFrame:
    """``shard`` from 1, even and contiguous in the total order; the first shards are larger by one where they cannot all be even. One or fewer shards: all items in the first.

    All items are numbered by range counts, so that no task holds them all; with ``by`` each group, which one task holds, is dealt on its own.
    """
    if total <= 1:
        return items.withColumn("shard", F.lit(1))
    if by:
        return items.withColumn("shard", F.ntile(total).over(Window.partitionBy(*by).orderBy(*order)))
    numbered = number_rows(items, order, "_n")
    least, more = divmod(numbered.count(), total)
    n, large = F.col("_n"), more * (least + 1)
    shard = F.when(n < large, F.floor(n / F.lit(least + 1))).otherwise(more + F.floor((n - large) / F.lit(max(1, least))))
    return numbered.withColumn("shard", (shard + 1).cast("int")).drop("_n")


def slice_for(items: DataFrame, order: list[str], shard: int, total: int) -> DataFrame:
    """One shard's items; none for a number over the total."""
    return assign_shards(items, order, total).where(F.col("shard") == shard).drop("shard")


def grid(*parts: DataFrame) -> DataFrame:
    """All combinations of small dimensions, each with its ``ord``, in nested order as ``unit`` from 0 (the last part turns fastest)."""
    out, unit = None, F.lit(0)
    for i, p in enumerate(parts):
        n = p.count()
        named = p.withColumnRenamed("ord", f"_ord{i}")
        out = named if out is None else out.crossJoin(F.broadcast(named))
        unit = unit * n + F.col(f"_ord{i}")
    return out.withColumn("unit", unit).drop(*[f"_ord{i}" for i in range(len(parts))])


def years(spark: SparkSession, first: int, last: int, down: bool = False) -> DataFrame:
    return dimension(spark, [(y,) for y in (range(last, first - 1, -1) if down else range(first, last + 1))], "year int")


def nclt_grid(spark: SparkSession, company: str, first_year: int, last_year: int) -> DataFrame:
    """The searches of one company: benches, years, party types and statuses."""
    return grid(
        dimension(spark, NCLT_BENCHES, "bench_id int, bench_name string, bench_short string"),
        years(spark, first_year, last_year),
        dimension(spark, NCLT_PARTY_TYPES, "pt_code string, pt_label string"),
        dimension(spark, NCLT_STATUSES, "st_code string, st_label string"),
    ).withColumn("company", F.lit(company))


def remaining(units: DataFrame, progress: DataFrame, by: list[str]) -> DataFrame:
    """T4: the units after the last one done, by the keys of the progress table (``unit`` there is the last done); all where none is known."""
    done = progress.select(*by, F.col("unit").alias("_done"))
    return units.join(done, by, "left").where(F.col("_done").isNull() | (F.col("unit") > F.col("_done"))).drop("_done")


def realign(progress: DataFrame, assigned: DataFrame, owner: list[str], item: list[str]) -> DataFrame:
    """T5: progress after shards were dealt anew: kept where its item is still the owner's, else from the start (unit -1)."""
    mine = assigned.select(*owner, *item).distinct().withColumn("_mine", F.lit(True))
    return progress.join(mine, [*owner, *item], "left").withColumn("unit", F.when(F.col("_mine"), F.col("unit")).otherwise(F.lit(-1))).drop("_mine")


def to_retry(states: DataFrame, state: str = "state", tries: str = "tries", most: int = 3) -> DataFrame:
    """The units whose last state may be tried again, at most ``most`` times."""
    return states.where((F.col(state) == "retryable_error") & (F.col(tries) < most))


def round_robin(items: DataFrame, order: list[str], n: int, by: list[str]) -> DataFrame:
    """Turns in order, within the groups of ``by``."""
    return items.withColumn("turn", F.pmod(F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1, F.lit(n)))


def strided(start: Column, worker: Column, workers: Column, count: int) -> Column:
    """The first numbers of one of several workers that take turns."""
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: start + worker + i * workers)
