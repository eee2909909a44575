"""How rows are laid out: long cells over several rows, and pages of a bounded number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.core import text
from lexmill.storage import cut_lineage

#: Characters of a stored cell and of a result's cell.
STORE_LIMIT, RESULT_LIMIT = 49_000, 50_000
#: Rows of a page, with its header.
PAGE_ROWS = 35_000


def as_text(df: DataFrame, column: str):
    """Nested values as JSON with their nulls, the others as text; null is empty."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.to_json(F.col(column), {"ignoreNullFields": "false"}), F.lit(""))
    return text(column)


def split_overflow(rows: DataFrame, columns: list[str], limit: int = STORE_LIMIT, part: str = "part_no") -> DataFrame:
    """K4, K5: as many rows as the longest cell has parts of ``limit`` characters. Part 0 has the short cells whole; later parts have what is left of the long ones and are else empty.

    Other columns are repeated on every part; ``part_no`` counts from 0.
    """
    shown = rows.select(*[c for c in rows.columns if c not in columns], *[as_text(rows, c).alias(c) for c in columns])
    longest = F.greatest(F.lit(1), *[F.ceil(F.length(c) / F.lit(limit)).cast("int") for c in columns]) if columns else F.lit(1)
    parts = shown.withColumn(part, F.explode(F.sequence(F.lit(0), longest - 1)))
    cut = [F.when(F.length(c) > limit, F.substring(F.col(c), F.col(part) * limit + 1, F.lit(limit))).when(F.col(part) == 0, F.col(c)).otherwise(F.lit("")).alias(c) for c in columns]
    return parts.select(*[c for c in rows.columns if c not in columns], part, *cut)


def join_overflow(parts: DataFrame, key: list[str], columns: list[str], part: str = "part_no") -> DataFrame:
    """The rows before they were split: parts of each cell in order, by the rows' key."""
    gathered = parts.groupBy(*key).agg(*[F.sort_array(F.collect_list(F.struct(part, c))).alias(c) for c in columns])
    return gathered.select(*key, *[F.array_join(F.col(f"{c}.{c}"), "").alias(c) for c in columns])


def running_sum(rows: DataFrame, order: list[str], value, name: str) -> DataFrame:
    """The sum of ``value`` over the rows before each in a total order, without all rows in one task.

    Rows are sorted into ranges; the ranges' sums, one row each, are added up and joined back. The ranges are written first, as they must not fall otherwise in the second pass.
    """
    ranged = cut_lineage(rows.withColumn("_v", value).repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumn("_own", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    sizes = ranged.groupBy("_part").agg(F.sum("_v").alias("_size"))
    before = sizes.withColumn("_base", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_size")
    return own.join(F.broadcast(before), "_part").withColumn(name, (F.col("_base") + F.col("_own")).cast("long")).drop("_part", "_own", "_base", "_v")


def number_rows(rows: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """Row numbers from 0 in a total order."""
    return running_sum(rows, order, F.lit(1), name)


def paginate_groups(groups: DataFrame, size: str, order: list[str], largest: int, page_rows: int = PAGE_ROWS) -> DataFrame:
    """K2 with groups of at most ``largest`` rows kept together: page_no by where a group starts, on pages that leave room for the largest one to end."""
    room = page_rows - largest
    if room < 1:
        raise ValueError("a page must hold the largest group")
    return running_sum(groups, order, F.col(size), "_start").withColumn("page_no", F.floor(F.col("_start") / room).cast("long")).drop("_start")


def paginate(numbered: DataFrame, number: str = "n", existing: int = 0, page_rows: int = PAGE_ROWS) -> DataFrame:
    """page_no and the row on it, of rows that are numbered from 0, after ``existing`` ones; a page holds one row less than ``page_rows``, for its header."""
    cap = page_rows - 1
    at = F.col(number) + existing
    return numbered.withColumn("page_no", F.floor(at / cap).cast("long")).withColumn("page_row", (at % cap + 2).cast("long"))


def write_pages(paged: DataFrame, path: str, by: list[str], mode: str = "append") -> None:
    """K2, K3: one folder for each court and page; ``mode`` is overwrite to clear, or append."""
    paged.write.mode(mode).partitionBy(*by).parquet(path)


def result_batches(numbered: DataFrame, number: str = "n", rows: int = 10_000) -> DataFrame:
    """The batch of a result's row."""
    return numbered.withColumn("batch", F.floor(F.col(number) / rows).cast("long"))
