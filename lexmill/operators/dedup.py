"""Keys of rows: audits of duplicates, cleaning, and appends of what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lexmill.functions.cases import dedup_key
from lexmill.functions.core import is_blank, strip, text
from lexmill.operators.continuation import row_groups
from lexmill.schema import KEY_FIELDS
from lexmill.storage import cut_lineage, delete


def key_of(df: DataFrame) -> Column:
    """F13 over the key fields that are there."""
    return dedup_key(*[F.col(c) if c in df.columns else F.lit("") for c in KEY_FIELDS])


def keyed_groups(rows: DataFrame, page: str = "page_id", row: str = "row_no") -> DataFrame:
    groups = row_groups(rows, page, row)
    return groups.withColumn("key", key_of(groups))


def audit(groups: DataFrame, page: str = "page_id", order: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The groups whose key stands earlier, by page order and then row, with the first one's place. Blank keys are none.

    Firsts are partial minima before they are shuffled, and the join back is against one row a key, so a key that very many groups share is not gathered in one task.
    """
    known = groups.where(F.col("key") != "")
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate((*order, "start_row"))])
    firsts = known.groupBy("key").agg(F.min(F.struct(place.alias("place"), F.col(page).alias("page"), F.col("start_row").alias("start"))).alias("_first"))
    later = known.join(firsts, "key").where(place != F.col("_first.place"))
    return later.withColumn("first_page", F.col("_first.page")).withColumn("first_start", F.col("_first.start")).drop("_first")


def audit_counts(groups: DataFrame) -> DataFrame:
    """Groups, distinct keys and duplicates, of those with a key."""
    return groups.where(F.col("key") != "").agg(F.count("*").alias("logical_rows"), F.count_distinct("key").alias("unique_keys"), (F.count("*") - F.count_distinct("key")).alias("duplicates"))


def coalesce_ranges(ranges: DataFrame, page: str = "page_id", start: str = "start_row", end: str = "end_row") -> DataFrame:
    """Ranges of rows that touch or overlap as one, by page."""
    by = Window.partitionBy(page).orderBy(start, end)
    before = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = ranges.withColumn("_new", (before.isNull() | (F.col(start) > before + 1)).cast("int"))
    island = new.withColumn("_island", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(page, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def range_totals(ranges: DataFrame, page: str = "page_id", start: str = "start_row", end: str = "end_row") -> DataFrame:
    """A10: ranges and rows to delete, by page."""
    return ranges.groupBy(page).agg(F.count("*").alias("ranges"), F.sum(F.col(end) - F.col(start) + 1).alias("deleted_rows"))


def page_lists(duplicates: DataFrame, page: str = "page_id") -> DataFrame:
    """By page, its duplicates in order. A page is bounded by the store, and with it the list."""
    return duplicates.groupBy(page).agg(F.sort_array(F.collect_list(F.struct("start_row", "end_row", "key"))).alias("duplicates"))


def delete_duplicates(rows: DataFrame, page: str = "page_id", row: str = "row_no", order: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The rows without all groups that repeat an earlier one's key."""
    ranges = coalesce_ranges(audit(keyed_groups(rows, page, row), page, order), page)
    gone = ranges.select(page, F.explode(F.sequence("start_row", "end_row")).alias(row))
    return rows.join(gone, [page, row], "left_anti")


def first_of(rows: DataFrame, key: str, order: list[str], keep_blank: bool = False) -> DataFrame:
    """The first row of each key in a total order, by partial minima. Rows with a blank key go, or with ``keep_blank`` all stay."""
    known = rows.where(~is_blank(key))
    firsts = known.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")).select("_row.*")
    return firsts.unionByName(rows.where(is_blank(key))) if keep_blank else firsts


def new_rows(batch: DataFrame, stored: DataFrame, order: list[str], key: str = "key") -> DataFrame:
    """The first row of each key of a batch that is not stored yet, without ``key`` blank."""
    return first_of(batch, key, order).join(stored.select(key), key, "left_anti")


def known_keys(*tables: DataFrame, key: str = "key") -> DataFrame:
    """The distinct keys of caches and pages."""
    out = tables[0].select(key)
    for t in tables[1:]:
        out = out.union(t.select(key))
    return out.where(~is_blank(key)).distinct()


def read_keys(spark, path: str) -> DataFrame:
    """Keys of a cache, one a line; blank lines are none."""
    return spark.read.text(path).select(strip(text("value")).alias("key")).where("key != ''")


def write_keys(keys: DataFrame, path: str, key: str = "key") -> None:
    """K7: sorted keys, one a line, by a range partitioning that spreads them."""
    keys.select(F.col(key).alias("value")).where(~is_blank("value")).distinct().orderBy("value").write.mode("overwrite").text(path)


def case_numbers(rows: DataFrame, column: str = "caseNumber") -> DataFrame:
    """The distinct case numbers that are not blank."""
    return rows.select(strip(text(column)).alias(column)).where(F.col(column) != "").distinct()


#: Folders that a store's rows are dealt to by their key.
BUCKETS = 16


def write_cases(batch: DataFrame, path: str, order: list[str], batch_id: int | None = None) -> int:
    """Appends the new rows of a batch to the store, a Parquet table with the columns ``key`` and ``bucket``; returns how many.

    Rows lie in folders by a hash of their key, and a batch reads the keys of its own buckets alone, anew each time. Keys are read from the rows themselves, so they
    are stored exactly when the rows are. With a ``batch_id`` the rows land in that batch's own folders, which a retry replaces: the rows of other batches alone count
    as stored then. The buckets of the batch, at most BUCKETS numbers, reach the driver.
    """
    spark = batch.sparkSession
    keyed = batch if "key" in batch.columns else batch.withColumn("key", key_of(batch))
    firsts = cut_lineage(first_of(keyed, "key", order).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")))
    touched = [r["bucket"] for r in firsts.select("bucket").distinct().collect()]
    try:
        stored = spark.read.parquet(path).where(F.col("bucket").isin(touched))
    except Exception as error:  # nothing is stored yet
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        stored = None
    if stored is not None and batch_id is not None:
        stored = stored.where(F.col("batch_id") != batch_id)
    fresh = firsts if stored is None else firsts.join(stored.select("key", "bucket"), ["key", "bucket"], "left_anti")
    seen = Observation()
    folders = ["bucket"]
    if batch_id is not None:
        fresh, folders = fresh.withColumn("batch_id", F.lit(batch_id).cast("long")), ["batch_id", "bucket"]
        delete(spark, f"{path}/batch_id={batch_id}")  # what an earlier try of this batch left
    fresh.select(*keyed.columns, *folders).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy(*folders).parquet(path)
    return seen.get["n"]
