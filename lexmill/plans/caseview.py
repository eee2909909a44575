"""A deterministic table of case rows made from the order tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

#: Every seventh order continues the row before it; every fifth has no unique id; one in eleven repeats an earlier one's.
CASES = """
SELECT
  page_id, row_no, k,
  CASE WHEN cont THEN '' ELSE court END AS courtType,
  CASE WHEN cont THEN '' ELSE bench END AS benchName,
  CASE WHEN cont THEN '' ELSE cast(k AS string) END AS caseNumber,
  CASE WHEN cont THEN '' ELSE reg END AS registrationDate,
  CASE WHEN cont THEN '' ELSE state END AS caseStatus,
  CASE WHEN cont THEN '' ELSE pet END AS petitioner,
  CASE WHEN cont THEN '' ELSE res END AS respondent,
  CASE WHEN cont OR k % 4 <> 0 THEN '' ELSE concat('Shri Ram ', bench) END AS otherPetitioner,
  '' AS otherRespondent,
  CASE WHEN cont THEN '' ELSE 'CS - CIVIL SUIT' END AS caseType,
  CASE WHEN cont OR k % 5 = 0 THEN '' WHEN k % 11 = 0 THEN concat('DC|', cast(k % 77 AS string)) ELSE concat('dc|', cast(k AS string)) END AS uniqueness,
  CASE WHEN cont OR k % 3 = 0 THEN '["09 JAN 2025"]' ELSE '' END AS listingHistory
FROM (
  SELECT
    cast((o.o_orderkey - o.o_orderkey % 500) / 500 AS bigint) AS page_id, cast(o.o_orderkey % 500 + 2 AS bigint) AS row_no, o.o_orderkey AS k, o.o_orderkey % 7 = 3 AS cont,
    CASE o.o_orderkey % 3 WHEN 0 THEN 'District Court' WHEN 1 THEN 'High Court' ELSE 'NCLT' END AS court, n.n_name AS bench,
    CASE o.o_orderkey % 4
      WHEN 0 THEN concat(lpad(cast(day(o.o_orderdate) AS string), 2, '0'), '-', lpad(cast(month(o.o_orderdate) AS string), 2, '0'), '-', cast(year(o.o_orderdate) AS string))
      WHEN 1 THEN concat(cast(year(o.o_orderdate) AS string), '-', cast(month(o.o_orderdate) AS string), '-', cast(day(o.o_orderdate) AS string), ' 10:30:00')
      WHEN 2 THEN concat(cast(day(o.o_orderdate) AS string), '/', cast(month(o.o_orderdate) AS string), '/', cast(year(o.o_orderdate) AS string))
      ELSE 'NA' END AS reg,
    CASE o.o_orderstatus WHEN 'F' THEN 'Disposed Off' WHEN 'O' THEN ' Pending ' ELSE 'dismissed in default' END AS state,
    concat(CASE o.o_orderkey % 3 WHEN 0 THEN 'M/S ' WHEN 1 THEN '1. ' ELSE '' END, c.c_mktsegment, ' ', cast(c.c_custkey % 50 AS string), ' Traders',
      CASE o.o_orderkey % 5 WHEN 0 THEN ' Pvt Ltd' WHEN 1 THEN ' PRIVATE LIMITED' WHEN 2 THEN ' & Ors.' WHEN 3 THEN ' LIMITED Mumbai' ELSE '' END) AS pet,
    CASE WHEN o.o_orderkey % 2 = 0 THEN concat('"', s.s_name, ' LTD", "Smt. Sita ', n.n_name, '"') ELSE concat(s.s_name, ' Ltd, R/O ', n.n_name, ', Hari Das AND 3 ORS') END AS res
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {supplier} s ON s.s_suppkey = o.o_orderkey % 10
) v
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(scan: DataFrame) -> DataFrame:
    """A table dealt evenly before costly work on each row, if it has fewer partitions than there are cores, as a small file has; a large one stays as it is read."""
    own = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return scan.repartition(parts(scan.sparkSession)) if own < scan.sparkSession.sparkContext.defaultParallelism else scan


def case_view(spark: SparkSession, sf_dir: str, costly: bool = False) -> DataFrame:
    """The case rows, as they come: what needs the rows of a page together deals them by page itself. ``costly``: there is much work on each row, see spread."""
    given = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in CASES}
    if costly:
        given["orders"] = spread(given["orders"])
    return spark.sql(CASES, **given)


def plain(text: str) -> str:
    """The same SQL for an engine that has the tables under their names."""
    for t in TABLES:
        text = text.replace(f"{{{t}}}", t)
    return text


CASES_PLAIN = plain(CASES)
