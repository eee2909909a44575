"""Connected components of a table of links, without bringing any of it to the driver."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lexmill.llm.common import cut_lineage

#: Links that a task contracts at most, about.
TASK_LINKS = 500_000


def _contract(edges: DataFrame, parts: int) -> DataFrame:
    """Each of ``parts`` partitions of links (u, v) as stars: every node but the least of its group there points to that one."""
    schema = to_arrow_schema(edges.schema)

    def run(batches):
        up: dict = {}

        def top(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                p, q = top(up.setdefault(u, u)), top(up.setdefault(v, v))
                if p != q:
                    up[max(p, q)] = min(p, q)
        pairs = [(u, top(u)) for u in up]
        pairs = [(u, v) for u, v in pairs if u != v]
        for at in range(0, len(pairs), 50_000):
            part = pairs[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in part], f.type) for i, f in enumerate(schema)], schema=schema)

    return edges.coalesce(parts).mapInArrow(run, edges.schema)


def components(links: DataFrame, a: str = "a", b: str = "b", task_links: int = TASK_LINKS, most_rounds: int = 60) -> DataFrame:
    """(node, component): the least node that each linked node can reach.

    Tasks contract the links they hold into stars, about ``task_links`` each. If one task was enough, these are the components; else large-star and
    small-star steps follow, whose minima are partial sums first and whose joins back are on keys that have one row on the other side, so that a node with very many
    links is not gathered in one place; and so on until nothing changes. An empty table has no rows; a null link is ignored. It raises if ``most_rounds`` do not settle it.
    """
    edges = cut_lineage(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = None
    for _ in range(most_rounds):
        parts = max(1, -(-edges.count() // task_links))
        if parts == 1:
            return _labelled(cut_lineage(_contract(edges, 1)))
        edges = cut_lineage(_contract(edges, parts))
        # Large star: the larger neighbours of a node point to the least of its neighbours and itself.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.select(F.col("u").alias("x"), F.col("v").alias("y")).where("y > x").join(least.withColumnRenamed("u", "x"), "x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: a node and its smaller neighbours point to the least of these.
        joined = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        edges = cut_lineage(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(joined.select("u", F.col("m").alias("v"))).distinct())
        was, mark = mark, _mark(edges)
        if was == mark:
            return _labelled(edges)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _labelled(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """A count and two sums of hashes that tell two tables of links apart."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s"), F.expr("bit_xor(xxhash64(v, u, 3))").alias("x")).first()
    return row["n"], row["s"], row["x"]
