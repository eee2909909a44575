"""Ranks of rows by a sort of pairs that is spread over all tasks: the step that a prefix doubling repeats.

Spark deals the rows into ranges of their pairs and sorts each; a pass over the sorted stream numbers the runs of equal pairs and drops the rows that are alone.
Ties are broken by the rows' places, so that a pair that a third of all rows have fills many ranges. The first and the last row of each range tell which runs go on
from one range to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexmill.llm.common import Written, bound_batches, give_back, shuffle_parts

_SHIFT = 40


def _stream(by: list[str], place: list[str], kept: list[str], schema: pa.Schema, keep_alone: bool):
    """Over one sorted range: rank, whether a row is alone, whether it is at its run's first place, and the pair and first place of the range's first and last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.int64(TaskContext.get().partitionId()) << np.int64(_SHIFT)
        held: pa.Table | None = None  # the last row, which the next batch may equal
        same_before, number, first = False, 0, True
        began = np.zeros((1, len(place)), np.int64)  # the first place of the held row's run

        def numbers(table: pa.Table, names: list[str]) -> np.ndarray:
            return np.stack([table.column(n).to_numpy().astype(np.int64) for n in names], axis=1) if names else np.zeros((table.num_rows, 0), np.int64)

        def made(table: pa.Table, pairs: np.ndarray, ranks: np.ndarray, alone: np.ndarray, lead: np.ndarray, starts: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
            wanted = ~lead | (ranks == base) if place else ~alone  # rows of the first run may go on from the range before
            at = np.flatnonzero(np.ones(len(alone), bool) if keep_alone else wanted | edge)
            columns = [table.column(n).take(pa.array(at)).combine_chunks() for n in kept]
            marks = [[*pairs[i].tolist(), *starts[i].tolist()] if edge[i] else None for i in at] if edge[at].any() else [None] * len(at)
            return pa.RecordBatch.from_arrays([*[c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], pa.array(ranks[at]), pa.array(alone[at]), pa.array(lead[at]), pa.array(marks, schema.field("edge").type)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            pairs, places = numbers(table, by), numbers(table, place)
            equal = (pairs[1:] == pairs[:-1]).all(axis=1)
            ranks = base + number + np.append(0, np.cumsum(~equal))
            before = np.append(same_before, equal)
            # Where each row's run begins: in this batch, or, for the run of the held row, where that began.
            opens = np.append(0, np.flatnonzero(~equal) + 1)
            starts = places[opens[ranks - ranks[0]]]
            if held is not None:
                starts[ranks == ranks[0]] = began
            lead = (places == starts).all(axis=1)
            n = len(pairs) - 1
            if n:
                edge = np.zeros(n, bool)
                edge[0] = first
                yield made(table.slice(0, n), pairs[:n], ranks[:n], ~(before[:n] | equal), lead[:n], starts[:n], edge)
                first = False
            held, same_before, number, began, last = table.slice(n), bool(before[n]), int(ranks[n] - base), starts[n:], (pairs[n:], lead[n:])
        if held is not None:
            yield made(held, last[0], np.array([base + number]), np.array([not same_before]), last[1], began, np.array([True]))
        give_back()

    return run


def _joined(edges: list, pair: int) -> list[tuple[int, int, bool]]:
    """(rank, new rank, whether the first place is the same) of the runs that reach over an edge between two ranges; ``edges`` are the first and last rows of the ranges."""
    out: dict[int, tuple[int, bool]] = {}
    root: dict[int, list] = {}
    edges = sorted(edges, key=lambda r: r["rank"])
    for a, b in zip(edges, edges[1:], strict=False):
        if a["rank"] >> _SHIFT != b["rank"] >> _SHIFT and a["edge"][:pair] == b["edge"][:pair]:
            if a["rank"] not in out:
                out[a["rank"]], root[a["rank"]] = (a["rank"], True), a["edge"][pair:]
            head = out[a["rank"]][0]
            out[b["rank"]] = head, b["edge"][pair:] == root[head]
    return [(k, *v) for k, v in out.items()]


def rerank(tables: Written, name: str, rows: DataFrame, by: list[str], ties: list[str], keep_alone: bool = False, place: list[str] | None = None) -> DataFrame:
    """``rows`` without the columns ``by``, with ``rank``, equal where all of ``by`` are equal and in their order, and ``alone``, true where no other row has them.

    ``by`` are columns of 64-bit numbers without nulls. Rows that are alone are dropped unless ``keep_alone``. ``ties`` order equal rows and spread them over ranges.
    With ``place``, the last of ``ties``, whole numbers that name a row, only rows at another place than the first of their equals are returned. ``rows`` is read
    twice, once to find the ranges. What reaches the driver is two rows a range. The table ``name`` is written and the caller's to drop.
    """
    spark, place = rows.sparkSession, place or []
    bound_batches(spark)
    made = ("rank", "alone", "lead", "edge")
    kept = [c for c in rows.columns if c not in (*by, *made)]
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField("rank", T.LongType()), T.StructField("alone", T.BooleanType()), T.StructField("lead", T.BooleanType()), T.StructField("edge", T.ArrayType(T.LongType()))])
    ordered = rows.repartitionByRange(shuffle_parts(spark), *by, *ties).sortWithinPartitions(*by, *ties)
    out = tables.write(name, ordered.mapInArrow(_stream(by, place, kept, to_arrow_schema(schema), keep_alone), schema))
    fixes = _joined(out.where("edge is not null").select("rank", "edge").collect(), len(by))
    out = out.drop("edge")
    if fixes:
        fix = F.broadcast(spark.createDataFrame(fixes, "rank long, _rank long, _same boolean").coalesce(1))
        out = out.join(fix, "rank", "left").select(*kept, F.coalesce("_rank", "rank").alias("rank"), (F.col("alone") & F.col("_rank").isNull()).alias("alone"), (F.col("lead") & F.coalesce("_same", F.lit(True))).alias("lead"))
    out = out.where("not lead") if place else out if keep_alone else out.where("not alone")
    return out.drop("lead")
