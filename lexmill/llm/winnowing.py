"""Document fingerprints by winnowing.

Rolling hashes of all k-grams of code points; of each window of ``window`` hashes the least is kept, the rightmost one where it occurs more than once.
Two texts that share a run of ``window + k - 1`` code points share a kept hash, and its position in each is kept.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import bound_batches, cut_lineage, fields, map_rows, shuffle_parts

_BASE = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)


def rolling_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all runs of ``k`` values, built from runs of doubling length."""
    made, length = None, 0
    run, size = points + np.uint64(1), 1
    while True:
        if k & size:
            if made is None:
                made, length = run, size
            else:
                n = len(points) - length - size + 1
                made = made[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + run[length : length + n]
                length += size
        if length == k:
            break
        n = len(run) - size
        run = run[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + run[size : size + n]
        size *= 2
    made = made ^ (made >> np.uint64(29))
    made = made * np.uint64(0xBF58476D1CE4E5B9 & _WORD)
    return made >> np.uint64(32)


def winnow(text: str, k: int = 16, window: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) that are kept of a text. A text of under ``k`` code points has one hash, of the whole text; an empty one has none."""
    points = code_points(text)
    if not len(points):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    hashes = rolling_hashes(points, min(k, len(points)))
    n = len(hashes)
    least = (hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    done, wide = 1, min(window, n)
    while done < wide:
        step = min(done, wide - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    keep = np.append(True, least[1:] != least[:-1])
    least = least[keep]
    return (least >> np.uint64(32)).astype(np.uint32), (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """The number of kept hashes and a digest of them with their positions."""
    packed = hashes.astype("<u4").tobytes() + positions.astype("<u4").tobytes()
    return f"{len(hashes)}:{hashlib.blake2b(packed, digest_size=16).hexdigest()}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of two sets of sorted distinct hashes (Jaccard); 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, k: int = 16, window: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, hashes and positions that winnowing keeps. Null and empty texts have none; repeated rows have a row each; other columns are not read."""
    schema = fields(docs, id_col, hashes=T.ArrayType(T.LongType()), positions=T.ArrayType(T.LongType()))

    def make():
        def work(cols: dict[str, list]) -> dict:
            kept = [winnow(x or "", k, window) for x in cols[text_col]]
            return {id_col: cols[id_col], "hashes": [h.astype("int64").tolist() for h, _ in kept], "positions": [p.tolist() for _, p in kept]}

        return work

    return map_rows(docs.select(id_col, text_col), schema, make)


def edited_text(text: str, following: str) -> str:
    """The last floor(n/4) code points replaced by the first as many, or all, of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _place(known, doc, mark) -> tuple:
    """What rows are ordered by: null ids first, then the id (a NaN after all numbers), then a digest of the text."""
    if not known:
        return (False, False, b"", mark)
    return (True, doc != doc, "" if doc != doc else doc, mark)


def fingerprint_changes(docs: DataFrame, k: int = 16, window: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edited text, with their likeness to one another and to the next document's.

    The next document is the one with the next id in ascending order, the first one after the last. Rows of one id are ordered by a digest of the text; null ids
    come first. Null texts are empty. Ids of any type that can be ordered are dealt by ranges of id and digest, found on a table of these alone, and texts are
    shuffled once; the row after the last of a range is sent to that range as well. Rows that are equal in id and text and more than a range should hold travel once
    for each task that has them, with their number.
    """
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    kind = docs.schema[id_col].dataType
    mark = F.md5(F.col("_text"))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).withColumn("_mark", mark)
    schema = fields(docs, id_col, n_chars=T.LongType(), edited_sha256=T.StringType(), fingerprint=T.StringType(), edited_fingerprint=T.StringType(), near_edited=T.DoubleType(), near_next=T.DoubleType())

    counted = rows.groupBy("_id", "_mark").agg(F.count("*").alias("_n"))
    ranged = cut_lineage(counted.repartitionByRange(parts, F.col("_id").asc_nulls_first(), "_mark").withColumn("_part", F.spark_partition_id()))
    total = ranged.agg(F.sum("_n")).first()[0]
    if not total:
        return spark.createDataFrame([], schema)
    least = ranged.groupBy("_part").agg(F.min(F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id").alias("id"), F.col("_mark").alias("mark"))).alias("f")).collect()
    heads = sorted((r["f"] for r in least), key=lambda f: _place(*f))  # one a range
    bounds = [_place(*f) for f in heads]
    # A row that is there this often is sent once by each task: there are at most 4 * parts of these, which are broadcast.
    often = ranged.where(F.col("_n") > max(8, total // (4 * parts))).select("_id", "_mark", "_n")
    crowd = [(r["_id"], r["_mark"], r["_n"]) for r in often.collect()]

    @F.arrow_udf(T.IntegerType())
    def part_of(ids: pa.Array, marks: pa.Array) -> pa.Array:
        found = (bisect_right(bounds, _place(i is not None, i, m)) - 1 for i, m in zip(ids.to_pylist(), marks.to_pylist(), strict=True))
        return pa.array([max(0, x) for x in found], pa.int32())

    bound_batches(spark)
    if crowd:
        crowd_schema = T.StructType([T.StructField("_id", kind), T.StructField("_mark", T.StringType()), T.StructField("_n", T.LongType())])
        known = F.broadcast(spark.createDataFrame(crowd, crowd_schema).withColumnsRenamed({"_id": "_i", "_mark": "_m"}))
        joined = rows.join(known, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")), "left")
        once = joined.where("_n is not null").groupBy("_id", "_mark").agg(F.first("_text").alias("_text"), F.first("_n").alias("_n"))
        rows = joined.where("_n is null").select("_id", "_text", "_mark", F.lit(1).cast("long").alias("_n")).unionByName(once)
    else:
        rows = rows.withColumn("_n", F.lit(1).cast("long"))
    cut = rows.withColumn("_part", part_of("_id", "_mark"))
    # The first row of each range follows the last row of the range before it; that of the first range, the last of all.
    before = [(f["id"], f["mark"], (i or len(heads)) - 1) for i, f in enumerate(heads)]
    to = F.broadcast(spark.createDataFrame(before, T.StructType([T.StructField("_i", kind), T.StructField("_m", T.StringType()), T.StructField("_to", T.IntegerType())])))
    tails = cut.join(to, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m"))).select(F.col("_to").alias("_part"), F.lit(True).alias("_tail"), "_id", "_text", "_mark", "_n")
    marked = cut.select("_part", F.lit(False).alias("_tail"), "_id", "_text", "_mark", "_n").unionByName(tails)
    dealt = marked.repartitionById(parts, "_part").sortWithinPartitions("_part", "_tail", F.col("_id").asc_nulls_first(), "_mark")
    out_schema = T.StructType([*schema.fields, T.StructField("_times", T.LongType())])

    def make():
        held: list = []  # the document whose next one is not yet known: part, id, text, fingerprint, how often it is there
        tail_of: list = []

        def one(text: str):
            h, p = winnow(text, k, window)
            return text, digest(h, p), np.unique(h)

        def work(cols: dict[str, list]) -> dict:
            out: dict[str, list] = {f.name: [] for f in out_schema}

            def put(doc, own: tuple, following: tuple, times: int) -> None:
                text, name, marks = own
                changed = edited_text(text, following[0])
                _, other, others = one(changed)
                values = (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), name, other, 1.0 if name == other else likeness(marks, others), 1.0 if name == following[1] else likeness(marks, following[2]), times)
                for n, v in zip(out, values, strict=True):
                    out[n].append(v)

            for p, tail, doc, text, many in zip(cols["_part"], cols["_tail"], cols["_id"], cols["_text"], cols["_n"], strict=True):
                if tail and tail_of == [p]:
                    continue  # a repeated first row was sent more than once
                new = one(text)
                if held and held[0] == p:
                    put(held[1], held[2], new, 1)
                if tail:
                    tail_of[:] = [p]
                    held.clear()
                else:
                    if many > 1:  # all but the last of them are followed by their like
                        put(doc, new, new, many - 1)
                    held[:] = [p, doc, new]
            return out

        return work

    made = map_rows(dealt.select("_part", "_tail", "_id", "_text", "_n"), out_schema, make)
    if crowd:
        made = made.withColumn("_times", F.explode(F.sequence(F.lit(1).cast("long"), "_times")))
    return made.drop("_times")
