"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from lexmill.storage import delete, shared_folder

#: The bytes that count as white space in words and line keys: space, and tab to carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def _release(spark: SparkSession) -> None:
    """Spark deletes shuffle files once the driver has collected the plans they belong to as garbage, which a driver with much memory seldom does."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame, release: bool = False) -> DataFrame:
    """An eager checkpoint in the shared folder. ``release`` asks for the release of shuffle files first, so that a job of several large steps does not keep those of all."""
    shared_folder(df.sparkSession)
    if release:
        _release(df.sparkSession)
    return df.checkpoint(eager=True)


class Written:
    """Named tables of one job, as Parquet in the shared folder. Each is deleted when it is dropped."""

    def __init__(self, spark: SparkSession, job: str) -> None:
        self.spark, self.at = spark, f"{shared_folder(spark)}/{job}-{uuid.uuid4().hex}"

    def write(self, name: str, df: DataFrame, release: bool = False) -> DataFrame:
        if release:
            _release(self.spark)
        df.write.parquet(f"{self.at}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.at}/{name}")

    def drop(self, *names: str) -> None:
        """For tables that no later step reads."""
        for n in names:
            delete(self.spark, f"{self.at}/{n}")

    def close(self) -> None:
        delete(self.spark, self.at)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def crc_mod(doc_id: str, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(mod)


def fields(df: DataFrame, *names: str, **more: T.DataType) -> T.StructType:
    """A schema: the named columns of ``df`` as they are, then new ones."""
    return T.StructType([T.StructField(n, df.schema[n].dataType, True) for n in names] + [T.StructField(n, t, True) for n, t in more.items()])


def give_back() -> None:
    """Returns freed memory to the system. Python workers live on from task to task and would else hold the most that any task needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # the C library is not glibc
        ctypes.CDLL(None).malloc_trim(0)


#: Bytes of an Arrow batch on its way to a Python worker; Spark's own limit is 10,000 rows of any size.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, so that long texts make no large ones in the memory of the JVM and the worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def text_column(spark: SparkSession, text: Column, kind: T.DataType, make: Callable[[], Callable[[list], list]], rows: int = 256) -> Column:
    """A column that a function of slices of at most ``rows`` texts gives. The texts alone go to Python and its results alone come back; other columns stay where they are.

    ``make`` runs once in each worker.
    """
    bound_batches(spark)
    made, held = to_arrow_type(kind), []

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(make())
        out = []
        for at in range(0, len(texts), rows):
            out += held[0](texts.slice(at, rows).to_pylist())
        give_back()
        return pa.array(out, made)

    return run(text)


def map_rows(df: DataFrame, schema: T.StructType, make: Callable[[], Callable[[dict[str, list]], dict]], rows: int = 256) -> DataFrame:
    """Applies a function of column lists to slices of at most ``rows`` rows, so that memory follows the slice and not the Arrow batch.

    ``make`` runs once in each task and returns the function; what it returns has one list or array for each field of ``schema``, of any common length.
    """
    bound_batches(df.sparkSession)
    names = df.columns
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                made = work({n: piece.column(i).to_pylist() for i, n in enumerate(names)})
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type, from_pandas=False) for f in out], schema=out)
                del made, piece
            del batch
        del work
        give_back()

    return df.mapInArrow(run, schema)
