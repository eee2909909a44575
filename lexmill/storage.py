"""The folder that the cluster shares, and cutting lineage in it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the context's checkpoint folder, or the one ``spark.checkpoint.dir`` names. It is a folder of our own in local mode alone, as in tests."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if not known.isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and (context.master or "").split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="lexmill-checkpoint-"))
        known = context._jsc.sc().getCheckpointDir()
    return known.get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """An eager checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
