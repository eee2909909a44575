"""The queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import chunks, decontam, langid, lines, minhash, packing, quality, suffixes, toxicity, winnowing
from lexmill.llm.common import crc_mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _held_out(fold: int, held: int):
    """A null id counts as held out: its row is never learned from."""
    return F.coalesce(crc_mod("doc_id", fold) == held, F.lit(True)).alias("held_out")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), 2048)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_changes(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", _held_out(5, 0), "score", "predicted")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs)).select("doc_id", _held_out(5, 0), "lang_pred", "score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, trees).select("doc_id", _held_out(4, 2), "score", "predicted")


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "_lines.n_lines", "_lines.n_dropped", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_substrings(table(spark, sf_dir, "documents"), 200)


def op9_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup_chunks(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_winnowing": op3_winnowing,
    "op4_toxicity": op4_toxicity,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_minhash": op8_minhash,
    "op5_suffixes": op5_suffixes,
    "op9_chunks": op9_chunks,
    "op10_lines": op10_lines,
}

ORACLE_SQL: dict[str, str] = {"op8_minhash": minhash.ORACLE, "op10_lines": lines.ORACLE}
