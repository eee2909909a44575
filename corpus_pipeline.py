"""A cleaning pipeline over ``documents``: language ID, line dedup, MinHash near-dedup, benchmark decontamination and packing.

Each stage is a function of (spark, docs, sf_dir) that works on all rows its predecessor kept. All but the last return the columns of ``docs``, whatever
these are. ``run`` applies them in turn, each stage's result written as Parquet in the cluster's shared folder, read again, and deleted once the next one has it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import decontam, langid, lines, minhash, packing
from lexmill.llm.common import Written
from lexmill.llm.queries import table, tokenizer_path

#: Documents whose likeliest language is hardly over what it would be if all were as likely are rejected, as are those without a letter. The probabilities are of the
#: learned languages alone, so that a text in another language passes if it looks like one of these.
LEAST_OVER_EVEN = 0.05


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no learned language: null texts, texts without a letter and those whose likeliest language has less than LEAST_OVER_EVEN over 1 / languages.

    The network is fitted on a bounded sample of the rows that have a language; ``lang`` is no input of a decision and stays as it is. Repeated rows have the same fate.
    Without a labelled row there is no network, and nothing is rejected but texts without a letter.
    """
    net = langid.fit(docs)
    found = langid.identify(docs, net, keep=tuple(docs.columns)) if not {"lang_pred", "score"} & set(docs.columns) else None
    if found is None:  # the table has columns of these names itself
        names = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c in ("lang_pred", "score")}
        renamed = docs.withColumnsRenamed(names)
        found = langid.identify(renamed, net, keep=tuple(renamed.columns))
        kept = _speakable(found, net).drop("lang_pred", "score").withColumnsRenamed({v: k for k, v in names.items()})
        return kept.select(*docs.columns)
    return _speakable(found, net).select(*docs.columns)


def _speakable(found: DataFrame, net: langid.Network | None) -> DataFrame:
    if net is None:
        return found.where(F.col("text").rlike(r"\p{L}"))
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= min(1.0, 1 / len(net.labels) + LEAST_OVER_EVEN) - 1e-6))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines stay in the largest document that has them only; documents that lose all their lines go. ``n_chars``, if there, follows the text."""
    out = lines.dedup_lines(docs).where((F.col("_lines.n_dropped") == 0) | (F.length("text") > 0)).drop("_lines")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least id. Of rows that share an id one stays; rows with a null id all do."""
    return minhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of each document that is left, with its sequence and place there."""
    return packing.pack_documents(docs, tokenizer_path(), 2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: SQL can express neither the network nor signatures, alignment and packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Written(spark, "pipeline")
    try:
        docs, before = table(spark, sf_dir, "documents"), None
        for name, stage in STAGES[:-1]:
            docs = tables.write(name, stage(spark, docs, sf_dir))
            if before:
                tables.drop(before)
            before = name
        return STAGES[-1][1](spark, docs, sf_dir)  # packing has read its input when it returns
    finally:
        tables.close()
