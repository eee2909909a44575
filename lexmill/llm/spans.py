"""Cutting spans of bytes out of documents, and filters of keys that are sized by what they hold."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexmill.llm.common import bound_batches, cut_lineage, fields, give_back, shuffle_parts


def row_key(id_col: str, text_col: str) -> Column:
    """A 64-bit key of a row by its id and text. Equal rows share it, and with it their spans."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans; spans that touch are one run."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, s[1:] > e[:-1])
    return s[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(e) - 1)]


def cut(data: bytes, starts: np.ndarray, ends: np.ndarray, least: int = 0) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs). Runs of under ``least`` bytes stay, but for one that is the whole text."""
    if not len(starts):
        return data, 0, 0
    s, e = merged(starts, ends)
    if least:
        long = (e - s >= least) | (e - s == len(data))
        s, e = s[long], e[long]
    kept, at = [], 0
    for a, b in zip(s.tolist(), e.tolist(), strict=True):
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept), int((e - s).sum()), len(s)


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, least: int = 0) -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes.

    ``spans`` has (key, start, end) of the rows' keys, in bytes of UTF-8, and may overlap. Rows are joined with their spans; while a filter of the keys is small
    enough to be sent to all tasks, texts that it holds back are not moved for that. Runs of under ``least`` bytes stay (see cut). Null texts are empty.
    """
    bound_batches(docs.sparkSession)
    spans = spans.select("key", "start", "end")
    packed = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("end").cast("long"))
    gathered = spans.groupBy("key").agg(F.collect_list(packed).alias("spans"))
    maybe = key_filter(cut_lineage(spans.select("key").distinct()))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), row_key(id_col, text_col).alias("key"))
    hit = rows.withColumn("_maybe", maybe.test("key") if maybe else F.lit(True))
    joined = hit.where("_maybe").drop("_maybe").join(gathered, "key", "left")
    none = F.lit(None).cast("array<long>")
    extra = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept_sha256": T.StringType()} | ({"kept": T.BinaryType()} if keep_text else {})
    schema = fields(docs, id_col, **extra)
    out_schema = to_arrow_schema(schema)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                texts, lists = batch.column(1).to_pylist(), batch.column(2)
                made: list[list] = [batch.column(0).to_pylist(), [], [], [], [], []]
                for i, text in enumerate(texts):
                    data = text.encode()
                    own = lists[i].values
                    flat = own.to_numpy(zero_copy_only=False) if own is not None else np.empty(0, np.int64)
                    kept, removed, runs = cut(data, flat >> 32, flat & 0xFFFFFFFF, least)
                    for column, v in zip(made[1:], (len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(made[i], type=f.type) for i, f in enumerate(out_schema)], schema=out_schema)
        give_back()

    apply = lambda x: x.select("_id", "_text", "spans").mapInArrow(run, schema)
    return apply(joined).unionByName(apply(hit.where(~F.col("_maybe")).withColumn("spans", none))) if maybe else apply(joined)


def combined(*keys: np.ndarray) -> np.ndarray:
    """One 64-bit key of several columns of 64-bit numbers."""
    out = keys[0].astype(np.int64).view(np.uint64)
    for k in keys[1:]:
        out = out * np.uint64(0x9E3779B97F4A7C15) + k.astype(np.int64).view(np.uint64)
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out


def _slots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    x = (keys ^ (keys >> np.uint64(33))) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - bits)).astype(np.int64), ((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


class KeyFilter:
    """A Bloom filter of 2^bits bits and two hashes: False only for keys that were not put in."""

    def __init__(self, packed: np.ndarray, bits: int) -> None:
        self.packed, self.bits = packed, bits

    def has(self, *keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys[0]), bool)
        for slots in _slots(combined(*keys), self.bits):
            found &= (self.packed[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8) & 1).astype(bool)
        return found

    def test(self, col: str) -> Column:
        @F.pandas_udf(T.BooleanType())
        def passes(keys: pd.Series) -> pd.Series:
            return pd.Series(self.has(keys.to_numpy()))

        return passes(F.col(col))


#: Bytes of a filter that travel together.
_PIECE = 1024


#: Bits for each key, so that about one stranger in 30 passes, and the largest filter that is made: 2^25 bits, 4 MB, for 3.3 million keys.
BITS_A_KEY, MOST_BITS = 10, 25


def key_filter(keys: DataFrame, most_bits: int = MOST_BITS) -> KeyFilter | None:
    """The filter of a table of 64-bit keys of one or more columns; None for more keys than the largest filter is good for.

    It only saves work before an exact join, which is there at any size. The table is read twice. Tasks fill a filter each and send the pieces of it that are not
    empty; the driver gets each piece once.
    """
    count = len(keys.columns)
    bits = max(13, math.ceil(math.log2(BITS_A_KEY * max(1, keys.count()))))
    if bits > most_bits:
        return None
    bound_batches(keys.sparkSession)

    def run(batches):
        table = np.zeros(1 << bits, bool)
        for batch in batches:
            for slots in _slots(combined(*[batch.column(i).to_numpy(zero_copy_only=False) for i in range(count)]), bits):
                table[slots] = True
        packed = np.packbits(table).reshape(-1, _PIECE)
        at = np.flatnonzero(packed.any(axis=1))
        for a in range(0, len(at), 4096):
            part = at[a : a + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype("int32")), pa.array([packed[i].tobytes() for i in part], pa.binary())], names=["at", "part"])
        del table, packed
        give_back()

    pieces = keys.coalesce(max(1, shuffle_parts(keys.sparkSession) // 8)).mapInArrow(run, "at int, part binary")
    packed = np.zeros((1 << bits) // 8, np.uint8).reshape(-1, _PIECE)
    for r in pieces.groupBy("at").applyInArrow(_or_parts, "at int, part binary").collect():
        packed[r["at"]] = np.frombuffer(r["part"], np.uint8)
    return KeyFilter(packed.reshape(-1), bits)


def _or_parts(part: pa.Table) -> pa.Table:
    """One of the filter's pieces from those of all tasks, of which each task sends one at most."""
    whole = np.zeros(_PIECE, np.uint8)
    for x in part.column("part"):
        whole |= np.frombuffer(x.as_py(), np.uint8)
    return pa.table({"at": part.column("at").slice(0, 1), "part": pa.array([whole.tobytes()], pa.binary())})
