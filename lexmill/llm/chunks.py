"""Substring dedup by content-defined chunks.

A gear hash rolls over the last 32 bytes of a document and proposes ends of chunks where it falls under a threshold. They are taken in order of their hash, and a
place too near to one taken before is passed over, so that no chunk is short. A choice hangs on the content around it alone, so that boundaries come back in
step after an insertion. Every chunk is deduplicated by digest, and runs of repeated chunks are removed: a lone chunk of a few words that two texts happen to share is
no repeated passage and stays, while a copy of a text loses all its bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import Written, cut_lineage, map_rows
from lexmill.llm.ranks import rerank
from lexmill.llm.spans import remove_spans, row_key

_GEAR = np.random.default_rng(9).integers(0, 1 << 32, 256, dtype=np.int64).astype(np.uint32)


def gear_hashes(data: bytes) -> np.ndarray:
    """The gear hash after each byte, over the last 32 bytes: the table's values shifted by their distance and added."""
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        if step < len(h):
            h[step:] += h[:-step].copy() << np.uint32(step)
    return h


#: Places proposed for each chunk wanted: at this density chunks of at least 32 bytes have a mean of 47 over the documents of sf0.1, where 48 is asked for.
_PROPOSED = 6


def chunk_ends(data: bytes, mean: int = 48, most: int = 1024, least: int = 32) -> list[int]:
    """Ends of the chunks of a text, the text's end among them. No chunk is under ``least`` bytes but a text that is shorter as a whole, and none over ``most``.

    Of the places where the hash is under _PROPOSED * 2^32 / mean, that with the least hash is taken first; those nearer to it, or to an edge of the text, than
    ``least`` are not taken. Runs of more than ``most`` bytes without a place are cut every ``most`` bytes, the last cut early enough to leave ``least``.
    """
    n = len(data)
    hashes = gear_hashes(data)
    places = np.flatnonzero(hashes < np.uint32(min(_PROPOSED * ((1 << 32) // mean), (1 << 32) - 1))) + 1
    places = places[(places >= least) & (places <= n - least)]
    free, ends = bytearray(b"\1") * (n + least), [n]
    for at in places[np.argsort(hashes[places - 1], kind="stable")].tolist():
        if free[at]:
            ends.append(at)
            free[at - least + 1 : at + least] = bytes(2 * least - 1)
    out, at = [], 0
    for end in sorted(ends):
        while end - at > most:
            at += min(most, end - at - least)
            out.append(at)
        out.append(end)
        at = end
    return out


def chunk_rows(docs: DataFrame, mean: int = 48, least: int = 32, most: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc, start, end, d1, d2): a row for each chunk, with 128 bits of its digest."""
    rows = docs.where(F.length(text_col) > 0).select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc", docs.schema[id_col].dataType)] + [T.StructField(n, t) for n, t in (("start", T.IntegerType()), ("end", T.IntegerType()), ("d1", T.LongType()), ("d2", T.LongType()))])

    def make():
        def work(cols: dict[str, list]) -> dict:
            out: dict[str, list] = {f.name: [] for f in schema}
            digests = []
            for key, doc, text in zip(cols["key"], cols["doc"], cols["text"], strict=True):
                data = text.encode()
                ends = chunk_ends(data, mean, most, least)
                for a, b in zip([0, *ends], ends, strict=False):
                    digests.append(hashlib.blake2b(data[a:b], digest_size=16).digest())
                    out["key"].append(key)
                    out["doc"].append(doc)
                    out["start"].append(a)
                    out["end"].append(b)
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            return out | {"d1": both[:, 0], "d2": both[:, 1]}

        return work

    return map_rows(rows, schema, make, rows=128)


def repeated_chunks(docs: DataFrame, mean: int = 48, least: int = 32, most: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, start, end): the chunks whose digest occurs in an earlier place, by id and then by position. The first occurrence is not among them.

    Chunks are sorted once by digest and place, so that all but the first of equal ones stand behind it; a digest that very many chunks have fills many ranges.
    Equal rows are one document here.
    """
    tables = Written(docs.sparkSession, "chunks")
    chunks = chunk_rows(docs, mean, least, most, id_col, text_col)
    out = cut_lineage(rerank(tables, "sorted", chunks, ["d1", "d2"], ["doc", "key", "start"], place=["key", "start"]).select("key", "start", "end"))
    tables.close()
    return out


def dedup_chunks(docs: DataFrame, mean: int = 48, least: int = 32, most: int = 1024, least_run: int = 96, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes, after runs of repeated chunks are removed.

    A run is of chunks next to each other that all stood somewhere before; one of under ``least_run`` bytes, two chunks of the mean size, stays. A text all of whose
    chunks stood before loses all its bytes, also one under ``least`` bytes. Null and empty texts are empty and lose nothing; a null id comes first in the order.
    Rows that are equal in id and text are one document: none of them is a repeat of another. Other columns are not read.
    """
    return remove_spans(docs, repeated_chunks(docs, mean, least, most, id_col, text_col), id_col, text_col, keep_text, least_run)
