"""Best-fit packing of tokenised documents into sequences of a fixed length.

The packing is decided on the histogram of piece lengths, which has at most ``max_len`` entries at any input size. A bin is a pattern of
lengths that is used many times, so the plan is bounded by ``max_len`` too and pieces are assigned to it by their rank within a length, in parallel.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import cut_lineage, fields, map_rows, shuffle_parts


def byte_chars() -> dict[str, int]:
    """The byte that each character stands for in a byte-level vocabulary: printable bytes are themselves, the others follow from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


#: Fixed value: the published pattern by which this byte-level vocabulary cuts texts before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of texts by a ``tokenizers`` file of byte-level BPE.

    tiktoken gives the same ids four times as fast. Its pattern engine raises on about a million white-space characters in a row; such a text is encoded by
    ``tokenizers`` itself.
    """

    def __init__(self, path: str) -> None:
        self.path, self.fast, self.slow = path, load_encoder(path), None

    def ids(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all")
        except ValueError:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
            return self.slow.encode(text, add_special_tokens=False).ids


def load_encoder(path: str):
    """tiktoken's encoder for a ``tokenizers`` file of byte-level BPE."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    chars = byte_chars()
    ranks = {bytes(chars[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cut_pieces(n: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: one if they fit, else full pieces after a first one that takes the remainder."""
    if n <= max_len:
        return [(0, n)]
    first = n % max_len
    starts = ([0] if first else []) + list(range(first, n, max_len))
    return [(s, (first if first and s == 0 else max_len)) for s in starts]


def token_pieces(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each piece of each document: id, piece, start, length, ids_crc32 and, if asked for, the ids.

    A null or empty text is one piece that holds the end id alone. Repeated rows are documents of their own; a null id stays null. Other columns are not read.
    """
    extra = {"piece": T.IntegerType(), "start": T.LongType(), "length": T.LongType(), "ids_crc32": T.LongType()} | ({"ids": T.ArrayType(T.IntegerType())} if with_ids else {})
    names = [id_col, *extra]

    def make():
        encoder = Encoder(tokenizer_path)

        def work(cols: dict[str, list]) -> dict:
            out: dict[str, list] = {n: [] for n in names}
            for doc, text in zip(cols[id_col], cols[text_col], strict=True):
                ids = np.array([*encoder.ids(text or ""), end_id], dtype="<u4")
                for k, (start, length) in enumerate(cut_pieces(len(ids), max_len)):
                    own = ids[start : start + length]
                    row = [doc, k, start, length, zlib.crc32(own.tobytes())] + ([own.astype("int32").tolist()] if with_ids else [])
                    for n, v in zip(names, row, strict=True):
                        out[n].append(v)
            return out

        return work

    return map_rows(docs.select(id_col, text_col), fields(docs, id_col, **extra), make)


class Stock:
    """Lengths that are still to be packed, with their counts."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.count = dict(counts)
        self.lengths = sorted(counts)

    def largest(self, most: int, used: dict[int, int]) -> int:
        """The largest length of at most ``most`` with a piece left beside those used; 0 if there is none."""
        at = bisect_right(self.lengths, most)
        while at:
            at -= 1
            if self.count[self.lengths[at]] > used.get(self.lengths[at], 0):
                return self.lengths[at]
        return 0

    def take(self, pattern: dict[int, int]) -> int:
        """Removes the pattern as often as the stock allows; returns how often."""
        times = min(self.count[x] // n for x, n in pattern.items())
        for x, n in pattern.items():
            self.count[x] -= n * times
            if not self.count[x]:
                self.lengths.remove(x)
        return times


def best_two_fit(counts: dict[int, int], max_len: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ({length: pieces in the bin}, number of such bins) that pack all pieces.

    A bin is filled greedily, from the largest length left with the largest that still fits. Then its smallest piece is taken out, unless it is the
    only one, and replaced by the two unpacked pieces whose sum fills the wider gap more tightly than it did; where two pairs do so equally, the one with the longest piece is taken.
    """
    stock, plan = Stock({x: n for x, n in counts.items() if n > 0}), []
    while stock.lengths:
        used: dict[int, int] = {}
        gap = max_len
        while fit := stock.largest(gap, used):
            n = min(gap // fit, stock.count[fit] - used.get(fit, 0))
            used[fit] = used.get(fit, 0) + n
            gap -= n * fit
        if gap and sum(used.values()) > 1:
            small = min(used)
            room = gap + small
            rest = used | {small: used[small] - 1}
            best = (small, 0, 0)
            for long in reversed(stock.lengths[: bisect_right(stock.lengths, room - 1)]):
                if stock.count[long] <= rest.get(long, 0) or 2 * long <= best[0]:
                    continue
                short = stock.largest(min(long, room - long), rest | {long: rest.get(long, 0) + 1})
                if short and long + short > best[0]:
                    best = (long + short, long, short)
                    if best[0] == room:
                        break
            if best[1]:
                used = {x: n for x, n in rest.items() if n}
                for x in best[1:]:
                    used[x] = used.get(x, 0) + 1
        plan.append((used, stock.take(used)))
    return plan


def plan_runs(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset, pieces in each sequence): which ranks of a length go where."""
    runs, ranks, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            first = ranks.get(length, 0)
            runs.append((length, first, first + n * times - 1, sequence, offset, n))
            ranks[length] = first + n * times
            offset += n * length
        sequence += times
    return runs


def pack_pieces(pieces: DataFrame, max_len: int = 2048, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``max_len``; other columns stay as they are.

    All pieces are packed. Ranks within a length are counted in salted parts, so a length that a third of all rows has is spread over all tasks.
    The counts that reach the driver are one for each length; the plan is broadcast and is bounded by ``max_len`` alone. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    parts = shuffle_parts(spark)
    kept = cut_lineage(pieces)
    columns = kept.columns
    counts = {r["length"]: r["n"] for r in kept.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan_runs(best_two_fit(counts, max_len))
    plan = spark.createDataFrame(runs, "_length long, _first long, _last long, _sequence long, _offset long, _n long").coalesce(1)
    part = kept.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    own = part.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order)) - 1)
    sizes = part.groupBy("length", "_part").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    ranked = own.join(bases, ["length", "_part"]).withColumn("_at", F.col("_rank") + F.col("_base"))
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & F.col("_at").between(F.col("_first"), F.col("_last")))
    index = F.col("_at") - F.col("_first")
    return placed.select(
        *columns,
        (F.col("_sequence") + F.floor(index / F.col("_n"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(index, F.col("_n")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenises and packs whole documents: one row for each piece with its sequence and place there."""
    return pack_pieces(token_pieces(docs, tokenizer_path, max_len, end_id, id_col, text_col), max_len, (id_col, "piece"))
