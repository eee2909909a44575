"""Benchmark decontamination by the q-gram lemma.

An occurrence of an item of m characters with at most k edits keeps at least m - q + 1 - k * q of the item's q-grams, and these lie on diagonals at most k apart.
Shared q-grams are counted in overlapping bands of diagonals, bands that reach the bound are regions, and a banded alignment decides each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import cut_lineage, fields, map_rows, text_column
from lexmill.llm.winnowing import code_points, rolling_hashes

Q = 10
#: Edits allowed for each character of an item.
RATE = 0.06
_BITS = 22


def normal(text: str) -> str:
    """Lower-cased, with each run of white space one space and none at the ends."""
    return " ".join(text.lower().split())


def budget(m: int, q: int = Q, rate: float = RATE) -> tuple[int, int]:
    """(edits allowed, q-grams that must be shared) for an item of ``m`` characters. The edits are cut to what leaves at least one q-gram."""
    k = min(int(rate * m), max(0, (m - q) // q))
    return k, max(1, m - q + 1 - k * q)


@dataclass
class Index:
    """Items' normalised code points and, sorted, the hashes of all their q-grams with item and place.

    ``seen`` marks slots that a hash can have; ``limits`` has each item's budget() and ``sizes`` its length.
    """

    ids: list
    items: list[np.ndarray]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    sizes: np.ndarray
    limits: np.ndarray
    q: int


def build_index(rows: list[tuple], q: int = Q, rate: float = RATE) -> Index:
    """From (id, text); items of under ``q`` normalised characters are left out, as they have no q-gram."""
    kept = [(i, code_points(normal(x))) for i, x in rows if x is not None]
    kept = [(i, p) for i, p in kept if len(p) >= q]
    hashes = [rolling_hashes(p, q) for _, p in kept] or [np.empty(0, np.uint64)]
    flat = np.concatenate(hashes)
    order = np.argsort(flat, kind="stable")
    seen = np.zeros(1 << _BITS, bool)
    seen[(flat & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
    item = np.repeat(np.arange(len(kept)), [len(h) for h in hashes] if kept else []).astype(np.int32)
    place = np.concatenate([np.arange(len(h), dtype=np.int32) for h in hashes])
    sizes = np.array([len(p) for _, p in kept], dtype=np.int64)
    limits = np.array([budget(m, q, rate) for m in sizes.tolist()], dtype=np.int64).reshape(-1, 2)
    return Index([i for i, _ in kept], [p.astype(np.uint32) for _, p in kept], flat[order].astype(np.uint32), item[order] if kept else item, place[order], seen, sizes, limits, q)


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int] | None:
    """(edits, end) of the best occurrence of the item in the text within the diagonals ``low`` to ``high`` (text place less item place), if it takes at most ``most`` edits.

    One row of the table at a time over the band; the occurrence may start and end anywhere in it.
    """
    width = high - low + 1
    big = 1 << 20
    n = len(text)
    at = np.arange(low, high + 1)
    row = np.where((at >= 0) & (at <= n), 0, big)
    steps = np.arange(width)
    for i in range(1, len(item) + 1):
        at = at + 1  # text places before which this row's cells end
        inside = (at >= 0) & (at <= n)
        same = text[np.clip(at - 1, 0, n - 1)] == item[i - 1]
        moved = np.where((at >= 1) & inside, row + ~same, big)  # a match or a replaced character
        moved[:-1] = np.minimum(moved[:-1], row[1:] + 1)  # a character of the item left out
        row = np.minimum.accumulate(moved - steps) + steps  # characters of the text left over
        row = np.where(inside, row, big)
        if row.min() > most:
            return None
    end = int(row.argmin())
    return int(row[end]), int(at[end])


def find(text: str, index: Index) -> list[tuple[int, int, int]]:
    """(item number, edits, end in the normalised text) of the best occurrence of each item that is in the text within its budget."""
    if not len(index.hashes) or not text:
        return []
    points = code_points(normal(text))
    if len(points) < index.q:
        return []
    hashes = rolling_hashes(points, index.q).astype(np.uint32)
    maybe = np.flatnonzero(index.seen[hashes & np.uint32((1 << _BITS) - 1)])
    left = np.searchsorted(index.hashes, hashes[maybe], side="left")
    count = np.searchsorted(index.hashes, hashes[maybe], side="right") - left
    total = int(count.sum())
    if not total:
        return []
    slot = np.repeat(left - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(total)
    item = index.item[slot].astype(np.int64)
    diagonal = np.repeat(maybe, count) - index.place[slot]
    sizes, limits = index.sizes, index.limits
    # Bands of 2(k+1) diagonals that start every k+1: diagonals at most k apart share one.
    step = limits[item, 0] + 1
    band = (diagonal + sizes[item]) // step
    place = len(points) + int(sizes.max()) + 2
    keys = np.concatenate([item * place + band, item * place + band - 1])
    unique, counts = np.unique(keys, return_counts=True)
    owner = unique // place
    regions = unique[counts >= limits[owner, 1]]
    best: dict[int, tuple[int, int]] = {}
    for region in regions.tolist():
        i = region // place
        b = region % place
        if b == place - 1:  # band -1 of the next item
            i, b = i + 1, -1
        most = int(limits[i, 0])
        if i in best and best[i][0] == 0:
            continue
        low = b * (most + 1) - int(sizes[i])
        got = align(index.items[i], points, low - most, low + 2 * (most + 1) + most, most)
        if got and got[0] <= most and (i not in best or got < best[i]):
            best[i] = got
    return [(i, *v) for i, v in sorted(best.items())]


def blocks(benchmark: DataFrame, most_chars: int, id_col: str = "item_id", text_col: str = "text"):
    """The benchmark's rows in lists of at most ``most_chars`` characters (or one longer item), read one after another; the driver holds one block at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("x")).where("x is not null").orderBy("i", "x").toLocalIterator():
        if block and size + len(r["x"]) > most_chars:
            yield block
            block, size = [], 0
        block.append((r["i"], r["x"]))
        size += len(r["x"])
    if block:
        yield block


#: Characters of the benchmark that meet all documents at once. A task holds 12 bytes for each, and the 4 MB of marks.
MOST_CHARS = 2_000_000


def _block_leaks(rows: DataFrame, index: Index, schema: T.StructType, id_col: str, text_col: str) -> DataFrame:
    def make():
        def work(cols: dict[str, list]) -> dict:
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc, text in zip(cols[id_col], cols[text_col], strict=True):
                for i, edits, end in find(text or "", index):
                    for n, v in zip(out, (doc, index.ids[i], edits, end), strict=True):
                        out[n].append(v)
            return out

        return work

    return map_rows(rows, schema, make)


def leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, most_chars: int = MOST_CHARS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, edits, end): each benchmark item that a row's text has within ``rate`` edits a character, with the fewest edits and where that ends in the normalised text.

    Texts and items are compared lower-cased and with runs of white space as one space. Documents are read whole. The benchmark is a set of queries: blocks of
    at most ``most_chars`` characters of it go to all tasks, one after another, each against all documents. With more than one block each block's leaks are
    written before the next block is read, so that neither the driver nor the plan grows with the benchmark. Null and empty texts and items under ``q``
    characters match nothing. Repeated rows and items give repeated results; a null id is kept.
    """
    schema = T.StructType([*fields(docs, id_col).fields, *fields(benchmark, item_col).fields, T.StructField("edits", T.IntegerType()), T.StructField("end", T.IntegerType())])
    rows = docs.select(id_col, text_col)
    found, queue = None, blocks(benchmark, most_chars, item_col, item_text_col)
    block = next(queue, None)
    while block is not None:
        part = _block_leaks(rows, build_index(block, q, rate), schema, id_col, text_col)
        block = next(queue, None)
        if block is not None or found is not None:
            part = cut_lineage(part)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, most_chars: int = MOST_CHARS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose text has no item of the benchmark; null texts stay.

    A benchmark of one block filters the rows in one pass. With more, leaking texts are found block by block, named by 128 bits of hashes, and left out by one join.
    """
    queue = blocks(benchmark, most_chars)
    block, after = next(queue, None), next(queue, None)
    if block is None:
        return docs
    if after is None:
        index = build_index(block, q, rate)
        clean = text_column(docs.sparkSession, F.col(text_col), T.BooleanType(), lambda: lambda texts: [not find(x or "", index) for x in texts])
        return docs.where(clean)
    mark = [F.xxhash64(F.col(text_col)), F.xxhash64(F.lit(2), F.col(text_col))]
    own = {f"_mark{i}": c for i, c in enumerate(mark)}
    texts = docs.select(text_col).withColumns(own).select(F.struct(*own).alias("_marks"), text_col)
    items = benchmark.select("item_id", F.col("text").alias("text"))
    gone = leaks(texts, items, q, rate, most_chars, "_marks", text_col).select("_marks.*").distinct()
    return docs.withColumns(own).join(gone, list(own), "left_anti").select(*docs.columns)
