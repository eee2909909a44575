"""Exact removal of repeated substrings by a distributed prefix doubling, over the places that a sparse sample leaves open.

A doubling over every byte would sort a position and a rank for each of them in each round, many times the text. Here places that cannot repeat, and places whose
repeats are certain, are set aside first. Of each window of ``length`` bytes the start of the run of 8 bytes with the least hash is its sample, so that equal windows
have equal samples at the same place. A sample whose next 64 bytes are found nowhere else drops out with all its windows; where those bytes and all that the windows
around hold are alike in several places, all the windows repeat. Of what is left one place for each distinct surrounding goes on:

1. Spark sorts the places by pairs of their rank at 64 bytes and the name of the bytes that follow, at growing offsets to the right and to the left, reranks them and
   drops those that have become unique, until the offsets are past the threshold. How far a place agrees with any other bounds the windows around it that can repeat.
2. For each window start left, Spark sorts the pairs of the ranks of its two halves. Starts that share their pair are repeats; the others are unique.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import Written, cut_lineage, map_rows
from lexmill.llm.ranks import rerank
from lexmill.llm.spans import key_filter, remove_spans, row_key

SEED = 64
#: Rounds in which places are extended from SEED bytes to the whole length, to either side.
ROUNDS = 4
_BASES = (0xD1342543DE82EF95, 0x9FB21C651E98DF25)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
_BYTES = np.random.default_rng(3).integers(1, 1 << 63, (2, 256), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept up to a million, and made anew for longer texts."""
    own = _POWERS.get(base)
    if own is None or len(own) < n:
        out = np.ones(max(n, 1 << 16), np.uint64)
        done = 1
        while done < len(out):
            more = min(done, len(out) - done)
            out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        own = out
        if len(out) <= 1 << 20:
            _POWERS[base] = out
    return own[:n]


class Names:
    """64-bit names of runs of bytes: equal for equal runs, wherever they are. ``way`` is 0 or 1, for names that are independent of one another."""

    def __init__(self, raw: np.ndarray) -> None:
        self.raw, self.sums = raw, {}

    def of(self, starts: np.ndarray, ends: np.ndarray, way: int = 0) -> np.ndarray:
        n = len(self.raw)
        if way not in self.sums:
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            values = _BYTES[way][self.raw]
            values *= powers(_BASES[way], n)
            np.cumsum(values, out=sums[1:])
            self.sums[way] = sums
        sums = self.sums[way]
        return mix((sums[ends] - sums[starts]) * powers(_INVERSES[way], n + 1)[starts])


class Samples:
    """Of one text of at least ``length`` bytes: each sample's place and rank at 64 bytes, and the first and last window start that have it."""

    def __init__(self, data: bytes, length: int) -> None:
        raw = np.frombuffer(data, np.uint8)
        n = len(raw)
        self.length, self.names = length, Names(raw)
        starts = n - SEED + 1  # a sample has 64 bytes after it
        order = np.ndarray((starts,), "<u8", data, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
        order ^= order >> np.uint64(29)
        order *= np.uint64(0xBF58476D1CE4E5B9)
        order &= np.uint64(0xFFFFFFFF00000000)
        order |= np.uint64(0xFFFFFFFF) - np.arange(starts, dtype=np.uint64)  # of equal hashes the last counts
        done, wide = 1, length - SEED + 1
        while done < wide:
            step = min(done, wide - done)
            order = np.minimum(order[:-step], order[step:])
            done += step
        new = np.flatnonzero(order[1:] != order[:-1]) + 1
        self.first = np.append(0, new)
        self.last = np.append(new, len(order)) - 1
        self.place = (np.uint64(0xFFFFFFFF) - (order[self.first] & np.uint64(0xFFFFFFFF))).astype(np.int64)
        self.seed = self.names.of(self.place, self.place + SEED)

    def groups(self, way: int) -> np.ndarray:
        """Names of the bytes from the first window's start to the last one's end, with the sample's place in them."""
        inner = (self.place - self.first).astype(np.uint64) << np.uint64(32) | (self.last - self.first).astype(np.uint64)
        return mix(self.names.of(self.first, self.last + self.length, way) + mix(inner))

    def spans(self) -> np.ndarray:
        """First window start, how many more there are, and the sample's distance from the first, in one number."""
        return self.first << 32 | (self.last - self.first) << 16 | (self.place - self.first)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sample_rows(rows: DataFrame, length: int) -> DataFrame:
    """(key, seed, ga, gb, span): a row for each sample of each text, with two independent names of its surroundings."""
    schema = T.StructType.fromDDL("key long, seed long, ga long, gb long, span long")

    def make():
        def work(cols: dict[str, list]) -> dict:
            found: dict[str, list] = {f.name: [np.empty(0, np.int64)] for f in schema}
            for key, text in zip(cols["key"], cols["text"], strict=True):
                data = text.encode()
                if len(data) >= length:
                    s = Samples(data, length)
                    for n, v in zip(found, (np.full(len(s.seed), key, np.int64), _signed(s.seed), _signed(s.groups(0)), _signed(s.groups(1)), s.spans()), strict=True):
                        found[n].append(v)
            return {n: np.concatenate(v) for n, v in found.items()}

        return work

    return map_rows(rows, schema, make, rows=64)


def surroundings(rows: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(key, span, bytes): what the windows of each of the ``places`` (key, span) hold."""
    schema = T.StructType.fromDDL("key long, span long, bytes binary")
    maybe = key_filter(places.select("key").distinct())
    spans = places.groupBy("key").agg(F.collect_list("span").alias("spans"))  # of one text, so bounded by it
    texts = (rows.where(maybe.test("key")) if maybe else rows).join(spans, "key")

    def make():
        def work(cols: dict[str, list]) -> dict:
            out: dict[str, list] = {f.name: [] for f in schema}
            for key, text, own in zip(cols["key"], cols["text"], cols["spans"], strict=True):
                data = text.encode()
                for span in own:
                    first = span >> 32
                    out["key"].append(key)
                    out["span"].append(span)
                    out["bytes"].append(data[first : first + (span >> 16 & 0xFFFF) + length])
            return out

        return work

    return map_rows(texts.select("key", "text", "spans"), schema, make, rows=64).dropDuplicates(["key", "span"])  # equal rows share their key


def _flat(parts: list[bytes]) -> tuple[Names, np.ndarray, np.ndarray]:
    """Names over all parts end to end, where each starts, and their sizes."""
    sizes = np.array([len(x) for x in parts], np.int64)
    return Names(np.frombuffer(b"".join(parts), np.uint8)), np.cumsum(sizes) - sizes, sizes


def offsets(length: int) -> list[int]:
    """How many bytes beyond SEED a place is extended by after each round."""
    return [round(j * (length - SEED) / ROUNDS) for j in range(ROUNDS + 1)]


def chains(around: DataFrame, length: int) -> DataFrame:
    """(key, span, side, many, rank, b1 ..): for each place and side (0 right, 1 left) its rank at SEED bytes and the names of the ``many`` blocks next to these that its surroundings hold."""
    names = [f"b{j}" for j in range(1, ROUNDS + 1)]
    schema = T.StructType.fromDDL("key long, span long, side int, many int, rank long, " + ", ".join(f"{n} long" for n in names))
    steps = offsets(length)

    def make():
        def work(cols: dict[str, list]) -> dict:
            flat, at, sizes = _flat(cols["bytes"])
            span = np.array(cols["span"], np.int64)
            place = span & 0xFFFF
            out: dict[str, list] = {f.name: [] for f in schema}
            for side in (0, 1):
                room = place if side else sizes - place - SEED
                many = np.searchsorted(steps, room, side="right") - 1
                out["rank"].append(_signed(mix(flat.of(at + place, at + place + SEED) + np.uint64(side))))
                for v, n in ((np.array(cols["key"], np.int64), "key"), (span, "span"), (np.full(len(span), side, np.int32), "side"), (many.astype(np.int32), "many")):
                    out[n].append(v)
                for j, n in enumerate(names, start=1):
                    near, far = np.minimum(steps[j - 1], room), np.minimum(steps[j], room)
                    start, end = (at + place - far, at + place - near) if side else (at + place + SEED + near, at + place + SEED + far)
                    out[n].append(_signed(flat.of(start, end)))
            return {n: np.concatenate(v) for n, v in out.items()}

        return work

    return map_rows(around, schema, make, rows=2048)


def reaches(tables: Written, around: DataFrame, length: int) -> DataFrame:
    """(key, span, before, after): how many bytes to the left of a place, and from it to the right, some other place may have as well; null where nothing bounds it.

    In each round the places are sorted by (rank, name of the next block) and ranked anew; those that are alone reach less than that block's end, and drop out.
    """
    steps = offsets(length)
    alive, bounds = tables.write("chain0", chains(around, length)), None
    for j in range(1, ROUNDS + 1):
        ranked = rerank(tables, f"chain{j}", alive.where(F.col("many") >= j), ["rank", f"b{j}"], ["key", "span", "side"], keep_alone=True)
        ends = ranked.where("alone").select("key", "span", "side", F.lit(steps[j] - 1).alias("most"))
        bounds = ends if bounds is None else bounds.unionByName(ends)
        alive = ranked.where("not alone").drop("alone")
    return bounds.groupBy("key", "span").agg(F.max(F.when(F.col("side") == 1, F.col("most"))).alias("before"), F.max(F.when(F.col("side") == 0, F.col("most") + SEED)).alias("after"))


def window_starts(around: DataFrame, reach: DataFrame, length: int) -> DataFrame:
    """(key, start, head, tail, whole): the window starts that may repeat, with names of the first and the last half of the window and an independent one of all of it."""
    schema = T.StructType.fromDDL("key long, start long, head long, tail long, whole long")
    half = -(-length // 2)
    rows = around.join(reach, ["key", "span"], "left").select("key", "span", "bytes", "before", "after")

    def make():
        def work(cols: dict[str, list]) -> dict:
            flat, at, _ = _flat(cols["bytes"])
            span = np.array(cols["span"], np.int64)
            place, last = span & 0xFFFF, span >> 16 & 0xFFFF
            before = np.array([length if x is None else x for x in cols["before"]], np.int64)
            after = np.array([length if x is None else x for x in cols["after"]], np.int64)
            low, high = np.maximum(0, place - before), np.minimum(last, place - length + after)
            sizes = np.maximum(0, high - low + 1)
            own = np.repeat(np.arange(len(span)), sizes)
            inner = low[own] + np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            p = at[own] + inner
            key = np.array(cols["key"], np.int64)[own]
            return {
                "key": key, "start": (span >> 32)[own] + inner, "head": _signed(flat.of(p, p + half)), "tail": _signed(flat.of(p + length - half, p + length)),
                "whole": _signed(flat.of(p, p + length, 1)),
            }

        return work

    return map_rows(rows, schema, make, rows=1024)


def repeated_spans(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, start, end): spans of bytes that together cover every window of ``length`` bytes that also starts anywhere else, and nothing more.

    ``length`` is 65 to 60,000. Texts are read as UTF-8 and windows never cross them; a window may repeat in its own text and overlap itself. The key is
    spans.row_key's; equal rows have equal spans. Two windows count as equal if independent 64-bit names of all their bytes, and of what surrounds or halves them, agree.
    """
    if not SEED < length <= 60_000:
        raise ValueError("length must be over 64 and at most 60,000")
    rows = docs.where(F.octet_length(text_col) >= length).select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    tables = Written(docs.sparkSession, "repeats")
    samples = tables.write("samples", sample_rows(rows, length))
    group = F.struct("ga", "gb")
    again = samples.groupBy("seed").agg(F.count("*").alias("n"), F.min(group).alias("low"), F.max(group).alias("high")).where("n > 1").select("seed", (F.col("low") != F.col("high")).alias("mixed"))
    met = tables.write("met", samples.join(tables.write("again", again), "seed"))
    tables.drop("samples", "again")
    start = F.shiftright("span", 32)
    end = start + F.shiftright("span", 16).bitwiseAND(F.lit(0xFFFF)) + length
    mixed = met.where("mixed")
    classes = mixed.groupBy("seed", "ga", "gb").agg(F.count("*").alias("n"), F.min(F.struct("key", "span")).alias("one"))
    classes = tables.write("classes", classes.select("seed", "ga", "gb", "n", "one.key", "one.span"), release=True)
    alike = mixed.join(classes.where("n > 1").select("seed", "ga", "gb"), ["seed", "ga", "gb"]).unionByName(met.where("not mixed"))
    alike = tables.write("alike", alike.select("key", start.alias("start"), end.alias("end")))
    tables.drop("met")

    around = tables.write("around", surroundings(rows, classes.select("key", "span"), length), release=True)
    tables.drop("classes")
    reach = tables.write("reach", reaches(tables, around, length), release=True)
    tables.drop(*(f"chain{j}" for j in range(ROUNDS + 1)))
    windows = rerank(tables, "windows", window_starts(around, reach, length), ["head", "tail", "whole"], ["key", "start"])
    tables.drop("around", "reach")
    spans = alike.unionByName(windows.select("key", "start", (F.col("start") + length).alias("end")))
    out = cut_lineage(spans, release=True)
    tables.close()
    return out


def dedup_substrings(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes.

    Every byte that a repeated window of ``length`` bytes covers is removed, in all its occurrences. Null and empty texts are empty and lose nothing, nor do
    texts under ``length`` bytes. Repeated rows are documents of their own, so that each is a repeat of the other. Other columns are not read.
    """
    return remove_spans(docs, repeated_spans(docs, length, id_col, text_col), id_col, text_col, keep_text)
