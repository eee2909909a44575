"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Trees are complete binary trees laid out in arrays, so that a block of documents goes down all trees together in numpy.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import crc_mod, fields, map_rows

FEATURES = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper", "digit", "space", "newline", "high", "mark", "symbol", "bang", "pipe",
    "distinct_words", "top_word", "repeated_word", "two_apart", "compressed", "log_lines", "repeated_lines", "long_words", "title_words", "stops", "words_a_stop",
)


def _share_of(table: np.ndarray, chars: bytes) -> float:
    return float(table[list(chars)].sum())


def statistics(text: str) -> list[float]:
    """The features of one text, in the order of FEATURES; zeros for an empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    data = text.encode()
    table = np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data)
    words = text.split()
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    lines = text.split("\n")
    stops = _share_of(table, b".?") * len(data)
    title = sum(times for w, times in counts.items() if w.istitle())
    return [
        math.log1p(len(data)), math.log1p(len(words)), float(sizes.mean()), float(sizes.std()),
        float(table[65:91].sum()), float(table[48:58].sum()), float(table[32]), float(table[10]), float(table[128:].sum()),
        _share_of(table, b".,;:?'\"-"), _share_of(table, b"#$%&*+/<=>@\\^_`~{}[]()"), float(table[33]), float(table[124]),
        len(counts) / n, max(counts.values(), default=0) / n, sum(map(operator.eq, words, words[1:])) / n, sum(map(operator.eq, words, words[2:])) / n,
        len(zlib.compress(data, 1)) / len(data), math.log1p(len(lines)), 1 - len(set(lines)) / len(lines),
        float((sizes > 14).mean()), title / n, stops / n, math.log1p(n / (1 + stops)),
    ]


@dataclass
class Trees:
    """``feature`` and ``cut``: trees x inner nodes; ``value``: trees x leaves; ``base``: log-odds to start from. A row goes right where its feature is over the cut."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range(int(math.log2(self.value.shape[1])) if len(self.feature) else 0):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
        total = self.base + (self.value[trees, node - self.feature.shape[1]].sum(axis=1) if len(self.feature) else 0.0)
        return 1 / (1 + np.exp(-np.clip(total + np.zeros(len(x)), -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, least: int = 10, ridge: float = 1.0) -> Trees:
    """Boosts logistic loss. Splits are sought in histograms of ``bins`` quantile bins; a node that gains nothing sends all rows left."""
    base = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature, cut, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    score = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for d in range(depth):
            for k in range((1 << d) - 1, (2 << d) - 1):
                rows = np.flatnonzero(node == k)
                if len(rows) < 2 * least:
                    continue
                best = 1e-6
                total = g[rows].sum() ** 2 / (h[rows].sum() + ridge)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    b = binned[rows, f]
                    left_g, left_h, left_n = (np.bincount(b, weights=w, minlength=bins).cumsum() for w in (g[rows], h[rows], np.ones(len(rows))))
                    ok = (left_n >= least) & (left_n <= len(rows) - least)
                    gain = left_g**2 / (left_h + ridge) + (g[rows].sum() - left_g) ** 2 / (h[rows].sum() - left_h + ridge) - total
                    gain[~ok] = 0
                    at = int(gain[: len(e)].argmax())
                    if gain[at] > best:
                        best, feature[t, k], cut[t, k] = gain[at], f, e[at]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > cut[t, node])
        leaf = node - inner
        value[t] = -rate * np.bincount(leaf, weights=g, minlength=leaves) / (np.bincount(leaf, weights=h, minlength=leaves) + ridge)
        score += value[t, leaf]
    return Trees(feature, cut, value, base)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, most: int, fold: int, held: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(y, x) of at most ``most`` labelled documents, those with the least hashes of their ids.

    Labels other than 0 and 1, null ids and rows whose crc32(id as text) mod ``fold`` is ``held`` are not drawn; of repeated labels the greatest counts.
    The sample's ids are chosen before texts are read, and are broadcast: at most ``most`` of them.
    """
    known = labels.select(F.col(id_col).alias("_i"), F.col(label_col).cast("int").alias("_y")).where(F.col("_y").isin(0, 1) & F.col("_i").isNotNull()).groupBy("_i").agg(F.max("_y").alias("_y"))
    known = known.where(crc_mod("_i", fold) != held)
    chosen = known.withColumn("_h", F.xxhash64(F.col("_i").cast("string"))).orderBy("_h", "_i").limit(most)
    return docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("x")).join(F.broadcast(chosen), "_i").select("_h", F.col("_y").alias("y"), F.coalesce("x", F.lit("")).alias("x"))


def fit(docs: DataFrame, labels: DataFrame, most: int = 6000, fold: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees fitted on the statistics of at most ``most`` labelled documents; without any, trees that score 0.5. Only statistics reach the driver."""
    drawn = training_rows(docs, labels, "quality", most, fold, held, id_col, text_col)
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("f", T.ArrayType(T.DoubleType()))])

    def make():
        return lambda cols: {"h": cols["_h"], "y": cols["y"], "f": [statistics(x) for x in cols["x"]]}

    rows = sorted((r["h"], r["y"], tuple(r["f"])) for r in map_rows(drawn, schema, make).collect())
    if not rows:
        return Trees(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), 0.0)
    return boost(np.array([r[2] for r in rows]), np.array([r[1] for r in rows], dtype=float))


def score_quality(docs: DataFrame, trees: Trees, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: id, the columns ``keep``, score (0 to 1) and predicted (1 from ``threshold`` on), from the whole text alone.

    Null and empty texts have the score of statistics that are all zero. Repeated rows have a row each.
    """
    chosen = docs.select(id_col, text_col, *[c for c in keep if c not in (id_col, text_col)])
    names = [id_col, *[c for c in keep if c != id_col]]
    schema = fields(chosen, *names, score=T.DoubleType(), predicted=T.IntegerType())

    def make():
        def work(cols: dict[str, list]) -> dict:
            score = trees.scores(np.array([statistics(x or "") for x in cols[text_col]]))
            return {n: cols[n] for n in names} | {"score": score, "predicted": (score >= threshold).astype("int32")}

        return work

    return map_rows(chosen, schema, make)
