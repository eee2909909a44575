"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary documents, predict each byte of a lower-cased word from a few bytes before it; folds of the training rows choose how many. Each order backs off to the
continuation counts of the order below in its own class, and the lowest one to counts that both classes share: of byte pairs in the distinct words of all
documents. A rare expression therefore gets its probability from the pieces that it has in common with others. The score compares the two
log-likelihoods, normalised by the number of words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import crc_mod, fields, map_rows
from lexmill.llm.quality import training_rows

_WORD = re.compile(r"[^\W_]+")
#: Orders and weights of the labels' odds that folds of the training rows choose from, the first of equally good ones. A weight of 1 makes a score the probability
#: among all documents, 0 that among as many toxic ones as others.
ORDERS, ODDS_WEIGHTS, FOLDS = (5, 4, 6), (0.5, 0.25, 0.75, 0.0, 1.0), 3
DISCOUNT = 0.75
_EIGHT = np.uint64(8)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, word numbers) of all runs of ``order`` bytes that end in a word or at the space after it; spaces stand before a word."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    pad = b" " * (order - 1)
    flat = np.frombuffer(b"".join(pad + w + b" " for w in words), np.uint8).astype(np.uint64)
    n = len(flat) - order + 1
    key = np.zeros(n, np.uint64)
    for j in range(order):
        key = (key << _EIGHT) | flat[j : j + n]
    sizes = np.array([len(w) + order for w in words])
    ends = np.repeat(np.cumsum(sizes), sizes)[:n]
    valid = np.arange(n) + order - 1 < ends
    return key[valid], np.repeat(np.arange(len(words)), sizes)[:n][valid]


@dataclass
class Level:
    """Of one order: sorted keys with their discounted share, and sorted contexts with the weight of the order below."""

    keys: np.ndarray
    share: np.ndarray
    contexts: np.ndarray
    weight: np.ndarray


def _level(keys: np.ndarray, counts: np.ndarray) -> Level:
    contexts, at = np.unique(keys >> _EIGHT, return_inverse=True)
    total = np.bincount(at, weights=counts)
    taken = np.minimum(counts, DISCOUNT)
    return Level(keys, (counts - taken) / total[at], contexts, np.bincount(at, weights=taken) / total)


def levels(words: list[bytes], weights: np.ndarray, order: int) -> list[Level]:
    """Levels from order 2 up. The highest one counts; each below counts the distinct bytes before its keys."""
    keys, owner = grams(words, order)
    unique, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, weights=weights[owner], minlength=len(unique)) if len(keys) else np.empty(0)
    made = []
    for k in range(order, 1, -1):
        made.append(_level(unique, counts))
        unique, counts = np.unique(unique & np.uint64((1 << 8 * (k - 1)) - 1), return_counts=True)
        counts = counts.astype(float)
    return made[::-1]


def _find(table: np.ndarray, value: np.ndarray, key: np.ndarray, other: float) -> np.ndarray:
    if not len(table):
        return np.full(len(key), other)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return np.where(table[at] == key, value[at], other)


@dataclass
class Model:
    """``classes``: the levels of the toxic and of the ordinary class; ``shared``: probabilities of a byte after another one. ``slope`` and ``shift`` make a probability of the mean."""

    classes: tuple[list[Level], list[Level]]
    shared: np.ndarray
    order: int = ORDERS[0]
    slope: float = 1.0
    shift: float = 0.0
    cache: dict[str, float] = field(default_factory=dict)
    known: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.empty(0, np.uint64), np.empty(0)))

    def log_likelihood(self, side: int, keys: np.ndarray) -> np.ndarray:
        p = self.shared[(keys >> _EIGHT & np.uint64(255)).astype(np.int64), (keys & np.uint64(255)).astype(np.int64)]
        for k, level in enumerate(self.classes[side], start=2):
            key = keys & np.uint64((1 << 8 * k) - 1)
            p = _find(level.keys, level.share, key, 0.0) + _find(level.contexts, level.weight, key >> _EIGHT, 1.0) * p
        return np.log(p)

    def ratios(self, keys: np.ndarray) -> np.ndarray:
        """Toxic less ordinary log-likelihood of each key. Words share most of their pieces, so each key is worked out once and then looked up."""
        table, value = self.known
        at = np.minimum(np.searchsorted(table, keys), max(0, len(table) - 1))
        missing = np.unique(keys[table[at] != keys]) if len(table) else np.unique(keys)
        if len(missing):
            if len(table) > 2_000_000:
                table, value, missing = table[:0], value[:0], np.unique(keys)
            own = self.log_likelihood(0, missing) - self.log_likelihood(1, missing)
            table, value = np.append(table, missing), np.append(value, own)
            order = np.argsort(table, kind="stable")
            self.known = table, value = table[order], value[order]
            at = np.searchsorted(table, keys)
        return value[at]

    def means(self, texts: list[str]) -> np.ndarray:
        """The difference of the two log-likelihoods of each text, over its number of words; 0 without words."""
        split = [words_of(x) for x in texts]
        if len(self.cache) > 300_000:
            self.cache.clear()
        new = list({w for words in split for w in words} - self.cache.keys())
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            keys, owner = grams([w.encode() for w in part], self.order)
            self.cache.update(zip(part, np.bincount(owner, weights=self.ratios(keys), minlength=len(part)).tolist(), strict=True))
        get = self.cache.__getitem__
        return np.array([math.fsum(map(get, words)) / len(words) if words else 0.0 for words in split])

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.means(texts) + self.shift, -30, 30)))


def distinct_words(docs: DataFrame, text_col: str = "text", most: int = 150_000) -> DataFrame:
    """(w) the distinct words of all documents. A task hands on what it has found whenever that is ``most`` words, so its memory is bounded."""

    def run(batches):
        seen: set[str] = set()
        for batch in batches:
            for text in batch.column(0):
                seen.update(words_of(text.as_py() or ""))
                if len(seen) >= most:
                    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["w"])
                    seen.clear()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["w"])

    return docs.select(text_col).mapInArrow(run, "w string").distinct()


def shared_pairs(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Probabilities (256 x 256) of a byte after another in the distinct words of all documents: counted in Spark, of which at most 65,536 sums reach the driver."""

    def run(batches):
        table = np.zeros(1 << 16, np.int64)
        for batch in batches:
            keys, _ = grams([w.encode() for w in batch.column(0).to_pylist()], 2)
            table += np.bincount(keys.astype(np.int64), minlength=1 << 16)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("int32")), pa.array(table[at])], names=["p", "n"])

    sums = distinct_words(docs, text_col).mapInArrow(run, "p int, n long").groupBy("p").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(1 << 16)
    for r in sums:
        table[r["p"]] = r["n"]
    table = table.reshape(256, 256)
    single = (table.sum(axis=0) + 0.5) / (table.sum() + 128)
    total = table.sum(axis=1, keepdims=True)
    taken = np.minimum(table, DISCOUNT)
    return (table - taken + np.maximum(taken.sum(axis=1, keepdims=True), 1e-9) * single) / np.maximum(total, 1e-9)


def calibrate(mean: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and shift of a logistic curve through held-back rows, by Newton's method with a slight ridge."""
    scale = float(np.abs(mean).mean()) or 1.0
    x = np.stack([mean / scale, np.ones(len(y))], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 1e-2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w -= np.clip(np.linalg.solve(hess, grad), -4, 4)
    return float(max(w[0], 0.0) / scale), float(w[1])


def _class_levels(words: list[list[str]], order: int) -> list[Level]:
    """Levels of one class; a word counts once for each document that has it."""
    counts: Counter = Counter()
    for own in words:
        counts.update(set(own))
    known = sorted(counts)
    return levels([w.encode() for w in known], np.array([counts[w] for w in known], dtype=float), order)


def _model(words: list[list[str]], y: np.ndarray, used: np.ndarray, shared: np.ndarray, order: int) -> Model:
    of = lambda side: _class_levels([w for w, label, u in zip(words, y, used, strict=True) if label == side and u], order)
    return Model((of(1), of(0)), shared, order)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(y == 1, -z, z))))


def fit_sample(rows: list[tuple[int, int, str]], shared: np.ndarray, odds: float = 1.0) -> Model:
    """A model from (hash, label, text); ``odds``: how many times rarer toxic documents are than in these rows, against ordinary ones.

    Each fold's rows are scored by models of the other folds. From these scores the order with the least logistic loss is chosen, the curve is fitted, and the weight
    of the odds with the best mean of the shares of toxic and of ordinary rows that are right. The model itself is then fitted on all rows.
    """
    rows = sorted(rows)
    words, texts = [words_of(x) for _, _, x in rows], [x for _, _, x in rows]
    y = np.array([label for _, label, _ in rows])
    if len(set(y.tolist())) < 2:
        return Model(([], []), np.full((256, 256), 1 / 256), ORDERS[0], 0.0, -4.0)
    fold = np.empty(len(rows), np.int64)
    for label in (0, 1):  # by label, so that each fold has its share of both
        fold[y == label] = np.arange((y == label).sum()) % FOLDS
    best = None
    if min((y == 0).sum(), (y == 1).sum()) >= FOLDS:
        for order in ORDERS:
            means = np.empty(len(rows))
            for f in range(FOLDS):
                own = np.flatnonzero(fold == f)
                means[own] = _model(words, y, fold != f, shared, order).means([texts[i] for i in own])
            slope, shift = calibrate(means, y.astype(float))
            loss = _loss(slope * means + shift, y)
            if best is None or loss < best[0]:
                best = loss, order, slope, shift, slope * means + shift
    model = _model(words, y, np.ones(len(rows), bool), shared, best[1] if best else ORDERS[0])
    if best:
        _, _, model.slope, shift, z = best
        right = lambda w: ((z[y == 1] >= w * math.log(odds)).mean() + (z[y == 0] < w * math.log(odds)).mean()) / 2
        model.shift = shift - max(ODDS_WEIGHTS, key=right) * math.log(odds)
    return model


def fit(docs: DataFrame, labels: DataFrame, most: int = 4000, max_chars: int = 20_000, fold: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model fitted on at most ``most`` labelled documents of at most ``max_chars`` code points, half of each label, and on the distinct words of all documents.

    The sample's texts reach the driver; both parameters bound them. The share of toxic ones among all labels sets the odds. Without both labels every score is about 0.02.
    """
    short = docs.where(F.coalesce(F.length(text_col), F.lit(0)) <= max_chars)
    sample = []
    for label in (1, 0):
        own = labels.where(F.col("toxic") == label)
        sample += [(r["_h"], r["y"], r["x"]) for r in training_rows(short, own, "toxic", most // 2, fold, held, id_col, text_col).collect()]
    known = {r["toxic"]: r["count"] for r in labels.where(F.col("toxic").isin(0, 1) & (crc_mod(id_col, fold) != held)).groupBy("toxic").count().collect()}
    drawn = Counter(y for _, y, _ in sample)
    odds = (known.get(0, 0) / known[1]) / (drawn[0] / drawn[1]) if known.get(1) and drawn[0] and drawn[1] else 1.0
    return fit_sample(sample, shared_pairs(docs, text_col), odds)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: id, the columns ``keep``, score (0 to 1) and predicted (1 from ``threshold`` on), from the whole text alone.

    Null texts and texts without words have the score of a mean of 0. Repeated rows have a row each.
    """
    chosen = docs.select(id_col, text_col, *[c for c in keep if c not in (id_col, text_col)])
    names = [id_col, *[c for c in keep if c != id_col]]
    schema = fields(chosen, *names, score=T.DoubleType(), predicted=T.IntegerType())
    model.cache.clear()
    model.known = (np.empty(0, np.uint64), np.empty(0))

    def make():
        def work(cols: dict[str, list]) -> dict:
            score = model.score([x or "" for x in cols[text_col]])
            return {n: cols[n] for n in names} | {"score": score, "predicted": (score >= threshold).astype("int32")}

        return work

    return map_rows(chosen, schema, make)
