"""Language identification by a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time. It labels every byte; a document's probabilities are the mean over its bytes.
Texts are read whole, in segments of ``SEGMENT`` bytes that start with a zero state, so that segments run side by side and cost follows the bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import crc_mod, text_column

SEGMENT = 96
PAD = 256
UNKNOWN = "und"


@dataclass
class Network:
    """Weights of both directions: input tables (257 x 3h), recurrent matrices (h x 3h), the two halves of the output matrix and its bias."""

    labels: list[str]
    tables: list[np.ndarray]
    inner: list[np.ndarray]
    outer: list[np.ndarray]
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [*self.tables, *self.inner, *self.outer, self.bias]


def segments(data: list[bytes], length: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """(symbols by time and segment, number of the text of each segment); texts are padded to full segments."""
    counts = [-(-len(x) // length) for x in data]
    out = np.full((sum(counts), length), PAD, dtype=np.int16)
    at = 0
    for x, n in zip(data, counts, strict=True):
        flat = out[at : at + n].reshape(-1)
        flat[: len(x)] = np.frombuffer(x, dtype=np.uint8)
        at += n
    return np.ascontiguousarray(out.T), np.repeat(np.arange(len(data)), counts)


def _gates(table: np.ndarray, inner: np.ndarray, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step: update gate, reset gate, candidate, recurrent part of the candidate, new state."""
    size = h.shape[1]
    x = table.take(symbols, axis=0)
    u = h @ inner
    gates = x[:, : 2 * size] + u[:, : 2 * size]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    z, r = gates[:, :size], gates[:, size:]
    un = u[:, 2 * size :]
    n = r * un
    n += x[:, 2 * size :]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return z, r, n, un, new


def pooled(net: Network, data: list[bytes], at_once: int = 1024) -> np.ndarray:
    """Mean label probabilities of each text; zeros for an empty one."""
    symbols, owner = segments(data)
    total = np.zeros((len(data), len(net.labels)), dtype=np.float64)
    size = net.inner[0].shape[0]
    for a in range(0, symbols.shape[1], at_once):
        part = np.ascontiguousarray(symbols[:, a : a + at_once])
        steps, n = part.shape
        states = np.zeros((steps, n, size), dtype=np.float32)
        h = np.zeros((n, size), dtype=np.float32)
        for t in range(steps):
            h = _gates(net.tables[0], net.inner[0], part[t], h)[-1]
            states[t] = h
        sums = np.zeros((n, len(net.labels)), dtype=np.float32)
        h = np.zeros((n, size), dtype=np.float32)
        for t in range(steps - 1, -1, -1):
            h = _gates(net.tables[1], net.inner[1], part[t], h)[-1]
            logits = states[t] @ net.outer[0]
            logits += h @ net.outer[1]
            logits += net.bias
            logits -= logits.max(axis=1, keepdims=True)
            np.exp(logits, out=logits)
            logits *= (part[t] != PAD)[:, None] / logits.sum(axis=1, keepdims=True)
            sums += logits
        np.add.at(total, owner[a : a + at_once], sums)
    return total / np.maximum([len(x) for x in data], 1)[:, None]


def _grads(net: Network, symbols: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss a byte and its gradients, by backpropagation through time in both directions."""
    steps, n = symbols.shape
    size, classes = net.inner[0].shape[0], len(net.labels)
    kept: list[list] = [[], []]
    for way in (0, 1):
        h = np.zeros((n, size), dtype=np.float32)
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            step = _gates(net.tables[way], net.inner[way], symbols[t], h)
            kept[way].append((h, *step))
            h = step[-1]
        if way:
            kept[way].reverse()
    ahead = np.stack([k[-1] for k in kept[0]])
    back = np.stack([k[-1] for k in kept[1]])
    logits = ahead @ net.outer[0] + back @ net.outer[1] + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    seen = (symbols != PAD).astype(np.float32)
    total = max(1.0, float(seen.sum()))
    loss = -float((np.log(p[:, np.arange(n), label] + 1e-9) * seen).sum()) / total
    p[:, np.arange(n), label] -= 1
    p *= (seen / total)[:, :, None]
    flat = p.reshape(-1, classes)
    d_outer = [ahead.reshape(-1, size).T @ flat, back.reshape(-1, size).T @ flat]
    d_tables, d_inner = [], []
    for way in (0, 1):
        d_states = p @ net.outer[way].T
        d_table = np.zeros_like(net.tables[way])
        d_in = np.zeros_like(net.inner[way])
        carry = np.zeros((n, size), dtype=np.float32)
        for t in range(steps - 1, -1, -1) if way == 0 else range(steps):
            h, z, r, c, un, _ = kept[way][t]
            d = d_states[t] + carry
            dz = d * (h - c) * z * (1 - z)
            dc = d * (1 - z) * (1 - c * c)
            dr = dc * un * r * (1 - r)
            d_x = np.concatenate([dz, dr, dc], axis=1)
            d_u = np.concatenate([dz, dr, dc * r], axis=1)
            carry = d * z + d_u @ net.inner[way].T
            d_in += h.T @ d_u
            np.add.at(d_table, symbols[t], d_x)
        d_tables.append(d_table)
        d_inner.append(d_in)
    return loss, [*d_tables, *d_inner, *d_outer, flat.sum(axis=0)]


def train(texts: list[str], labels: list[str], size: int = 8, steps: int = 500, batch: int = 128, seed: int = 7, rate: float = 0.02) -> Network | None:
    """Fits the network to texts with their labels by Adam; None without any."""
    pairs = sorted((y, x) for x, y in zip(texts, labels, strict=True) if x)
    if not pairs:
        return None
    names = sorted({y for y, _ in pairs})
    rng = np.random.default_rng(seed)
    symbols, owner = segments([x.encode() for _, x in pairs])
    target = np.array([names.index(y) for y, _ in pairs])[owner]
    normal = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    net = Network(names, [normal(PAD + 1, 3 * size) for _ in "ab"], [normal(size, 3 * size) for _ in "ab"], [normal(size, len(names)) for _ in "ab"], np.zeros(len(names), np.float32))
    own = net.arrays()
    first, second = [np.zeros_like(w) for w in own], [np.zeros_like(w) for w in own]
    groups = [np.flatnonzero(target == c) for c in range(len(names))]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(g, max(1, batch // len(groups))) for g in groups])
        _, grads = _grads(net, symbols[:, pick], target[pick])
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        now = rate * (1 - step / (steps + 1))
        for w, m, v, g in zip(own, first, second, grads, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def training_sample(docs: DataFrame, per_label: int = 300, chars: int = 384, max_labels: int = 64, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", fold: int = 5) -> list:
    """About ``per_label`` rows of each label, with a window of at most ``chars`` code points at a place that the id's hash decides.

    No label is left out. Of more than ``max_labels`` labels each has fewer rows, so that all have about as many as ``max_labels`` have, but each at least the row
    of the least hash. Rows that share id and label are one draw, the least window of theirs. Rows whose crc32(id as text) mod ``fold`` is 0, whose id, text or label is null, or whose text is empty are not drawn.
    """
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("x"), F.col(label_col).cast("string").alias("y")).where((crc_mod(id_col, fold) != 0) & F.col(label_col).isNotNull() & (F.length(text_col) > 0))
    draw = F.pmod(F.xxhash64(F.col("i").cast("string"), F.lit(11)), F.lit(1 << 30))
    counts = rows.groupBy("y").agg(F.count("*").alias("n"), F.min(draw).alias("least")).collect()
    if not counts:
        return []
    each = max(1, per_label * max_labels // max(max_labels, len(counts)))
    shares = [(r["y"], max(r["least"] + 1, min(1 << 30, int((1 << 30) * 1.2 * each / r["n"]) + 1))) for r in counts]
    start = F.pmod(F.xxhash64(F.col("i").cast("string"), F.lit(12)), F.greatest(F.length("x") - chars + 1, F.lit(1))) + 1
    drawn = rows.join(F.broadcast(docs.sparkSession.createDataFrame(shares, "y string, share long")), "y").where(draw < F.col("share"))
    windows = drawn.select("y", F.expr("i").cast("string").alias("i"), F.substring("x", start.cast("int"), F.lit(chars)).alias("x"))
    return windows.groupBy("y", "i").agg(F.min("x").alias("x")).collect()


def fit(docs: DataFrame, per_label: int = 300, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", fold: int = 5, steps: int = 500) -> Network | None:
    """A network fitted on the bounded sample above; None if there is no labelled row."""
    sample = sorted(training_sample(docs, per_label, id_col=id_col, text_col=text_col, label_col=label_col, fold=fold))
    kept = [r for r in sample if has_letter(r["x"])]
    return train([r["x"] for r in kept], [r["y"] for r in kept], steps=steps)


def identify(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: id, the columns ``keep``, lang_pred and score, from the text alone.

    ``und`` with score 0 for a null text, a text without any letter, or without a network. Texts of any length are read whole. Repeated rows have a row each.
    """
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def make():
        def work(texts: list) -> list:
            known = [i for i, x in enumerate(texts) if net and x and has_letter(x)]
            out = [{"lang_pred": UNKNOWN, "score": 0.0}] * len(texts)
            if known:
                p = pooled(net, [texts[i].encode() for i in known])
                for i, row in zip(known, p, strict=True):
                    out[i] = {"lang_pred": net.labels[int(row.argmax())], "score": float(min(1.0, row.max()))}
            return out

        return work

    found = text_column(docs.sparkSession, F.col(text_col), kind, make, rows=192)
    return docs.select(id_col, *[c for c in keep if c != id_col], found.alias("_found")).select(id_col, *[c for c in keep if c != id_col], "_found.lang_pred", "_found.score")
