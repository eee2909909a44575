import random

import numpy as np
import pytest

from lexmill.llm import langid, quality, toxicity
from tests.llm.helpers import SCHEMA, odd_rows, prose


def auc(y, p):
    order = np.argsort(p)
    rank = np.empty(len(p))
    rank[order] = np.arange(len(p))
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones))


@pytest.fixture(scope="module")
def speech():
    rng = random.Random(4)
    kinds = {"xx": "aeioulmnr", "yy": "kptszxwv", "zz": "éüöäbdg"}
    rows = []
    for i in range(240):
        name = sorted(kinds)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(kinds[name]) for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 60))), name))
    return rows


def test_gradients_match_differences():
    net = langid.train(["abc ab", "xyz"], ["a", "b"], size=3, steps=1)
    for w in net.arrays():
        w[:] = w.astype(np.float32)
    symbols, owner = langid.segments([b"abcab", b"xy"], 6)
    label = np.array([0, 1])[owner]
    _, grads = langid._grads(net, symbols, label)
    for w, g in zip(net.arrays(), grads, strict=True):
        flat, at = w.reshape(-1), int(np.abs(g).argmax())
        keep, step = flat[at], np.float32(1e-2)
        flat[at] = keep + step
        up, _ = langid._grads(net, symbols, label)
        flat[at] = keep - step
        down, _ = langid._grads(net, symbols, label)
        flat[at] = keep
        assert (up - down) / (2 * step) == pytest.approx(g.reshape(-1)[at], rel=0.1, abs=2e-3)


def test_language_on_held_out_rows(spark, speech):
    docs = spark.createDataFrame(speech, "doc_id long, text string, lang string")
    net = langid.fit(docs, per_label=60, steps=120)
    found = langid.identify(docs, net, keep=("lang",)).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_no_label_is_left_out_of_the_sample(spark):
    rows = [(i, f"text {i}", f"l{i % 90}") for i in range(1800)] + [(2000 + i, f"more {i}", "l0") for i in range(3000)] + [(1, f"again {i}", "l1") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawable = {y for i, _, y in rows if __import__("zlib").crc32(str(i).encode()) % 5}
    assert {r["y"] for r in langid.training_sample(docs)} == drawable and len(drawable) == 90
    few = langid.training_sample(docs, per_label=1, max_labels=4)
    assert {r["y"] for r in few} == drawable and len(few) < 300


def test_language_of_odd_rows(spark, speech):
    net = langid.train([x for _, x, _ in speech], [y for _, _, y in speech], steps=20)
    rows = odd_rows()
    got = langid.identify(spark.createDataFrame(rows, SCHEMA), net).collect()
    assert len(got) == len(rows)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (10, 11, 12)} == {"und"}
    assert all(r["lang_pred"] in ("xx", "yy", "zz") for r in got if r["doc_id"] in (0, 13, 14))
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.fit(empty) is None
    assert langid.identify(empty, None).collect() == []
    nothing = langid.identify(spark.createDataFrame(rows[:1], SCHEMA), None).first()
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0.0)


def test_segments_of_long_texts_are_all_read(speech):
    net = langid.train([x for _, x, _ in speech], [y for _, _, y in speech], steps=60)
    a, b = "aeiou lmnr " * 200, "kptsz xwv " * 200
    p = langid.pooled(net, [(a + b).encode()])[0]
    assert p[net.labels.index("xx")] > 0.3 and p[net.labels.index("yy")] > 0.3 and p.sum() == pytest.approx(1, abs=1e-3)


def test_pooled_probabilities_against_a_plain_pass(speech):
    """One byte at a time, with the gates written out."""
    net = langid.train([x for _, x, _ in speech], [y for _, _, y in speech], steps=15)
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    size = net.inner[0].shape[0]

    def states(way, data):
        h, out = np.zeros(size), []
        for c in data if way == 0 else data[::-1]:
            x, w = net.tables[way][c].astype(float), net.inner[way].astype(float)
            z = sigmoid(x[:size] + h @ w[:, :size])
            r = sigmoid(x[size : 2 * size] + h @ w[:, size : 2 * size])
            n = np.tanh(x[2 * size :] + r * (h @ w[:, 2 * size :]))
            h = z * h + (1 - z) * n
            out.append(h)
        return out if way == 0 else out[::-1]

    for text in ("a", "aeiou kptsz é", "lmnr aeiou " * 30, "x" * langid.SEGMENT):
        data, total = text.encode(), np.zeros(len(net.labels))
        for at in range(0, len(data), langid.SEGMENT):
            part = [*data[at : at + langid.SEGMENT]]
            padded = part + [langid.PAD] * (langid.SEGMENT - len(part))
            ahead, back = states(0, padded), states(1, padded)
            for t in range(len(part)):
                logits = ahead[t] @ net.outer[0] + back[t] @ net.outer[1] + net.bias
                e = np.exp(logits - logits.max())
                total += e / e.sum()
        assert langid.pooled(net, [data])[0] == pytest.approx(total / len(data), abs=1e-4)


def test_first_split_against_all_splits():
    rng = np.random.default_rng(4)
    for _ in range(5):
        x = rng.integers(0, 12, (80, 4)).astype(float)
        y = (x[:, 1] + rng.integers(0, 6, 80) > 9).astype(float)
        trees = quality.boost(x, y, trees=1, depth=1, bins=64, least=5)
        p = 1 / (1 + np.exp(-trees.base))
        best = (1e-6, None, None)
        for f in range(4):
            for c in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1])):
                left = x[:, f] <= c
                if 5 <= left.sum() <= 75:
                    part = lambda m: (p - y[m]).sum() ** 2 / (p * (1 - p) * m.sum() + 1.0)
                    gain = part(left) + part(~left) - part(left | ~left)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, c)
        assert (trees.feature[0, 0], trees.cut[0, 0]) == best[1:]
        left = x[:, best[1]] <= best[2]
        want = [-0.15 * (p - y[m]).sum() / (p * (1 - p) * m.sum() + 1.0) for m in (left, ~left)]
        assert trees.value[0] == pytest.approx(want)


def test_trees_learn_and_are_flat():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = quality.boost(x[:400], y[:400], trees=40)
    assert ((trees.scores(x[400:]) > 0.5) == y[400:]).mean() > 0.9
    one = trees.scores(x[400:401])
    total = trees.base
    for t in range(len(trees.feature)):
        node = 0
        while node < trees.feature.shape[1]:
            node = 2 * node + 1 + int(x[400, trees.feature[t, node]] > trees.cut[t, node])
        total += trees.value[t, node - trees.feature.shape[1]]
    assert one[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_title_words_are_counted_over_the_whole_text():
    at = quality.FEATURES.index("title_words")
    for words in (["Aa", "bb"] * 2000, ["aa", "Bb"] * 2000, ["Aa"] * 9 + ["bb"] * 4991, ["Aa", "bb", "cc", "Dd"]):
        assert quality.statistics(" ".join(words))[at] == sum(map(str.istitle, words)) / len(words)
    assert quality.statistics(" \n ")[at] == 0


def test_quality_on_held_out_rows(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        good = i % 2
        rows.append((i, prose(rng, rng.randint(20, 90)) if good else "buy now!! " * rng.randint(5, 40)))
        labels.append((i, good, 0))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    trees = quality.fit(docs, known)
    got = {r["doc_id"]: r for r in quality.score_quality(docs, trees).collect()}
    assert np.mean([got[i]["predicted"] == q for i, q, _ in labels]) > 0.97
    odd = quality.score_quality(spark.createDataFrame(odd_rows(), SCHEMA), trees).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in odd)
    nothing = quality.fit(docs, known.limit(0))
    assert quality.score_quality(docs, nothing).first()["score"] == 0.5


def test_probabilities_of_a_context_sum_to_one():
    made = toxicity.levels([b"abc", b"abd", b"xyz"], np.array([3.0, 1.0, 2.0]), 5)
    model = toxicity.Model((made, made), np.full((256, 256), 1 / 256), 5)
    for context in (b"  ab", b"    ", b"  zz"):
        base = int.from_bytes(context, "big") << 8
        keys = np.array([base + b for b in range(256)], dtype=np.uint64)
        assert np.exp(model.log_likelihood(0, keys)).sum() == pytest.approx(1.0)


@pytest.mark.parametrize("order", [3, 5])
def test_likelihoods_against_plain_kneser_ney(order):
    """Interpolated Kneser-Ney by its definition: counts at the highest order, numbers of distinct bytes before below it, a table of pairs at the bottom."""
    rng = random.Random(order)
    words = {prose(rng, 1).encode(): float(rng.randint(1, 9)) for _ in range(60)}
    shared = np.full((256, 256), 1 / 256)
    model = toxicity.Model((toxicity.levels(list(words), np.array(list(words.values())), order), []), shared, order)
    count = [{} for _ in range(order + 1)]
    for w, n in words.items():
        padded = b" " * (order - 1) + w + b" "
        for i in range(len(padded) - order + 1):
            g = padded[i : i + order]
            count[order][g] = count[order].get(g, 0.0) + n
    for k in range(order - 1, 1, -1):
        for g in {x[1:] for x in count[k + 1]}:
            count[k][g] = float(len({x[0] for x in count[k + 1] if x[1:] == g}))

    def plain(gram, k):
        if k == 1:
            return 1 / 256
        follows = {g[-1]: c for g, c in count[k].items() if g[:-1] == gram[-k:-1]}
        below = plain(gram, k - 1)
        if not follows:
            return below
        total = sum(follows.values())
        c = follows.get(gram[-1], 0.0)
        return max(c - toxicity.DISCOUNT, 0) / total + sum(min(x, toxicity.DISCOUNT) for x in follows.values()) / total * below

    tried = [b" " * (order - 1) + w for w in (*list(words)[:20], b"zzz", b"abq")]
    grams = [p[i : i + order] for p in tried for i in range(len(p) - order + 1)]
    got = model.log_likelihood(0, np.array([int.from_bytes(g, "big") for g in grams], np.uint64))
    assert got == pytest.approx([float(np.log(plain(g, order))) for g in grams])


def test_toxicity_of_an_empty_table(spark):
    docs, known = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    assert toxicity.score_toxicity(docs, model).collect() == []
    one = toxicity.score_toxicity(spark.createDataFrame([(1, None), (2, ""), (3, "words")], "doc_id long, text string"), model).collect()
    assert [r["predicted"] for r in one] == [0, 0, 0]
    assert quality.score_quality(docs, quality.fit(docs, known)).collect() == []


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        bad = int(i % 4 == 0)
        words = prose(rng, rng.randint(20, 60)).split()
        for _ in range(4 * bad):
            words[rng.randrange(len(words))] = "zurg" + rng.choice(["ak", "ol", "ith", "a"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, bad))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    held = [(t, got[i]) for i, _, t in labels if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert auc(np.array([t for t, _ in held]), np.array([s for _, s in held])) > 0.97
    odd = toxicity.score_toxicity(spark.createDataFrame(odd_rows(), SCHEMA), model).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score_toxicity(docs, toxicity.fit(docs, known.limit(0))).first()["predicted"] == 0
