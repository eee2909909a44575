import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import winnowing
from tests.llm.helpers import SCHEMA, odd_rows, prose


def plain_winnow(text, k, window):
    if not text:
        return []
    h = [int(winnowing.rolling_hashes(winnowing.code_points(text[i : i + min(k, len(text))]), min(k, len(text)))[0]) for i in range(len(text) - min(k, len(text)) + 1)]
    wide, kept = min(window, len(h)), []
    for i in range(len(h) - wide + 1):
        least = min(h[i : i + wide])
        at = max(j for j in range(i, i + wide) if h[j] == least)
        if not kept or kept[-1][1] != at:
            kept.append((least, at))
    return kept


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é😀", max_size=60), st.integers(1, 7), st.integers(1, 9))
def test_keeps_the_rightmost_least_hash_of_each_window(text, k, window):
    hashes, positions = winnowing.winnow(text, k, window)
    assert list(zip(hashes.tolist(), positions.tolist(), strict=True)) == plain_winnow(text, k, window)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc", max_size=30), st.text(alphabet="abcd", min_size=12, max_size=12), st.text(alphabet="abc", max_size=30))
def test_shared_runs_share_a_hash(before, run, after):
    a, _ = winnowing.winnow(before + run, 5, 8)
    b, _ = winnowing.winnow(run + after, 5, 8)
    assert set(a.tolist()) & set(b.tolist())


def test_changes_against_plain_order(spark):
    rows = [r for r in odd_rows() if r[0] is not None][:-1]
    got = {r["doc_id"]: r for r in winnowing.fingerprint_changes(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        own, after = r[1] or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(own) // 4
        edited = own[: len(own) - n] + after[:n]
        g = got[r[0]]
        assert (g["n_chars"], g["edited_sha256"]) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert g["fingerprint"] == winnowing.digest(*winnowing.winnow(own)) and g["edited_fingerprint"] == winnowing.digest(*winnowing.winnow(edited))
        assert 0 <= g["near_edited"] <= 1 and (g["near_edited"] == 1) == (g["fingerprint"] == g["edited_fingerprint"])
        assert (g["near_next"] == 1) == (own == after)


def plain_changes(rows):
    """(id, n_chars, edited digest, fingerprint, whether the next text is the same) of rows in order of id, nulls first, and digest of the text."""
    rows = sorted(((i, x or "") for i, x in rows), key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for (i, own), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        n = len(own) // 4
        edited = own[: len(own) - n] + after[:n]
        out.append((i, len(own), hashlib.sha256(edited.encode()).hexdigest(), winnowing.digest(*winnowing.winnow(own)), own == after))
    return sorted(out, key=str)


def test_ids_of_any_kind_against_plain_order(spark):
    rng = random.Random(9)
    texts = [prose(rng, rng.randint(1, 30)) for _ in range(60)]
    named = [(f"document-{i:06d}", x) for i, x in enumerate(texts)]
    numbered = [((-1) ** i * (1 << 60) + i, x) for i, x in enumerate(texts)]
    crowded = [*((i, x) for i, x in enumerate(texts)), *[(30, texts[30])] * 90, *[(0, texts[0])] * 40, *[(None, "n")] * 3, *[(7, f"another {i}") for i in range(50)]]
    for rows, kind in ((named, "string"), (numbered, "long"), (crowded, "long"), ([(1, "same text")] * 200, "int")):
        rng.shuffle(rows)
        got = winnowing.fingerprint_changes(spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)).collect()
        assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["near_next"] == 1) for r in got), key=str) == plain_changes(rows)
    odd = spark.createDataFrame([(float("nan"), "a"), (1.5, "b"), (-2.0, "c")], "doc_id double, text string")
    assert winnowing.fingerprint_changes(odd).count() == 3


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    assert winnowing.fingerprint_changes(docs).count() == len(rows)
    assert winnowing.fingerprint_changes(docs.limit(1)).first()["near_next"] == 1.0
    assert winnowing.fingerprint_changes(docs.limit(0)).collect() == []
    named = spark.createDataFrame([("b", "x"), ("a", "y"), ("aa", "x")], "doc_id string, text string")
    got = {r["doc_id"]: r["near_next"] for r in winnowing.fingerprint_changes(named).collect()}
    assert got == {"a": 0.0, "aa": 1.0, "b": 0.0}
    kept = winnowing.fingerprints(docs)
    assert kept.count() == len(rows) and kept.where("doc_id = 10").first()["hashes"] == []
