import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexmill.llm import packing
from tests.llm.helpers import SCHEMA, odd_rows

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def test_same_ids_as_the_tokenizer_file():
    ours, theirs = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    for text in [*(r[1] or "" for r in odd_rows()), "it's  a b c\r\n\r\n 123 ½ ١٢ <|endoftext|>x", "日本語\x1c\x1d​", "\u0085 a", "a" * 300]:
        assert ours.ids(text) == theirs.encode(text, add_special_tokens=False).ids
    assert ours.slow is None


def test_same_ids_of_long_runs():
    ours = packing.Encoder(PATH)
    for text in (" " * 1_000_000 + "x", "\n" * 1_000_000, "a" * 1_000_000, "x" + " \t" * 500_000, "." * 1_000_000):
        assert ours.ids(text) == _THEIRS.encode(text, add_special_tokens=False).ids


def test_a_long_run_is_packed(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000 + "x"), (2, "y")], "doc_id long, text string")
    pieces = packing.pack_documents(docs, PATH).collect()
    assert sum(r["length"] for r in pieces if r["doc_id"] == 1) == 1_000_001 and max(r["length"] for r in pieces) == 2048


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_on_any_text(text):
    assert _OURS.ids(text) == _THEIRS.encode(text, add_special_tokens=False).ids


_THEIRS = Tokenizer.from_file(PATH)
_OURS = packing.Encoder(PATH)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_plan_packs_every_piece_once(sizes):
    counts = {x: sizes.count(x) for x in set(sizes)}
    plan = packing.best_two_fit(counts, 64)
    used: dict[int, int] = {}
    for pattern, times in plan:
        assert times > 0 and sum(x * n for x, n in pattern.items()) <= 64
        for x, n in pattern.items():
            used[x] = used.get(x, 0) + n * times
    assert used == counts
    assert sum(t for _, t in plan) <= 1.25 * -(-sum(sizes) // 64) + 1 or max(sizes) > 21


def plain_two_fit(sizes, most):
    """Best-two-fit one bin at a time, on a list: its bins as sorted tuples."""
    left, bins = sorted(sizes, reverse=True), []
    while left:
        own, gap, rest = [], most, list(left)
        for x in left:
            if x <= gap:
                own.append(x)
                rest.remove(x)
                gap -= x
        if gap and len(own) > 1:
            small, best = min(own), None
            for i, a in enumerate(rest):
                for b in rest[i + 1 :]:
                    if small < a + b <= gap + small and (best is None or (a + b, a) > (sum(best), best[0])):
                        best = (a, b)
            if best:
                own.remove(small)
                own += best
        for x in own:
            left.remove(x)
        bins.append(tuple(sorted(own)))
    return sorted(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40))
def test_plan_against_one_bin_at_a_time(sizes):
    plan = packing.best_two_fit({x: sizes.count(x) for x in set(sizes)}, 40)
    got = sorted(tuple(sorted(x for x, n in used.items() for _ in range(n))) for used, times in plan for _ in range(times))
    assert got == plain_two_fit(sizes, 40)


def test_smallest_piece_gives_way_to_two_that_fit_more_tightly():
    # 60 + 30 leaves 10; without 30 the gap of 40 takes 25 + 14, which leaves 1.
    plan = packing.best_two_fit({60: 1, 30: 1, 25: 1, 14: 1}, 100)
    assert plan[0] == ({60: 1, 25: 1, 14: 1}, 1)


def test_cut_puts_the_short_piece_first():
    assert packing.cut_pieces(5, 2) == [(0, 1), (1, 2), (3, 2)]
    assert packing.cut_pieces(4, 2) == [(0, 2), (2, 2)]
    assert packing.cut_pieces(2, 2) == [(0, 2)]


def test_documents_round_trip(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    pieces = packing.pack_pieces(packing.token_pieces(docs, PATH, 256, with_ids=True), 256).collect()
    assert len([r for r in pieces if r["start"] == 0]) == len(rows)
    own = {}
    for r in pieces:
        assert r["length"] == len(r["ids"]) <= 256
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        own.setdefault(r["doc_id"], {})[r["piece"]] = r["ids"]
    for r in rows:
        if r[0] is not None:
            ids = [x for p in sorted(own[r[0]]) for x in own[r[0]][p]]
            assert ids == [*_THEIRS.encode(r[1] or "", add_special_tokens=False).ids, 0]
    bins: dict[int, list] = {}
    for r in pieces:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    total = 0
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
        total += at
    assert len(bins) <= -(-total // 256) + 2


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []
