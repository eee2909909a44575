import random

import numpy as np

from lexmill.llm import decontam
from tests.llm.helpers import SCHEMA, odd_rows, prose


def plain_best(item, text):
    """The fewest edits of an occurrence of the item anywhere in the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        p = rng.randrange(len(out))
        rng.choice([lambda p=p: out.__setitem__(p, "*"), lambda p=p: out.__delitem__(p), lambda p=p: out.insert(p, "+")])()
    return "".join(out)


def test_finds_exactly_what_is_within_the_budget():
    rng = random.Random(3)
    items = [(i, prose(rng, rng.randint(12, 30))) for i in range(12)]
    index = decontam.build_index(items)
    for trial in range(60):
        i, x = items[trial % 12]
        k, _ = decontam.budget(len(x))
        n = rng.randint(0, k + 3)
        text = f"{prose(rng, 25)} {edited(rng, x, n)} {prose(rng, 15)}"
        best = plain_best(decontam.normal(x), decontam.normal(text))
        found = {index.ids[a]: e for a, e, _ in decontam.find(text, index)}
        assert found == ({i: best} if best <= k else {})


def test_bands_reach_the_bound():
    for m in range(10, 600):
        k, need = decontam.budget(m)
        assert need >= 1 and (k == 0 or m - 10 + 1 - 10 * k >= 1)


def test_alignment_ends_where_the_item_ends():
    item, text = (np.frombuffer(x, np.uint8).astype(np.uint64) for x in (b"abcdefghij", b"xxabcdeXfghijyy"))
    assert decontam.align(item, text, -2, 6, 3) == (1, 13)


def test_leaks_and_blocks(spark):
    rng = random.Random(7)
    rows = odd_rows()
    items = [(i, prose(rng, 20)) for i in range(6)] + [(6, None), (7, "short"), (8, "")]
    rows += [(300 + i, f"{prose(rng, 30)}\n{x.upper()}\n {prose(rng, 30)}", *rows[0][2:]) for i, x in items[:6]]
    rows += [(None, rows[-1][1], *rows[0][2:]), rows[-1]]  # a null id and a repeated row that match
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    for most in (100, 10_000):
        got = sorted(((r["doc_id"], r["item_id"], r["edits"]) for r in decontam.leaks(docs, bench, most_chars=most).collect()), key=str)
        assert got == sorted([(300 + i, i, 0) for i in range(6)] + [(None, 5, 0), (305, 5, 0)], key=str)
        kept = decontam.drop_leaks(docs, bench, most_chars=most)
        assert kept.columns == docs.columns and kept.count() == len(rows) - 8
    assert decontam.leaks(docs, bench.limit(0)).collect() == []
    assert decontam.leaks(docs.limit(0), bench).collect() == []
    assert decontam.drop_leaks(docs, bench.limit(0)).count() == len(rows)
