import hashlib
import random

import duckdb
import numpy as np
import pytest

from lexmill.llm import chunks, common, components, lines, minhash, ranks, spans, suffixes
from tests.llm.helpers import SCHEMA, odd_rows, prose


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset([tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else []))


def plain_components(rows):
    """{id: least id reachable} with the sets of the first text of each id."""
    sets = {}
    for i, x in rows:
        if i is not None:
            sets.setdefault(i, shingles(x))
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}, sets


def chain_rows(n=40):
    """Texts of which each is a near copy of the one before, so that far ones are linked only through the others."""
    rng = random.Random(6)
    words = prose(rng, 100).split()
    rows = []
    for i in range(n):
        rows.append((1000 - i, " ".join(words)))
        words = list(words)
        words[rng.randrange(100)] = f"new{i}"
    return rows


@pytest.mark.parametrize("task_links", [7, 1000])
def test_components_of_random_links(spark, task_links):
    rng = random.Random(0)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(50)] + [(300, 200 + i) for i in range(30)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long"), task_links=task_links).collect()}
    least = {x: x for link in links for x in link}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {x: c for x, c in least.items() if any(x in link and link[0] != link[1] for link in links)}


@pytest.mark.parametrize("rows", [[(r[0], r[1]) for r in odd_rows()], chain_rows(), [(i, "a b c d e f g") for i in range(9)]], ids=["odd", "chain", "equal"])
def test_near_duplicates_against_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", __import__("pyspark").sql.functions.lit("x"))
    got = minhash.near_duplicates(docs).collect()
    want, sets = plain_components(rows)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_links_between_documents_that_are_not_leaders(spark):
    # Many groups that share a passage, some of them linked by one text between two others.
    rng = random.Random(12)
    passage = prose(rng, 60)
    rows = []
    for i in range(60):
        own = prose(rng, 12)
        rows += [(3 * i, f"{passage} {own}"), (3 * i + 1, f"{passage} {own} {prose(rng, 8)}"), (3 * i + 2, f"{prose(rng, 10)} {passage} {own}")]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_components(rows)[0]


@pytest.mark.parametrize(("block_docs", "block_shingles"), [(7, 1_000_000), (1000, 900)])
def test_links_across_blocks(spark, block_docs, block_shingles):
    # One large component and many small ones that meet it and each other in bands; a few links are found between blocks alone.
    rng = random.Random(21)
    words = prose(rng, 110).split()
    rows = []
    for i in range(45):  # near copies, all linked
        own = list(words)
        own[rng.randrange(110)] = f"near{i}"
        rows.append((500 + i, " ".join(own)))
    for i in range(25):  # alike, but apart from the large group and mostly from each other
        own = list(words)
        for at in rng.sample(range(110), 5):
            own[at] = f"far{i}x{at}"
        rows += [(i, " ".join(own)), (100 + i, " ".join([*own, f"end{i}"]))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, block_docs=block_docs, block_shingles=block_shingles).collect()}
    want = plain_components(rows)[0]
    assert got == want and 5 < len(set(want.values())) < 40


def test_blocks_of_large_components_do_not_meet(spark):
    rows = [(i, 0 if i < 30 else i, 0, 10) for i in range(60)] + [(100, 100, 100, 10), (101, 101, 100, 10)]
    own = spark.createDataFrame(rows, "node long, c long, family long, n long")
    got = minhash._blocks(own, 10, 10_000).collect()
    assert all(r["total"] == (6 if r["family"] == 0 else 1) for r in got)
    assert all((r["low"], r["high"]) == ((3, 6) if r["c"] == 0 else (None, None)) for r in got)
    assert all(3 <= r["block"] < 6 if r["c"] == 0 else r["block"] < 3 for r in got)


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(20):
        a = rng.integers(0, 1 << 63, 500, dtype=np.int64).astype(np.uint64)
        agree.append((minhash.signature(a[:400]) == minhash.signature(a[100:])).mean())
    agree = np.mean(agree)
    assert agree == pytest.approx(0.6, abs=0.05)


def test_empty_near_duplicates(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = minhash.near_duplicates(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert all(r["kept"] and r["n_shingles"] == 0 and r["component_id"] == r["doc_id"] for r in alone)


def test_lines_against_sql(spark):
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] is not None][:-1]
    rng = random.Random(3)
    pool = [prose(rng, 4) for _ in range(30)]
    rows += [(100 + i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\t"]) for _ in range(rng.randint(1, 90)))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in lines.dedup_lines(docs).selectExpr("doc_id", "_lines.n_lines", "_lines.n_dropped", "sha2(encode(coalesce(text, ''), 'UTF-8'), 256)").collect())
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert got == sorted(con.execute(lines.ORACLE).fetchall())
    assert sum(n for _, _, n, _ in got) > 20


def test_hot_lines_against_sql(spark):
    # One line that a third of all rows hold, also more than once in a document, and keys that the least number of documents has.
    rng = random.Random(13)
    hot, pair, three = (prose(rng, 6) for _ in range(3))
    rows = [(i, "\n".join([prose(rng, 5), hot, *([hot.upper()] * (i % 3 == 0)), *([pair] * (i in (4, 70))), *([three] * (i in (1, 2, 250)))])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = lines.line_keys(docs)
    assert lines.hot_keys(keyed, 4).count() == 1
    got = sorted(tuple(r) for r in lines.dedup_lines(docs).selectExpr("doc_id", "_lines.n_lines", "_lines.n_dropped", "sha2(encode(text, 'UTF-8'), 256)").collect())
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert got == sorted(con.execute(lines.ORACLE).fetchall())
    lost = {i: n for i, _, n, _ in got}
    assert [lost[i] for i in (0, 1, 4, 70, 250, 299)] == [2, 2, 1, 1, 1, 0]
    slots = {r["slot"] for r in lines.first_occurrences(keyed, lines.hot_keys(keyed, 4), 4).select("slot").distinct().collect()}
    assert slots == {0, 1, 2, 3, 4}


def test_lines_are_decided_from_the_sorted_range_partitions(spark):
    keyed = lines.line_keys(spark.createDataFrame([(1, "x" * 30)], "doc_id long, text string"))
    plan = lines.first_occurrences(keyed, keyed.select("h1", "h2").limit(1), 4)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange rangepartitioning", 1)
    steps = [x.strip(" +-:*()0123456789").split(" ")[0] for x in above.splitlines()]
    assert steps.count("Sort") == 1 and steps.count("Window") == 2 and "Exchange" not in above and "Aggregate" not in above
    assert "doc#" in above.split("Sort [")[1] and "pos#" in above.split("Sort [")[1] and "REPARTITION_BY_NUM" in below


def test_marked_texts_pass_the_bitmap(spark):
    marks = spark.createDataFrame([(i * 37, i * i - 50) for i in range(2000)], "_doc long, _body long")
    docs = marks.selectExpr("_doc as doc_id", "_body as _own").unionByName(spark.range(2000).selectExpr("id + 1000000 as doc_id", "id as _own"))
    got = lines.maybe_marked(docs, marks, "doc_id")
    assert got.columns == ["doc_id", "_own", "_maybe"] and got.count() == 4000
    assert got.where("doc_id < 1000000 and _maybe").count() == 2000 and got.where("doc_id >= 1000000 and _maybe").count() < 400
    none = lines.maybe_marked(docs, marks.limit(0), "doc_id")
    assert none.where("_maybe").count() == 0


def test_lines_without_a_filter(spark, monkeypatch):
    rows = odd_rows()
    key = lambda r: str((r["doc_id"], r["text"], r["_lines"]))
    want = sorted(map(key, lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()))
    monkeypatch.setattr(lines, "MOST_BITS", 0)
    assert sorted(map(key, lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect())) == want


def test_lines_of_odd_rows(spark):
    rows = odd_rows()
    out = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    texts = {r["doc_id"]: r["text"] for r in out}
    assert texts[11] is None and texts[10] == "" and "LINE THAT" in texts[7] and "many" not in texts[6].lower()
    assert lines.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def plain_removed(texts, length):
    seen = {}
    for x in texts:
        for i in range(len(x) - length + 1):
            seen[x[i : i + length]] = seen.get(x[i : i + length], 0) + 1
    for x in texts:
        gone = [False] * len(x)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        yield bytes(b for b, g in zip(x, gone, strict=True) if not g), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substrings_against_all_windows(spark, seed):
    rng = random.Random(seed)
    rows = odd_rows(seed)
    base = rows[0][1] * 2
    for i in range(30):  # pieces of one text with edits, so that samples have several surroundings
        a = rng.randrange(len(base) - 150)
        x = base[a : a + rng.randint(100, 500)]
        p = rng.randrange(len(x))
        rows.append((100 + i, x[:p] + "#" + x[p + 1 :], None, None, None, None, None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.dedup_substrings(docs, 90).collect())
    assert got == plainly(rows, 90)


def plainly(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    return sorted((len(x), n, s, hashlib.sha256(k).hexdigest()) for x, (k, n, s) in zip(texts, plain_removed(texts, length), strict=True))


@pytest.mark.parametrize("length", [65, 200])
def test_substrings_at_other_lengths(spark, length):
    # Passages a little shorter and longer than the length, at edges of texts and within them, a period, and one passage in a third of all texts.
    rng = random.Random(length)
    hot, rows = prose(rng, 80), []
    passages = [prose(rng, 200)[: length + d] for d in (-2, -1, 0, 1, 2, 60, 300) for _ in "ab"]
    for i in range(240):
        own, other = prose(rng, rng.randint(5, 60)), prose(rng, rng.randint(5, 60))
        mid = hot if i % 3 == 0 else rng.choice(passages)
        rows.append((i, (f"{own} {mid} {other}", f"{mid}{own}", f"{own}{mid}", f"{own}{mid}{other}{mid}")[i % 4]))
    rows += [(300, "ab" * 400), (301, "x" * 900), (302, "x" * (length - 1)), (303, "x" * length), (304, "é" * length)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.dedup_substrings(docs, length).collect())
    assert got == plainly(rows, length)


def test_ranks_across_ranges(spark):
    rng = random.Random(4)
    pairs = [(5, 5)] * 300 + [(rng.randrange(-9, 9), rng.randrange(40)) for _ in range(200)] + [(7, -(1 << 62))]
    rows = [(a, b, i) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "a long, b long, at long")
    tables = common.Written(spark, "test")
    assert df.repartitionByRange(4, "a", "b", "at").where("a = 5 and b = 5").selectExpr("spark_partition_id() as p").distinct().count() > 1
    got = {r["at"]: r for r in ranks.rerank(tables, "all", df, ["a", "b"], ["at"], keep_alone=True).collect()}
    assert sorted(got) == list(range(len(rows)))
    assert all(got[i]["alone"] == (pairs.count(pairs[i]) == 1) for i in got)
    order = sorted({got[i]["rank"]: pairs[i] for i in got}.items())
    assert [p for _, p in order] == sorted(set(pairs)) and len({(got[i]["rank"], pairs[i]) for i in got}) == len(order)
    assert {r["at"] for r in ranks.rerank(tables, "some", df, ["a", "b"], ["at"]).collect()} == {i for i in got if not got[i]["alone"]}
    assert ranks.rerank(tables, "none", df.limit(0), ["a", "b"], ["at"]).collect() == []
    again = df.unionByName(df.where("at < 40 or at > 290")).withColumn("doc", df.at % 7)  # some rows stand there twice
    found = sorted((r["doc"], r["at"]) for r in ranks.rerank(tables, "later", again, ["a", "b"], ["doc", "at"], place=["doc", "at"]).collect())
    least = {p: min((i % 7, i) for i, q in enumerate(pairs) if q == p) for p in pairs}
    assert found == sorted((i % 7, i) for i, p in enumerate(pairs) for _ in range(1 + (i < 40 or i > 290)) if (i % 7, i) != least[p])
    same = spark.createDataFrame([(1, 1, 5)] * 400 + [(1, 1, 6)] * 3, "a long, b long, at long")
    assert [r["at"] for r in ranks.rerank(tables, "same", same, ["a", "b"], ["at"], place=["at"]).collect()] == [6] * 3
    tables.close()


def test_sums_of_both_ways_name_runs_wherever_they_are():
    data = np.frombuffer(b"abcabcxabd", np.uint8)
    names = suffixes.Names(data)
    for way in (0, 1):
        a, b, c = names.of(np.array([0, 3, 7]), np.array([3, 6, 10]), way)
        assert a == b != c
    assert names.of(np.array([0]), np.array([3]), 0) != names.of(np.array([0]), np.array([3]), 1)


def test_substrings_of_nothing(spark):
    assert suffixes.dedup_substrings(spark.createDataFrame([], SCHEMA)).collect() == []
    r = suffixes.dedup_substrings(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert all((x["n_bytes"], x["n_removed"]) == (0, 0) for x in r)


def test_filter_has_no_false_negatives(spark):
    keys = [(i * 7919 - 5000, i) for i in range(3000)]
    df = spark.createDataFrame(keys, "a long, b long").repartition(3)
    made = spans.key_filter(df)
    a, b = (np.array(x) for x in zip(*keys, strict=True))
    assert made.has(a, b).all() and made.has(a + 1, b).mean() < 0.1
    assert spans.key_filter(df, 12) is None


def test_spans_are_removed_without_a_filter(spark, monkeypatch):
    monkeypatch.setattr(spans, "key_filter", lambda keys: None)
    monkeypatch.setattr(suffixes, "key_filter", lambda keys: None)
    rows = odd_rows()
    got = suffixes.dedup_substrings(spark.createDataFrame(rows, SCHEMA), 90).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == plainly(rows, 90)


def test_spans_merge():
    data = b"0123456789"
    assert spans.cut(data, np.array([5, 1, 3]), np.array([7, 2, 5])) == (b"02789", 5, 2)
    assert spans.cut(data, np.array([], int), np.array([], int)) == (data, 0, 0)
    assert spans.cut(data, np.array([5, 1, 3]), np.array([7, 2, 5]), 2) == (b"012789", 4, 1)
    assert spans.cut(data, np.array([0, 4]), np.array([4, 10]), 99) == (b"", 10, 1)


def test_gear_hash_depends_on_the_last_32_bytes():
    rng = random.Random(1)
    a, b, c = (bytes(rng.randrange(256) for _ in range(n)) for n in (50, 70, 400))
    assert (chunks.gear_hashes(a + c)[50 + 31 :] == chunks.gear_hashes(b + c)[70 + 31 :]).all()
    plain = 0
    for x in c[:40]:
        plain = ((plain << 1) + int(chunks._GEAR[x])) & 0xFFFFFFFF
    assert plain == chunks.gear_hashes(c)[39]


def test_chunks_against_a_plain_pass(spark):
    rng = random.Random(5)
    passage = prose(rng, 90)
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] is not None][:-1]
    rows += [(200 + i, prose(rng, 30) + " " + passage + " " + prose(rng, 20)) for i in range(6)]
    rows += [(300 + i, prose(rng, 30) + " " + passage[:70] + " " + prose(rng, 20)) for i in range(6)]
    seen, want = set(), {}
    for i, x in rows:
        data, at, runs = (x or "").encode(), 0, []
        for end in chunks.chunk_ends(data) if data else []:
            old = data[at:end] in seen
            if runs and runs[-1][0] == old:
                runs[-1][1] += data[at:end]
            else:
                runs.append([old, data[at:end]])
            seen.add(data[at:end])
            at = end
        kept = b"".join(x for old, x in runs if not old or (len(x) < 96 and x != data))
        want[i] = (len(data), len(data) - len(kept), hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in chunks.dedup_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
    assert all(want[200 + i][1] > 200 for i in range(1, 6)) and want[0][1] == 0


def test_chunks_of_odd_rows(spark):
    rows = odd_rows()
    assert chunks.dedup_chunks(spark.createDataFrame(rows, SCHEMA), keep_text=True).count() == len(rows)
    assert chunks.dedup_chunks(spark.createDataFrame([], SCHEMA)).collect() == []


def test_copies_lose_all_their_bytes(spark):
    rng = random.Random(7)
    texts = [prose(rng, rng.randint(1, 150)) for _ in range(40)] + ["ab", "é" * 700, "la " * 500]
    rows = [(i, x) for i, x in enumerate(texts)] + [(100 + i, x) for i, x in enumerate(texts)]
    got = {r["doc_id"]: r for r in chunks.dedup_chunks(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True).collect()}
    assert all(got[100 + i]["n_removed"] == len(x.encode()) and got[100 + i]["kept"] == b"" for i, x in enumerate(texts))


def test_no_chunk_is_short_and_ends_come_back_in_step():
    rng = random.Random(8)
    data = prose(rng, 4000).encode()
    for x in (data, b"a" * 1030, b"ab" * 5000, data[:40], data[:5]):
        ends = chunks.chunk_ends(x)
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(x) and sizes.max() <= 1024 and (sizes.min() >= 32 or ends == [len(x)])
    ends = chunks.chunk_ends(data)
    assert len(data) / len(ends) == pytest.approx(48, rel=0.1)
    moved = chunks.chunk_ends(data[:5000] + b"an insertion" + data[5000:])
    assert [e for e in moved if e < 4500] == [e for e in ends if e < 4500]
    assert [e - 12 for e in moved if e > 5512] == [e for e in ends if e > 5500]
