import random

from tokenizers import Tokenizer

import corpus_pipeline
from lexmill.llm import queries
from tests.llm.helpers import prose
from tests.llm.test_dedup import plain_components
from tests.llm.test_packing import plain_two_fit


def write(spark, folder, rows, items):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(5)
    item = prose(rng, 25)
    line = "this line is found in very many documents of the table"
    rows = [(i, prose(rng, 60), "xx", "s", 1) for i in range(60)]
    rows[5] = (5, f"{rows[5][1]} {item}", "xx", "s", 1)
    rows[6] = (6, rows[7][1], None, "s", 1)
    rows[8] = (8, "1234 5678 !!", "xx", "s", 1)
    rows[9] = (9, None, "xx", None, None)
    for i in (20, 21, 22, 23):
        rows[i] = (i, f"{rows[i][1]}\n{line}", "xx", "s", 1)
    write(spark, tmp_path, rows, [(1, item)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        counts.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(range(60)) - set(counts[0]) == {8, 9}
    assert [i for i in (20, 21, 22, 23) if line in counts[1][i]] == [23]
    assert set(counts[1]) - set(counts[2]) == {7} and set(counts[2]) - set(counts[3]) == {5}
    want, _ = plain_components(list(counts[1].items()))
    assert set(counts[2]) == {i for i, c in want.items() if i == c}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(counts[3])
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append(r["length"])
    theirs = Tokenizer.from_file(queries.tokenizer_path())
    sizes = [len(theirs.encode(x, add_special_tokens=False).ids) + 1 for x in counts[3].values()]
    assert max(sizes) <= 2048 and sorted(tuple(sorted(b)) for b in bins.values()) == plain_two_fit(sizes, 2048)


def test_texts_half_in_each_language_are_rejected(spark):
    rng = random.Random(3)
    speak = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))
    rows = [(i, speak("aeiou", 40) if i % 2 else speak("kptsz", 40), "xx" if i % 2 else "yy", "s", 1) for i in range(200)]
    rows += [(1000, speak("aeiou", 300) + speak("kptsz", 305), None, "s", 1), (1001, speak("aeiou", 9), None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert {r[0] for r in rows} - kept == {1000}


def test_one_row_of_each_id_and_group(spark):
    rng = random.Random(2)
    text = prose(rng, 60)
    rows = [(1, text, "b"), (1, text, "a"), (2, text, "c"), (3, prose(rng, 30), "d"), (None, text, "e"), (None, text, "e"), (4, None, "f"), (5, "", "g"), (6, "z", None), (6, "y", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    for _ in range(2):
        got = sorted(((r["doc_id"], r["_row"]) for r in corpus_pipeline.near_dedup(spark, docs.repartition(3), "").collect()), key=str)
        assert got == sorted([(1, "a"), (3, "d"), (None, "e"), (None, "e"), (4, "f"), (5, "g"), (6, "h")], key=str)
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").collect() == []


def test_empty_tables_and_odd_columns(spark, tmp_path):
    write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    rows = [(1, "a text with words", "xx", "s", 1, 0.0, "x"), (1, "a text with words", "xx", "s", 1, 0.0, "x"), (None, "other words are here", None, None, None, None, None), (3, "", "xx", "s", 0, 1.0, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns[-2:] == ["score", "lang_pred"], name
    assert sorted(r["doc_id"] or 0 for r in docs.collect()) == [0, 1]


def test_every_operator_has_a_query():
    assert sorted({int(n[2:].split("_")[0]) for n in queries.QUERIES}) == list(range(1, 11))
