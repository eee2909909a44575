"""Tables worked out by hand, properties, and sources."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lexmill import schema
from lexmill.operators import continuation, dedup, joins, layout, search, shard
from lexmill.plans import reports
from lexmill.sources import builders, courts, html, payloads, registry
from lexmill.streaming import ingest


def rows_of(spark, values, **columns):
    kinds = "page_id int, row_no int, " + ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([(0, i + 2, *v) for i, v in enumerate(values)], kinds)


def test_groups_and_audit(spark):
    rows = rows_of(spark, [("",), ("A|",), ("",), ("",), ("B|",), ("A|",)], uniqueness=0)
    groups = dedup.keyed_groups(rows)
    assert sorted((r["start_row"], r["end_row"], r["key"]) for r in groups.collect()) == [(3, 5, "A|"), (6, 6, "B|"), (7, 7, "A|")]
    assert tuple(dedup.audit_counts(groups).first()) == (3, 2, 1)
    assert [(r["start_row"], r["first_start"]) for r in dedup.audit(groups).collect()] == [(7, 3)]
    assert sorted(r["row_no"] for r in dedup.delete_duplicates(rows).collect()) == [2, 3, 4, 5, 6]


def test_ranges(spark):
    ranges = spark.createDataFrame([(0, 3, 5), (0, 6, 6), (0, 9, 9)], "page_id int, start_row int, end_row int")
    merged = dedup.coalesce_ranges(ranges)
    assert sorted((r["start_row"], r["end_row"]) for r in merged.collect()) == [(3, 6), (9, 9)]
    assert dedup.range_totals(merged).first()["deleted_rows"] == 5


def test_fate(spark):
    rows = rows_of(spark, [("",), ("m",), ("",), ("x",), ("",), ("m",), ("",)], petitioner=0)
    kept = continuation.carried_fate(rows, continuation.hit_rows(rows, F.col("petitioner") == "m"))
    assert sorted(r["row_no"] - 1 for r in kept.collect()) == [2, 3, 6, 7]


def test_runs_against_a_sequential_model(spark):
    rng = random.Random(3)
    values = [(rng.choice(["", "n"]), rng.choice(["", "", "q"]), rng.choice(["", "h"])) for _ in range(600)]
    rows = rows_of(spark, values, caseNumber=0, otherRespondent=0, listingHistory=0)
    got = sorted((r["row_no"], r["_is_continuation"]) for r in continuation.matched_runs(rows, continuation.hit_rows(rows, F.col("otherRespondent") == "q")).collect())
    want, i = [], 0
    while i < len(values):
        if values[i][1] == "q":
            want.append((i + 2, False))
            while i + 1 < len(values) and values[i + 1][2] and not values[i + 1][0]:
                i += 1
                want.append((i + 2, True))
        i += 1
    assert got == want


def test_search_and_exact_filter(spark):
    rows = rows_of(spark, [("1", '"Ram Das", "X"', ""), ("", "", "h"), ("2", "Ram Dass", ""), ("3", "Shri Ram Das", "")], caseNumber=0, petitioner=0, listingHistory=0)
    found = search.search_individual(rows.withColumn("partyName", F.lit("")), "Ram Das")
    assert sorted((r["row_no"], r["partyName"]) for r in found.collect()) == [(2, "Ram Das"), (3, ""), (4, "Ram Das"), (5, "Ram Das")]
    assert sorted(r["row_no"] for r in search.filter_exact(found, "Mr. Ram Das", "individual").collect()) == [2, 3, 5]
    assert search.filter_exact(found, "Ram Das", "company").count() == 4
    odd = rows_of(spark, [("1", "M/s. Acme (I) Ltd &amp; Ors"), ("2", "ACME (INDIA) LTD"), ("3", '"Zed", "acme  (i) ltd."'), ("4", "Acme Ltd")], caseNumber=0, petitioner=0)
    assert sorted(r["row_no"] for r in search.filter_exact(odd, "Acme (India) Ltd", "individual").collect()) == [2, 3, 4]
    firm = rows_of(spark, [("1", "Acme Foods Pvt Ltd", ""), ("", "", "h"), ("2", "Zed", "")], caseNumber=0, petitioner=0, listingHistory=0)
    assert sorted(r["row_no"] for r in search.search_company(firm, "Acme Foods Private Limited").collect()) == [2, 3]


def test_overflow(spark):
    rows = spark.createDataFrame([(1, "abcdefg", "xy"), (2, "", None)], "k int, a string, b string")
    parts = layout.split_overflow(rows, ["a", "b"], 3)
    assert sorted(tuple(r) for r in parts.collect()) == [(1, 0, "abc", "xy"), (1, 1, "def", ""), (1, 2, "g", ""), (2, 0, "", "")]
    assert sorted(tuple(r) for r in layout.join_overflow(parts, ["k"], ["a", "b"]).collect()) == [(1, "abcdefg", "xy"), (2, "", "")]
    nested = spark.createDataFrame([(1, [("d", None)])], "k int, a array<struct<x:string,y:string>>")
    assert layout.split_overflow(nested, ["a"], 100).first()["a"] == '[{"x":"d","y":null}]'


@pytest.mark.parametrize("parts", ["1", "4", "16"])
def test_numbers_do_not_depend_on_partitions(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        numbered = layout.paginate(layout.number_rows(spark.range(1000).withColumn("x", (F.col("id") * 7919) % 1000), ["x"]), page_rows=101)
        assert all(r["n"] == r["x"] and r["page_no"] == r["x"] // 100 for r in numbered.collect())
        groups = spark.range(300).withColumn("size", F.col("id") % 5 + 1)
        pages = layout.paginate_groups(groups, "size", ["id"], 5, 50).groupBy("page_no").agg(F.sum("size").alias("s")).collect()
        assert max(r["s"] for r in pages) <= 49 and sum(r["s"] for r in pages) == 900
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shards(spark):
    items = spark.range(10).withColumnRenamed("id", "i")
    sizes = [shard.slice_for(items, ["i"], s, 3).count() for s in (1, 2, 3, 4)]
    assert sizes == [4, 3, 3, 0]
    assert shard.slice_for(items, ["i"], 1, 1).count() == 10 and shard.slice_for(items, ["i"], 2, 1).count() == 0
    assert spark.range(1).select(shard.strided(F.lit(10), F.lit(1), F.lit(3), 3).alias("s")).first()["s"] == [11, 14, 17]
    assert shard.nclt_grid(spark, "x", 2007, 2026).count() == 1200


def test_court_grids(spark):
    inner = schema.dimension(spark, [("b1",), ("b2",)], "bench string")
    types = schema.dimension(spark, [("t",)], "type string")
    units = courts.court_grid(spark, inner, types, 2024, 2025).orderBy("unit").collect()
    assert [(r["bench"], r["year"], r["state"]) for r in units][:3] == [("b1", 2025, "Pending"), ("b1", 2025, "Disposed"), ("b1", 2024, "Pending")] and len(units) == 8
    assert courts.sc_case_types(spark).count() == 38


def test_write_cases_twice_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    batch = rows_of(spark, [("A|1", "x"), ("a|1", "y"), ("B|", "z")], uniqueness=0, caseNumber=0)
    assert dedup.write_cases(batch, path, ["row_no"]) == 2
    assert dedup.write_cases(batch, path, ["row_no"]) == 0
    keys = str(tmp_path / "keys")
    dedup.write_keys(spark.read.parquet(path), keys)
    assert sorted(r["key"] for r in dedup.read_keys(spark, keys).collect()) == ["A|1", "B|"]


def test_stream_equals_batch(spark, tmp_path):
    source, store, check = (str(tmp_path / n) for n in ("in", "store", "check"))
    rows = [(i % 7, i, f"K|{i % 20}") for i in range(60)]
    frame = spark.createDataFrame(rows, "page_id int, row_no int, uniqueness string")
    frame.repartition(4).write.parquet(source)

    def run():
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.ingest(stream, lambda b: b, store, check, ["row_no"]).awaitTermination()
        return sorted(r["key"] for r in spark.read.parquet(store).collect())

    assert run() == sorted({f"K|{i % 20}" for i in range(60)}) == run()


def test_stream_windows(spark, tmp_path):
    events = spark.createDataFrame([("a", "2024-01-01 00:05:00"), ("a", "2024-01-01 00:55:00"), ("b", "2024-01-01 01:05:00")], "kind string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    once = ingest.dedup_in_flight(stream, "kind", "ts")
    q = ingest.arrivals(stream, "kind", "ts").writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["kind"], r["events"]) for r in spark.table("windows").collect()) == [("a", 2), ("b", 1)]
    p = once.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    p.awaitTermination()
    assert spark.table("once").count() == 2


PAGE = """<table class="case_details_table"><tr><td>Case Type</td><td>CS - CIVIL SUIT</td></tr>
<tr><td>Registration Number</td><td>12/2024</td><td>Registration Date:</td><td>09-01-2024</td></tr></table>
<table class="table_r"><tr><td>Case Status</td><td>Case disposed</td></tr></table>
<div class="Petitioner_Advocate_table">1) Acme Foods Pvt Ltd</br>Advocate- A. Rao, B. Das<br>C. Sen,<br>2) Sita  Devi</div>
<div class="Respondent_Advocate_table">1) Orbit Steel Ltd</div>"""


def test_case_page():
    kv, pet, pet_advs, res, res_advs, hearings, orders, error = html.read_case_page(PAGE, "dc")
    assert kv == {"Case Type": "CS - CIVIL SUIT", "Registration Number": "12/2024", "Registration Date": "09-01-2024", "Case Status": "Case disposed"}
    assert (pet, pet_advs, res, res_advs) == (["Acme Foods Pvt Ltd", "Sita Devi"], ["A. Rao", "B. Das", "C. Sen"], ["Orbit Steel Ltd"], [])
    assert html.read_case_page("<p>sql error 5</p>", "hc")[-1] == "sql_error" and html.read_case_page(None, "hc")[0] == {}


def test_nested_rows_and_bad_markup():
    root = html.parse("<table><tr><td>a<table><tr><td>in</td></tr></table></td></tr></b><tbody><tr><td>b<br>c</td></tr></table>")
    assert [r.text("|") for r in html.rows_of(root.find("table"))] == ["a|in", "b|c"]


def test_hits():
    page = """<table><tr><td>1</td><td>CS/5/2024</td><td><a href="#" onclick="viewHistory(1,'C',3,4,'5',6,7,8)" aria-label="view case X">v</a></td></tr></table><a href="#" onclick="viewHistory(1)">w</a>"""
    assert html.read_dc_hits(page) == [("1", "C", "3", "5", "6", "7", "8", "CScaseType", "view case X", "CS/5/2024")]
    row = "<tr data-diary-no=1 data-diary-year=2024>" + "".join(f"<td>{x}</td>" for x in "abcdef") + "</tr>"
    assert html.read_sc_hits(f"<table>{row}<tr><td>x</td></tr></table>") == [("1", "2024", "c", "d", "e", "f")]


def test_options(spark):
    page = spark.createDataFrame([('<select><option value="">-</option><option value=0>all</option><option value="3^a">Three</option></select>',)], "p string")
    got = page.select(html.options("p").alias("a"), html.options("p", zero=False).alias("b"), html.options("p", mark="^").alias("c"), html.sc_hits("p", True).alias("d"), html.dc_hits("p").alias("e"), html.unescape_all(F.lit("a&eacute;")).alias("f")).first()
    assert [x["value"] for x in got["a"]] == ["0", "3^a"] and [x["text"] for x in got["b"]] == ["Three"] and len(got["c"]) == 1 and got["d"] == got["e"] == [] and got["f"] == "aé"


def test_titles_as_in_sql(spark, tmp_path):
    pages = [
        None, "", "no title", "<title> a </title>", "<title></title><title>b</title>", "<TITLE>a</TITLE>", '<title lang="x">a</title>', "<title>a</title >", "<title>a", "<!--<title>c</title>--><title>d</title>",
        "<title>a<b>c</b></title><title>z</title>", "<title>a\n b\t</title>", "<title>a &amp;&amp</title>", "<title>token = &quot;x&quot; &#38;lt; &nbsp;</title>", "<title>&amp;lt;&amp;amp;&lt;b&gt;</title>",
        "<title>&&lt;amp;&&amp;gt;amp;</title>", "<title>\xa0\u2003x\u3000 </title>", "<title>\u200bx\r\x85</title>", "<title>$1 \\1</title>", f"<title>{'q' * 300000} </title>",
    ]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    sql = __spark_entry__.oracle_sql()["q_html_titles"]
    want = con.execute(sql[sql.rindex("SELECT page_id") :]).fetchall()
    got = [tuple(r) for r in __spark_entry__.queries()["q_html_titles"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and dict(got)[0] is None and dict(got)[12] == "a &&amp"


def test_builders(spark):
    hit = spark.createDataFrame([(PAGE, "C1", None, "view case x, P<br>Vs</br>R", "st", "di")], "page string, cino string, case_no string, case_label string, state_name string, dist_name string")
    dc = builders.build_dc(hit.withColumn("detail", html.case_page("page", "dc"))).first()
    assert (dc["caseNumber"], dc["petitioner"], dc["uniqueness"], dc["courtType"], dc["caseStatus"]) == ("12", '"Acme Foods Pvt Ltd", "Sita Devi"', "DC|C1", "District Court", "Disposed")
    empty = hit.withColumn("detail", html.case_page(F.lit(""), "dc_on_demand"))
    old = builders.build_dc_on_demand(empty, "q").first()
    assert (old["partyName"], old["petitioner"], old["respondent"], old["location"], old["courtType"], old["caseNumber"]) == ("q", '"P"', '"R"', "st", "DISTRICT_COURT (di)", "C1")
    hc = builders.build_hc_on_demand(hit.withColumn("detail", html.case_page(F.lit(""), "hc")).withColumn("hc_name", F.lit("X")), "q", "").first()
    assert hc["courtType"] == "HIGH_COURT (X)" and hc["caseStatus"] == "Pending"
    tabs = F.create_map(F.lit("case_details"), F.lit("<table><tr><td>Diary Number</td><td>1 Filed on 03-02-2025 10:00 AM</td></tr><tr><td>Case Number</td><td>SLP 5/2025 Registered on 1</td></tr><tr><td>Likely to be listed on</td><td>04-02-2025</td></tr></table>"))
    sc = builders.build_sc_on_demand(hit.withColumn("detail", html.sc_page(tabs)), "q").first()
    assert (sc["registrationDate"], sc["caseNumber"], sc["nextListingDate"], sc["location"]) == ("03 FEB 2025", "SLP 5/2025", "04 FEB 2025", "India")
    assert set(dc.asDict()) == set(schema.CASE_COLUMNS)


def test_normalize_rows(spark):
    rows = rows_of(spark, [("Mr. A, B", "hearing"), ("", None), ("X", " ")], petitioner=0, caseStatus=0)
    assert [(r["petitioner"], r["caseStatus"]) for r in builders.normalize_rows(rows).orderBy("row_no").collect()] == [('"A", "B"', "Pending"), ("", ""), ('"X"', "Pending")]


def test_payloads(spark):
    assert payloads.chosen_tabs(None) == list(schema.SC_REQUIRED_TABS) and payloads.chosen_tabs("notices, x") == ["notices"] and len(payloads.chosen_tabs("all")) == 9
    replies = ["<html>x", '{"Error": "bad"}', "Record Not Found", '{"con": ["Invalid Captcha"]}', '{"con": "invalid captcha"}', '{"totRecords": "2"}', "﻿{}", "THERE IS AN ERROR", "[1"]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, r string")
    kinds = [r["k"] for r in frame.select("i", payloads.reply_kind("r").alias("k")).orderBy("i").collect()]
    assert kinds == ["session_expired", "captcha_error", "no_results", "captcha_error", "captcha_error", "ok", "no_results", "captcha_error", "captcha_error"]


def test_registry():
    known, unknown = registry.known_sources(["nclt", "x"])
    assert [s.name for s in known] == ["nclt"] and unknown == ["x"] and len(registry.all_sources()) == 9


def test_reports(spark):
    rows = spark.createDataFrame([("NCLT", "A"), ("NCLT", "B"), ("HIGH_COURT (X)", "C"), ("High Court", "D"), (None, "E")], "courtType string, benchName string")
    assert {r["courtType"]: r["cases"] for r in reports.court_counts(rows).collect()} == {"NCLT": 2, "HIGH_COURT (X)": 1, "High Court": 1}
    assert {r["benchName"]: r["cases"] for r in reports.bench_counts(rows).collect()} == {"A": 1, "B": 1, "TOTAL": 2}
    assert reports.bench_counts(rows, "DRT").collect() == []
    assert {r["label"]: r["cases"] for r in reports.high_court_counts(rows, stored=True).collect()} == {"X": 1, "High Court": 1}
    cells = reports.result_cells(reports.source_rows(rows), {"nclt": "B1", "drt": "B2", "drat": "B2", "high_court": "B3", "district_court": "B3"})
    assert {r["cell"]: r["result"] for r in cells.collect()} == {"B1": "yes (2)", "B2": "no", "B3": "yes(high_court: 2, district_court: 0)"}


def test_counters(spark):
    from pyspark.sql import Observation

    seen = Observation("run")
    states = spark.createDataFrame([("success",), ("failure",), ("success",)], "state string")
    reports.run_counters(states, seen).collect()
    assert seen.get == {"started": 3, "success": 2, "failure": 1, "duplicate": 0}


def test_control_tables(spark):
    assert joins.output_mode(" Append ") == "append" and joins.output_mode(None) == "overwrite"
    assert joins.cluster_systems(spark, ("total_systems", "x"), ("three PCs", "")) == 3 and joins.cluster_systems(spark, ("4", ""), ("", "")) == 4
    states = spark.createDataFrame([("S", [{"id": "7", "name": "N"}, {"districtId": "8"}, {"name": "none"}])], "state string, districts array<map<string,string>>")
    assert sorted(tuple(r) for r in joins.districts(states).collect()) == [("7", "DCDRC - N (S)"), ("8", "DCDRC - 8 (S)")]


def test_pages_on_disk(spark, tmp_path):
    rows = layout.paginate(layout.number_rows(spark.range(25), ["id"]), page_rows=11)
    layout.write_pages(rows, str(tmp_path / "p"), ["page_no"], "overwrite")
    assert sorted((r["page_no"], r["count"]) for r in spark.read.parquet(str(tmp_path / "p")).groupBy("page_no").count().collect()) == [(0, 10), (1, 10), (2, 5)]
    assert layout.result_batches(rows, rows=10).agg(F.max("batch")).first()[0] == 2


def test_typed_date_keeps_json_shape(spark):
    shown = spark.range(1).select(builders.tribunal_hearings(F.lit('[{"causelistdate": "9/1/2025", "purpose": "x"}]')).alias("j")).first()["j"]
    assert json.loads(shown) == [{"date": {"day": 9, "month": 1, "year": 2025}, "purpose": "x"}]


QUERY_NAMES = [n for n in __spark_entry__.queries() if n.startswith("q_")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages".split():
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUERY_NAMES)
def test_query_agrees_with_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
    got = df.collect()
    assert got
    sql = __spark_entry__.oracle_sql().get(name)
    if sql is not None:
        made = duck.execute(sql)
        names = [d[0] for d in made.description]
        order = sorted(names)
        assert order == sorted(df.columns)
        want = sorted(repr([r[names.index(c)] for c in order]) for r in made.fetchall())
        assert sorted(repr([r[c] for c in order]) for r in got) == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
