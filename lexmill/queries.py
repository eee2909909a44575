"""The queries over the given tables, with the SQL that each must agree with where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexmill import schema
from lexmill.functions import cases, company, dates, parties
from lexmill.functions.core import pick
from lexmill.operators import continuation, dedup, joins, layout, search, shard
from lexmill.plans import reports
from lexmill.plans.caseview import CASES_PLAIN, case_view, spread, table
from lexmill.sources import builders, courts, html, payloads, registry
from lexmill.storage import cut_lineage, delete, shared_folder
from lexmill.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
VIEW = f"WITH cases AS ({CASES_PLAIN})"


def query(name: str, oracle: str | None = None):
    """Registers a query, with its SQL over ``cases`` and the given tables."""

    def add(f):
        QUERIES[name] = f
        if oracle is not None:
            own = oracle.strip()
            if own.startswith("WITH RECURSIVE "):
                ORACLE_SQL[name] = f"WITH RECURSIVE {VIEW[5:]}, {own[15:]}"
            else:
                ORACLE_SQL[name] = f"{VIEW}, {own[5:]}" if own.startswith("WITH ") else f"{VIEW} {own}"
        return f

    return add


# ---------------------------------------------------------------- values

STATUS_SQL = """
CASE WHEN trim(caseStatus) = '' THEN ''
  WHEN lower(trim(caseStatus)) IN ('disposed','disposed off','disposed off/compliance','dismissed','dismissed in default','allowed','consigned to recordroom','decree','decreed','withdrawn','settled','transferred','converted','rejected','abated','not pressed','compromised')
    OR contains(lower(caseStatus), 'dispos') OR contains(lower(caseStatus), 'dismiss') OR contains(lower(caseStatus), 'allowed') THEN 'Disposed' ELSE 'Pending' END
"""


@query("q_status", f"""
SELECT k, {STATUS_SQL} AS case_status, CASE WHEN contains(lower(caseStatus), 'dispos') THEN 'Disposed' ELSE 'Pending' END AS court_status,
  CASE WHEN lower(trim(caseStatus)) IN ('disposal', 'disposed') THEN 'Disposed' ELSE 'Pending' END AS tribunal_status, CASE WHEN caseStatus = '' THEN 'PENDING' ELSE caseStatus END AS consumer_status,
  CASE WHEN caseStatus <> '' THEN CASE WHEN contains(lower(caseStatus), 'dispos') THEN 'Disposed' ELSE 'Pending' END WHEN registrationDate <> '' THEN 'Disposed' ELSE 'Pending' END AS decided
FROM cases
""")  # fmt: skip
def status(spark, d):
    c = F.col("caseStatus")
    return case_view(spark, d).select(
        "k", cases.case_status(c).alias("case_status"), cases.court_status(c).alias("court_status"), cases.tribunal_status(c).alias("tribunal_status"),
        cases.consumer_status(c).alias("consumer_status"), cases.status_or_decision(c, F.col("registrationDate")).alias("decided"),
    )


MONTHS_SQL = "['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC']"


def date_sql(x: str) -> str:
    """D1 for texts of three whole numbers, for use on a column."""
    s = f"CASE WHEN contains({x}, ':') THEN split_part(trim({x}), ' ', 1) ELSE trim({x}) END"
    out = []
    for sep in ("-", "/"):
        p = [f"TRY_CAST(split_part({s}, '{sep}', {i}) AS BIGINT)" for i in (1, 2, 3)]
        fits = f"len(string_split({s}, '{sep}')) = 3 AND {p[0]} IS NOT NULL AND {p[2]} IS NOT NULL AND {p[1]} BETWEEN 1 AND 12"
        name = f"{MONTHS_SQL}[CAST({p[1]} AS INT)]"
        out.append(f"WHEN {fits} THEN CASE WHEN {p[0]} > 31 THEN printf('%02d %s %d', {p[2]}, {name}, {p[0]}) ELSE printf('%02d %s %d', {p[0]}, {name}, {p[2]}) END")
    return f"(CASE {' '.join(out)} ELSE '' END)"


@query("q_format_date", f"SELECT k, {date_sql('registrationDate')} AS shown FROM cases")
def format_date(spark, d):
    return case_view(spark, d).select("k", dates.format_date("registrationDate").alias("shown"))


@query("q_date_words", f"""
SELECT o_orderkey AS k,
  printf('%02d %s %d', CAST(day(o_orderdate) AS BIGINT), {MONTHS_SQL}[CAST(month(o_orderdate) AS INT)], CAST(year(o_orderdate) AS BIGINT)) AS ordinal,
  CASE WHEN o_orderkey % 2 = 0 THEN printf('%02d %s %d', CAST(day(o_orderdate) AS BIGINT), {MONTHS_SQL}[CAST(month(o_orderdate) AS INT)], CAST(year(o_orderdate) AS BIGINT)) ELSE '' END AS registered,
  CASE WHEN day(o_orderdate) > 12 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(make_date(CAST(year(o_orderdate) AS INT), CAST(day(o_orderdate) AS INT), CAST(month(o_orderdate) AS INT)), '%Y-%m-%d') END AS config_day,
  CAST(year(o_orderdate) AS BIGINT) * 10000 + CAST(month(o_orderdate) AS BIGINT) * 100 + CAST(day(o_orderdate) AS BIGINT) AS parts, strftime(o_orderdate, '%Y-%m-%d') AS typed
FROM orders
""")  # fmt: skip
def date_words(spark, d):
    o = table(spark, d, "orders")
    day, month, year = F.dayofmonth("o_orderdate"), F.month("o_orderdate"), F.year("o_orderdate")
    names = F.element_at(F.array(*[F.lit(m.title()) for m in schema.FULL_MONTHS]), month)
    ordinal = dates.any_date(F.concat(day.cast("string"), F.lit("th "), names, F.lit(" "), year.cast("string")))
    dmy = F.format_string("%02d-%02d-%d", day, month, year)
    registered = dates.format_date(dates.registered_on(F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("No 1 Registered  on "), dmy)).otherwise(dmy)))
    parts = dates.date_parts(F.concat(dmy, F.lit(" 10:00")))
    return o.select(
        F.col("o_orderkey").alias("k"), ordinal.alias("ordinal"), registered.alias("registered"), dates.config_date(F.format_string("%d/%d/%d", day, month, year), "2025-01-01").alias("config_day"),
        (parts["year"].cast("long") * 10000 + parts["month"].cast("long") * 100 + parts["day"].cast("long")).alias("parts"), dates.typed_date(ordinal).cast("string").alias("typed"),
    )


def part_sql(x: str) -> str:
    return f"upper(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"


KEY_SQL = f"CASE WHEN contains(uniqueness, '|') THEN upper(trim(uniqueness)) ELSE 'LEGACY|' || {part_sql('courtType')} || '|' || {part_sql('benchName')} || '|' || {part_sql('caseNumber')} || '|' || {part_sql('registrationDate')} END"


@query("q_dedup_key", f"SELECT k, {KEY_SQL} AS key FROM cases")
def dedup_keys(spark, d):
    v = case_view(spark, d)
    return v.select("k", dedup.key_of(v).alias("key"))


def clean_sql(x: str) -> str:
    out = f"upper(trim({x}))"
    for p in (r"^M/S\.\s*", r"^M/S \s*", r"^M S \s*", r"^M/S\s*"):
        out = f"regexp_replace({out}, '{p}', '')"
    for p, _ in parties.PLAIN_TAILS:
        out = f"regexp_replace({out}, '{p}', '')"
    return f"CASE WHEN regexp_matches({x}, '[A-Za-z]') THEN trim(rtrim({out}, ',. ')) ELSE '' END"


@query("q_clean_party", f"SELECT k, {clean_sql('petitioner')} AS petitioner, {clean_sql('respondent')} AS respondent FROM cases")
def clean_party(spark, d):
    return case_view(spark, d, costly=True).select("k", parties.clean_party_name("petitioner").alias("petitioner"), parties.clean_party_name("respondent").alias("respondent"))


def norm_steps(source: str) -> str:
    """F1 as a chain of common table expressions over a table with the column x; the last one is ``normal``. RE2 has no look-ahead, so a group stands for it."""
    strip_sql = "trim({x})"
    steps = [strip_sql]
    steps += ["replace(replace(replace(replace({x}, '&amp;', '&'), '&AMP;', '&'), '&lt;', '<'), '&gt;', '>')"]
    sub = lambda p, by="", flags="gi": f"regexp_replace({{x}}, '{p}', '{by}', '{flags}')"
    steps += [sub(r"\(Not Applicable\)"), sub(r"\[.*?\]"), strip_sql, sub(r"^\d+\.\s*", flags=""), sub(r"^\d+\)\s*", flags=""), sub(r"^\d\s+([A-Z])", r"\1", ""), "trim(upper({x}))", sub(r"(\.+)([A-Z])", r"\1 \2", "g")]
    for _ in range(3):
        steps += [sub(rf"^(?:{parties.TITLES})\s+", flags="i"), strip_sql]
    steps += [sub(parties.FIRM_PREFIXES, flags=""), strip_sql, sub(r"^.*?\bRESOLUTION\s+PROFESSIONAL\s+OF\b\s*(.+)$", r"\1", "i"), strip_sql, sub(r"\(I\)", "(INDIA)", "g")]
    for p, _ in parties.TAILS:
        steps.append(strip_sql if "(?U)" in p else sub(p.replace("(?i)", ""), flags="i"))
    cuts = " ".join(f"WHEN contains({{x}}, '{s}') THEN trim(substr({{x}}, 1, instr({{x}}, '{s}') + {len(s) - 1}))" for s in parties.LEGAL_SUFFIXES)
    steps += [f"CASE {cuts} ELSE {{x}} END", sub(r"\s+UNIT\s+\d+\s*$", flags="i"), "rtrim(trim({x}), '.,;: ')", sub(r"\s+", " ", "g"), strip_sql]
    roles, words = parties.ROLES.replace("(?i)", ""), parties.ENTITY_WORDS.replace("(?i)", "")
    steps.append(f"CASE WHEN NOT regexp_matches({{x}}, '[A-Za-z]') OR (regexp_matches({{x}}, '{roles}', 'i') AND NOT regexp_matches({{x}}, '{words}', 'i')) THEN '' ELSE {{x}} END")
    out, last = [], source
    for i, s in enumerate(steps):
        name = "normal" if i == len(steps) - 1 else f"s{i}"
        out.append(f"{name} AS (SELECT * REPLACE ({s.format(x='x')} AS x) FROM {last})")
        last = name
    return ", ".join(out)


@query("q_norm_party", f"WITH given AS (SELECT k, petitioner AS x FROM cases), {norm_steps('given')} SELECT k, x AS name FROM normal")
def norm_party(spark, d):
    return case_view(spark, d, costly=True).select("k", parties.normalize_party_name("petitioner").alias("name"))


#: Parties of the view's respondents: quoted ones, or those between commas but for an address that begins R/O.
PARTS_SQL = """
parts AS (SELECT k, unnest(CASE WHEN contains(respondent, '"') THEN regexp_extract_all(respondent, '"([^"]+)"', 1) WHEN respondent = '' THEN [] ELSE string_split(regexp_replace(respondent, ', R/O', ' @ R/O'), ',') END) AS raw,
  generate_subscripts(CASE WHEN contains(respondent, '"') THEN regexp_extract_all(respondent, '"([^"]+)"', 1) WHEN respondent = '' THEN [] ELSE string_split(regexp_replace(respondent, ', R/O', ' @ R/O'), ',') END, 1) AS i FROM cases),
given AS (SELECT k, i, replace(raw, ' @ R/O', ', R/O') AS x FROM parts)
"""


@query("q_multi_party", f"""
WITH {PARTS_SQL}, {norm_steps('given')}, firsts AS (SELECT k, x, min(i) AS i FROM normal WHERE x <> '' GROUP BY k, x), cells AS (SELECT k, string_agg('"' || x || '"', ', ' ORDER BY i) AS names FROM firsts GROUP BY k)
SELECT c.k, coalesce(cells.names, '') AS names FROM cases c LEFT JOIN cells ON c.k = cells.k
""")  # fmt: skip
def multi_party(spark, d):
    return case_view(spark, d, costly=True).select("k", parties.normalize_multi_party("respondent").alias("names"))


@query("q_normalize_rows", f"""
WITH given AS (SELECT k, petitioner AS x FROM cases), {norm_steps('given')}
SELECT c.k, CASE WHEN petitioner = '' AND respondent = '' AND otherPetitioner = '' THEN petitioner WHEN x = '' THEN '' ELSE '"' || x || '"' END AS petitioner,
  CASE WHEN petitioner = '' AND respondent = '' AND otherPetitioner = '' THEN caseStatus WHEN trim(caseStatus) = '' THEN 'Pending' ELSE {STATUS_SQL} END AS status
FROM cases c JOIN normal m ON c.k = m.k
""")  # fmt: skip
def normalize_rows(spark, d):
    return builders.normalize_rows(case_view(spark, d, costly=True)).select("k", "petitioner", F.col("caseStatus").alias("status"))


@query("q_case_numbers", """
SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS hc_number, 'CS-' || CAST(o_orderkey AS VARCHAR) AS hc_plain, 'CHA/' || CAST(o_orderkey AS VARCHAR) || '/2024' AS list_ref, CAST(o_orderkey AS VARCHAR) AS dc_number,
  'SLP(C)/' || CAST(o_orderkey AS VARCHAR) || '/2025' AS sc_shown, CASE o_orderkey % 3 WHEN 0 THEN 'SLP(C)' WHEN 1 THEN 'CIVILAPPEA' ELSE 'T999' END AS slug, 'CSCIVIL' AS abbreviation,
  CAST(o_orderkey % 40 AS VARCHAR) AS court_number, o_orderkey >= 0 AS cnr
FROM orders
""")  # fmt: skip
def case_numbers(spark, d):
    k = F.col("o_orderkey").cast("string")
    ref = F.concat(F.lit(" cha / "), k, F.lit("/2024 "))
    code = F.element_at(F.array(F.lit("1"), F.lit("77"), F.lit("999")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    name = F.element_at(F.array(F.lit(""), F.lit("Civil Appeal No."), F.lit("")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    slug = F.when(F.col("o_orderkey") % 3 == 1, cases.sc_slug(F.lit("77"), name)).otherwise(cases.sc_slug(code, F.lit("")))
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"), cases.hc_case_number(F.concat(F.lit("WP / "), k, F.lit("/2021"))).alias("hc_number"), cases.hc_case_number(F.concat(F.lit("CS - "), k)).alias("hc_plain"),
        cases.list_case_ref(ref).alias("list_ref"), cases.dc_case_number(F.lit(""), F.lit(""), F.concat(k, F.lit("/2024")), F.lit("CS")).alias("dc_number"),
        cases.sc_case_display(F.concat(F.lit("No. slp(c)/ "), k, F.lit(" /2025 x"))).alias("sc_shown"), slug.alias("slug"), cases.dc_type_abbreviation(F.lit(" cs civil - suit")).alias("abbreviation"),
        cases.dc_court_number(F.concat(F.lit("<b>"), (F.col("o_orderkey") % 40).cast("string"), F.lit("</b> - Judge"))).alias("court_number"), cases.is_cnr_token(F.concat(F.lit("HRHS0300"), F.lpad(k, 8, "0"))).alias("cnr"),
    )


@query("q_unique_keys", """
SELECT k, CASE WHEN caseNumber = '' THEN 'DC|NO_CINO|' ELSE 'DC|' || caseNumber END AS dc, CASE WHEN uniqueness <> '' THEN 'HC|' || uniqueness ELSE 'HC|' || caseNumber || '|' || benchName || '|' || registrationDate END AS hc,
  CASE WHEN caseNumber <> '' AND benchName <> '' THEN 'SC|' || caseNumber || '|' || benchName ELSE 'SC|||' || caseNumber END AS sc,
  courtType || ' (dis: ' || benchName || ', comp:' || caseType || ' est:' || CASE WHEN otherPetitioner = '' THEN 'null' ELSE otherPetitioner END || ')' AS bench,
  CASE WHEN courtType <> '' THEN courtType || ' (bench: ' || benchName || ')' ELSE benchName END AS hc_bench, CASE WHEN k % 2 = 0 THEN 'Bengaluru' ELSE benchName END AS nclt_bench
FROM cases
""")  # fmt: skip
def unique_keys(spark, d):
    c = F.col
    return case_view(spark, d).select(
        "k", cases.dc_unique("caseNumber", F.lit("")).alias("dc"), cases.hc_unique(c("uniqueness"), c("caseNumber"), c("benchName"), c("registrationDate")).alias("hc"),
        cases.sc_unique("caseNumber", "benchName", F.lit(""), F.lit(""), c("caseNumber")).alias("sc"), cases.dc_bench("courtType", "benchName", "caseType", "otherPetitioner").alias("bench"),
        cases.hc_bench("courtType", "benchName").alias("hc_bench"), cases.nclt_bench(F.when(c("k") % 2 == 0, F.lit(" NCLT Bangalore Court ")).otherwise(c("benchName"))).alias("nclt_bench"),
    )


@query("q_pick", "SELECT k, CASE WHEN otherPetitioner <> '' THEN otherPetitioner WHEN registrationDate NOT IN ('', 'NA') THEN registrationDate ELSE trim(caseStatus) END AS value FROM cases")
def picked(spark, d):
    return case_view(spark, d).select("k", pick("otherPetitioner", "registrationDate", "caseStatus").alias("value"))


@query("q_formats", """
SELECT event_id AS k, printf('%.1f%%', least(100.0, greatest(0.0, CAST(event_id % 130 AS DOUBLE) / 120.0 * 100.0))) AS share,
  CASE WHEN event_id < 60 THEN event_id || 's' WHEN event_id < 3600 THEN (event_id // 60) || 'm ' || (event_id % 60) || 's' ELSE (event_id // 3600) || 'h ' || (event_id // 60 % 60) || 'm ' || (event_id % 60) || 's' END AS lasted,
  CASE WHEN event_type = 'error' THEN '"a ''b''=' || event_type || '"' ELSE event_type END AS logged,
  (event_id % 20 + 1) || '/20 pct=' || printf('%.1f%%', CAST(event_id % 20 AS DOUBLE) / 20.0 * 100.0) || ' done=' || (event_id % 20) || ' left=' || (19 - event_id % 20) AS progress,
  CASE WHEN event_id % 70 <= 10 THEN 1 WHEN event_id % 70 <= 20 THEN 5 WHEN event_id % 70 <= 30 THEN 10 WHEN event_id % 70 <= 40 THEN 50 WHEN event_id % 70 <= 50 THEN 100 WHEN event_id % 70 <= 60 THEN 500 ELSE 1000 END AS jump
FROM events
""")  # fmt: skip
def formats(spark, d):
    k = F.col("event_id")
    noisy = F.when(F.col("event_type") == "error", F.concat(F.lit(' a  "b"='), F.col("event_type"))).otherwise(F.col("event_type"))
    return table(spark, d, "events").select(k.alias("k"), cases.percent(k % 130, F.lit(120)).alias("share"), cases.duration(k).alias("lasted"), cases.log_value(noisy).alias("logged"), cases.stage_progress(k % 20, F.lit(20)).alias("progress"), cases.empty_jump(k % 70).alias("jump"))


@query("q_errors", """
SELECT event_id AS k, CASE event_type WHEN 'view' THEN 'timeout' WHEN 'signup' THEN 'proxy_error' WHEN 'error' THEN 'connection_error' WHEN 'click' THEN 'http_error' ELSE 'valueerror' END AS kind,
  CASE event_type WHEN 'view' THEN 'notFound' WHEN 'signup' THEN 'backendError' ELSE '' END AS reason, event_type <> 'view' AS retryable, event_type = 'click' AS limited,
  CASE WHEN user_id % 2 = 0 THEN 'w' || user_id ELSE 'w' || user_id || '|x' END AS owner, user_id % 2 = 0 AND 5000 - user_id > 4940 AS stale, event_type = 'purchase' AS detail
FROM events
""")  # fmt: skip
def errors(spark, d):
    t = F.col("event_type")
    name = F.when(t == "view", F.lit("ReadTimeout")).otherwise(F.lit("ValueError"))
    said = F.when(t == "view", F.lit("{'reason': 'notFound'}")).when(t == "signup", F.lit("bad Proxy {'reason':  'backendError'}")).when(t == "error", F.lit("Connection lost")).when(t == "click", F.lit("status {'code': 429}")).otherwise(F.lit("Case History of x"))
    lock = F.concat(F.lit("w"), F.col("user_id").cast("string"), F.when(F.col("user_id") % 2 == 0, F.concat(F.lit(" | "), F.col("user_id").cast("string"))).otherwise(F.lit("|x")))
    return table(spark, d, "events").select(
        F.col("event_id").alias("k"), cases.error_kind(name, said).alias("kind"), cases.error_reason(said).alias("reason"), cases.is_retryable(said).alias("retryable"), cases.is_rate_limit(said).alias("limited"),
        cases.lock_owner(lock).alias("owner"), cases.is_stale(lock, F.lit(5000.0), 4940.0).alias("stale"), cases.is_detail_page(said).alias("detail"),
    )


def canonical_sql(x: str) -> str:
    known = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in company.CANONICAL.items())
    t = f"trim(upper(trim({x})))"
    for p in (company.NUMBERING, company.FIRM_COMPAT):
        t = f"trim(regexp_replace({t}, '{p}', ''))"
    t = f"regexp_replace({t}, '{company.COUNTRY}', ' INDIA ', 'g')"
    t = f"trim(regexp_replace({t}, '{company.DESIGNATION}', ''))"
    return f"list_aggregate(list_transform(regexp_extract_all({t}, '[A-Z0-9]+|&'), lambda w: CASE w {known} ELSE w END), 'string_agg', ' ')"


LEGAL = "(LIMITED\\sLIABILITY\\sPARTNERSHIP|PRIVATE\\sLIMITED|LIMITED|LLP|INCORPORATED|INC|CORPORATION|COMPANY)"


def core_sql(x: str) -> str:
    """M2 of a normalised name."""
    return f"trim(regexp_replace({x}, '(^|\\s){LEGAL}$', ''))"


def normal_sql(x: str) -> str:
    """M1, with the single P before LIMITED."""
    return f"regexp_replace(coalesce({canonical_sql(x)}, ''), '(^|\\s)P LIMITED$', '\\1PRIVATE LIMITED')"


#: M9 over a table ``pairs`` (a, b) of letters and digits: one step for each character of a, which takes the first free equal one of b within reach.
WINKLER_SQL = """
steps AS (
  SELECT a, b, CAST(0 AS BIGINT) AS i, repeat('1', length(b)) AS free, '' AS mine, greatest(length(a), length(b)) // 2 - 1 AS reach FROM pairs WHERE a <> '' AND b <> '' AND a <> b
  UNION ALL
  SELECT a, b, i + 1, CASE WHEN j IS NULL THEN free ELSE substr(free, 1, j) || '0' || substr(free, j + 2) END, CASE WHEN j IS NULL THEN mine ELSE mine || substr(a, i + 1, 1) END, reach
  FROM (SELECT *, list_filter(range(greatest(0, i - reach), least(i + reach + 1, length(b))), lambda p: substr(free, p + 1, 1) = '1' AND substr(b, p + 1, 1) = substr(a, i + 1, 1))[1] AS j FROM steps WHERE i < length(a))
), taken AS (
  SELECT a, b, mine, length(mine) AS n, list_aggregate(list_transform(list_filter(range(length(b)), lambda p: substr(free, p + 1, 1) = '0'), lambda p: substr(b, p + 1, 1)), 'string_agg', '') AS theirs FROM steps WHERE i = length(a)
), jaro AS (
  SELECT a, b, CASE WHEN n = 0 THEN 0.0 ELSE (CAST(n AS DOUBLE) / length(a) + CAST(n AS DOUBLE) / length(b) + (n - len(list_filter(range(n), lambda p: substr(mine, p + 1, 1) <> substr(theirs, p + 1, 1))) / 2.0) / n) / 3 END AS j,
    CASE WHEN substr(a, 1, 4) = substr(b, 1, 4) THEN least(4, length(a), length(b)) WHEN substr(a, 1, 3) = substr(b, 1, 3) THEN least(3, length(a), length(b)) WHEN substr(a, 1, 2) = substr(b, 1, 2) THEN least(2, length(a), length(b)) WHEN substr(a, 1, 1) = substr(b, 1, 1) THEN 1 ELSE 0 END AS same FROM taken
), scored AS (
  SELECT a, b, CAST(round_even(100 * CASE WHEN j > 0.7 THEN least(1.0, j + same * 0.1 * (1 - j)) ELSE j END, 0) AS INT) AS score FROM jaro
  UNION ALL SELECT a, b, CASE WHEN a = b AND a <> '' THEN 100 ELSE 0 END FROM pairs WHERE a = '' OR b = '' OR a = b
)
"""


def company_sql(query: str) -> str:
    """M6 to M10 of the cells of a table ``given`` (cell), to ``decided``: for a query without short words or initials, whose variants differ in their endings alone."""
    plan = company.make_plan(query)
    quote = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    alias = lambda w: "(" + "|".join(company.ALIASES.get(w, (w,))) + ")"
    found = " ".join(f"WHEN regexp_matches(upper(cell), '(^|[^A-Z0-9]){'[^A-Z0-9]+'.join(alias(w) for w in company.normalize(v).split())}([^A-Z0-9]|$)') THEN '{v}'" for v in plan.variants)

    def present(t: str) -> str:
        forms = quote({company.CANONICAL.get(a, a) for a in (t, *company.ALIASES.get(t, ()))})
        stem = f" OR list_contains(list_transform(list_filter(words, lambda w: length(w) > 4), lambda w: rtrim(w, 'S')), '{t.rstrip('S')}')" if len(t) > 4 else ""
        return f"(list_has_any(words, {forms}){stem})"

    hard = [t for t in plan.tokens if t not in company.SOFT_TOKENS]
    need = hard if len(hard) > 1 else list(plan.tokens)
    return f"""
listed AS (SELECT cell, [cell] || CASE WHEN len(regexp_extract_all(cell, '"([^"]+)"', 1)) > 0 THEN regexp_extract_all(cell, '"([^"]+)"', 1) WHEN contains(cell, ',') THEN string_split(cell, ',') ELSE [] END AS names FROM given WHERE cell <> ''),
named AS (SELECT cell, upper(trim(regexp_replace(name, '\\s+', ' ', 'g'))) AS name, i FROM (SELECT cell, unnest(names) AS name, generate_subscripts(names, 1) AS i FROM listed)),
firsts_of AS (SELECT cell, name, min(i) AS i FROM named WHERE name <> '' GROUP BY cell, name),
normals AS (SELECT cell, i, {normal_sql('name')} AS normal FROM firsts_of),
twice AS (SELECT *, {normal_sql('normal')} AS second FROM normals WHERE normal <> ''),
parts_of AS (SELECT cell, i, normal, {core_sql('normal')} AS core, string_split({core_sql('normal')}, ' ') AS words, regexp_replace({normal_sql('second')}, '[^A-Z0-9]+', '', 'g') AS letters FROM twice),
judged AS (SELECT *, core <> '' AND (contains(core, '{plan.core}') OR ({' AND '.join(present(t) for t in plan.tokens)})) AS has_core, {' + '.join(f'CAST({present(t)} AS INT)' for t in need)} >= 0.75 * {len(need)} AS enough FROM parts_of),
wholes AS (SELECT cell, regexp_replace({normal_sql('second')}, '[^A-Z0-9]+', '', 'g') AS letters FROM (SELECT cell, {normal_sql('cell')} AS second FROM listed)),
equal_names AS (SELECT unnest({quote(plan.equals)}) AS b),
pairs AS (SELECT DISTINCT letters AS a, b FROM (SELECT letters FROM judged WHERE has_core OR enough UNION SELECT letters FROM wholes) CROSS JOIN equal_names), {WINKLER_SQL},
best AS (SELECT a AS letters, max(score) AS score FROM scored GROUP BY a),
hits AS (SELECT j.cell, min_by({{'normal': normal, 'score': score, 'has_core': has_core}}, i) AS h FROM judged j JOIN best USING (letters) WHERE has_core OR (enough AND score >= {plan.accept}) GROUP BY j.cell),
decided AS (
  SELECT w.cell, v IS NOT NULL OR h IS NOT NULL AS matched, CASE WHEN v IS NOT NULL THEN greatest(best.score, 95) WHEN h.has_core THEN greatest(h.score, 90) WHEN h IS NOT NULL THEN h.score ELSE best.score END AS score,
    CASE WHEN v IS NOT NULL THEN 'variant_regex' WHEN h.has_core THEN 'core_tokens' WHEN h IS NOT NULL THEN 'jaro_winkler' ELSE 'no_match' END AS method,
    CASE WHEN v IS NOT NULL THEN v WHEN h.has_core THEN '{plan.core}' WHEN h IS NOT NULL THEN '{plan.normal}' ELSE '' END AS variant
  FROM (SELECT cell, letters, CASE {found} END AS v FROM wholes) w JOIN best USING (letters) LEFT JOIN hits ON hits.cell = w.cell
  UNION ALL SELECT cell, false, 0, 'empty', '' FROM given WHERE cell = ''
)
"""


# ---------------------------------------------------------------- search

TERM = "MACHINERY 13 Traders"
BREAK_SQL = "(trim(caseNumber) <> '' OR trim(respondent) <> '' OR trim(petitioner) <> '' OR trim(caseType) <> '' OR trim(registrationDate) <> '' OR trim(listingHistory) = '')"
ISLANDS_SQL = """
islands AS (SELECT *, sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY row_no) AS island FROM marked),
firsts AS (SELECT *, min(CASE WHEN hit THEN row_no END) OVER (PARTITION BY page_id, island) AS first_hit FROM islands)
"""
RUNS_SQL = f"""
marked AS (SELECT *, (regexp_matches(upper(respondent), {{p}}) OR regexp_matches(upper(otherRespondent), {{p}}) OR regexp_matches(upper(petitioner), {{p}}) OR regexp_matches(upper(otherPetitioner), {{p}})) AS hit, {BREAK_SQL} AS brk FROM cases), {ISLANDS_SQL}
"""


@query("q_search_individual", f"""
WITH {RUNS_SQL.format(p="'MACHINERY\\s+13'")}
SELECT page_id, row_no, CASE WHEN row_no > first_hit THEN '' ELSE '{TERM}' END AS partyName, CASE WHEN row_no > first_hit THEN '' ELSE caseNumber END AS caseNumber, listingHistory, row_no > first_hit AS continuation
FROM firsts WHERE row_no >= first_hit
""")  # fmt: skip
def search_individual(spark, d):
    v = case_view(spark, d).withColumn("partyName", F.lit(""))
    found = search.search_individual(v, TERM)
    return found.select("page_id", "row_no", "partyName", "caseNumber", "listingHistory", F.col("_is_continuation").alias("continuation"))


FIRM = "Machinery 13 Traders Private Limited"


@query("q_search_company", f"""
WITH RECURSIVE given AS (SELECT petitioner AS cell FROM cases UNION SELECT respondent FROM cases UNION SELECT otherPetitioner FROM cases UNION SELECT otherRespondent FROM cases), {company_sql(FIRM)},
good AS (SELECT cell FROM decided WHERE matched),
marked AS (SELECT *, (petitioner IN (FROM good) OR respondent IN (FROM good) OR otherPetitioner IN (FROM good) OR otherRespondent IN (FROM good)) AS hit, {BREAK_SQL} AS brk FROM cases), {ISLANDS_SQL}
SELECT page_id, row_no, CASE WHEN row_no > first_hit THEN '' ELSE '{FIRM}' END AS partyName, CASE WHEN row_no > first_hit THEN '' ELSE caseNumber END AS caseNumber, row_no > first_hit AS continuation
FROM firsts WHERE row_no >= first_hit
""")  # fmt: skip
def search_company(spark, d):
    v = case_view(spark, d, costly=True).withColumn("partyName", F.lit(""))
    found = search.search_company(v, FIRM)
    return found.select("page_id", "row_no", "partyName", "caseNumber", F.col("_is_continuation").alias("continuation"))


@query("q_name_filter", f"""
WITH given AS (SELECT k, petitioner AS x FROM cases), {norm_steps('given')},
fate AS (SELECT c.page_id, c.row_no, c.k, last_value(CASE WHEN petitioner <> '' OR respondent <> '' OR otherPetitioner <> '' THEN m.x = 'MACHINERY 13 TRADERS PRIVATE LIMITED' END IGNORE NULLS) OVER (PARTITION BY c.page_id ORDER BY c.row_no) AS kept FROM cases c JOIN normal m ON c.k = m.k)
SELECT page_id, row_no, k FROM fate WHERE kept
""")  # fmt: skip
def name_filter(spark, d):
    return search.filter_exact(case_view(spark, d, costly=True), "M/s Machinery 13 Traders Private Limited", "individual").select("page_id", "row_no", "k")


@query("q_projection", "SELECT k AS caseNo, '' AS missing, trim(courtType) AS courtType FROM cases".replace("k AS caseNo", "caseNumber"))
def projection(spark, d):
    return search.project(case_view(spark, d), ["caseNumber", "missing", "courtType"])


@query("q_case_number_scan", "SELECT DISTINCT trim(caseNumber) AS caseNumber FROM cases WHERE trim(caseNumber) <> ''")
def case_number_scan(spark, d):
    return dedup.case_numbers(case_view(spark, d))


# ---------------------------------------------------------------- keys and pages

GROUPS_SQL = f"""
anchors AS (SELECT *, uniqueness <> '' OR courtType <> '' OR benchName <> '' OR caseNumber <> '' OR registrationDate <> '' AS anchor FROM cases),
owned AS (SELECT *, last_value(CASE WHEN anchor THEN row_no END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY row_no) AS start_row FROM anchors),
groups AS (SELECT page_id, start_row, max(row_no) AS end_row, max(CASE WHEN anchor THEN {KEY_SQL} END) AS key FROM owned WHERE start_row IS NOT NULL GROUP BY page_id, start_row)
"""
AUDIT_SQL = GROUPS_SQL + """, ranked AS (SELECT *, row_number() OVER w AS rn, first_value(page_id) OVER w AS first_page, first_value(start_row) OVER w AS first_start FROM groups WINDOW w AS (PARTITION BY key ORDER BY page_id, start_row)), dups AS (SELECT * FROM ranked WHERE rn > 1)"""
RANGES_SQL = AUDIT_SQL + """, flagged AS (SELECT *, CASE WHEN start_row > coalesce(max(end_row) OVER (PARTITION BY page_id ORDER BY start_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -9) + 1 THEN 1 ELSE 0 END AS fresh FROM dups),
isl AS (SELECT *, sum(fresh) OVER (PARTITION BY page_id ORDER BY start_row) AS island FROM flagged), ranges AS (SELECT page_id, min(start_row) AS start_row, max(end_row) AS end_row FROM isl GROUP BY page_id, island)"""


@query("q_row_groups", f"WITH {GROUPS_SQL} SELECT * FROM groups")
def row_groups(spark, d):
    return dedup.keyed_groups(case_view(spark, d)).select("page_id", "start_row", "end_row", "key")


@query("q_dup_audit", f"WITH {AUDIT_SQL} SELECT page_id, start_row, end_row, key, first_page, first_start FROM dups")
def dup_audit(spark, d):
    return dedup.audit(dedup.keyed_groups(case_view(spark, d))).select("page_id", "start_row", "end_row", "key", "first_page", "first_start")


@query("q_dup_ranges", f"WITH {RANGES_SQL} SELECT page_id, start_row, end_row FROM ranges")
def dup_ranges(spark, d):
    return dedup.coalesce_ranges(dedup.audit(dedup.keyed_groups(case_view(spark, d)))).select("page_id", "start_row", "end_row")


@query("q_range_totals", f"WITH {RANGES_SQL} SELECT page_id, count(*) AS ranges, CAST(sum(end_row - start_row + 1) AS BIGINT) AS deleted_rows FROM ranges GROUP BY page_id")
def range_totals(spark, d):
    return dedup.range_totals(dup_ranges(spark, d))


@query("q_audit_counts", f"WITH {GROUPS_SQL} SELECT count(*) AS logical_rows, count(DISTINCT key) AS unique_keys, count(*) - count(DISTINCT key) AS duplicates FROM groups")
def audit_counts(spark, d):
    return dedup.audit_counts(dedup.keyed_groups(case_view(spark, d)))


@query("q_page_duplicates", f"WITH {AUDIT_SQL} SELECT page_id, string_agg(start_row || '-' || end_row || ' ' || key, '; ' ORDER BY start_row) AS listed FROM dups GROUP BY page_id")
def page_duplicates(spark, d):
    listed = dedup.page_lists(dedup.audit(dedup.keyed_groups(case_view(spark, d))))
    each = F.transform("duplicates", lambda x: F.concat(x["start_row"].cast("string"), F.lit("-"), x["end_row"].cast("string"), F.lit(" "), x["key"]))
    return listed.select("page_id", F.array_join(each, "; ").alias("listed"))


@query("q_cleaned", f"WITH {AUDIT_SQL} SELECT c.page_id, c.row_no FROM cases c WHERE NOT EXISTS (SELECT 1 FROM dups d WHERE d.page_id = c.page_id AND c.row_no BETWEEN d.start_row AND d.end_row)")
def cleaned(spark, d):
    return dedup.delete_duplicates(case_view(spark, d)).select("page_id", "row_no")


@query("q_new_rows", f"""
WITH keyed AS (SELECT k, {KEY_SQL} AS key FROM cases WHERE caseNumber <> ''), batch AS (SELECT key, min(k) AS k FROM keyed WHERE k % 2 = 1 GROUP BY key)
SELECT key, k FROM batch WHERE key NOT IN (SELECT key FROM keyed WHERE k % 2 = 0)
""")  # fmt: skip
def new_rows(spark, d):
    v = case_view(spark, d).where("caseNumber <> ''")
    keyed = v.withColumn("key", dedup.key_of(v)).select("key", "k")
    return dedup.new_rows(keyed.where("k % 2 = 1"), keyed.where("k % 2 = 0"), ["k"])


@query("q_known_keys", f"SELECT DISTINCT {KEY_SQL} AS key FROM cases")
def known_keys(spark, d):
    v = case_view(spark, d)
    keyed = v.select(dedup.key_of(v).alias("key"), "k")
    return dedup.known_keys(keyed.where("k % 3 = 0"), keyed.where("k % 3 <> 0"))


@query("q_first_hits", """
SELECT l_orderkey AS hit, l_linenumber AS line, l_partkey AS part FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1
""")  # fmt: skip
def first_hits(spark, d):
    t = table(spark, d, "lineitem").withColumn("hit", F.col("l_orderkey"))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return dedup.first_of(t, "hit", order).select("hit", F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"))


@query("q_overflow", """
WITH sized AS (SELECT doc_id, text, lang, greatest(1, CAST(ceil(length(text) / 1000.0) AS BIGINT)) AS parts FROM documents), split AS (SELECT doc_id, text, lang, CAST(unnest(range(parts)) AS INT) AS part_no FROM sized)
SELECT doc_id, part_no, CASE WHEN length(text) > 1000 THEN substr(text, part_no * 1000 + 1, 1000) WHEN part_no = 0 THEN text ELSE '' END AS text, CASE WHEN part_no = 0 THEN lang ELSE '' END AS lang FROM split
""")  # fmt: skip
def overflow(spark, d):
    return layout.split_overflow(table(spark, d, "documents").select("doc_id", "text", "lang"), ["text", "lang"], 1000)


@query("q_overflow_round_trip", "SELECT doc_id, sha256(text) AS digest FROM documents")
def overflow_round_trip(spark, d):
    joined = layout.join_overflow(overflow(spark, d), ["doc_id"], ["text", "lang"])
    return joined.select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"))


@query("q_paginate", "SELECT o_orderkey AS k, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1 + 40) / 499) AS BIGINT) AS page_no, CAST((row_number() OVER (ORDER BY o_orderkey) - 1 + 40) % 499 + 2 AS BIGINT) AS page_row FROM orders")
def paginate(spark, d):
    numbered = layout.number_rows(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), ["k"])
    return layout.paginate(numbered, existing=40, page_rows=500).select("k", "page_no", "page_row")


@query("q_paginate_groups", f"WITH {GROUPS_SQL}, run AS (SELECT *, coalesce(sum(end_row - start_row + 1) OVER (ORDER BY page_id, start_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM groups) SELECT page_id, start_row, CAST(floor(before / 190) AS BIGINT) AS page_no FROM run")
def paginate_groups(spark, d):
    groups = continuation.row_groups(case_view(spark, d)).select("page_id", "start_row", (F.col("end_row") - F.col("start_row") + 1).alias("size"))
    return layout.paginate_groups(groups, "size", ["page_id", "start_row"], 10, 200).select("page_id", "start_row", "page_no")


# ---------------------------------------------------------------- shards and progress


@query("q_shards", "SELECT n_nationkey, CAST(ntile(4) OVER (ORDER BY n_nationkey) AS INT) AS shard FROM nation")
def shards(spark, d):
    return shard.assign_shards(table(spark, d, "nation"), ["n_nationkey"], 4).select("n_nationkey", "shard")


@query("q_slice", "SELECT c_custkey FROM (SELECT c_custkey, ntile(7) OVER (ORDER BY c_custkey) AS shard FROM customer) WHERE shard = 2")
def one_slice(spark, d):
    """One shard's items."""
    return shard.slice_for(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], 2, 7)


@query("q_task_grid", """
WITH bench(b, bo) AS (SELECT unnest([10, 9, 13, 1, 12, 4, 8, 11, 3, 5, 6, 7, 14, 15, 2]), unnest(range(15)))
SELECT CAST(b AS INT) AS bench_id, CAST(y AS INT) AS year, p AS pt_code, s AS st_code, CAST(((bo * 3 + (y - 2020)) * 2 + po) * 2 + so AS INT) AS unit
FROM bench CROSS JOIN (SELECT unnest(range(2020, 2023)) AS y) CROSS JOIN (SELECT unnest(['P', 'R']) AS p, unnest(range(2)) AS po) CROSS JOIN (SELECT unnest(['P', 'D']) AS s, unnest(range(2)) AS so)
""")  # fmt: skip
def task_grid(spark, d):
    return shard.nclt_grid(spark, "Acme", 2020, 2022).select("bench_id", "year", "pt_code", "st_code", F.col("unit").cast("int").alias("unit"))


@query("q_court_dims", "SELECT * FROM (VALUES ('district_court', CAST(36 AS BIGINT), 'Andaman and Nicobar'), ('high_court', 25, 'Allahabad High Court'), ('drt', 39, 'DEBTS RECOVERY TRIBUNAL DELHI (DRT 1)'), ('drat', 5, 'DEBT RECOVERY APPELLATE TRIBUNAL - DELHI'), ('nclt', 15, 'Principal Bench / New Delhi Bench'), ('scdrc', 36, 'ANDAMAN NICOBAR')) t(source, n, first)")
def court_dims(spark, d):
    parts = [courts.courts(spark, s).agg(F.count("*").alias("n"), F.min_by("name", "ord").alias("first")).withColumn("source", F.lit(s)) for s in ("district_court", "high_court", "drt", "drat", "nclt", "scdrc")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("q_sc_grid", "SELECT CAST(2025 - y AS INT) AS year, count(*) AS units FROM (SELECT unnest(range(38)) AS t) CROSS JOIN (SELECT unnest(range(3)) AS y) GROUP BY y")
def sc_grid(spark, d):
    return courts.sc_grid(spark, 2023, 2025).groupBy("year").agg(F.count("*").alias("units"))


@query("q_remaining", """
SELECT o.o_custkey AS owner, o.o_orderkey AS unit FROM orders o LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS done FROM orders WHERE o_custkey % 2 = 0 GROUP BY o_custkey) p ON o.o_custkey = p.o_custkey WHERE done IS NULL OR o.o_orderkey > done
""")  # fmt: skip
def remaining(spark, d):
    units = table(spark, d, "orders").select(F.col("o_custkey").alias("owner"), F.col("o_orderkey").alias("unit"))
    progress = units.where("owner % 2 = 0").groupBy("owner").agg(F.min("unit").alias("unit"))
    return shard.remaining(units, progress, ["owner"])


@query("q_realign", "SELECT n_regionkey AS owner, n_nationkey AS item, CASE WHEN n_nationkey % 5 = n_regionkey AND n_nationkey < 15 THEN CAST(n_nationkey AS BIGINT) ELSE -1 END AS unit FROM nation")
def realign(spark, d):
    t = table(spark, d, "nation")
    progress = t.select(F.col("n_regionkey").alias("owner"), F.col("n_nationkey").alias("item"), F.col("n_nationkey").cast("long").alias("unit"))
    assigned = t.where("n_nationkey < 15").select((F.col("n_nationkey") % 5).alias("owner"), F.col("n_nationkey").alias("item"))
    return shard.realign(progress, assigned, ["owner"], ["item"]).select("owner", "item", "unit")


@query("q_retry", "SELECT event_id FROM events WHERE event_type = 'error' AND user_id % 5 < 3")
def retry(spark, d):
    states = table(spark, d, "events").select("event_id", F.when(F.col("event_type") == "error", F.lit("retryable_error")).otherwise(F.lit("ok")).alias("state"), (F.col("user_id") % 5).alias("tries"))
    return shard.to_retry(states).select("event_id")


@query("q_round_robin", "SELECT n_nationkey, CAST((row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1) % 3 AS INT) AS turn FROM nation")
def round_robin(spark, d):
    return shard.round_robin(table(spark, d, "nation"), ["n_nationkey"], 3, ["n_regionkey"]).select("n_nationkey", F.col("turn").cast("int").alias("turn"))


# ---------------------------------------------------------------- reports


@query("q_court_counts", "SELECT courtType, count(*) AS cases FROM cases GROUP BY courtType")
def court_counts(spark, d):
    return reports.court_counts(case_view(spark, d))


@query("q_bench_counts", "SELECT benchName, count(*) AS cases FROM cases WHERE courtType = 'NCLT' GROUP BY benchName UNION ALL SELECT 'TOTAL', count(*) FROM cases WHERE courtType = 'NCLT' HAVING count(*) > 0")
def bench_counts(spark, d):
    return reports.bench_counts(case_view(spark, d))


@query("q_high_court_counts", "SELECT benchName AS label, count(*) AS cases FROM cases WHERE courtType = 'High Court' GROUP BY benchName")
def high_court_counts(spark, d):
    v = case_view(spark, d)
    return reports.high_court_counts(v.withColumn("courtType", F.when(F.col("courtType") == "High Court", F.concat(F.lit("HIGH_COURT ("), "benchName", F.lit(")"))).otherwise(F.col("courtType"))))


SOURCE_SQL = "SELECT * FROM (VALUES ('drt', 0, 0), ('drat', 1, 0), ('nclt', 2, (SELECT count(*) FROM cases WHERE courtType = 'NCLT')), ('ncdrc', 3, 0), ('scdrc', 4, 0), ('dcdrc', 5, 0), ('high_court', 6, (SELECT count(*) FROM cases WHERE courtType = 'High Court')), ('district_court', 7, (SELECT count(*) FROM cases WHERE courtType = 'District Court')), ('supreme_court', 8, 0)) t(source, ord, n)"


@query("q_source_counts", f"WITH counts AS ({SOURCE_SQL}) SELECT source, CAST(ord AS INT) AS ord, CAST(n AS BIGINT) AS n FROM counts")
def source_counts(spark, d):
    return reports.source_rows(case_view(spark, d))


@query("q_result_cells", f"""
WITH counts AS ({SOURCE_SQL}), cell AS (SELECT *, CASE WHEN source IN ('drt', 'drat') THEN 'B8' WHEN source = 'nclt' THEN 'B9' WHEN source IN ('high_court', 'district_court') THEN 'B10' END AS cell FROM counts)
SELECT cell, CASE WHEN sum(n) = 0 THEN 'no' WHEN count(*) > 1 THEN 'yes(' || string_agg(source || ': ' || n, ', ' ORDER BY ord) || ')' ELSE 'yes (' || CAST(sum(n) AS BIGINT) || ')' END AS result FROM cell WHERE cell IS NOT NULL GROUP BY cell
""")  # fmt: skip
def result_cells(spark, d):
    cells = {"drt": "B8", "drat": "B8", "nclt": "B9", "high_court": "B10", "district_court": "B10"}
    return reports.result_cells(source_counts(spark, d), cells)


@query("q_primary_count", "SELECT count(*) FILTER (WHERE caseNumber <> '') AS primary_rows FROM cases")
def primary_count(spark, d):
    return reports.primary_count(case_view(spark, d).withColumn("_is_continuation", F.col("caseNumber") == ""))


@query("q_run_times", """
WITH r AS (SELECT event_type AS source, min(ts) AS a, max(ts) AS b FROM events WHERE user_id % 3 = 0 GROUP BY event_type), s AS (SELECT source, CAST(floor(epoch(b) - epoch(a)) AS BIGINT) AS seconds FROM r)
SELECT source, seconds, CASE WHEN seconds < 60 THEN seconds || 's' ELSE (seconds // 60) || 'm ' || (seconds % 60) || 's' END AS shown FROM s
""")  # fmt: skip
def run_times(spark, d):
    e = table(spark, d, "events").where("user_id % 3 = 0").select(F.col("event_type").alias("source"), "ts")
    return reports.run_times(e, "source", "ts", "ts").select("source", "seconds", "shown")


@query("q_success_rates", "SELECT user_id, CASE WHEN count(*) < 5 THEN 0.5 ELSE round(CAST(count(*) FILTER (WHERE event_type <> 'error') AS DOUBLE) / count(*), 9) END AS rate FROM events GROUP BY user_id")
def success_rates(spark, d):
    counted = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") != "error").alias("good"), F.count("*").alias("tries"))
    return counted.select("user_id", F.round(cases.success_rate(F.col("good"), F.col("tries")), 9).alias("rate"))


@query("q_top_benches", "SELECT benchName, count(*) AS cases FROM cases WHERE benchName <> '' GROUP BY benchName ORDER BY cases DESC, benchName LIMIT 5")
def top_benches(spark, d):
    """A report of the five benches with the most cases."""
    counted = case_view(spark, d).where("benchName <> ''").groupBy("benchName").agg(F.count("*").alias("cases"))
    return counted.orderBy(F.desc("cases"), "benchName").limit(5)


# ---------------------------------------------------------------- joins and control tables

DETAILS_SQL = "SELECT l_orderkey AS k, count(*) AS lines, CAST(max(l_partkey) AS BIGINT) AS part FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey"


def _details(spark, d):
    return table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("lines"), F.max("l_partkey").cast("long").alias("part"))


@query("q_hits_left", f"SELECT o.o_orderkey AS k, lines, part FROM orders o LEFT JOIN ({DETAILS_SQL}) d ON o.o_orderkey = d.k")
def hits_left(spark, d):
    return joins.with_details(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), _details(spark, d), ["k"])


@query("q_hits_inner", f"SELECT o.o_orderkey AS k, lines, part FROM orders o JOIN ({DETAILS_SQL}) d ON o.o_orderkey = d.k")
def hits_inner(spark, d):
    return joins.with_details(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), _details(spark, d), ["k"], keep_missing=False)


@query("q_overlay", "SELECT c.k, CASE WHEN c.k % 2 = 0 AND trim(c.otherPetitioner) <> '' THEN c.otherPetitioner ELSE c.petitioner END AS petitioner FROM cases c")
def overlaid(spark, d):
    v = case_view(spark, d)
    details = v.where("k % 2 = 0").select("k", F.col("otherPetitioner").alias("petitioner"))
    return joins.overlaid(v.select("k", "petitioner"), details, ["k"], ["petitioner"])


@query("q_lookup", "SELECT c_custkey, coalesce(n_name, 'UNKNOWN') AS n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def lookup(spark, d):
    dim = table(spark, d, "nation").where("n_nationkey < 20").withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.lookup(table(spark, d, "customer").select("c_custkey", "c_nationkey"), dim, "c_nationkey", "n_name", F.lit("UNKNOWN")).select("c_custkey", "n_name")


@query("q_requests", "SELECT CAST(c_custkey AS BIGINT) AS row, c_name AS party, CASE c_custkey % 3 WHEN 0 THEN 'company' ELSE 'individual' END AS entity_type FROM customer WHERE c_custkey % 2 = 0")
def requests(spark, d):
    k = F.col("c_custkey")
    cells = table(spark, d, "customer").select(
        k.alias("row"), F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("party"), F.when(k % 2 == 0, F.lit(" Fetch")).otherwise(F.lit("DONE")).alias("command"),
        F.when(k % 3 == 0, F.lit("Company ")).when(k % 3 == 1, F.lit("INDIVIDUAL")).otherwise(F.lit("?")).alias("entity_type"),
    )
    return joins.requests(cells)


@query("q_config", "SELECT * FROM (VALUES ('drt', CAST(1 AS BIGINT), '2024-01-01', '2025-12-31'), ('nclt', 3, '2020-01-01', '2025-06-30'), ('ncdrc', 4, '2025-03-25', '2025-07-01'), ('scdrc', 5, '2025-03-25', '2025-07-01'), ('dcdrc', 6, '2025-03-25', '2025-07-01')) t(source, ord, date_from, date_to)")
def config(spark, d):
    rows = [(1, "append mode", "", "", ""), (2, "High Court", "TRUE", "2001", ""), (3, "Courts", "Active", "", ""), (4, "e-Jagriti", " true ", "25/3/2025", ""), (5, "Debts Recovery Tribunals", "TRUE", "2024", "12/31/2025"),
            (6, "Party Name | National Company Law Tribunal", "TRUE", "1/1/2020", "6/30/2025"), (7, "District Courts of India", "FALSE", "", ""), (8, "Other", "TRUE", "", "")]
    table_ = spark.createDataFrame(rows, "row int, court_name string, is_active string, start_date string, end_date string")
    return joins.active_sources(table_, "2025-07-01").select("source", F.col("ord").cast("long").alias("ord"), "date_from", "date_to")


@query("q_page_index", "SELECT 'dc' AS court, CAST(n_nationkey AS INT) AS page_ord, CASE n_nationkey % 3 WHEN 0 THEN 'id-' || n_nationkey || '_x' ELSE n_name END AS page_id FROM nation WHERE n_nationkey % 3 <> 2")
def page_index(spark, d):
    k = F.col("n_nationkey")
    link = F.when(k % 3 == 0, F.concat(F.lit('=HYPERLINK("https://docs/d/id-'), k.cast("string"), F.lit('_x/edit","p")'))).otherwise(F.lit(""))
    cells = table(spark, d, "nation").select(F.lit("dc").alias("court"), k.cast("int").alias("page_ord"), link.alias("formula"), F.when(k % 3 == 1, F.concat(F.lit(" "), "n_name")).otherwise(F.lit(" ")).alias("raw"))
    return joins.page_index(cells)


@query("q_union_sources", "SELECT source, CAST(source_ord AS INT) AS source_ord, count(*) AS cases FROM (SELECT CASE courtType WHEN 'NCLT' THEN 'nclt' WHEN 'High Court' THEN 'high_court' ELSE 'district_court' END AS source, CASE courtType WHEN 'NCLT' THEN 2 WHEN 'High Court' THEN 6 ELSE 7 END AS source_ord FROM cases WHERE courtType <> '') GROUP BY source, source_ord")
def union_sources(spark, d):
    v = case_view(spark, d)
    parts = {"district_court": v.where("courtType = 'District Court'"), "nclt": v.where("courtType = 'NCLT'"), "high_court": v.where("courtType = 'High Court'")}
    return joins.union_sources(parts).groupBy("source", "source_ord").agg(F.count("*").alias("cases"))


@query("q_systems", "SELECT event_type AS kind, CAST(CASE event_type WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'error' THEN 1 WHEN 'click' THEN 12 ELSE 1 END AS INT) AS systems, CASE event_type WHEN 'view' THEN 'total_systems' ELSE 'dc_write_lock' END AS head FROM events GROUP BY event_type")
def systems(spark, d):
    t = F.col("event_type")
    raw = F.when(t == "view", F.lit("2 PCs")).when(t == "signup", F.lit("Three PCs")).when(t == "error", F.lit("")).when(t == "click", F.lit("12")).otherwise(F.lit("none"))
    head = F.when(t == "view", F.lit(" Total  Systems ")).otherwise(F.lit("DC Write-Lock"))
    return table(spark, d, "events").select(t.alias("kind"), cases.total_systems(raw).alias("systems"), cases.header_name(head).alias("head")).distinct()


# ---------------------------------------------------------------- companies


@query("q_company_norm", f"WITH named AS (SELECT k, coalesce({canonical_sql('petitioner')}, '') AS name FROM cases) SELECT k, name, trim(regexp_replace(name, '(^|\\s)(LIMITED\\sLIABILITY\\sPARTNERSHIP|PRIVATE\\sLIMITED|LIMITED|LLP|INCORPORATED|INC|CORPORATION|COMPANY)$', '')) AS core FROM named")
def company_norm(spark, d):
    named = case_view(spark, d, costly=True).select("k", company.normalize_column("petitioner").alias("name"))
    return named.select("k", "name", company.core_column(F.col("name")).alias("core"))


@query("q_company_regex", r"""
SELECT k FROM cases WHERE regexp_matches(upper(petitioner), '(^|[^A-Z0-9])MACHINERY[^A-Z0-9]+13[^A-Z0-9]+TRADERS([^A-Z0-9]|$)')
""")  # fmt: skip
def company_regex(spark, d):
    plan = company.make_plan("Machinery 13 Traders")
    return case_view(spark, d).where(company.variant_match(F.col("petitioner"), plan)).select("k")


def company_match_of(query_text: str, column: str):
    def run(spark, d):
        found = company.match_cells(case_view(spark, d, costly=True), column, company.make_plan(query_text))
        return found.select("cell", "match.matched", "match.score", "match.method", "match.variant")

    return run


def match_oracle(query_text: str, column: str) -> str:
    return f"WITH RECURSIVE given AS (SELECT DISTINCT {column} AS cell FROM cases), {company_sql(query_text)} SELECT cell, matched, score, method, variant FROM decided"


query("q_company_match", match_oracle("Machinary 13 Trader Pvt Ltd", "petitioner"))(company_match_of("Machinary 13 Trader Pvt Ltd", "petitioner"))
query("q_company_match_near", match_oracle("Machinery 13 Traders Limited Mumbay", "petitioner"))(company_match_of("Machinery 13 Traders Limited Mumbay", "petitioner"))
query("q_company_match_core", match_oracle("Traders 13 Machinery Ltd", "petitioner"))(company_match_of("Traders 13 Machinery Ltd", "petitioner"))
query("q_company_match_listed", match_oracle("Supplier Limited", "respondent"))(company_match_of("Supplier Limited", "respondent"))


@query("q_jw_scores", f"""
WITH RECURSIVE names AS (SELECT DISTINCT p_name, p_type, regexp_replace({normal_sql('p_name')}, '[^A-Z0-9]+', '', 'g') AS a, regexp_replace({normal_sql('p_type')}, '[^A-Z0-9]+', '', 'g') AS b FROM part),
pairs AS (SELECT DISTINCT a, b FROM names), {WINKLER_SQL}
SELECT p_name, p_type, score FROM names JOIN scored USING (a, b)
""")  # fmt: skip
def jw_scores(spark, d):
    return company.scores(table(spark, d, "part").select("p_name", "p_type").distinct(), "p_name", "p_type")


@query("q_company_plan", """
SELECT * FROM (VALUES ('AB Foods Ltd', 'AB FOODS LIMITED', CAST(9 AS INT), 'AB FOODS LIMITED; AB FOODS LTD; AB FOODS PRIVATE LIMITED; AB FOODS PVT LTD; AB FOODS; A B FOODS LIMITED; A B FOODS LTD; A B FOODS PRIVATE LIMITED; A B FOODS PVT LTD; A B FOODS; A.B. FOODS LIMITED; A.B. FOODS LTD; A.B. FOODS PRIVATE LIMITED; A.B. FOODS PVT LTD; A.B. FOODS', 'AB AND FOODS; A AND B AND FOODS; A.B. AND FOODS'),
  ('M K Rao', 'M K RAO', 9, 'M K RAO; M K R A O; M K R.A.O.; MK RAO; MK R A O; MK R.A.O.; M.K. RAO; M.K. R A O; M.K. R.A.O.', 'M AND K AND RAO; M AND K AND R AND A AND O; M AND K AND R.A.O.; MK AND RAO; MK AND R AND A AND O; MK AND R.A.O.; M.K. AND RAO; M.K. AND R AND A AND O; M.K. AND R.A.O.')) t(name, normal, n, variants, keywords)
""".replace("CAST(9 AS INT)", "CAST(15 AS INT)"))  # fmt: skip
def company_plan(spark, d):
    """M3, M4: what two queries are searched by."""
    plans = [company.make_plan(n) for n in ("AB Foods Ltd", "M K Rao")]
    return spark.createDataFrame([(p.name, p.normal, len(p.variants), "; ".join(p.variants), "; ".join(p.keywords)) for p in plans], "name string, normal string, n int, variants string, keywords string")


@query("q_many_companies", f"""
WITH RECURSIVE given AS (SELECT DISTINCT petitioner AS cell FROM cases), {company_sql('Machinery 13 Traders Private Limited')}, one AS (SELECT cell, score, method FROM decided WHERE matched)
SELECT 'Machinery 13 Traders Private Limited' AS query, cell, score, method FROM one
""")  # fmt: skip
def many_companies(spark, d):
    """The cells that match each of many queries; the second query finds nothing."""
    asked = spark.createDataFrame([("Machinery 13 Traders Private Limited",), ("Zzz 7 Qqq",)], "q string")
    return company.matched_pairs(asked, case_view(spark, d), "q", "petitioner")


# ---------------------------------------------------------------- payloads


@query("q_envelopes", """
SELECT event_id AS k, CAST(CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END AS INT) AS items, CASE WHEN event_id % 5 < 2 THEN CAST(json_extract(props, '$.k') AS VARCHAR) WHEN event_id % 5 = 2 THEN 'x' END AS first
FROM events
""")  # fmt: skip
def envelopes(spark, d):
    k, p = F.col("event_id"), F.col("props")
    reply = (
        F.when(k % 5 == 0, F.concat(F.lit("["), p, F.lit(","), p, F.lit("]"))).when(k % 5 == 1, F.concat(F.lit('{"status": 1, "data": 3, "cases": ['), p, F.lit("]}")))
        .when(k % 5 == 2, F.lit('{"caseNumber": 1, "k": "x"}')).when(k % 5 == 3, F.lit("no json")).otherwise(p)
    )
    items = table(spark, d, "events").select(k.alias("k"), payloads.envelope_items(reply).alias("items"))
    return items.select("k", F.size("items").alias("items"), F.get_json_object(F.try_element_at("items", F.lit(1)), "$.k").alias("first"))


@query("q_replies", """
SELECT event_id AS k, CAST(CASE event_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 2 ELSE 0 END AS INT) AS tribunal, CAST(CASE event_id % 6 WHEN 4 THEN 3 ELSE 0 END AS INT) AS con,
  CASE event_id % 6 WHEN 0 THEN 'no_results' WHEN 1 THEN 'no_results' WHEN 2 THEN 'no_results' WHEN 3 THEN 'no_results' WHEN 4 THEN 'ok' ELSE 'session_expired' END AS kind
FROM events
""")  # fmt: skip
def replies(spark, d):
    k, p = F.col("event_id"), F.col("props")
    reply = (
        F.when(k % 6 == 0, F.lit('{"status": "Record Not Fund", "x": 1}')).when(k % 6 == 1, p).when(k % 6 == 2, F.lit('{"message": "busy"}')).when(k % 6 == 3, F.concat(F.lit("["), p, F.lit(", "), p, F.lit("]")))
        .when(k % 6 == 4, F.lit('{"con": ["[{\\"a\\": 1}, {\\"a\\": 2}]", "bad", {"a": 3}], "totRecords": 3, "status": "No Record"}')).otherwise(F.lit("<html>Please login</html>"))
    )
    return table(spark, d, "events").select(k.alias("k"), F.size(payloads.tribunal_items(reply)).alias("tribunal"), F.size(payloads.con_items(reply)).alias("con"), payloads.reply_kind(reply).alias("kind"))


@query("q_delimited", "SELECT n_regionkey, string_agg(n_nationkey || '=' || n_name, ',' ORDER BY n_nationkey) AS pairs FROM nation WHERE n_nationkey <> 0 GROUP BY n_regionkey")
def delimited(spark, d):
    lists = table(spark, d, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("l"))
    raw = F.concat(F.lit("﻿"), F.array_join(F.transform("l", lambda x: F.concat(x["n_nationkey"].cast("string"), F.lit("~ "), x["n_name"])), "#"), F.lit("#x"))
    return lists.select("n_regionkey", F.array_join(F.transform(payloads.delimited(raw), lambda x: F.concat(x["code"], F.lit("="), x["name"])), ",").alias("pairs"))


@query("q_html_links", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS INT) AS links, coalesce(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)[1], '') AS first FROM pages
""")  # fmt: skip
def html_links(spark, d):
    found = table(spark, d, "pages").select("page_id", html.page_links("html").alias("l"))
    return found.select("page_id", F.size("l").alias("links"), F.coalesce(F.try_element_at("l", F.lit(1)), F.lit("")).alias("first"))


@query("q_html_titles", """
SELECT page_id, trim(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS title FROM pages
""")  # fmt: skip
def html_titles(spark, d):
    return table(spark, d, "pages").select("page_id", html.page_title("html").alias("title"))


def dc_page(k, number):
    """An invented page of a district court's case."""
    return F.concat(
        F.lit('<table class="case_details_table x"><tr><td>Case Type</td><td>CS - CIVIL SUIT</td></tr><tr><td>Registration Number:</td><td>'), number, F.lit("/2024</td><td>Registration Date:</td><td>09-01-2024</td></tr></table>"),
        F.lit('<table class="table_r"><tr><td>Case Status</td><td>Case disposed</td></tr><tr><td>Court Number and Judge</td><td>12 - Judge A</td></tr></table>'),
        F.lit('<div class="Petitioner_Advocate_table">1) Acme '), number, F.lit(" Pvt Ltd</br>Advocate- A. Rao, B. Das<br>2) Sita Devi</div>"),
        F.lit('<table class="history_table"><thead><tr><th>Judge</th><th>Business on Date</th><th>Hearing Date</th><th>Purpose of Hearing</th></tr></thead><tr><td>J</td><td>01-02-2024</td><td>03-02-2024</td><td>Final</td></tr></table>'),
    )


@query("q_build_district", """
SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS caseNumber, '12' AS courtNumber, '09 JAN 2024' AS registrationDate, '"Acme ' || o_orderkey || ' Pvt Ltd", "Sita Devi"' AS petitioner, '"A. Rao", "B. Das"' AS petitionerAdvocate, 'Disposed' AS caseStatus,
  'DC|C' || o_orderkey AS uniqueness, 'S (dis: D, comp:X est:null)' AS benchName, '[{"date":"03 FEB 2024","purpose":"Final","judge":"J"}]' AS listingHistory
FROM orders
""")  # fmt: skip
def build_district(spark, d):
    k = F.col("o_orderkey").cast("string")
    hits = spread(table(spark, d, "orders")).select(F.col("o_orderkey").alias("k"), html.case_page(dc_page(F.col("o_orderkey"), k), "dc").alias("detail"), F.concat(F.lit("C"), k).alias("cino"), F.lit("S").alias("state_name"), F.lit("D").alias("dist_name"), F.lit("X").alias("complex_name"))
    return builders.build_dc(hits, keep=("k",)).select("k", "caseNumber", "courtNumber", "registrationDate", "petitioner", "petitionerAdvocate", "caseStatus", "uniqueness", "benchName", "listingHistory")


@query("q_build_high", """
SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS caseNumber, '05 FEB 2024' AS registrationDate, '"P ' || o_orderkey || '"' AS petitioner, '"R"' AS respondent, 'Pending' AS caseStatus, 'HC|H' || o_orderkey AS uniqueness, 'HC X (bench: B)' AS benchName,
  '[{"date":"01 MAR 2024","purpose":"Orders","judge":"J","orderUrl":"https://x/cases/o.pdf"},{"date":"02 MAR 2024","purpose":null,"judge":"J"}]' AS listingHistory
FROM orders
""")  # fmt: skip
def build_high(spark, d):
    k = F.col("o_orderkey").cast("string")
    page = F.concat(
        F.lit('<table class="case_details_table"><tr><td>Registration Number</td><td>WP/'), k, F.lit("/2024</td><td>Filing Date</td><td>05-02-2024</td></tr></table>"),
        F.lit('<table class="order_table"><tr><td>1</td><td>a</td><td>b</td><td>01-03-2024</td><td><a href="cases_qry/cases/o.pdf">x</a></td></tr></table>'),
        F.lit('<table class="history_table"><tr><td>1</td><td>J</td><td>01-03-2024</td><td>05-03-2024</td><td>Orders</td></tr><tr><td>2</td><td>J</td><td>02-03-2024</td><td></td></tr><tr><td>3</td><td>J</td><td>soon</td><td></td></tr></table>'),
    )
    hits = spread(table(spark, d, "orders")).select(F.col("o_orderkey").alias("k"), html.case_page(page, "hc").alias("detail"), F.concat(F.lit("H"), k).alias("cino"), F.concat(F.lit("P  "), k).alias("pet_name"), F.lit("R").alias("extra_party"), F.lit("HC X").alias("name"), F.lit("B").alias("bench_name"))
    return builders.build_hc(hits, "https://x/", keep=("k",)).select("k", "caseNumber", "registrationDate", "petitioner", "respondent", "caseStatus", "uniqueness", "benchName", "listingHistory")


@query("q_build_supreme", """
SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS caseNumber, '07 MAR 2025' AS registrationDate, '08 APR 2025' AS nextListingDate, '"A B", "C"' AS petitioner, 'R' AS respondent, 'Disposed' AS caseStatus, 'SC|2025|' || o_orderkey AS uniqueness,
  '[{"date":"01-01-2025","purpose":"[ROP]","orderDetail":{"url":"u.pdf"},"actionTaken":null,"encPath":null}]' AS listingHistory,
  '[{"filingNumber":"7/2025","caseType":"IA","caseTitle":"X","benchName":"New Delhi","caseStatus":"Pending","courtNumber":null,"applicationNumber":"7/2025","registrationDate":null,"filingDate":{"day":3,"month":2,"year":2025},"nextListingDate":null,"disposalDate":null}]' AS applicationDetails
FROM orders
""")  # fmt: skip
def build_supreme(spark, d):
    k = F.col("o_orderkey").cast("string")
    main = F.lit("<table><tr><td>Case Number</td><td>SLP No. 1 Registered on 07-03-2025 (Verified)</td></tr><tr><td>Status/Stage :</td><td>DISPOSED List On (Date) (08-04-2025)</td></tr><tr><td>Petitioner(s)</td><td>1 A  B<br>2. C<br>1 A B</td></tr></table>")
    tabs = F.create_map(
        F.lit("case_details"), main, F.lit("judgement_orders"), F.lit('<table><tr><td><a href="u.pdf">01-01-2025</a> [ROP]</td></tr></table>'),
        F.lit("interlocutory_application_documents"), F.lit("<table><tr><td>Serial Number</td><td>a</td><td>b</td><td>c</td><td>d</td><td>e</td></tr><tr><td>1</td><td>7/2025</td><td>IA</td><td></td><td>X</td><td>03-02-2025</td><td>7/2025</td></tr></table>"),
    )
    hits = spread(table(spark, d, "orders")).select(F.col("o_orderkey").alias("k"), html.sc_page(payloads.keep_tabs(tabs, "required")).alias("detail"), k.alias("diary_no"), F.lit("2025").alias("diary_year"), F.lit("R").alias("respondent"), F.lit("1").alias("sc_type_code"), k.alias("searched_case_no"), F.lit("2025").alias("sc_year"))
    return builders.build_sc(hits, keep=("k",)).select("k", "caseNumber", "registrationDate", "nextListingDate", "petitioner", "respondent", "caseStatus", "uniqueness", "listingHistory", "applicationDetails")


@query("q_build_tribunals", """
SELECT o_orderkey AS k, 'NCLT' AS courtType, 'C ' || o_orderkey AS caseNumber, '09 JAN 2025' AS registrationDate, 'ACME LTD, B' AS petitioner, 'ORBIT' AS respondent, 'Bengaluru' AS benchName, 'Pending' AS caseStatus,
  '[{"date":"01 FEB 2025","orderDetail":{"url":"https://n/ordersview.drt?path=q"},"encPath":"q","purpose":"p","actionTaken":null}]' AS listingHistory FROM orders
UNION ALL SELECT o_orderkey, 'DRT', CAST(o_orderkey AS VARCHAR), '09 JAN 2025', 'X BANK', 'Y', 'DRT 1', 'Disposed', '[{"date":{"day":1,"month":2,"year":2025},"purpose":"h"},{"date":null,"purpose":null}]' FROM orders
UNION ALL SELECT o_orderkey, 'NCDRC', 'R' || o_orderkey, '09 JAN 2025', 'A', 'B CO', 'N', 'PENDING', '' FROM orders
""")  # fmt: skip
def build_tribunals(spark, d):
    base = spread(table(spark, d, "orders")).select(F.col("o_orderkey").alias("k"))
    ks = F.col("k").cast("string")
    nclt = base.select(
        "k", F.concat(F.lit("C "), ks).alias("case_no"), F.lit("2025-01-09 00:00:00").alias("regis_date"), F.lit("Bangalore Bench").alias("bench_location_name"), F.lit("M/S Orbit & ORS").alias("case_title2"),
        F.lit('{"partydetailslist": [{"party_type": "P1", "party_name": "Acme Ltd AND ORS."}, {"party_type": "p2", "party_name": "B (x)"}, {"party_type": "X", "party_name": "Z"}], "allproceedingdtls": [{"listing_date": "01/02/2025", "encPath": "q", "purpose": "NA", "next_listing_purpose": "p"}, {"listing_date": "?"}]}').alias("detail"),
    )
    drt = base.select(
        "k", F.lit("DRT 1").alias("name"), F.lit("M/S. X Bank").alias("applicant"), F.lit("y").alias("respondent"), F.lit("Disposal ").alias("casestatus"),
        F.concat(F.lit('{"caseno": "'), ks, F.lit('", "dateoffiling": "09/01/2025", "casestatus": " ", "caseProceedingDetails": [{"causelistdate": "1/2/2025", "purpose": "h"}, {"causelistdate": "x"}]}')).alias("detail"),
    )
    consumer = base.select("k", F.lit("N").alias("name"), F.concat(F.lit('{"caseNumber": "R'), ks, F.lit('", "regDate": "09-01-2025", "complainantNameEn": "a, ", "respondentName": "B Co.", "status": "null"}')).alias("item"))
    names = ("k", "courtType", "caseNumber", "registrationDate", "petitioner", "respondent", "benchName", "caseStatus", "listingHistory")
    parts = [builders.build_nclt(nclt, "q", "https://n", keep=("k",)), builders.build_tribunal(drt, "DRT", "q", keep=("k",)), builders.build_consumer(consumer, "NCDRC", "q", keep=("k",))]
    return parts[0].select(*names).unionByName(parts[1].select(*names)).unionByName(parts[2].select(*names))


@query("q_registry", "SELECT 'nclt' AS source, 'C ' || o_orderkey AS caseNumber, 'NCLT' AS courtType, 'asked' AS partyName FROM orders UNION ALL SELECT 'drt', CAST(o_orderkey AS VARCHAR), 'DRT', 'asked' FROM orders")
def from_registry(spark, d):
    """Sources by their names, of which one is not known; each builds its rows by what the registry has for it."""
    k = F.col("o_orderkey").cast("string")
    base = table(spark, d, "orders")
    payload_of = {"nclt": base.select(F.concat(F.lit("C "), k).alias("case_no"), F.lit("{}").alias("detail")), "drt": base.select(F.concat(F.lit('{"caseno": "'), k, F.lit('"}')).alias("detail"))}
    known, unknown = registry.known_sources(["nclt", "elsewhere", "drt"])
    parts = [source.build(payload_of[source.name], "asked").select(F.lit(source.name).alias("source"), "caseNumber", "courtType", "partyName") for source in known]
    return parts[0].unionByName(parts[1]).where(F.lit(unknown == ["elsewhere"]))


# ---------------------------------------------------------------- pages in other forms


@query("q_district_pages", """
SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 2 THEN '' ELSE '"Acme ' || o_orderkey || '"' END AS petitioner, CASE o_orderkey % 5 WHEN 1 THEN '"B. Das", "C. Rao", "D. Sen"' ELSE '' END AS petitionerAdvocate,
  CASE o_orderkey % 5 WHEN 2 THEN '' WHEN 3 THEN '"Orbit"' ELSE '' END AS respondent, CASE o_orderkey % 5 WHEN 0 THEN 'Pending' WHEN 1 THEN 'Disposed' ELSE 'Pending' END AS caseStatus,
  CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '[{"date":"05 MAR 2024","purpose":"Hearing","judge":"J One"}]' WHEN 4 THEN '[{"date":"02 JAN 2024","purpose":"Last","judge":"AB"}]' ELSE '' END AS listingHistory,
  CASE o_orderkey % 5 WHEN 2 THEN 'sql_error' END AS parse_error
FROM orders
""")  # fmt: skip
def district_pages(spark, d):
    """Pages without tables, with labels that repeat, three columns of hearings, nested tables, an error, and names in the hit's label alone."""
    n = F.col("o_orderkey")
    k, kind = n.cast("string"), n % 5
    name = F.concat(F.lit("1) Acme "), k)
    page = (
        F.when(kind == 0, F.concat(F.lit('<p>no tables</p><div class="x Petitioner_Advocate_table">'), name, F.lit(",<br></div><table><tr><td>Case Status</td><td>Case disposed</td></tr></table>")))
        .when(kind == 1, F.concat(
            F.lit('<table class="case_details_table"><tr><td>Case Type</td><td>A</td><td>Case Type :</td><td>B</td></tr></table><table class="case_status_table"><tr><th>Case Status</th><td>Case pending</td></tr><tr><td>Case Status:</td><td>Disposed of</td></tr></table>'),
            F.lit('<div class="Petitioner_Advocate_table">'), name, F.lit("</br>advocate - B. Das, C. Rao<br>D.  Sen,<br>"), name, F.lit("</div>"),
            F.lit('<table class="history_table"><tr><td> J  One </td><td>05-03-2024</td><td>Hearing</td></tr><tr><td>J</td><td>none</td><td>x</td></tr></table>'),
        ))
        .when(kind == 2, F.lit("<html><b>Sql error: lost</b></html>"))
        .when(kind == 3, F.lit("<table class='case_details_table'><tr><td>only one cell</td></tr></table><!-- <table class='history_table'> -->"))
        .otherwise(F.concat(
            F.lit('<table class="history_table"><thead><tr><th>Purpose of hearing</th><th>Hearing  Date</th><th>Judge</th><th>x</th></tr></thead><tbody><tr><td>Last</td><td>02-01-2024&nbsp;</td><td>A<br>B</td><td><table><tr><td>in</td></tr></table></td></tr></tbody></table><div class="Petitioner_Advocate_table">'),
            name, F.lit("</div>"),
        ))
    )
    label = F.when(kind == 3, F.concat(F.lit("View case details, Acme "), k, F.lit("<br>Vs</br>Orbit")))
    hits = spread(table(spark, d, "orders")).select(n.alias("k"), html.case_page(page, "dc").alias("detail"), label.alias("case_label"))
    return builders.build_dc(hits, keep=("k", "detail")).select("k", "petitioner", "petitionerAdvocate", "respondent", "caseStatus", "listingHistory", F.col("detail.parse_error").alias("parse_error"))


@query("q_build_on_demand", """
SELECT o_orderkey AS k, 'DISTRICT_COURT (D)' AS courtType, CASE WHEN o_orderkey % 2 = 0 THEN 'R' || o_orderkey ELSE 'n' || o_orderkey END AS caseNumber, '09 JAN 2024' AS registrationDate, '"A"' AS petitioner, 'S' AS location, 'E' AS benchName,
  '[{"date":"03 FEB 2024","purpose":"Final","judge":"J"}]' AS listingHistory FROM orders
UNION ALL SELECT o_orderkey, 'HIGH_COURT (X)', CASE WHEN o_orderkey = 0 THEN '' ELSE 'WP/' || o_orderkey || '/2021' END, '05 FEB 2024', '"P"', 'INDIA', 'B', '[{"date":"01 MAR 2024","purpose":"Orders","judge":"J","orderUrl":"https://x/o.pdf"}]' FROM orders
UNION ALL SELECT o_orderkey, 'SUPREME COURT', CASE WHEN o_orderkey % 2 = 0 THEN 'SLP ' || o_orderkey ELSE '' END, '07 MAR 2025', '"A B"', 'India', 'New Delhi', '' FROM orders
""")  # fmt: skip
def build_on_demand(spark, d):
    """The three builders of the older form."""
    n = F.col("o_orderkey")
    k, base = n.cast("string"), spread(table(spark, d, "orders"))
    dc_page_ = F.concat(
        F.lit('<table class="case_details_table"><tr><td>Registration Number</td><td>'), F.when(n % 2 == 0, F.concat(F.lit("R"), k)).otherwise(F.lit("")), F.lit("</td><td>Registration Date</td><td>09-01-2024</td></tr></table>"),
        F.lit('<div class="Petitioner_Advocate_table">1) A</div><table class="history_table"><tr><td>1</td><td>J</td><td>03-02-2024</td><td>04-02-2024</td><td>Final</td></tr></table>'),
    )
    dc = base.select(n.alias("k"), html.case_page(dc_page_, "dc_on_demand").alias("detail"), F.concat(F.lit("n"), k).alias("case_no"), F.lit("S").alias("state_name"), F.lit("D").alias("dist_name"), F.lit("E").alias("est_name"))
    hc_page_ = F.lit(
        '<table class="case_details_table"><tr><td>Filing Date</td><td>05-02-2024</td></tr></table><table class="order_table"><tr><td>1</td><td>a</td><td>b</td><td>01-03-2024</td><td><a href="/cases_qry/o.pdf">x</a></td></tr></table>'
        '<table class="history_table"><tr><td>1</td><td>J</td><td>01-03-2024</td><td>05-03-2024</td><td>Orders</td></tr></table>'
    )
    hc = base.select(n.alias("k"), html.case_page(hc_page_, "hc").alias("detail"), F.lit("WP").alias("type_name"), k.alias("case_no2"), F.lit("2021").alias("case_year"), F.lit("P").alias("pet_name"), F.lit("X").alias("hc_name"), F.lit("B").alias("bench_name"))
    main = F.concat(
        F.lit("<table><tr><td>Diary Number</td><td>1/2025 Filed on 07-03-2025 10:00 AM</td></tr><tr><td>Case Number</td><td>"), F.when(n % 2 == 0, F.concat(F.lit("SLP "), k, F.lit(" Registered on 08-03-2025"))).otherwise(F.lit("none")),
        F.lit("</td></tr><tr><td>Petitioner(s)</td><td>1 A  B</td></tr></table>"),
    )
    sc = base.select(n.alias("k"), html.sc_page(F.create_map(F.lit(""), main)).alias("detail"))
    names = ("k", "courtType", "caseNumber", "registrationDate", "petitioner", "location", "benchName", "listingHistory")
    made = [builders.build_dc_on_demand(dc, "q", keep=("k",)), builders.build_hc_on_demand(hc, "q", "https://x/", keep=("k",)), builders.build_sc_on_demand(sc, "q", keep=("k",))]
    return made[0].select(*names).unionByName(made[1].select(*names)).unionByName(made[2].select(*names))


@query("q_options", "SELECT n_nationkey AS k, CAST(CASE WHEN n_nationkey % 2 = 0 THEN 3 ELSE 2 END AS INT) AS n_all, 'v' || n_nationkey || '=' || n_name AS plain, CASE WHEN n_nationkey % 2 = 0 THEN '1^' || n_nationkey || '=M' ELSE '' END AS marked FROM nation")
def options(spark, d):
    """Lists of options with blank values, a 0, and values with a mark."""
    k = F.col("n_nationkey").cast("string")
    page = F.concat(F.lit('<select><option value="">Select</option><option value="0">All</option><option value=" v'), k, F.lit(' "> '), "n_name", F.lit("</option>"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit('<option value="1^'), k, F.lit('">M</option>'))).otherwise(F.lit("")), F.lit("<option>none</option></select>"))
    shown = lambda o: F.concat(o["value"], F.lit("="), o["text"])
    some = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), html.options(page).alias("a"), html.options(page, zero=False).alias("b"), html.options(page, mark="^").alias("c"))
    return some.select("k", F.size("a").alias("n_all"), shown(F.get("b", F.lit(0))).alias("plain"), F.array_join(F.transform("c", shown), ",").alias("marked"))


@query("q_dc_hits", "SELECT o_orderkey AS k, 'N' || o_orderkey AS case_no, 'C' || o_orderkey AS cino, CASE WHEN o_orderkey % 2 = 0 THEN 'CScaseType' ELSE 'byParty' END AS search_by, 'View A' AS case_label, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'CS/' || o_orderkey || '/2024' END AS list_case_ref FROM orders")
def dc_hits(spark, d):
    """Links that open a case; those with fewer arguments or elsewhere are none."""
    k, n = F.col("o_orderkey").cast("string"), F.col("o_orderkey")
    row = F.concat(
        F.lit("<table><tr><td>1</td><td>"), F.when(n % 3 == 0, F.lit("no ref")).otherwise(F.concat(F.lit("CS/"), k, F.lit("/2024"))), F.lit("</td><td><a href='#' aria-label='View A' onclick=\"viewHistory('N"), k, F.lit("', 'C"), k,
        F.lit("','5','','flag','S','D','X'"), F.when(n % 2 == 0, F.lit("")).otherwise(F.lit(",'byParty'")), F.lit(")\">View</a></td></tr><tr><td><a href='#' onclick=\"viewHistory('a','b')\">x</a><a href='/' onclick=\"viewHistory(1,2,3,4,5,6,7,8)\">y</a></td></tr></table>"),
    )
    found = spread(table(spark, d, "orders")).select(n.alias("k"), F.explode(html.dc_hits(row)).alias("h"))
    return found.select("k", "h.case_no", "h.cino", "h.search_by", "h.case_label", "h.list_case_ref")


@query("q_sc_hits", "SELECT o_orderkey AS k, 'all' AS mode, CAST(o_orderkey AS VARCHAR) AS diary_no, '2024' AS diary_year, 'A B' AS petitioner FROM orders UNION ALL SELECT o_orderkey, 'all', 'x', '2023', 'Q' FROM orders UNION ALL SELECT o_orderkey, 'first', CAST(o_orderkey AS VARCHAR), '2024', 'A B' FROM orders")
def sc_hits(spark, d):
    """All rows of a result with a diary number, or the first alone."""
    k = F.col("o_orderkey").cast("string")
    page = F.concat(F.lit('<table><tr data-diary-no="1"><td>few</td></tr><tr data-diary-no="'), k, F.lit('" data-diary-year="2024"><td>1</td><td>d</td><td>c</td><td>A<br>B</td><td>R</td><td>PENDING</td></tr><tr data-diary-no="x" data-diary-year="2023"><td>1</td><td>d</td><td>c</td><td>Q</td><td>R</td><td>S</td></tr></table>'))
    base = spread(table(spark, d, "orders")).select(F.col("o_orderkey").alias("k"), page.alias("page"))
    parts = [base.select("k", F.lit(mode).alias("mode"), F.explode(html.sc_hits("page", first_only=mode == "first")).alias("h")) for mode in ("all", "first")]
    return parts[0].unionByName(parts[1]).select("k", "mode", "h.diary_no", "h.diary_year", "h.petitioner")


# ---------------------------------------------------------------- names and small values


@query("q_compounds", "SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'ACME ' || o_orderkey || ' LTD' WHEN 1 THEN 'ORBIT ' || o_orderkey WHEN 2 THEN 'BANK ' || o_orderkey ELSE '' END AS entity, CASE o_orderkey % 4 WHEN 0 THEN 'Acme ' || o_orderkey || '<br>' ELSE '' END AS pet, CASE o_orderkey % 4 WHEN 0 THEN 'Orbit' ELSE '' END AS res, CASE o_orderkey % 4 WHEN 0 THEN 'a vs b' WHEN 1 THEN 'a' WHEN 2 THEN 'b' END AS title FROM orders".replace("'Acme ' || o_orderkey || '<br>'", "'Acme ' || o_orderkey"))
def compounds(spark, d):
    """entities in compounds, parties of a case's label, titles of two names."""
    n = F.col("o_orderkey")
    k, kind = n.cast("string"), n % 4
    name = F.when(kind == 0, F.concat(F.lit("The Branch Manager of M/s Acme "), k, F.lit(" Ltd"))).when(kind == 1, F.concat(F.lit("Ram Das the liquidator for Orbit "), k)).when(kind == 2, F.concat(F.lit("Hari, Chairman at Bank "), k)).otherwise(F.lit("The manager of 77"))
    label = F.when(kind == 0, F.concat(F.lit("View case history of 1, Acme "), k, F.lit("<br>Vs</br> Orbit"))).otherwise(F.lit("View case, A and B"))
    pet, res = parties.split_case_label(label)
    first, second = F.when(kind < 2, F.lit("a")).otherwise(F.lit("")), F.when((kind == 0) | (kind == 2), F.lit("b")).otherwise(F.lit(""))
    return table(spark, d, "orders").select(n.alias("k"), parties.entity_in_compound(name).alias("entity"), pet.alias("pet"), res.alias("res"), parties.case_title(first, second).alias("title"))


@query("q_small_parts", """
SELECT event_id AS k, CASE WHEN user_id % 3 = 0 THEN CAST(event_id AS INT) END AS diary, CASE WHEN user_id % 3 = 0 THEN 2024 END AS diary_year, CASE WHEN user_id % 3 < 2 THEN '03-02-2024' ELSE '' END AS filed, user_id % 3 <> 1 AS header,
  (least(user_id % 4, 3) + 1) || '/4 pct=' || printf('%.1f%%', CAST(user_id % 4 AS DOUBLE) / 4.0 * 100.0) || ' done=' || (user_id % 4) || ' left=' || (3 - user_id % 4) AS progress, (event_id + user_id % 3) || ',' || (event_id + user_id % 3 + 3) || ',' || (event_id + user_id % 3 + 6) AS numbers
FROM events
""")  # fmt: skip
def small_parts(spark, d):
    """Diary numbers, dates of filing, header rows, progress through years, and the numbers of one worker of three."""
    k, u = F.col("event_id"), F.col("user_id")
    diary = cases.diary_parts(F.when(u % 3 == 0, F.concat(F.lit(" "), k.cast("string"), F.lit("/2024"))).when(u % 3 == 1, F.lit("x/2024")).otherwise(F.lit("1/2/3")))
    filed = dates.filed_on(F.when(u % 3 == 0, F.lit("1/2024 Filed  on 03-02-2024 10:30")).when(u % 3 == 1, F.lit("FILED ON 03-02-2024")).otherwise(F.lit("on 03-02-2024")))
    header = cases.is_header_row(F.when(u % 3 == 0, F.lit("total_systems")).when(u % 3 == 1, F.lit(" 4")).otherwise(F.lit("3 PCs")), F.lit("2"))
    return table(spark, d, "events").select(
        k.alias("k"), diary["number"].alias("diary"), diary["year"].alias("diary_year"), filed.alias("filed"), header.alias("header"), cases.year_progress(F.lit(2024) - (u % 4).cast("int"), F.lit(2021), F.lit(2024)).alias("progress"),
        F.array_join(F.transform(shard.strided(k, u % 3, F.lit(3), 3), lambda x: x.cast("string")), ",").alias("numbers"),
    )


@query("q_districts", "SELECT CASE n_nationkey % 4 WHEN 3 THEN 'D' || n_nationkey ELSE CAST(n_nationkey AS VARCHAR) END AS id, 'DCDRC - ' || CASE WHEN n_nationkey % 4 = 2 THEN CAST(n_nationkey AS VARCHAR) ELSE n_name END || ' (' || r_name || ')' AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 7")
def districts(spark, d):
    """States with lists of districts whose id and name go by one of several names; one has no id."""
    k, name = F.col("n_nationkey"), F.col("n_name")
    item = (
        F.when(k == 7, F.create_map(F.lit("name"), name)).when(k % 4 == 0, F.create_map(F.lit("commissionId"), k.cast("string"), F.lit("commissionNameEn"), name))
        .when(k % 4 == 1, F.create_map(F.lit("districtCommissionId"), F.lit(" "), F.lit("id"), k.cast("string"), F.lit("districtName"), name)).when(k % 4 == 2, F.create_map(F.lit("districtId"), k.cast("string"), F.lit("name"), F.lit("")))
        .otherwise(F.create_map(F.lit("districtId"), F.concat(F.lit("D"), k.cast("string")), F.lit("districtNameEn"), name))
    )
    states = table(spark, d, "nation").groupBy("n_regionkey").agg(F.collect_list(item).alias("districts")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joins.districts(states.select(F.col("r_name").alias("state"), "districts"))


@query("q_cluster", "SELECT * FROM (VALUES ('headers', CAST(3 AS INT)), ('one cell', 4), ('nothing', 1)) t(layout, systems)")
def cluster(spark, d):
    """The number of systems in both layouts of a configuration."""
    given = [("headers", ("DC Write Lock", "Total  Systems"), ("x|1", "three PCs")), ("one cell", ("4", ""), ("", "")), ("nothing", ("", ""), ("", ""))]
    return spark.createDataFrame([(n, joins.cluster_systems(spark, a, b)) for n, a, b in given], "layout string, systems int")


@query("q_nested_overflow", """
WITH shown AS (SELECT event_id AS k, '{"kind":"' || event_type || '","user":' || user_id || ',"none":null}' AS j, CAST(unnest(range(CAST(ceil(length('{"kind":"' || event_type || '","user":' || user_id || ',"none":null}') / 20.0) AS BIGINT))) AS INT) AS part_no FROM events)
SELECT k, part_no, substr(j, part_no * 20 + 1, 20) AS detail, CASE WHEN part_no = 0 THEN '["a",null]' ELSE '' END AS list FROM shown
""")  # fmt: skip
def nested_overflow(spark, d):
    """Nested cells are JSON with their nulls before they are split."""
    nested = F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user"), F.lit(None).cast("string").alias("none"))
    rows = table(spark, d, "events").select(F.col("event_id").alias("k"), nested.alias("detail"), F.array(F.lit("a"), F.lit(None).cast("string")).alias("list"))
    return layout.split_overflow(rows, ["detail", "list"], 20)


@query("q_run_counters", "SELECT count(*) AS started, count(*) FILTER (WHERE event_type = 'purchase') AS success, count(*) FILTER (WHERE event_type = 'error') AS failure, count(*) FILTER (WHERE event_type = 'view') AS duplicate FROM events")
def run_counters(spark, d):
    """What a run counted while it wrote its rows."""
    t = F.col("event_type")
    state = F.when(t == "purchase", F.lit("success")).when(t == "error", F.lit("failure")).when(t == "view", F.lit("duplicate")).otherwise(F.lit("other"))
    seen = Observation()
    reports.run_counters(table(spark, d, "events").select("event_id", state.alias("state")), seen).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[n] for n in ("started", "success", "failure", "duplicate"))], "started long, success long, failure long, duplicate long")


# ---------------------------------------------------------------- stores


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """What a query read from a store of its own, which is deleted."""
    out = cut_lineage(df)
    delete(spark, path)
    return out


KEYED_SQL = f"keyed AS (SELECT k, {KEY_SQL} AS key FROM cases WHERE caseNumber <> '')"


@query("q_append", f"WITH {KEYED_SQL}, firsts AS (SELECT key, coalesce(min(k) FILTER (WHERE k % 2 = 0), min(k)) AS k, CASE WHEN count(*) FILTER (WHERE k % 2 = 0) > 0 THEN 1 ELSE 2 END AS batch FROM keyed GROUP BY key) SELECT key, k, CAST(count(*) OVER (PARTITION BY batch) AS BIGINT) AS reported FROM firsts")
def append(spark, d):
    """Two batches into a store, of which the second holds all keys of the first again; each reports how many rows were new."""
    v = case_view(spark, d).where("caseNumber <> ''")
    keyed = v.withColumn("key", dedup.key_of(v)).select("key", "k")
    path = scratch(spark, "append")
    new = [dedup.write_cases(keyed.where("k % 2 = 0"), path, ["k"]), dedup.write_cases(keyed, path, ["k"])]
    stored = spark.read.parquet(path)
    first = keyed.where("k % 2 = 0").select("key").distinct().withColumn("_first", F.lit(True))
    marked = stored.join(first, "key", "left").select("key", "k", F.when(F.col("_first"), F.lit(new[0])).otherwise(F.lit(new[1])).cast("long").alias("reported"))
    return settled(spark, path, marked)


@query("q_key_cache", f"WITH {KEYED_SQL} SELECT key, CAST(row_number() OVER (ORDER BY key) - 1 AS BIGINT) AS place FROM (SELECT DISTINCT key FROM keyed)")
def key_cache(spark, d):
    """Keys written in order, one a line, and read back with their place in the files."""
    v = case_view(spark, d).where("caseNumber <> ''")
    path = scratch(spark, "keys")
    dedup.write_keys(v.select(dedup.key_of(v).alias("key")), path)
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"), F.trim("value").alias("key"))
    placed = layout.number_rows(lines, ["file", "line"], "place").join(dedup.read_keys(spark, path), "key")
    return settled(spark, path, placed.select("key", "place"))


@query("q_write_modes", "SELECT o_orderkey AS k, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 499) AS BIGINT) AS page_no, CAST(2 AS BIGINT) AS times FROM orders")
def write_modes(spark, d):
    """K2, K3: pages that are cleared by the second write and grow by the third."""
    paged = layout.paginate(layout.number_rows(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), ["k"]), page_rows=500)
    path = scratch(spark, "pages")
    for mode in ("overwrite", joins.output_mode(""), joins.output_mode("append mode")):
        layout.write_pages(paged, path, ["page_no"], mode)
    return settled(spark, path, spark.read.parquet(path).groupBy("k", "page_no").agg(F.count("*").alias("times")).select("k", F.col("page_no").cast("long").alias("page_no"), "times"))


# ---------------------------------------------------------------- streams


@query("q_stream_ingest", "SELECT user_id || '|' || event_type AS key, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def stream_ingest(spark, d):
    """A stream of files is taken in until it is empty, twice over: the store holds each key once."""
    schema_ = table(spark, d, "events").schema
    path = scratch(spark, "stream")
    key = F.concat_ws("|", F.col("user_id").cast("string"), "event_type")
    for n in range(2):
        stream = spark.readStream.schema(schema_).parquet(f"{d}/event[s].parquet")  # a pattern may also name a single file
        ingest.ingest(stream, lambda b: b.select(key.alias("key"), "event_id"), f"{path}/store", f"{path}/checkpoint{n}", ["event_id"]).awaitTermination()
    return settled(spark, path, spark.read.parquet(f"{path}/store").select("key", "event_id"))


# ---------------------------------------------------------------- streams (as tables)


@query("q_event_windows", "SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL")
def event_windows(spark, d):
    counted = ingest.arrivals(table(spark, d, "events"), "event_type", "ts")
    return counted.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "events")


@query("q_event_first", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def event_first(spark, d):
    """The first event of each user and kind, as a stream's keys would keep it."""
    keyed = table(spark, d, "events").withColumn("key", F.concat_ws("|", F.col("user_id").cast("string"), "event_type"))
    return dedup.first_of(keyed, "key", ["event_id"]).select("user_id", "event_type", "event_id")


PARTY = "Machinery 13 Traders"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A party's cases: search, exact names, the first of each key, and counts by court."""
    v = case_view(spark, sf_dir, costly=True).withColumn("partyName", F.lit(""))
    hits = cut_lineage(search.search_individual(v, PARTY))  # what a search found is read by each step after it
    found = search.filter_exact(hits, PARTY, "individual").where("not _is_continuation")
    keyed = found.withColumn("key", dedup.key_of(found))
    return reports.court_counts(dedup.first_of(keyed, "key", ["page_id", "row_no"]))


QUERIES["q_party_search"] = flagship
ORACLE_SQL["q_party_search"] = f"""
{VIEW}, given AS (SELECT k, petitioner AS x FROM cases), {norm_steps('given')},
hits AS (SELECT c.*, row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY page_id, row_no) AS rn FROM cases c JOIN normal m ON c.k = m.k WHERE m.x = 'MACHINERY 13 TRADERS')
SELECT courtType, count(*) AS cases FROM hits WHERE rn = 1 GROUP BY courtType
"""
