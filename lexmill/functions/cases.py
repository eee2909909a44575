"""Statuses, keys, case numbers, labels and other single values of a case row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.core import collapse, first_filled, group, is_blank, let, ordered_choice, squeeze, strip, text
from lexmill.schema import BENCH_FRAGMENTS, SC_TYPE_SLUGS

# Statuses that mean a case is closed, and parts of longer ones that do.
DISPOSED_STATUSES = (
    "disposed", "disposed off", "disposed off/compliance", "dismissed", "dismissed in default", "allowed", "consigned to recordroom", "decree", "decreed", "withdrawn", "settled",
    "transferred", "converted", "rejected", "abated", "not pressed", "compromised",
)
DISPOSED_PARTS = ("dispos", "dismiss", "allowed")


def case_status(raw: Column | str) -> Column:
    """Disposed or Pending; empty for a blank text."""

    def body(s: Column) -> Column:
        closed = s.isin(*DISPOSED_STATUSES)
        for part in DISPOSED_PARTS:
            closed = closed | s.contains(part)
        return F.when(s == "", F.lit("")).when(closed, F.lit("Disposed")).otherwise(F.lit("Pending"))

    return let(F.lower(strip(text(raw))), body)


def court_status(raw: Column | str) -> Column:
    """Disposed if it says so in any case, else Pending, also for nothing."""
    return F.when(F.lower(text(raw)).contains("dispos"), F.lit("Disposed")).otherwise(F.lit("Pending"))


def tribunal_status(raw: Column | str) -> Column:
    """Disposed for two exact words only."""
    return F.when(F.lower(strip(text(raw))).isin("disposal", "disposed"), F.lit("Disposed")).otherwise(F.lit("Pending"))


def consumer_status(raw: Column) -> Column:
    """The text as it is, PENDING for a blank one."""
    return F.when(raw == "", F.lit("PENDING")).otherwise(raw)


def status_or_decision(raw: Column, decision: Column) -> Column:
    """F8: the court's status; where it has none, Disposed if there is a decision date."""
    return F.when(raw != "", court_status(raw)).when(decision != "", F.lit("Disposed")).otherwise(F.lit("Pending"))


def interlocutory_status(raw: Column | str) -> Column:
    """Disposed if the text says so, else Pending."""
    return court_status(raw)


def key_part(c: Column | str) -> Column:
    """F12."""
    return F.upper(collapse(text(c)))


def dedup_key(uniqueness: Column | str, court: Column | str, bench: Column | str, number: Column | str, registered: Column | str) -> Column:
    """the upper-case unique id if it has a bar, else a key of four parts."""
    legacy = F.concat_ws("|", F.lit("LEGACY"), key_part(court), key_part(bench), key_part(number), key_part(registered))
    return let(strip(text(uniqueness)), lambda u: F.when(u.contains("|"), F.upper(u)).otherwise(legacy))


def lock_owner(value: Column | str) -> Column:
    """what stands before the last bar if a number follows it, else the whole text."""
    t = strip(text(value))
    return F.when(lock_time(value).isNotNull(), strip(group(t, r"(?s)^(.*)\|[^|]*$"))).otherwise(t)


def lock_time(value: Column | str) -> Column:
    """the number after the last bar, or null."""
    return strip(group(strip(text(value)), r"(?s)\|([^|]*)$")).try_cast("double")


def is_stale(value: Column | str, now: Column, after_seconds: float = 1800.0) -> Column:
    """A lock whose time is longer ago; one without a time is not stale."""
    return F.coalesce(now - lock_time(value) > after_seconds, F.lit(False))


# Number words.
NUMBER_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")


def total_systems(raw: Column | str) -> Column:
    """The first whole number of a text, else the number of the least number word that it has, else 1; at least 1."""
    t = F.lower(strip(text(raw)))
    words = [F.when(t.rlike(rf"\b{w}\b"), F.lit(i + 1)) for i, w in enumerate(NUMBER_WORDS)]
    return F.greatest(F.coalesce(group(t, r"(\d+)").try_cast("int"), *words, F.lit(1)), F.lit(1))


def header_name(raw: Column | str) -> Column:
    """a header in lower case with low lines for white space and dashes."""
    return F.replace(F.regexp_replace(F.lower(strip(text(raw))), r"(?U)\s+", "_"), F.lit("-"), F.lit("_"))


def is_header_row(first: Column | str, second: Column | str) -> Column:
    """whether a row's first cell is a label: it has a letter, and is no small number beside a blank or a number."""
    a, b = F.lower(strip(text(first))), strip(text(second))
    legacy = a.rlike(r"^\d{1,2}$") & (a.try_cast("int") >= 1) & ((b == "") | b.rlike(r"^\d+$"))
    return a.rlike(r"\p{L}") & ~legacy


_DASH = r"[-–—]"


def dc_court_number(raw: Column | str) -> Column:
    """F16: the number before a dash at the start, the whole text if it is a number, or one to three digits before a dash and a letter."""
    s = collapse(F.regexp_replace(text(raw), r"<[^>]+>", ""))
    return let(s, lambda t: first_filled(group(t, rf"^\s*(\d+)\s*{_DASH}"), group(t, r"^\s*(\d+)\s*$"), group(t, rf"\b(\d{{1,3}})\s*{_DASH}\s*[A-Za-z]")))


def dc_type_abbreviation(raw: Column | str) -> Column:
    """what stands before the first dash, without space, in upper case, 16 characters at most."""
    return F.substring(F.upper(squeeze(F.split_part(strip(text(raw)), F.lit("-"), F.lit(1)))), 1, 16)


def list_case_ref(raw: Column | str) -> Column:
    """TYPE/NUMBER/YEAR in upper case, or empty."""
    return F.upper(group(squeeze(text(raw)), r"([A-Za-z]{1,12}/\d{1,8}/\d{4})"))


def is_cnr_token(raw: Column | str) -> Column:
    """ten or more letters and digits, and nothing else."""
    return squeeze(text(raw)).rlike(r"^[\p{L}\p{N}]{10,}$")


def dc_case_number(list_ref: Column, label: Column, registration: Column, abbreviation: Column) -> Column:
    """the number of a district court's case, from the list's reference, else the registration number with the type."""
    ref = first_filled(list_case_ref(list_ref), list_case_ref(F.replace(F.replace(text(label), F.lit("<br>"), F.lit(" ")), F.lit("</br>"), F.lit(" "))))
    rn = squeeze(registration)
    typed = F.concat(abbreviation, F.lit("/"), rn)
    plain = rn.rlike(r"^\d{1,12}/\d{4}$")
    with_type = F.when(plain, typed).when(rn.rlike(r"^[A-Za-z]{1,12}/\d{1,8}/\d{4}"), first_filled(list_case_ref(rn), F.upper(rn))).when(F.startswith(F.upper(rn), F.concat(abbreviation, F.lit("/"))), rn).otherwise(typed)
    chosen = F.when(ref != "", ref).when((rn != "") & (abbreviation != ""), with_type).otherwise(rn)
    return finish_dc_case_number(chosen, abbreviation, registration)


def finish_dc_case_number(number: Column, abbreviation: Column, registration: Column) -> Column:
    """the last part with a digit before the last slash; the first part if there is none; the text if it has no slash."""
    s = strip(number)
    s = F.when(is_cnr_token(s), F.lit("")).otherwise(s)
    rn = squeeze(text(registration))
    typed = F.concat(abbreviation, F.lit("/"), rn)
    both = (abbreviation != "") & (rn != "")

    def full(t: Column) -> Column:
        fits = rn.rlike(r"^\d{1,12}/\d{4}$") | (rn.contains("/") & ~rn.rlike(r"^[A-Za-z]"))
        return F.when(list_case_ref(t) != "", list_case_ref(t)).when(both & fits, typed).when(t != "", t).when(both, typed).otherwise(F.lit(""))

    def numeric(t: Column) -> Column:
        parts = F.split(t, "/")
        before = F.filter(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.rlike(r"\p{Nd}"))
        return F.when(t.contains("/"), F.coalesce(F.try_element_at(before, F.lit(-1)), F.element_at(parts, 1))).otherwise(t)

    return let(let(s, full), numeric)


def hc_case_number(raw: Column | str) -> Column:
    """N of X/N/YYYY or N/YYYY, else the text without space."""
    return let(squeeze(text(raw)), lambda c: first_filled(group(c, r"^[^/]+/(\d{1,10})/\d{4}$"), group(c, r"^(\d{1,10})/\d{4}$"), c))


def sc_case_display(raw: Column | str) -> Column:
    """TYPE/NUMBER/YEAR of a supreme court reference, or empty."""
    pattern = r"\b([A-Za-z()]{2,40})/\s*(\d{1,8})\s*/\s*(\d{4})\b"
    t = strip(text(raw))
    return F.when(group(t, pattern) != "", F.concat_ws("/", F.upper(group(t, pattern, 1)), group(t, pattern, 2), group(t, pattern, 3))).otherwise(F.lit(""))


def sc_slug(code: Column | str, name: Column | str) -> Column:
    """the prefix of a type's code; else up to ten letters of its name; else T and the code, or SC without a code and name."""
    c = strip(text(code))
    slugs = F.create_map(*[F.lit(x) for kv in SC_TYPE_SLUGS.items() for x in kv])
    letters = F.substring(F.regexp_replace(F.upper(text(name)), "[^A-Z]", ""), 1, 10)
    other = F.when(letters != "", letters).when((c != "") | (text(name) != ""), F.concat(F.lit("T"), c)).otherwise(F.lit("SC"))
    return F.coalesce(F.try_element_at(slugs, c), other)


def sc_case_number(slug: Column, number: Column | str, year: Column | str, raw: Column | str) -> Column:
    """the number searched for where slug, number and year are known; else the reference shown, or the raw text."""
    known = (slug != "") & ~is_blank(number) & ~is_blank(year)
    return F.when(known, strip(text(number))).otherwise(first_filled(sc_case_display(raw), strip(text(raw))))


def dc_unique(cino: Column | str, number: Column | str) -> Column:
    """F24."""
    return F.when(is_blank(cino), F.concat(F.lit("DC|NO_CINO|"), strip(text(number)))).otherwise(F.concat(F.lit("DC|"), strip(text(cino))))


def hc_unique(cino: Column, number: Column, bench: Column, registered: Column) -> Column:
    """F24."""
    return F.when(cino != "", F.concat(F.lit("HC|"), cino)).otherwise(F.concat_ws("|", F.lit("HC"), number, bench, registered))


def sc_unique(year: Column | str, diary: Column | str, searched: Column | str, raw: Column | str, number: Column) -> Column:
    """F24."""
    known = ~is_blank(year) & ~is_blank(diary)
    return F.when(known, F.concat_ws("|", F.lit("SC"), strip(text(year)), strip(text(diary)))).otherwise(F.concat_ws("|", F.lit("SC"), text(searched), text(raw), number))


def dc_bench(state: Column | str, district: Column | str, complex_name: Column | str, establishment: Column | str) -> Column:
    """"state (dis: d, comp:c est:e)", with null for no establishment; INDIA for no state at all."""
    est = F.when(text(establishment) == "", F.lit("null")).otherwise(text(establishment))
    return F.concat(F.coalesce(F.col(state) if isinstance(state, str) else state, F.lit("INDIA")), F.lit(" (dis: "), text(district), F.lit(", comp:"), text(complex_name), F.lit(" est:"), est, F.lit(")"))


def hc_bench(court: Column | str, bench: Column | str) -> Column:
    """"court (bench: b)", or the bench alone."""
    return F.when(text(court) != "", F.concat(text(court), F.lit(" (bench: "), text(bench), F.lit(")"))).otherwise(text(bench))


def nclt_bench(raw: Column | str) -> Column:
    """the bench of the first known fragment, else the stripped text."""
    return let(strip(text(raw)), lambda t: F.when(t == "", F.lit("")).otherwise(ordered_choice(F.lower(t), BENCH_FRAGMENTS, t)))


def hc_order_url(href: Column | str, base: str) -> Column:
    """an absolute address without the query folder before its cases; else the base with the path without that folder."""
    h = strip(text(href))
    rest = F.replace(F.replace(F.ltrim(h, F.lit("/")), F.lit("cases_qry/cases/"), F.lit("cases/")), F.lit("cases_qry/"), F.lit(""))
    return F.when(h == "", F.lit("")).when(h.rlike("^https?://"), F.replace(h, F.lit("/cases_qry/cases/"), F.lit("/cases/"))).otherwise(F.concat(F.lit(base), rest))


def hc_order_url_on_demand(href: Column | str, base: str) -> Column:
    """F27, the older form: without the query folder, and the base before what is not an address."""
    h = F.replace(text(href), F.lit("cases_qry/"), F.lit(""))
    return F.when(h == "", F.lit("")).when(h.startswith("http"), h).otherwise(F.concat(F.lit(base), F.ltrim(h, F.lit("/"))))


def diary_parts(raw: Column | str) -> Column:
    """F32: a struct of number and year of "n/yyyy", or null."""
    p = F.split(strip(text(raw)), "/")
    number, year = (F.try_element_at(p, F.lit(i)).try_cast("int") for i in (1, 2))
    return F.when((F.size(p) == 2) & number.isNotNull() & year.isNotNull(), F.struct(number.alias("number"), year.alias("year")))


def percent(done: Column, total: Column) -> Column:
    """One decimal, between 0 and 100; 0.0% without a total."""
    share = F.greatest(F.lit(0.0), F.least(F.lit(100.0), done.cast("double") / F.when(total > 0, total.cast("double")) * 100.0))
    return F.format_string("%.1f%%", F.coalesce(share, F.lit(0.0)))


def duration(seconds: Column, hours: bool = True) -> Column:
    """Ns, Mm Ss and Hh Mm Ss; without hours for a run's report."""
    s = F.greatest(seconds.cast("long"), F.lit(0))
    minutes = F.floor(s / 60)
    out = F.when(s < 60, F.format_string("%ds", s))
    if hours:
        out = out.when(minutes >= 60, F.format_string("%dh %dm %ds", F.floor(minutes / 60), minutes % 60, s % 60))
    return out.otherwise(F.format_string("%dm %ds", minutes, s % 60))


def log_value(raw: Column | str) -> Column:
    """a value of a log line, quoted if it has space, an equals sign or a quote; a dash for nothing."""
    t = collapse(text(raw))
    return let(t, lambda v: F.when(v == "", F.lit("-")).when(v.rlike(r'[\s="]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit("'")), F.lit('"'))).otherwise(v))


def stage_progress(index: Column, total: Column) -> Column:
    """current/total with percent, done and left, of an index from 0."""
    n = F.greatest(total, F.lit(0))
    done = F.least(F.greatest(index, F.lit(0)), n)
    shown = F.format_string("%d/%d pct=%s done=%d left=%d", F.least(done + 1, n), n, percent(done, n), done, F.greatest(n - done - 1, F.lit(0)))
    return F.when(n == 0, F.lit("0/0 pct=0.0% done=0 left=0")).otherwise(shown)


def year_progress(current: Column, start: Column, end: Column) -> Column:
    """the same for years that count down from the end."""
    return stage_progress(end - current, end - start + 1)


def success_rate(good: Column, all_of_them: Column, least: int = 5) -> Column:
    """The share of successes; one half below ``least`` tries."""
    return F.when(all_of_them < least, F.lit(0.5)).otherwise(good / F.when(all_of_them > 0, all_of_them))


# Kinds of errors and the parts of their names and messages, in order.
ERROR_KINDS = (("timeout", ("timeout",), ("timeout",)), ("proxy_error", ("proxy",), ("proxy",)), ("connection_error", ("connect",), ("connection", "connect")), ("http_error", ("response",), ("status",)))


def error_kind(name: Column | str, message: Column | str) -> Column:
    """the first kind whose part the name or the message has; else the lower-case name, or unknown_error."""
    n, m = F.lower(text(name)), F.lower(text(message))
    out = None
    for kind, in_name, in_message in ERROR_KINDS:
        test = F.lit(False)
        for part in in_name:
            test = test | n.contains(part)
        for part in in_message:
            test = test | m.contains(part)
        out = F.when(test, F.lit(kind)) if out is None else out.when(test, F.lit(kind))
    return out.when(n != "", n).otherwise(F.lit("unknown_error"))


# Marks of a page with a case's details.
DETAIL_MARKS = ("case history", "case details", "petitioner", "respondent")
# Reasons for which a write is not tried again.
FINAL_REASONS = ("storageQuotaExceeded", "insufficientFilePermissions", "notFound", "forbidden")


def is_detail_page(raw: Column | str) -> Column:
    """F36."""
    t = F.lower(text(raw))
    out = F.lit(False)
    for mark in DETAIL_MARKS:
        out = out | t.contains(mark)
    return out


def error_reason(message: Column | str) -> Column:
    """the reason named in an error's text, or empty."""
    return group(text(message), r"'reason':\s*'([^']+)'")


def is_retryable(message: Column | str) -> Column:
    """all but four reasons."""
    return ~error_reason(message).isin(*FINAL_REASONS)


def is_rate_limit(message: Column | str) -> Column:
    """F37."""
    return text(message).contains("RATE_LIMIT_EXCEEDED") | text(message).contains("'code': 429")


def empty_jump(empty_in_a_row: Column) -> Column:
    """How far to jump after so many empty numbers in a row."""
    out = None
    for most, jump in ((10, 1), (20, 5), (30, 10), (40, 50), (50, 100), (60, 500)):
        out = F.when(empty_in_a_row <= most, F.lit(jump)) if out is None else out.when(empty_in_a_row <= most, F.lit(jump))
    return out.otherwise(F.lit(1000))


def page_id(formula: Column | str, raw: Column | str) -> Column:
    """The id in a link's path, else the stripped text, or null for a blank one."""
    found = group(text(formula), r"/d/([a-zA-Z0-9-_]+)")
    return F.coalesce(F.when(found != "", found), F.when(~is_blank(raw), strip(text(raw))))


