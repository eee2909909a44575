"""Replies as rows: JSON envelopes, delimited lists and what kind of reply a text is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.core import strip, text
from lexmill.schema import SC_REQUIRED_TABS, SC_TABS

# Where an envelope may hold its list, in order, and the marks of a single case.
ENVELOPE_LISTS = ("data", "result", "cases", "list", "records", "response")
SINGLE_MARKS = ("caseNumber", "complainantNameEn")


def _is_list(c: Column) -> Column:
    return F.startswith(F.ltrim(c), F.lit("["))


def _is_object(c: Column) -> Column:
    return F.startswith(F.ltrim(c), F.lit("{"))


def valid_json(c: Column) -> Column:
    return F.try_parse_json(c).isNotNull()


def json_items(c: Column) -> Column:
    """The elements of a JSON list as JSON texts; null for anything else."""
    return F.when(_is_list(c), F.from_json(c, "array<string>"))


def envelope_items(reply: Column | str) -> Column:
    """A list as it is, an object's first known list, the object itself if it is a case; else no element."""
    c = text(reply)
    field = lambda n: F.get_json_object(c, f"$.{n}")
    inner = F.coalesce(*[json_items(field(n)) for n in ENVELOPE_LISTS])
    single = F.lit(False)
    for n in SINGLE_MARKS:
        single = single | F.array_contains(F.json_object_keys(F.when(_is_object(c), c)), n)
    none = F.array().cast("array<string>")
    return F.when(~valid_json(c), none).when(_is_list(c), json_items(c)).when(_is_object(c), F.coalesce(inner, F.when(F.coalesce(single, F.lit(False)), F.array(c)), none)).otherwise(none)


# What a tribunal's reply says when it has no record.
NO_RECORD = ("Record Not Fund", "No Record")


def tribunal_items(reply: Column | str) -> Column:
    """A list's elements, or an object as the one element; none for no reply, one that says it has no record, or one with a status or message alone."""
    c = text(reply)
    keys = F.json_object_keys(F.when(_is_object(c), c))
    said = F.concat_ws(" ", F.get_json_object(c, "$.status"), F.get_json_object(c, "$.message"))
    nothing = F.lit(False)
    for words in NO_RECORD:
        nothing = nothing | said.contains(words)
    alone = (F.size(keys) == 1) & F.element_at(keys, 1).isin("status", "message")
    none = F.array().cast("array<string>")
    return F.when(~valid_json(c), none).when(_is_list(c), json_items(c)).when(_is_object(c) & ~nothing & ~F.coalesce(alone, F.lit(False)), F.array(c)).otherwise(none)


def con_items(reply: Column | str) -> Column:
    """The cases of a reply's ``con``: a text, object or list of these, each of them JSON of an object or list; parts that are no JSON are passed over."""
    con = F.get_json_object(text(reply), "$.con")
    chunks = F.when(con.isNull(), F.array().cast("array<string>")).when(_is_list(con), F.coalesce(json_items(con), F.array().cast("array<string>"))).otherwise(F.array(con))
    each = F.transform(F.filter(chunks, valid_json), lambda x: F.when(_is_list(x), json_items(x)).when(_is_object(x), F.array(x)).otherwise(F.array().cast("array<string>")))
    return F.flatten(each)


def delimited(raw: Column | str) -> Column:
    """Code and name of "code~name#code~name"; a byte-order mark and the code 0 go."""
    parts = F.filter(F.split(strip(text(raw)), "#"), lambda p: p.contains("~"))
    pairs = F.transform(parts, lambda p: F.struct(F.replace(strip(F.replace(F.element_at(F.split(p, "~", 2), 1), F.lit("﻿"), F.lit(""))), F.lit("﻿"), F.lit("")).alias("code"), strip(F.element_at(F.split(p, "~", 2), 2)).alias("name")))
    return F.filter(pairs, lambda x: x["code"] != "0")


# Signs of an expired session in a reply.
EXPIRED = ("session expired", "your session has", "please login", "login required", "invalid session")


def is_expired(raw: Column | str, signs=EXPIRED) -> Column:
    t = F.lower(strip(text(raw)))
    out = (t.startswith("<!doctype") | t.startswith("<html")) & ~t.contains("case history") & ~t.contains("case details")
    for s in signs:
        out = out | t.contains(s)
    return out


def reply_kind(raw: Column | str) -> Column:
    """session_expired, captcha_error, no_results or ok, by the first rule that fits."""
    c = F.regexp_replace(strip(text(raw)), "^﻿+", "")
    error = strip(F.coalesce(F.get_json_object(c, "$.Error"), F.lit("")))
    con = F.get_json_object(c, "$.con")
    first = F.coalesce(F.get_json_object(c, "$.con[0]"), F.lit(""))
    invalid = (~_is_list(con) & ~_is_object(con) & F.lower(con).contains("invalid captcha")) | (_is_list(con) & (F.lower(strip(first)) == "invalid captcha"))
    total = F.coalesce(F.get_json_object(c, "$.totRecords").try_cast("int"), F.lit(0))
    return (
        F.when(is_expired(raw), F.lit("session_expired"))
        .when(c.contains("THERE IS AN ERROR"), F.lit("captcha_error"))
        .when(c.contains("Record Not Found"), F.lit("no_results"))
        .when(~valid_json(c), F.lit("captcha_error"))
        .when(~error.isin("", "null", "None"), F.lit("captcha_error"))
        .when(F.coalesce(invalid, F.lit(False)), F.lit("captcha_error"))
        .when(total > 0, F.lit("ok"))
        .otherwise(F.lit("no_results"))
    )


def explode_items(replies: DataFrame, items: Column, name: str = "item") -> DataFrame:
    """One row for each element, with the reply's other columns."""
    return replies.withColumn(name, F.explode(items))


def chosen_tabs(setting: str | None) -> list[str]:
    """H9: required, minimal or nothing: the four tabs that rows need; all: every tab; else the known ones of a list, or the four."""
    raw = (setting or "").strip().lower()
    if raw == "all":
        return list(SC_TABS)
    return [t for x in raw.split(",") if (t := x.strip()) in SC_TABS] or list(SC_REQUIRED_TABS)


def keep_tabs(tabs: Column, setting: str | None) -> Column:
    """H9: a map with the chosen tabs alone."""
    names = chosen_tabs(setting)
    return F.map_filter(tabs, lambda k, v: k.isin(*names))
