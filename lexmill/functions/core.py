"""Building blocks: white space, blanks, ordered choices. Null and blank text mean the same throughout and come out as the empty string."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space and the four separators that also count as such.
_WS = r"[\s\x1c-\x1f]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    """Without Unicode white space at both ends; F.trim would only take spaces."""
    return F.regexp_replace(col(c), rf"(?U)^{_WS}+|{_WS}+$", "")


def collapse(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(col(c), rf"(?U){_WS}+", " "))


def squeeze(c: Column | str) -> Column:
    """Without any white space."""
    return F.regexp_replace(col(c), rf"(?U){_WS}+", "")


def rstrip_chars(c: Column, chars: str) -> Column:
    return F.rtrim(c, F.lit(chars))


def is_blank(c: Column | str) -> Column:
    return strip(text(c)) == ""


def has_letter(c: Column) -> Column:
    return c.rlike(r"\p{L}")


def replace_all(c: Column, steps: Iterable[tuple[str, str]]) -> Column:
    for pattern, by in steps:
        c = F.regexp_replace(c, pattern, by)
    return c


def group(c: Column | str, pattern: str, number: int = 1) -> Column:
    """A group of the first match, or the empty string."""
    return F.coalesce(F.regexp_extract(col(c), pattern, number), F.lit(""))


def first_filled(*cols: Column) -> Column:
    """The first that is not the empty string, or the empty string."""
    return F.coalesce(*[let(c, lambda v: F.when(v != "", v)) for c in cols], F.lit(""))


def ordered_choice(c: Column, pairs: Iterable[tuple[str, str]], otherwise: Column) -> Column:
    """What belongs to the first fragment, in the order given, that the text contains."""
    out = None
    for fragment, value in pairs:
        out = F.when(c.contains(fragment), F.lit(value)) if out is None else out.when(c.contains(fragment), F.lit(value))
    return otherwise if out is None else out.otherwise(otherwise)


def present(c: Column | str, empty: Iterable[str] = ("0", "NA", "null", "None")) -> Column:
    """The stripped text, or the empty string where it is one of the words for nothing (case matters)."""
    return let(strip(text(c)), lambda s: F.when(s.isin(*empty), F.lit("")).otherwise(s))


def pick(*cols: Column | str, empty: Iterable[str] = ("0", "NA", "null", "None")) -> Column:
    """The first column with a present value."""
    return first_filled(*[present(c, tuple(empty)) for c in cols])


def overlay(detail: Column | str, fallback: Column | str) -> Column:
    """The detail's value as it is, unless it is null or blank; then the fallback's."""
    return F.when(~is_blank(detail), col(detail)).otherwise(col(fallback))
