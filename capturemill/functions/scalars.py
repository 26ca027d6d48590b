"""Scalar helpers whose meaning differs between engines if left to defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from a to b, with fractions."""
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 1e6


def second_boundaries(a: Column, b: Column) -> Column:
    """Whole seconds from a to b, each first cut to its second."""
    return F.unix_seconds(F.date_trunc("second", b).cast("timestamp")) - F.unix_seconds(F.date_trunc("second", a).cast("timestamp"))


def contains(array: Column, value: Column) -> Column:
    """Membership: false, not null, when a non-null array lacks the value but has nulls."""
    return F.when(array.isNotNull(), F.coalesce(F.array_contains(array, value), F.lit(False)))


def segment(path: Column, k: int) -> Column:
    """The k-th segment of a path (negative: from the end); null out of range."""
    return F.try_element_at(F.split(path, "/"), F.lit(k))


def capture_key(path: Column, root: str) -> Column:
    """A capture's index key: its path from ``root`` on, under ``history`` and its season if a season stands before the root, else under ``raw``."""
    above = F.regexp_extract(path, rf"([^/]+)/{root}/", 1)
    rest = F.regexp_extract(path, rf"[^/]+/({root}/.*)$", 1)
    return F.when(above.rlike(r"^\d{4}-\d{2}$"), F.concat(F.lit("history/"), above, F.lit("/"), rest)).otherwise(F.concat(F.lit("raw/"), rest))


def utc_now(pinned: str | None = None) -> Column:
    """The moment of the query in UTC, without a zone, or a pinned one."""
    return F.lit(pinned).cast("timestamp_ntz") if pinned else F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def parse_filename(path: Column, trim_extension: bool = False) -> Column:
    """A path's last part, without its last extension if asked."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "") if trim_extension else name


# The directives of a format and their letters here.
_DIRECTIVES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%f": "SSSSSS"}


def strptime(text: Column, form: str) -> Column:
    """A timestamp without a zone from text by a format of ``%Y %m %d %H %M %S %f``; null if the text isn't of that form."""
    out, rest = "", form
    while rest:
        if rest[:2] in _DIRECTIVES:
            out, rest = out + _DIRECTIVES[rest[:2]], rest[2:]
        elif rest[0] == "%":
            raise ValueError(f"unknown directive in {form!r}")
        else:
            out, rest = out + ("''" if rest[0] == "'" else f"'{rest[0]}'" if rest[0].isalpha() else rest[0]), rest[1:]
    return F.try_to_timestamp(text, F.lit(out)).cast("timestamp_ntz")


def make_date(year: Column, month: Column, day: Column) -> Column:
    """A date of its parts; null if a part is, and where there is no such day."""
    return F.to_date(F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)))
