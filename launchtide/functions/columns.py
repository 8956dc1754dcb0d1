"""Column expressions shared by the operators; all of them run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def earliest(times: Column) -> Column:
    """Least element of an array, nulls passed over; null for an array of nulls."""
    return F.array_min(times)


def earliest_unless_null(times: Column) -> Column:
    """Least element of an array where a null counts as least of all.

    Among structs, unlike among plain values, one holding a null sorts first.
    """
    return F.array_min(F.arrays_zip(times.alias("time")))["time"]


def yyyymm(time: Column) -> Column:
    """The month of a date or timestamp as an integer such as 202009."""
    return (F.year(time) * 100 + F.month(time)).cast("int")


def month_pattern(directory: str = "{country}/{month}", country: str = "*") -> str:
    """A pattern for the paths of files in ``directory`` below any base; its group is the month."""
    if directory.count("{month}") != 1:
        raise ValueError(f"the directory {directory!r} has to hold {{month}} once")
    named = "[^/]*" if re.search(r"[*?\[{]", country) else re.escape(country)
    parts = re.split(r"(\{month\}|\{country\})", directory.strip("/"))
    known = {"{month}": r"(\d{6})", "{country}": named}
    return "^.*/" + "".join(known.get(part, re.escape(part)) for part in parts) + "/"


def month_of_path(path: Column, directory: str = "{country}/{month}", country: str = "*") -> Column:
    """The month in a file's path, found where ``directory`` has ``{month}``.

    ``directory`` is the place of the profiles below their base, such as ``{country}/{month}``,
    ``{month}/{country}`` or ``{country}/month={month}``; folders below it don't matter. A
    path without a month there is an error that names it.
    """
    found = F.regexp_extract(path, month_pattern(directory, country), 1)
    missing = F.raise_error(F.concat(F.lit(f"no month where {directory} has it: "), path))
    return F.when(found != "", found).otherwise(missing.cast("string")).cast("int")


def within(value: Column, lo: Column | int | None, hi: Column | int | None) -> Column:
    """``lo <= value <= hi`` with a Python ``None`` for an open end."""
    inside = value.isNotNull()
    if lo is not None:
        inside = inside & (value >= lo)
    if hi is not None:
        inside = inside & (value <= hi)
    return inside
