"""Typed parsing of exported text cells; a bad cell becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchgrid.functions.text import _col, strip


def money(c: Column | str) -> Column:
    """'3', '$488K', '$4.1M', '1,200' -> decimal; '' and '#...' -> NULL."""
    s = F.replace(strip(c), F.lit(","), F.lit(""))
    body = F.regexp_replace(F.regexp_replace(s, r"^\$", ""), r"[KM]$", "")
    times = F.when(s.endswith("K"), 1_000).when(s.endswith("M"), 1_000_000).otherwise(1)
    value = body.try_cast("decimal(24,6)") * times.cast("decimal(8,0)")
    return F.when((s != "") & ~s.startswith("#"), value.cast("decimal(38,6)"))


def month(c: Column | str) -> Column:
    """'Mar 2024' -> first day of that month."""
    return F.trunc(F.try_to_timestamp(strip(c), F.lit("MMM yyyy")).cast("date"), "month")


def day(c: Column | str) -> Column:
    """'5 Mar 2024' -> date."""
    return F.try_to_timestamp(strip(c), F.lit("d MMM yyyy")).cast("date")


def timestamp(c: Column | str) -> Column:
    """ISO-8601 with offset or Z -> timestamp."""
    return F.try_to_timestamp(F.nullif(_col(c), F.lit("")))
