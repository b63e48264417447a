"""Texts for tables and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month(d: Column) -> Column:
    return F.date_format(d, "MMM yyyy")


def shortened(c: Column, chars: int = 60) -> Column:
    return F.when(F.length(c) > chars, F.concat(F.substring(c, 1, chars), F.lit("..."))).otherwise(c)


def tally(yes: Column, no: Column, abstain: Column) -> Column:
    return F.concat_ws("-", yes.cast("string"), no.cast("string"), abstain.cast("string"))


def percent(share: Column) -> Column:
    return F.concat(F.round(share * 100).cast("int").cast("string"), F.lit("%"))


def words(c: Column) -> Column:
    return F.replace(c, F.lit("_"), F.lit(" "))


def summary(*cs: Column, chars: int = 80) -> Column:
    """The first field that says something, cut."""
    return F.substring(F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cs]), 1, chars)
