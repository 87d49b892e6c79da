"""Times as texts. Timestamps are shown in the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import col


def iso(ts) -> Column:
    """20240131T100001.000250; without a fraction if it is zero."""
    whole, part = F.date_format(col(ts), "yyyyMMdd'T'HHmmss"), F.date_format(col(ts), "SSSSSS")
    return F.when(part == "000000", whole).otherwise(F.concat(whole, F.lit("."), part))


def from_iso(text) -> Column:
    """The timestamp of such a text, with a comma or a point; null if it is none."""
    return F.try_to_timestamp(F.translate(col(text), ",", "."), F.lit("yyyyMMdd'T'HHmmss[.SSSSSS]"))


def stamp(ts) -> Column:
    """2024-Jan-31 10:00:01."""
    return F.date_format(col(ts), "yyyy-MMM-dd HH:mm:ss")


def seconds_between(start, finish) -> Column:
    micros = lambda t: F.unix_micros(col(t).cast("timestamp"))
    return (micros(finish) - micros(start)) / 1e6
