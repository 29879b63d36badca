"""Epoch arithmetic, rounding and exact measure units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import as_col

MICROS = 1_000_000
UNIT = 1_000_000  # measures are compared at a resolution of 1e-6


def micros(ts: str | Column) -> Column:
    return F.unix_micros(as_col(ts).cast("timestamp"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(MICROS)


def slot(ts: str | Column, seconds: float) -> Column:
    """Number of the fixed-width time slot, counted from the epoch; floors before 1970 too."""
    width = F.lit(int(seconds * MICROS)).cast("bigint")
    m = micros(ts)
    return ((m - F.pmod(m, width)) / width).cast("bigint")


def slot_start(ts: str | Column, seconds: float) -> Column:
    """Start of the slot that holds ``ts``."""
    width = F.lit(int(seconds * MICROS)).cast("bigint")
    m = micros(ts)
    return F.timestamp_micros(m - F.pmod(m, width)).cast("timestamp_ntz")


def minutes_interval(minutes: float) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(minutes * 60).cast("decimal(18,6)"))


def round_half_up(c: Column, places: int) -> Column:
    """Round a double as a decimal, half away from zero."""
    return F.round(c.cast("decimal(38,10)"), places).cast("double")


def units(c: str | Column) -> Column:
    """A measure as whole units of 1e-6, so that sums do not depend on their order."""
    return F.round(as_col(c) * F.lit(float(UNIT))).cast("bigint")
