"""Column expressions: keys, money, averages, shares and sort orders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"


def asc(name: str) -> Column:
    """Ascending with nulls last, as the reports expect."""
    return F.asc_nulls_last(name)


def desc(name: str) -> Column:
    """Descending with nulls first, the mirror image of :func:`asc`."""
    return F.desc_nulls_first(name)


def date_key(date: Column) -> Column:
    """The date as the integer yyyymmdd.

    A computed key needs no lookup when facts are loaded, sorts like the date, and lets a range of
    dates reach the file statistics of the fact table.
    """
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def month_of_key(date_id: Column) -> Column:
    """yyyymm of a yyyymmdd key: the partition column of the fact table."""
    return F.floor(date_id / 100).cast("int")


def mean(value: str) -> Column:
    """Average as an exact decimal or integer sum divided once in double precision."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def total(value: str) -> Column:
    """Exact sum of a decimal(10,2) money column; the result is a decimal(20,2)."""
    return F.sum(value)


def share(part: Column, whole: Column) -> Column:
    """Percentage of ``whole`` rounded half-up to two decimals; 0 unless ``whole`` is positive."""
    exact = (part.cast("decimal(28,2)") / whole.cast("decimal(28,2)") * 100).cast("decimal(20,2)")
    return F.when(whole > 0, exact).otherwise(F.lit(0).cast("decimal(20,2)"))


def days_in_quarter(date: Column) -> Column:
    """Exact number of distinct dates in a group whose dates all fall in one calendar quarter.

    A quarter has at most 92 days, so the set of days fits two 64-bit masks: months one and two
    (62 bits) and month three (31 bits). Two ``bit_or`` buffers combine on the map side, whereas a
    second distinct count would multiply every input row.
    """
    slot = (F.month(date) - 1) % 3
    bit = slot % 2 * 31 + F.dayofmonth(date) - 1
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    none = F.lit(0).cast("bigint")
    early = F.bit_or(F.when(slot < 2, mask).otherwise(none))
    late = F.bit_or(F.when(slot == 2, mask).otherwise(none))
    return (F.bit_count(early) + F.bit_count(late)).cast("bigint")


def not_blank(value: Column) -> Column:
    """Null instead of the empty string, for ids that mean 'unknown' when empty."""
    return F.nullif(value, F.lit(""))
