"""Which of two sources wins when a field comes from both."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandtide.functions.dates import UNKNOWN_DATE


def _equal(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(False))


def pick_name(base: Column, extra: Column, key: Column) -> Column:
    """The extra name unless it only repeats the key, then the base name; the base name likewise."""
    chosen = F.when(_equal(extra, key), base).otherwise(extra)
    chosen = F.when(_equal(base, key) | base.isNull(), extra).otherwise(chosen)
    return F.coalesce(chosen, base)


def pick_date(base: Column, extra: Column, origin: Column) -> Column:
    unknown = extra.isNull() | (extra == UNKNOWN_DATE)
    return F.when(_equal(origin, F.lit("date_correction")), extra).when(unknown, base).otherwise(extra)


def pick_longest(base: Column, extra: Column) -> Column:
    return F.when(base.isNull() | (F.length(base) < F.length(extra)), extra).otherwise(base)


def fill_from(first: Column, *others: Column) -> Column:
    return F.coalesce(first, *others)


def replace_unless(flag: Column, own: Column, override: Column) -> Column:
    """The override where the row is not flagged and the override has a value."""
    return F.when(F.coalesce(flag, F.lit(False)), own).otherwise(F.coalesce(override, own))


def has_value(col: Column) -> Column:
    return col.isNotNull()
