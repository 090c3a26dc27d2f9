"""Partial dates (`XX` for unknown parts), numeric dates and age bins."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandtide.functions.binding import bind

UNKNOWN_DATE = "XXXX-XX-XX"

# The date formats in the order in which they are tried.
DATE_FORMATS = (
    "%Y-%m-%d",
    "%Y",
    "XX-%m-%Y",
    "%Y-%m-%dT%H:%M:%SZ",
    "XX-XX-%Y",
    "XX-XX-XXXX",
    "%m.%Y",
    "%m-%Y",
    "%d.%m.%Y",
    "%b-%Y",
    "%d-%b-%Y",
    "%Y-%m",
)

# One capture group per directive; anything else in a format is literal text.
_DIRECTIVES = {
    "%Y": r"(\d{4})",
    "%m": r"(\d{1,2})",
    "%d": r"(\d{1,2})",
    "%b": r"([A-Za-z]{3})",
    "%H": r"(\d{1,2})",
    "%M": r"(\d{1,2})",
    "%S": r"(\d{1,2})",
}
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def _pattern_and_parts(fmt: str) -> tuple[str, str]:
    """Regular expression of a format and the replacement that brings its parts into year|month|day."""
    tokens = re.findall(r"%[A-Za-z]|[^%]+", fmt)
    unknown = [t for t in tokens if t.startswith("%") and t not in _DIRECTIVES]
    if unknown:
        raise ValueError(f"date directives not supported: {unknown}")
    pattern = "^" + "".join(_DIRECTIVES.get(t) or re.sub(r"([.\\+*?()\[\]|])", r"\\\1", t) for t in tokens) + "$"
    groups = [t for t in tokens if t.startswith("%")]

    def part(names: tuple[str, ...], missing: str) -> str:
        return next((f"${groups.index(n) + 1}" for n in names if n in groups), missing)

    return pattern, "|".join([part(("%Y",), "XXXX"), part(("%m", "%b"), "XX"), part(("%d",), "XX")])


def _checked_iso(raw: Column) -> Column:
    """year|month|day to ISO text; null unless it is a real date once unknown parts are filled in."""
    parts = F.split(raw, r"\|")
    year, month, day = (F.get(parts, F.lit(i)) for i in range(3))
    numbers = F.create_map(*[F.lit(x) for i, m in enumerate(_MONTHS) for x in (m, f"{i + 1:02d}")])
    month = F.when(month.rlike("^[A-Za-z]{3}$"), F.try_element_at(numbers, F.lower(month))).otherwise(F.lpad(month, 2, "0"))
    iso = F.concat(year, F.lit("-"), month, F.lit("-"), F.lpad(day, 2, "0"))
    probe = F.replace(F.replace(iso, F.lit("XXXX"), F.lit("2000")), F.lit("XX"), F.lit("01"))
    return F.when(F.try_to_date(probe, "yyyy-MM-dd").isNotNull(), iso)


def format_date(col: Column, formats: Sequence[str] = DATE_FORMATS, mask_failure: bool = True) -> Column:
    """First matching format wins; failures become the unknown date or stay as they are."""
    styles = [_pattern_and_parts(f) for f in formats]

    def convert(text: Column) -> Column:
        raw = F.array(*[F.when(text.rlike(p), F.regexp_replace(text, p, r)) for p, r in styles])
        iso = F.transform(F.array_compact(raw), _checked_iso)
        return F.get(F.array_compact(iso), F.lit(0))

    fallback = F.lit(UNKNOWN_DATE) if mask_failure else col
    return F.when(col.isNull(), col).otherwise(F.coalesce(bind(F.trim(col), convert), fallback))


def _bounds(text: Column) -> Column:
    iso = r"^(\d{4})(?:-(\d{2}|XX))?(?:-(\d{2}|XX))?$"
    known_m = text.rlike(r"^\d{4}-\d{2}")
    known_d = text.rlike(r"^\d{4}-\d{2}-\d{2}")
    first = F.concat(F.regexp_replace(F.substr(F.concat(text, F.lit("-XX-XX")), F.lit(1), F.lit(10)), "XX", "01"))
    lo = F.when(text.rlike(iso), F.try_to_date(first, "yyyy-MM-dd"))

    def ends(day: Column) -> Column:
        year_end = F.make_date(F.year(day), F.lit(12), F.lit(31))
        hi = F.when(known_d, day).when(known_m, F.last_day(day)).otherwise(year_end)
        return F.struct(day.alias("lo"), hi.alias("hi"))

    return bind(lo, ends)


def date_bounds(col: Column) -> Column:
    """First and last day that a partial ISO date can mean; null for an unknown year."""
    return bind(col, _bounds)


def _partial(text: Column) -> Column:
    parts = F.split(text, "-")
    number = [F.get(parts, F.lit(i)).try_cast("int") for i in range(3)]

    def fields(bounds: Column) -> Column:
        return F.struct(
            text.alias("iso"),
            number[0].alias("year"),
            number[1].alias("month"),
            number[2].alias("day"),
            bounds["lo"].alias("lo"),
            bounds["hi"].alias("hi"),
        )

    return bind(_bounds(text), fields)


def partial_date(col: Column) -> Column:
    """Struct (iso, year, month, day, lo, hi) of a partial ISO date."""
    return bind(col, _partial)


def on_or_after(col: Column, bound: str | int) -> Column:
    """Keep a partial date if the latest day it can mean is on or after the bound."""
    text = str(bound)
    first = text if len(text) > 4 else f"{int(text):04d}-01-01"
    return F.coalesce(date_bounds(col)["hi"] >= F.lit(first).cast("date"), F.lit(False))


def year_of_text(col: Column) -> Column:
    """First four-digit run as text, else the trimmed text; null for blank."""
    text = F.nullif(F.trim(col), F.lit(""))
    return F.coalesce(F.nullif(F.regexp_extract(text, r"(\d{4})", 1), F.lit("")), text)


def numeric_date(date: Column) -> Column:
    return F.bround(F.year(date) + (F.month(date) - 1) / 12 + (F.dayofmonth(date) - 1) / 365.25, 2)


# Age bins, left-closed; those below one year are the month bins.
AGE_BINS = (
    (0.25, "0-3 m/o"),
    (0.5, "4-6 m/o"),
    (1.0, "7-12 m/o"),
    (6.0, "1-5 y/o"),
    (11.0, "6-10 y/o"),
    (18.0, "11-17 y/o"),
)
AGE_TOP = "18+ y/o"
AGE_MISSING = "nan"


def age_range(age: Column) -> Column:
    missing = age.isNull() | F.isnan(age)
    out = F.when(missing, F.lit(AGE_MISSING))
    for upper, label in AGE_BINS:
        out = out.when(age < upper, F.lit(label))
    return out.otherwise(F.lit(AGE_TOP))


def to_number(col: Column) -> Column:
    return F.trim(col).try_cast("double")


def range_label(col: Column, bins: Sequence[tuple[str, float, float]]) -> Column:
    """Label of the first closed interval that holds the value."""
    out = F.lit(None).cast("string")
    for label, lo, hi in reversed(list(bins)):
        out = F.when(col.between(lo, hi), F.lit(label)).otherwise(out)
    return out


def interval_coverage(target_lo: Column, target_hi: Column, span_lo: Column, span_hi: Column) -> Column:
    """Share of the target interval that the span covers; null for a target without width."""
    shared = F.least(target_hi, span_hi) - F.greatest(target_lo, span_lo)
    return F.try_divide(F.greatest(shared, F.lit(0.0)), target_hi - target_lo)
