"""Text cleaning and recoding of metadata fields."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandtide.functions.binding import bind

# Old or misspelt country names and what they become.
COUNTRY_CORRECTIONS = {
    "czech republic": "czechia",
    "hongkong": "hong_kong",
    "viet nam": "vietnam",
    "uk": "united kingdom",
    "ivory coast": "côte d'ivoire",
}
# Fixed value: characters that may not occur in a feature name.
FORBIDDEN_NAME_CHARS = " ,.;:()[]"
# Fixed value: address prefix of a public nucleotide record.
RECORD_URL = "https://www.ncbi.nlm.nih.gov/nuccore/"

ACCESSION = r"[A-Z]{1,2}\d{5,6}"


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


@F.pandas_udf(T.StringType())
def _nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFC", v), na_action="ignore")


def squeeze_space(col: Column) -> Column:
    """Trim and turn every run of white space, Unicode included, into one blank."""
    return F.trim(F.regexp_replace(col, r"[\s\p{Z}]+", " "))


def normalize_text(col: Column) -> Column:
    """Canonical composition plus white-space clean-up; ASCII values skip the Python worker's work."""
    clean = squeeze_space(col)
    beyond_ascii = F.when(clean.rlike(r"[^\x00-\x7F]"), clean)
    return F.coalesce(_nfc(beyond_ascii), clean)


def normalize_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: normalize_text(F.col(c)) for c in names})


def transform_strain(strain: Column, backups: Sequence[Column], pattern: str = "^.+$") -> Column:
    fits = [F.when(c.rlike(pattern), c) for c in (strain, *backups)]
    return F.coalesce(*fits, strain)


def parse_location(col: Column) -> Column:
    """`Country: Division, Location` to a struct of three trimmed parts."""

    def parts(top: Column) -> Column:
        rest = F.split(F.get(top, F.lit(1)), ",", 2)
        return F.struct(
            blank_to_null(F.get(top, F.lit(0))).alias("country"),
            blank_to_null(F.get(rest, F.lit(0))).alias("division"),
            blank_to_null(F.get(rest, F.lit(1))).alias("location"),
        )

    return bind(F.split(col, ":", 2), parts)


def _capitalized(word: Column) -> Column:
    return F.concat(F.upper(F.substr(word, F.lit(1), F.lit(1))), F.lower(F.substr(word, F.lit(2))))


def title_words(col: Column, articles: Sequence[str] = (), abbreviations: Sequence[str] = ()) -> Column:
    """Title case per blank-separated word; articles stay lower, abbreviations upper."""

    def word(w: Column) -> Column:
        out = _capitalized(w)
        if articles:
            out = F.when(F.lower(w).isin([a.lower() for a in articles]), F.lower(w)).otherwise(out)
        if abbreviations:
            out = F.when(F.upper(w).isin([a.upper() for a in abbreviations]), F.upper(w)).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(col, " "), word), " ")


def title_letters(col: Column) -> Column:
    """A capital after every character that is not a letter (`south-eastern` -> `South-Eastern`)."""
    runs = F.regexp_extract_all(col, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, _capitalized), "")


def abbreviate_authors(col: Column, default: str = "?") -> Column:
    first = F.trim(F.get(F.split(col, ","), F.lit(0)))
    return (
        F.when(blank_to_null(col).isNull(), F.lit(default))
        .when(F.contains(col, F.lit(",")), F.concat(first, F.lit(" et al")))
        .otherwise(F.trim(col))
    )


def correct_country(col: Column) -> Column:
    known = literal_map(COUNTRY_CORRECTIONS)

    def clean(spaced: Column) -> Column:
        shouted = (F.upper(spaced) == spaced) & (F.lower(spaced) != spaced)
        return F.when(F.lower(spaced) == "usa", F.upper(spaced)).when(shouted, title_letters(spaced)).otherwise(spaced)

    def correct(text: Column) -> Column:
        hit = F.try_element_at(known, F.lower(text))
        spaced = F.trim(F.regexp_replace(F.replace(text, F.lit("_"), F.lit(" ")), r"\s+", " "))
        fixed = F.replace(title_letters(hit), F.lit("_"), F.lit(" "))
        return F.coalesce(fixed, bind(spaced, clean))

    return bind(blank_to_null(col), correct)


def split_multi(col: Column) -> Column:
    """Parts of a list written with `,`, `;`, `/` or ` or `; trimmed, without empty parts."""
    flat = F.replace(F.regexp_replace(col, r",|/| or ", ";"), F.lit("  "), F.lit(" "))
    parts = F.transform(F.split(flat, ";"), lambda p: strip(p))
    return F.filter(parts, lambda p: p != "")


def distinct_sorted_join(values: Column, sep: str = "; ") -> Column:
    return F.array_join(F.array_sort(F.array_distinct(values)), sep)


def major_group(col: Column, groups: Mapping[str, str]) -> Column:
    """Map each `; `-part to its major group; a value that already is one stays; no hit gives null."""
    hits = F.filter(
        F.transform(F.split(col, "; "), lambda p: F.try_element_at(literal_map(groups), p)),
        lambda v: v.isNotNull(),
    )
    mapped = F.nullif(distinct_sorted_join(hits), F.lit(""))
    return F.when(col.isin(sorted(set(groups.values()))), col).when(col != "", mapped)


def parse_gender(col: Column) -> Column:
    low = F.lower(col)
    return F.when(low.contains("female"), F.lit("F")).when(low.contains("male"), F.lit("M")).otherwise(col)


def pick_strain(strain: Column, isolate: Column) -> Column:
    """The isolate where the strain is missing, empty or shorter."""
    s, i = F.nullif(strain, F.lit("")), F.nullif(isolate, F.lit(""))
    return F.when(s.isNull() | (F.length(s) < F.length(i)), i).otherwise(s)


def extract_digits(col: Column, n: int = 4, position: str = "first") -> Column:
    if position not in ("first", "last"):
        raise ValueError("position must be 'first' or 'last'")
    digits = F.regexp_replace(col, r"\D", "")
    return F.left(digits, F.lit(n)) if position == "first" else F.right(digits, F.lit(n))


def private_authors(df: DataFrame, flag: str = "ENPEN", prefix: str = "Private: ") -> DataFrame:
    """Flagged rows carry their authors in the doi field; move them and mark the doi as private."""
    flagged = F.col(flag)
    return df.withColumns(
        {
            "authors": F.when(flagged, F.replace(F.col("doi"), F.lit(prefix), F.lit(""))).otherwise(F.col("authors")),
            "doi": F.when(flagged, F.lit("Private")).otherwise(F.col("doi")),
        }
    )


def contains_ci(col: Column, needle: str) -> Column:
    """Case-insensitive containment, false for null."""
    return F.coalesce(F.lower(col).contains(needle.lower()), F.lit(False))


def safe_feature_name(col: Column) -> Column:
    return F.translate(col, FORBIDDEN_NAME_CHARS, "_" * len(FORBIDDEN_NAME_CHARS))


def parse_attributes(col: Column) -> Column:
    """`k=v;k=v` to a map; the value keeps any further `=`, and the last of a repeated key wins."""
    items = F.filter(F.split(col, ";"), lambda x: x.contains("="))
    pairs = F.transform(
        items,
        lambda x: F.struct(
            F.substring_index(x, "=", 1).alias("k"), F.regexp_replace(x, "^[^=]*=", "").alias("v")
        ),
    )

    def last_of_each(entries: Column) -> Column:
        def is_last(entry: Column, i: Column) -> Column:
            later = F.slice(entries, i + 2, F.size(entries))
            return ~F.exists(later, lambda o: o["k"] == entry["k"])

        return F.map_from_entries(F.filter(entries, is_last))

    return bind(pairs, last_of_each)


def looks_like_accession(col: Column) -> Column:
    return col.rlike(f"^{ACCESSION}$")


def accession_in(col: Column) -> Column:
    """First accession-shaped word of a header, else the trimmed header."""
    return F.coalesce(F.nullif(F.regexp_extract(col, rf"\b{ACCESSION}\b", 0), F.lit("")), F.trim(col))


def unversioned(col: Column) -> Column:
    """Text before the first dot; empty without one."""
    return F.regexp_extract(col, r"^(.+?)\.", 1)


def record_url(col: Column, prefix: str = RECORD_URL) -> Column:
    return F.concat(F.lit(prefix), col)


def first_contained(col: Column, keywords: Sequence[str]) -> Column:
    """First keyword in list order that the text contains, ignoring case.

    The keyword list is configuration; the plan holds it as one folded array, so no join is needed.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("word"), F.lit(k.lower()).alias("probe")) for k in keywords])

    def first(text: Column) -> Column:
        return F.get(F.filter(pairs, lambda p: F.contains(text, p["probe"])), F.lit(0))["word"]

    return bind(F.lower(col), first)
