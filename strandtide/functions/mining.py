"""Facts found in free text: host, age, sex, diagnosis, genotype, severity, strain."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandtide.functions.binding import bind
from strandtide.functions.text import distinct_sorted_join, literal_map

# Words and patterns that are looked for, and the numbers that number words stand for.
HOST_WORDS = r"(homo sapiens|human|other hosts|child)"
SEX_WORDS = r"(?U)\b(male|female|m|f|man|woman|boy|girl|h)\b"
FEMALE_WORDS = ("f", "girl", "woman", "female")
AGE_PATTERN = (
    r"(\d+\.?\d*|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve)"
    r"\s*(years?|months?|days?|y|m|d)"
)
NUMBER_WORDS = "one two three four five six seven eight nine ten eleven twelve".split()
ISOLATION_WORDS = (
    r"(?U)\b(feces|throat|plasma|csf|cerebro spinal fluid|mouth swab|vesicle|stool|blood|serum)\b"
)
GENOTYPE_PATTERN = (
    r"(?i)(?U)\b([A-Za-z0-9\-\.]+)\s*(?:subgenogroup|genogroup|type)\b"
    r"|\b(?:subgenogroup|genogroup|type)\s*([A-Za-z0-9\-\.]+)\b"
)
NOTE_GENOTYPE_PATTERN = r"(?i)(type|genogroup)[\s:]*([A-Za-z0-9\-\.]+)"
SEVERITY_PATTERN = r"severity\s*score:\s*(\w+).*outcome:\s*(\w+)"
STRAIN_PATTERN = r"(strain|isolate)\s+([\w\-\./]+)"
# Words of clinical notes, and what a title must name.
CLINICAL_WORDS = ("year", "month", "patient", "male")
WANTED_REGIONS = (r"\bVP1\b", r"\bcomplete \b", r"\bpartial cds\b")
# matches no text, for empty lists
NOTHING = "(?!)"


def _found(col: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def _capitalized(col: Column) -> Column:
    return F.concat(F.upper(F.substr(col, F.lit(1), F.lit(1))), F.substr(col, F.lit(2)))


def term_pattern(terms: Sequence[str]) -> str:
    """Whole-word alternation of the terms, in their given order."""
    escaped = "|".join(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", t.lower()) for t in terms)
    return rf"(?U)\b(?:{escaped})\b" if escaped else NOTHING


def _age_from_parts(pairs: Column) -> Column:
    """Years, months and days to (age_yrs, age_mo); two parts are added."""
    in_years = F.filter(pairs, lambda p: p["u"].isin("d", "y"))
    in_months = F.filter(pairs, lambda p: p["u"] == "m")
    last = F.try_element_at(in_years, F.lit(-1))
    yrs = F.when(last["u"] == "d", F.bround(last["v"] / 365, 3)).otherwise(last["v"])
    found = F.struct(
        yrs.alias("y"), F.try_element_at(in_months, F.lit(-1))["v"].alias("m"), (F.size(pairs) > 1).alias("several")
    )

    def ages(f: Column) -> Column:
        total = F.coalesce(f["y"], F.lit(0.0)) + F.bround(F.coalesce(f["m"], F.lit(0.0)) / 12, 3)
        return F.struct(
            F.when(f["several"], total).otherwise(F.coalesce(f["y"], F.bround(f["m"] / 12, 3))).alias("age_yrs"),
            F.when(f["several"], total * 12).otherwise(F.coalesce(F.bround(f["y"] * 12, 3), f["m"])).alias("age_mo"),
        )

    return bind(found, ages)


def mine_ages(text: Column) -> Column:
    """Struct (age_yrs, age_mo) from phrases such as `2 years 3 months`, `five days`."""
    values = F.regexp_extract_all(text, F.lit(AGE_PATTERN), F.lit(1))
    units = F.regexp_extract_all(text, F.lit(AGE_PATTERN), F.lit(2))
    words = literal_map({w: str(i + 1) for i, w in enumerate(NUMBER_WORDS)})
    pairs = F.zip_with(
        values,
        units,
        lambda v, u: F.struct(
            F.coalesce(v.try_cast("double"), F.try_element_at(words, v).cast("double")).alias("v"),
            F.substr(u, F.lit(1), F.lit(1)).alias("u"),
        ),
    )
    return bind(pairs, _age_from_parts)


def mine_host_text(col: Column, symptoms: Mapping[str, str]) -> Column:
    """Struct (host, isolation, sex, age_yrs, age_mo, diagnosis) from a host or source field."""
    by_term = {k.lower(): v for k, v in symptoms.items()}
    known = literal_map(by_term)

    def words(text: Column) -> Column:
        return F.struct(
            text.alias("text"),
            _found(text, SEX_WORDS, 1).alias("sex"),
            _found(text, HOST_WORDS, 1).alias("host"),
            _found(text, ISOLATION_WORDS, 1).alias("specimen"),
            F.regexp_extract(text, r"^\s*(\S+)", 1).alias("first"),
            mine_ages(text).alias("age"),
            F.regexp_extract_all(text, F.lit(term_pattern(list(by_term))), F.lit(0)).alias("terms"),
        )

    def facts(w: Column) -> Column:
        usable = (F.length(w["first"]) >= 2) & ~w["first"].rlike(r"^\d+$")
        diagnoses = F.transform(w["terms"], lambda t: F.try_element_at(known, t))
        return F.struct(
            _capitalized(w["host"]).alias("host"),
            F.coalesce(_capitalized(w["specimen"]), F.when(usable, w["first"])).alias("isolation"),
            F.when(w["sex"].isin(*FEMALE_WORDS), "F").when(w["sex"].isNotNull(), "M").alias("sex"),
            w["age"]["age_yrs"].alias("age_yrs"),
            w["age"]["age_mo"].alias("age_mo"),
            F.nullif(distinct_sorted_join(diagnoses), F.lit("")).alias("diagnosis"),
        )

    return bind(bind(F.lower(col), words), facts)


def worth_mining(col: Column, symptoms: Mapping[str, str]) -> Column:
    """Whether a source field holds clinical words rather than a plain specimen name."""
    escaped = "|".join(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", k.lower()) for k in symptoms)
    return F.coalesce(col.rlike("|".join(CLINICAL_WORDS)) | F.lower(col).rlike(escaped or NOTHING), F.lit(False))


def mine_genotype(title: Column, note: Column | None = None) -> Column:
    """Word next to `subgenogroup`, `genogroup` or `type`; a note overrides the title."""
    from_title = F.coalesce(_found(title, GENOTYPE_PATTERN, 1), _found(title, GENOTYPE_PATTERN, 2))
    if note is None:
        return from_title
    return F.coalesce(_found(note, NOTE_GENOTYPE_PATTERN, 2), from_title)


def mine_severity(diagnosis: Column, note: Column) -> Column:
    """Append `severity <score>; <outcome>` found in the note to the diagnosis."""
    score, outcome = _found(note, SEVERITY_PATTERN, 1), _found(note, SEVERITY_PATTERN, 2)
    extra = F.concat(F.lit("severity "), score, F.lit("; "), outcome)
    return F.nullif(F.concat_ws("; ", F.nullif(diagnosis, F.lit("")), extra), F.lit(""))


def description_is_target(col: Column, organism_pattern: str) -> Column:
    """Title names the organism and a wanted region or completeness."""
    wanted = WANTED_REGIONS
    region = col.rlike(rf"(?i){wanted[0]}") | col.rlike(rf"(?i){wanted[1]}") | col.rlike(rf"(?i){wanted[2]}")
    return F.coalesce(col.rlike(rf"(?i)\b({organism_pattern})\b") & region, F.lit(False))


def strain_from_title(col: Column, n_hits: Column) -> Column:
    """Text after `strain` or `isolate`; `c` is added for complete records among several hits."""
    name = _found(col, STRAIN_PATTERN, 2)
    complete = col.rlike(r"(?i)\bcomplete \b") & (n_hits > 1)
    return F.when(complete, F.concat(name, F.lit("c"))).otherwise(name)
