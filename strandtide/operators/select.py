"""Projections and filters over metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandtide.functions.text import unversioned

# Inclusive length bounds per segment.
SEGMENT_BOUNDS = {"vp1": (600, 900), "P1": (2000, 2600), "whole_genome": (6400, 8000)}
# Exclusive length bounds per sampling class.
LENGTH_CLASSES = {
    "vp1": (600, 8000),
    "whole_genome": (6000, 8000),
    "vp4vp1": (6000, 8000),
    "2a3d": (6000, 8000),
}
# The columns of the final metadata table, in order.
FINAL_COLUMNS = (
    "accession accession_version strain date region place country host gender age_yrs age_range has_age "
    "has_diagnosis med_diagnosis_all med_diagnosis_major isolation_source NCBI_length_genome subgenogroup "
    "date_released abbr_authors authors institution ENPEN doi qc.overallScore qc.overallStatus alignmentScore "
    "alignmentStart alignmentEnd genome_coverage date_added date_added_num"
).split()
# Record columns of a parsed source record and the other names users may ask for.
RECORD_COLUMNS = (
    "accession strain country location region subgenogroup lineage date collection_yr sex age_yrs age_mo "
    "diagnosis isolation origin doi"
).split()
RECORD_ALIASES = {
    "gender": "sex",
    "place": "location",
    "year": "collection_yr",
    "collection_date": "date",
    "age": "age_yrs",
    "age_years": "age_yrs",
    "age_month": "age_mo",
    "symptoms": "diagnosis",
    "clade": "subgenogroup",
}


def rename_fields(df: DataFrame, field_map: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    """Rename columns; the second value lists source names that are missing."""
    missing = [old for old in field_map if old not in df.columns]
    return df.withColumnsRenamed({o: n for o, n in field_map.items() if o in df.columns}), missing


def resolve_columns(
    df: DataFrame,
    requested: Sequence[str],
    canonical: Sequence[str] = RECORD_COLUMNS,
    aliases: Mapping[str, str] = RECORD_ALIASES,
) -> tuple[DataFrame, list[str]]:
    """Select by canonical name or alias under the requested name; unknown names come back as a list."""
    source = {name: name if name in canonical else aliases.get(name) for name in requested}
    unknown = [name for name, col in source.items() if col is None]
    return df.select([F.col(f"`{c}`").alias(n) for n, c in source.items() if c is not None]), unknown


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed column order; absent columns are empty, extra ones are dropped."""
    have = set(df.columns)
    return df.select([F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def select_final(df: DataFrame) -> DataFrame:
    return select_columns(df, FINAL_COLUMNS)


def duplicate_column(df: DataFrame, source: str, target: str) -> DataFrame:
    if source not in df.columns:
        raise ValueError(f"column '{source}' is not in the table")
    if target in df.columns:
        raise ValueError(f"column name '{target}' is already in use")
    return df.withColumn(target, F.col(f"`{source}`"))


def derive_accession(df: DataFrame, versioned: str = "accession_version", name: str = "accession") -> DataFrame:
    rest = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(unversioned(F.col(versioned)).alias(name), *rest)


def length_between(df: DataFrame, col: str, lo: int, hi: int) -> DataFrame:
    return df.filter(F.length(col).between(lo, hi))


def length_class(df: DataFrame, col: str, name: str) -> DataFrame:
    if name not in LENGTH_CLASSES:
        raise ValueError(f"length class must be one of {sorted(LENGTH_CLASSES)}")
    lo, hi = LENGTH_CLASSES[name]
    return df.filter((F.length(col) > lo) & (F.length(col) < hi))


def exclude_where(df: DataFrame, col: str, value: str) -> DataFrame:
    """Drop rows whose value equals the given one, ignoring case; nulls stay."""
    return df.filter(~equals_ci(F.col(col), value))


def equals_ci(col: Column, value: str) -> Column:
    return F.coalesce(F.lower(col.cast("string")) == value.lower(), F.lit(False))


def drop_sparse(df: DataFrame, min_non_null: int = 2) -> DataFrame:
    """Rows with so many values at least; a NaN is none. Names may have dots."""
    has = lambda f: F.col(f"`{f.name}`").isNotNull() & ~F.isnan(f"`{f.name}`") if f.dataType.typeName() in ("float", "double") else F.col(f"`{f.name}`").isNotNull()
    return df.filter(sum((has(f).cast("int") for f in df.schema.fields), F.lit(0)) >= min_non_null)


def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.dropna(subset=[key])


@dataclass(frozen=True)
class DropRule:
    """A named condition under which a row is dropped."""

    name: str
    condition: Column


def with_drop_reason(
    df: DataFrame, rules: Sequence[DropRule], force_keep: Column | None = None, name: str = "reason"
) -> DataFrame:
    """First failing rule per row, null when kept; a forced row is kept and marked so."""
    reason = F.lit(None).cast("string")
    for rule in reversed(list(rules)):
        reason = F.when(F.coalesce(rule.condition, F.lit(False)), F.lit(rule.name)).otherwise(reason)
    if force_keep is not None:
        reason = F.when(F.coalesce(force_keep, F.lit(False)), F.lit("force_include")).otherwise(reason)
    return df.withColumn(name, reason)


def filter_with_reasons(
    df: DataFrame, rules: Sequence[DropRule], force_keep: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and one line per row that was dropped or forced with its reason."""
    flagged = with_drop_reason(df, rules, force_keep)
    kept = flagged.filter(F.col("reason").isNull() | (F.col("reason") == "force_include")).drop("reason")
    return kept, flagged.filter(F.col("reason").isNotNull())


def mark_listed(df: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """Boolean column: is the key in the id list. The list is deduplicated, so rows are not multiplied."""
    listed = ids.select(F.col(ids.columns[0]).alias(key)).distinct().withColumn(flag, F.lit(True))
    return df.join(listed, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def organism_is(df: DataFrame, col: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the target organism, and how many rows name another one."""
    target = F.coalesce(F.col(col) == name, F.lit(False))
    others = df.filter(~target).groupBy(F.col(col).alias("organism")).agg(F.count(F.lit(1)).alias("n"))
    return df.filter(target), others


def split_records(
    df: DataFrame, id_field: str, sequence_field: str, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One record set to metadata, sequences and rejected records with the reason."""
    no_id = F.coalesce(F.col(id_field), F.lit("")) == ""
    no_seq = F.coalesce(F.col(sequence_field), F.lit("")) == ""
    judged = df.withColumn("reject", F.when(no_id, F.lit("no sequence id")).when(no_seq, F.lit("no sequence")))
    good = judged.filter(F.col("reject").isNull())
    sequences = good.select(F.col(id_field).alias("id"), F.col(sequence_field).alias("seq"))
    return select_columns(good, columns), sequences, judged.filter(F.col("reject").isNotNull())
