"""The ingest chain and the final metadata table as compositions of operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandtide.functions import dates, precedence, text
from strandtide.operators import joins, select
from strandtide.operators.dedup import keep_first
from strandtide.operators.fuzzy import Terms, standardize_all
from strandtide.runtime import cut_lineage

# The source columns of a downloaded record and what they are called here.
FIELD_MAP = {
    "accession": "accession",
    "accession_version": "accession_version",
    "sourcedb": "database",
    "sra-accs": "sra_accessions",
    "isolate-lineage": "strain",
    "geo-region": "region",
    "geo-location": "location",
    "isolate-collection-date": "date",
    "release-date": "date_released",
    "update-date": "date_updated",
    "length": "length",
    "host-name": "host",
    "sex": "sex",
    "genotype": "genotype",
    "isolate-lineage-source": "sample_type",
    "biosample-acc": "biosample_accessions",
    "submitter-names": "authors",
    "submitter-affiliation": "institution",
    "submitter-country": "submitter_country",
}
# Words that stay lower case or upper case in place names.
ARTICLES = "and d de del des di do en l la las le los nad of op sur the y".split()
ABBREVIATIONS = ("USA",)
# The columns kept after curation.
CURATED_COLUMNS = (
    "accession accession_version strain date region country division location length host sex genotype "
    "date_released date_updated sra_accessions authors abbr_authors institution"
).split()
PLACE_LEVELS = ("region", "country", "division", "location")


@dataclass(frozen=True)
class CurationSettings:
    field_map: Mapping[str, str] = field(default_factory=lambda: dict(FIELD_MAP))
    strain_pattern: str = "^.+$"
    strain_backups: Sequence[str] = ("accession",)
    date_fields: Sequence[str] = ("date", "date_released", "date_updated")
    date_formats: Sequence[str] = dates.DATE_FORMATS
    articles: Sequence[str] = tuple(ARTICLES)
    abbreviations: Sequence[str] = ABBREVIATIONS
    authors_default: str = "?"
    id_field: str = "accession"
    edit_fields: Sequence[str] = ("strain", "date", "region", "country", "division", "location", "host")


def curate_columns(df: DataFrame, settings: CurationSettings = CurationSettings()) -> DataFrame:
    """The record-wise part: names, text, strain, dates, place parts, title case, authors. No shuffle."""
    df, _ = select.rename_fields(df, settings.field_map)
    df = text.normalize_strings(df, [c for c in df.columns if c != "sequence"])
    backups = [F.col(c) for c in settings.strain_backups]
    df = df.withColumn("strain", text.transform_strain(F.col("strain"), backups, settings.strain_pattern))
    df = df.withColumns({c: dates.format_date(F.col(c), settings.date_formats) for c in settings.date_fields if c in df.columns})
    place = text.parse_location(F.col("location"))
    df = df.withColumns({c: place[c] for c in ("country", "division", "location")})
    title = lambda c: text.title_words(F.col(c), settings.articles, settings.abbreviations)
    df = df.withColumns({c: title(c) for c in PLACE_LEVELS if c in df.columns})
    return df.withColumn("abbr_authors", text.abbreviate_authors(F.col("authors"), settings.authors_default))


def curate_places_and_edits(df: DataFrame, geo_rules: DataFrame, edits: DataFrame, settings: CurationSettings) -> DataFrame:
    """The part that looks things up: place rules, then point edits."""
    df = joins.wildcard_rules(df, geo_rules, PLACE_LEVELS)
    return joins.apply_annotations(df, edits, settings.id_field, [f for f in settings.edit_fields if f in df.columns])


def curate(
    df: DataFrame, geo_rules: DataFrame, edits: DataFrame, settings: CurationSettings = CurationSettings()
) -> DataFrame:
    return curate_places_and_edits(curate_columns(df, settings), geo_rules, edits, settings)


def curate_and_split(
    df: DataFrame, geo_rules: DataFrame, edits: DataFrame, settings: CurationSettings = CurationSettings()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metadata, sequences and rejected records of the curated stream."""
    return select.split_records(curate(df, geo_rules, edits, settings), settings.id_field, "sequence", CURATED_COLUMNS)


def source_record(
    df: DataFrame, organism: str, symptoms: Mapping[str, str], places: Sequence[str]
) -> DataFrame:
    """Parsed source records (accession, organism, strain, isolate, geo_loc_name, isolation_source, host, note,
    collection_date, title, pubmed_id) to the sixteen record columns."""
    from strandtide.functions import mining

    target, _ = select.organism_is(df, "organism", organism)
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    isolation, host, note = blank("isolation_source"), blank("host"), blank("note")
    strain = text.pick_strain(F.col("strain"), F.col("isolate"))
    place = F.split(blank("geo_loc_name"), ":", 2)
    by_isolation = F.when(mining.worth_mining(isolation, symptoms), mining.mine_host_text(isolation, symptoms))
    by_host = F.when(host != "Homo sapiens", mining.mine_host_text(host, symptoms))
    by_note = F.when(note.rlike("year|patient"), mining.mine_host_text(note, symptoms))
    lowered = {k.lower(): v for k, v in symptoms.items()}
    named = text.first_contained(F.concat_ws("\n", F.col("strain"), F.col("isolate")), list(lowered))
    standard = F.try_element_at(text.literal_map(lowered), named)
    by_title = F.try_element_at(text.literal_map(lowered), text.first_contained(F.col("title"), list(lowered)))
    mined = target.withColumns({"_i": by_isolation, "_h": by_host, "_n": by_note})
    # the last field that was mined decides sex, age and diagnosis; a note also overrides names' findings
    facts = F.coalesce("_n", "_h", "_i")
    before = F.when(F.coalesce("_h", "_i").isNotNull(), F.coalesce("_h", "_i")["diagnosis"]).otherwise(by_title)
    with_name = F.nullif(F.concat_ws("; ", before, standard), F.lit(""))
    diagnosis = F.when(F.col("_n").isNotNull(), F.col("_n")["diagnosis"]).otherwise(with_name)
    diagnosis = mining.mine_severity(diagnosis, note)
    # Two findings that are named twice.
    for finding in ("HFMD", "AFP"):
        diagnosis = F.replace(diagnosis, F.lit(f"{finding}; {finding}"), F.lit(finding))
    where = F.trim(F.get(place, F.lit(1)))
    isolation_out = F.when(F.coalesce("_n", "_h").isNotNull(), isolation).when(F.col("_i").isNotNull(), F.col("_i")["isolation"]).otherwise(isolation)
    origin = F.when(F.col("_n").isNull() & F.col("_h").isNotNull(), F.col("_h")["host"]).otherwise(host)
    return mined.select(
        "accession",
        strain.alias("strain"),
        F.trim(F.get(place, F.lit(0))).alias("country"),
        F.coalesce(where, text.first_contained(F.concat_ws("\n", "strain", "isolate"), places)).alias("location"),
        F.lit(None).cast("string").alias("region"),
        mining.mine_genotype(F.col("title"), note).alias("subgenogroup"),
        F.lit(None).cast("string").alias("lineage"),
        F.col("collection_date").alias("date"),
        dates.year_of_text(F.col("collection_date")).alias("collection_yr"),
        facts["sex"].alias("sex"),
        facts["age_yrs"].alias("age_yrs"),
        facts["age_mo"].alias("age_mo"),
        diagnosis.alias("diagnosis"),
        isolation_out.alias("isolation"),
        origin.alias("origin"),
        F.coalesce(F.concat(F.lit("PMID: "), blank("pubmed_id")), F.lit("genbank corrections")).alias("doi"),
    )


@dataclass(frozen=True)
class Vocabularies:
    """Configuration tables (key, value, ord) and the grouping of symptoms."""

    symptoms: DataFrame
    isolation: DataFrame
    short_forms: Sequence[str]
    major_groups: Mapping[str, str]


def add_metadata(
    meta: DataFrame,
    extra: DataFrame,
    local_names: DataFrame,
    ledger: DataFrame,
    regions: DataFrame,
    overrides: DataFrame,
    vocab: Vocabularies,
    flag: str = "ENPEN",
    cutoff: float = 75.0,
) -> DataFrame:
    """Curated metadata and extra metadata to the final table, one row per accession.

    `meta` and `extra` carry `ord`; `local_names` is (key = sample name, value = accession, ord);
    `overrides` is (accession, subgenogroup, doi, ord). Every join is on the accession, so the planner
    reuses one partitioning.
    """
    extra = joins.lookup_override(extra, local_names, "strain", "accession", "ord")
    meta = meta.withColumn("location", F.coalesce("location", "division"))
    if "sample_type" not in meta.columns:
        meta = meta.withColumn("sample_type", F.col("`isolate-lineage-source`") if "isolate-lineage-source" in meta.columns else F.lit(None).cast("string"))
    both = joins.merge_sides(meta, extra, "accession", "ord", "ord")
    b = lambda c: F.col("base")[c] if c in meta.columns else F.lit(None).cast("string")
    x = lambda c: F.col("extra")[c] if c in extra.columns else F.lit(None).cast("string")
    key = F.col("accession")
    merged = both.select(
        key,
        b("accession_version").alias("accession_version"),
        precedence.pick_name(b("strain"), x("strain"), key).alias("strain"),
        precedence.pick_date(b("date"), x("date"), x("origin")).alias("date"),
        precedence.fill_from(x("place"), b("location")).alias("place"),
        text.correct_country(precedence.fill_from(x("country"), b("country"))).alias("country"),
        b("host").alias("host"),
        text.parse_gender(x("gender")).alias("gender"),
        dates.to_number(x("age_yrs")).alias("age_yrs"),
        x("diagnosis").alias("diagnosis"),
        x("isolation").alias("_iso_extra"),
        b("sample_type").alias("_iso_base"),
        b("length").alias("NCBI_length_genome"),
        precedence.fill_from(x("subgenogroup"), b("clade")).alias("subgenogroup"),
        b("date_released").alias("date_released"),
        b("abbr_authors").alias("abbr_authors"),
        b("authors").alias("authors"),
        b("institution").alias("institution"),
        text.contains_ci(x("origin"), flag).alias(flag),
        x("doi").alias("doi"),
        *[b(c).alias(c) for c in ("qc.overallScore", "qc.overallStatus", "alignmentScore", "alignmentStart", "alignmentEnd", "genome_coverage")],
    )
    first_seen = ledger.groupBy("accession").agg(F.min("date_added").cast("date").alias("date_added"))
    merged = merged.join(first_seen, "accession", "left").withColumn("date_added_num", dates.numeric_date(F.col("date_added")))
    # stored once: each field's distinct values are then read from this table, not from the sources again
    merged = standardize_all(
        cut_lineage(merged),
        [
            Terms("_iso_extra", vocab.isolation, cutoff),
            Terms("_iso_base", vocab.isolation, cutoff),
            Terms("diagnosis", vocab.symptoms, cutoff, "title", vocab.short_forms, "med_diagnosis_all"),
        ],
    )
    merged = merged.withColumn("isolation_source", F.coalesce("_iso_extra", "_iso_base"))
    merged = joins.country_region(merged, "country", regions)
    merged = text.private_authors(merged, flag)
    merged = merged.withColumns(
        {
            "med_diagnosis_major": text.major_group(F.col("med_diagnosis_all"), vocab.major_groups),
            "has_diagnosis": precedence.has_value(F.col("diagnosis")),
            "has_age": precedence.has_value(F.col("age_yrs")),
            "age_range": dates.age_range(F.col("age_yrs")),
        }
    )
    final = select.select_final(merged)
    wins = keep_first(overrides.dropna(subset=["accession"]), ["accession"], ["ord"]).select(
        "accession", F.col("subgenogroup").alias("_sub"), F.col("doi").alias("_doi")
    )
    return (
        final.join(wins, "accession", "full")
        .withColumns(
            {
                "subgenogroup": F.coalesce("_sub", "subgenogroup"),
                "doi": precedence.replace_unless(F.col(flag), F.col("doi"), F.col("_doi")),
            }
        )
        .select([f"`{c}`" for c in select.FINAL_COLUMNS])
    )

