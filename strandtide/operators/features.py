"""Features on sequences: extraction, masking and mutation positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandtide.names import quoted
from strandtide.functions import sequence as seqfn
from strandtide.functions.text import safe_feature_name
from strandtide.operators.dedup import rank_in_group

WHOLE_GENOME = "whole_genome"


def _names_feature(col, name: str):
    escaped = "".join("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in name.lower())
    return F.lower(col).rlike(rf"(?U)\b{escaped}\b")


def _with_spans(features: DataFrame) -> DataFrame:
    """Features with their parts: `spans` as read, or the one part that start, end and strand describe."""
    if "spans" in features.columns:
        return features
    strand = F.coalesce("strand", F.lit("+")) if "strand" in features.columns else F.lit("+")
    return features.withColumn("spans", F.array(F.struct("start", "end", strand.alias("strand"))))


def find_feature(features: DataFrame, name: str) -> DataFrame:
    """First CDS per record that holds the name as a whole word in any of its products, else in any of its genes.

    Returns (seqid, start, end, spans, elsewhere); the spans are the feature's parts in reading order, `elsewhere` says
    that it has parts in other records.
    """
    with_spans = _with_spans(features)
    if "values" in features.columns:
        every = lambda key: F.coalesce(F.try_element_at("values", F.lit(key)), F.array())
    else:
        every = lambda key: F.array_compact(F.array(F.try_element_at("attrs", F.lit(key))))
    labels = F.when(F.size(every("product")) > 0, every("product")).otherwise(every("gene"))
    hits = with_spans.filter((F.col("type") == "CDS") & F.exists(labels, lambda x: _names_feature(x, name)))
    elsewhere = (F.size("remote") > 0) if "remote" in features.columns else F.lit(False)
    return hits.groupBy("seqid").agg(F.min_by(F.struct("start", "end", "spans", elsewhere.alias("elsewhere")), "ord").alias("_f")).select("seqid", "_f.*")


def extract_feature(seqs: DataFrame, features: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Cut the named feature out of each record, and the features inside it moved to the new origin.

    Parts are joined in reading order; a part on the minus strand is reverse-complemented, and features in it change
    their strand. A feature that lies within one part moves with it, the named feature itself spans the whole cut, and
    features across parts stay out. A feature with parts in other records cannot be cut from its own: the record stays, with a null
    sequence and without features.
    """
    if name.lower() == WHOLE_GENOME:
        return seqs, features
    found = find_feature(features, name)
    # a hash of the named features, few of each record: sequences and features stream past it and are not sorted
    cut = seqs.join(found.withColumnRenamed("seqid", "id").hint("shuffle_hash"), "id")
    cut = cut.withColumn("seq", F.when(~F.col("elsewhere"), seqfn.cut_spans(F.col("seq"), F.col("spans")))).select(quoted(seqs.columns))
    parts = found.filter(~F.col("elsewhere")).select("seqid", F.posexplode("spans").alias("_at", "_part"), F.col("spans").alias("_all"), F.col("start").alias("_from"), F.col("end").alias("_to"))
    length = lambda p: p["end"] - p["start"] + 1
    before = F.aggregate(F.slice("_all", F.lit(1), F.col("_at")), F.lit(0), lambda n, p: n + length(p))
    total = F.aggregate("_all", F.lit(0), lambda n, p: n + length(p))
    window = parts.select("seqid", "_at", "_part", "_from", "_to", before.alias("_before"), total.alias("_total"), F.size("_all").alias("_parts"))
    full = _with_spans(features)
    joined = full.join(window.hint("shuffle_hash"), "seqid")
    itself = (F.col("start") == F.col("_from")) & (F.col("end") == F.col("_to")) & (F.col("_parts") > 1)
    inside = (F.col("start") >= F.col("_part.start")) & (F.col("end") <= F.col("_part.end")) & ~itself
    turned = F.col("_part.strand") == "-"
    flip = lambda s: F.when(turned, F.when(s == "-", "+").otherwise("-")).otherwise(s)
    lo = lambda p: F.when(turned, F.col("_part.end") - p["end"]).otherwise(p["start"] - F.col("_part.start")) + F.col("_before") + 1
    hi = lambda p: F.when(turned, F.col("_part.end") - p["start"]).otherwise(p["end"] - F.col("_part.start")) + F.col("_before") + 1
    whole = itself & (F.col("_at") == 0)
    own = F.struct("start", "end")
    values = {
        "start": F.when(whole, F.lit(1)).otherwise(lo(own)).cast("int"),
        "end": F.when(whole, F.col("_total")).otherwise(hi(own)).cast("int"),
        "spans": F.when(whole, F.array(F.struct(F.lit(1).alias("start"), F.col("_total").cast("int").alias("end"), F.lit("+").alias("strand")))).otherwise(
            F.transform("spans", lambda p: F.struct(lo(p).cast("int").alias("start"), hi(p).cast("int").alias("end"), flip(p["strand"]).alias("strand")))
        ),
    }
    if "strand" in features.columns:
        values["strand"] = F.when(whole, F.lit("+")).otherwise(flip(F.col("strand")))
    moved = joined.filter(inside | whole)
    return cut, moved.select([values[c].alias(c) if c in values else F.col(f"`{c}`") for c in features.columns])


def _windows(features: Sequence[tuple[str, int, int]]):
    return F.array(
        *[F.struct(F.lit(n).alias("feature"), F.lit(s).alias("start"), F.lit(e).alias("end")) for n, s, e in features]
    )


def extract_all_features(seqs: DataFrame, features: Sequence[tuple[str, int, int]]) -> DataFrame:
    """One row per (sequence, feature) with the feature's letters; the feature list rides along as a literal."""
    wide = seqs.select("id", "seq", F.explode(_windows(features)).alias("f")).select("id", "seq", "f.*")
    part = wide.withColumn("part", F.substr("seq", F.col("start"), F.col("end") - F.col("start") + 1))
    return part.filter(~F.col("part").rlike("^(N*|-*)$")).select("id", "feature", "part")


def mask_outside(seqs: DataFrame, start: int, end: int) -> DataFrame:
    masked = seqs.withColumn("seq", seqfn.mask_outside(F.col("seq"), F.lit(start), F.lit(end)))
    return masked.filter(F.col("seq").isNotNull())


def mutation_positions(muts: DataFrame, features: DataFrame) -> DataFrame:
    """Labels such as `16M` on a protein to residue positions on the polyprotein: (feature_set, position).

    `muts` has (feature_set, protein, label), `features` has (protein, start, end) in nucleotides.
    Labels without digits or outside their protein end the query with an error.
    """
    number = F.regexp_replace("label", r"\D", "").try_cast("int")
    joined = muts.withColumn("_p", number).join(features, "protein", "left")
    size = F.floor((F.col("end") - F.col("start") + 1) / 3)
    message = F.concat(F.lit("mutation label out of range: "), F.col("protein"), F.lit(" "), F.col("label"))
    fine = F.coalesce(F.col("_p").between(1, size), F.lit(False))
    position = F.when(fine, F.floor((F.col("start") - 1) / 3) + F.col("_p")).otherwise(F.raise_error(message).cast("long"))
    return joined.select("feature_set", position.cast("int").alias("position")).distinct()


def unique_feature_names(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Names without forbidden characters; from its second occurrence on a name gets `_002`, `_003`, ..."""
    safe = df.withColumn(name, safe_feature_name(F.col(name)))
    ranked = rank_in_group(safe, [name], order, "_nth")
    numbered = F.concat(F.col(name), F.format_string("_%03d", F.col("_nth")))
    return ranked.withColumn(name, F.when(F.col("_nth") > 1, numbered).otherwise(F.col(name))).select(quoted(df.columns))
