"""Vocabulary matching with an exact candidate join, and the columns built on it."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandtide.names import quoted
from strandtide.functions.text import distinct_sorted_join, split_multi, title_letters


def similarity(a: Column, b: Column) -> Column:
    """100 * (1 - edit distance / longer length)."""
    return 100 * (1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def _edit_budget(length: Column, cutoff: float) -> Column:
    """Most edits any text can be away from a key of this length and still reach the cutoff.

    distance <= (1 - c) * longer and longer <= length + distance give distance <= (1 - c) / c * length.
    """
    c = cutoff / 100.0
    return F.floor(length * ((1 - c) / c) + F.lit(1e-9)).cast("int")


def match_vocabulary(tokens: DataFrame, vocab: DataFrame, cutoff: float = 75.0) -> DataFrame:
    """Best vocabulary entry per distinct token: (token, value, score); tokens without a match are absent.

    A key that is at most d edits away can be cut into d + 1 pieces of which one occurs unchanged in
    the token, moved by at most d positions. Pieces are equi-joined with the token's substrings by
    (text, position), and only those candidates are scored: complete, and no cross join.
    """
    if not 50 < cutoff <= 100:
        raise ValueError("cutoff must be above 50: below it no piece of a key need survive")
    keys = (
        vocab.groupBy(F.lower("key").alias("key"))
        .agg(F.min("ord").alias("ord"), F.min_by("value", "ord").alias("value"))
        .filter(F.length("key") > 0)
    )
    n, d = F.length("key"), _edit_budget(F.length("key"), cutoff)
    pieces = keys.withColumns({"_len": n, "_d": F.least(d, n - 1)}).withColumn(
        "_cut", F.explode(F.sequence(F.lit(0), F.col("_d")))
    )
    start = lambda i: F.floor(i * F.col("_len") / (F.col("_d") + 1)).cast("int")
    pieces = pieces.withColumns({"_from": start(F.col("_cut")) + 1, "_next": start(F.col("_cut") + 1) + 1})
    pieces = pieces.withColumn("piece", F.substr("key", F.col("_from"), F.col("_next") - F.col("_from")))
    pieces = pieces.withColumn(
        "at", F.explode(F.sequence(F.greatest(F.col("_from") - F.col("_d"), F.lit(1)), F.col("_from") + F.col("_d")))
    )
    # the token's length is part of the join key as well: at most d letters more or fewer
    lengths = F.sequence(F.greatest(F.col("_len") - F.col("_d"), F.lit(1)), F.col("_len") + F.col("_d"))
    pieces = pieces.withColumn("size", F.explode(lengths)).select("key", "value", "ord", "piece", "at", "size")
    size = F.length("_t")
    # tokens of a length that no key can reach, such as whole paragraphs, are not cut up at all
    probe = (
        tokens.select(F.lower("token").alias("_t"), "token")
        .withColumn("size", size)
        .distinct()
        .join(pieces.select("size").distinct(), "size", "left_semi")
    )
    if cutoff == 100:  # every key is one piece
        grams = probe.select("token", "_t", F.lit(1).alias("at"), F.col("_t").alias("piece"), "size")
    else:
        widest = math.ceil(cutoff / (100.0 - cutoff))  # pieces are at most c / (1 - c) letters long, rounded up
        room = F.least(F.lit(widest), F.col("size") - F.col("at") + 1)
        grams = (
            probe.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size"))))
            .withColumn("_w", F.explode(F.sequence(F.lit(1), room)))
            .select("token", "_t", "at", F.substr("_t", F.col("at"), F.col("_w")).alias("piece"), "size")
        )
    candidates = (
        grams.join(pieces, ["piece", "at", "size"])
        .select("token", "_t", "key", "value", "ord")
        .distinct()
    )
    scored = candidates.withColumn("score", similarity(F.col("_t"), F.col("key"))).filter(F.col("score") >= cutoff)
    # an exact hit scores 100, so it is first by itself; ties go to the earlier entry
    best = scored.groupBy("token").agg(F.min_by(F.struct("value", "score"), F.struct(-F.col("score"), "ord")).alias("_b"))
    return best.select("token", F.col("_b.value").alias("value"), F.col("_b.score").alias("score"))


@dataclass(frozen=True)
class Terms:
    """How one list field is standardized; see `standardize_terms`."""

    col: str
    vocab: DataFrame
    cutoff: float = 75.0
    fallback: str = "lower"
    short_forms: Sequence[str] = ()
    target: str | None = None


def _standard_texts(texts: DataFrame, job: Terms) -> DataFrame:
    """(_text, _out) for distinct field values: their parts matched, written, distinct and sorted."""
    passed = F.col("_text").isin(list(job.short_forms)) if job.short_forms else F.lit(False)
    parts = texts.filter(~passed).withColumn("token", F.explode_outer(split_multi(F.col("_text"))))
    matched = match_vocabulary(parts.select("token").dropna().distinct(), job.vocab, job.cutoff)
    own = F.lower("token")
    if job.fallback == "title":
        keeps = F.col("token").isin(list(job.short_forms)) if job.short_forms else F.lit(False)
        own = F.when(keeps, F.col("token")).otherwise(title_letters(F.col("token")))
    value = F.coalesce(F.col("value"), own)
    if job.fallback == "lower":
        value = F.lower(value)
    return (
        parts.join(matched, "token", "left")
        .groupBy("_text")
        .agg(F.collect_set(value).alias("_set"))  # bounded by the parts of one field value
        .select("_text", distinct_sorted_join(F.col("_set")).alias("_out"))
    )


def standardize_all(df: DataFrame, jobs: Sequence[Terms]) -> DataFrame:
    """Several list fields at once. Every field's distinct values are read from `df` itself, so with a stored table as
    `df` nothing above it is planned again, however many fields there are."""
    out = df
    for job in jobs:
        if job.fallback not in ("lower", "title"):
            raise ValueError("fallback must be 'lower' or 'title'")
        target = job.target or job.col
        done = _standard_texts(df.select(F.col(f"`{job.col}`").alias("_text")).dropna().distinct(), job)
        text = F.col(f"`{job.col}`")
        joined = out.join(done, text == F.col("_text"), "left")
        value = F.when(text.isin(list(job.short_forms)), text).otherwise(F.col("_out")) if job.short_forms else F.col("_out")
        out = joined.select(*quoted(c for c in out.columns if c != target), value.alias(target))
    return out


def standardize_terms(
    df: DataFrame,
    col: str,
    vocab: DataFrame,
    cutoff: float = 75.0,
    fallback: str = "lower",
    short_forms: Sequence[str] = (),
    target: str | None = None,
) -> DataFrame:
    """Split a list field, match each part with the vocabulary, and write the distinct sorted result.

    Works on distinct field values and joins back once, so repeated texts are matched once.
    `fallback` says how unmatched parts are written: 'lower' (then all output is lower case) or 'title'.
    """
    return standardize_all(df, [Terms(col, vocab, cutoff, fallback, short_forms, target)])
