"""Quality scores and substitutions against a reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandtide.functions import sequence as seqfn

# Thresholds and weights of the quality scores.
MISSING_BIAS, MISSING_SPAN = 500, 2000
MIXED_THRESHOLD = 40
PRIVATE_TYPICAL, PRIVATE_CUTOFF = 600, 700
FRAME_SHIFT_WEIGHT, STOP_CODON_WEIGHT = 20, 40
GOOD_BELOW, MEDIOCRE_BELOW = 30, 100


def substitutions(aligned: DataFrame, refs: DataFrame, ref_key: str = "ref_id") -> DataFrame:
    """Long mutation table (id, pos, ref, alt); `aligned` names its reference or parent in `ref_key`.

    Only differing positions leave the row: the comparison happens inside it, not by a join on positions.
    """
    base = refs.select(F.col("id").alias(ref_key), F.col("seq").alias("_ref"))
    joined = aligned.join(base, ref_key)
    return joined.select("id", F.inline(seqfn.differences(F.col("seq"), F.col("_ref"))))


def frame_shifts(seq: Column) -> Column:
    """Gap runs inside the sequence whose length is not a multiple of three."""
    inner = F.regexp_replace(F.regexp_replace(seq, "^-+", ""), "-+$", "")
    runs = F.regexp_extract_all(inner, F.lit("-+"), F.lit(0))
    return F.size(F.filter(runs, lambda r: F.length(r) % 3 != 0))


def stop_codons(seq: Column) -> Column:
    """Stops of the first frame other than a closing one."""
    protein = seqfn.translate_seq(seq)
    body = F.regexp_replace(protein, r"\*$", "")
    return seqfn.letter_count(body, "*")


def _above(value: Column, floor: int, span: int) -> Column:
    return F.greatest((value - floor) * 100.0 / span, F.lit(0.0))


def quality_scores(missing: Column, mixed: Column, private: Column, shifts: Column, stops: Column) -> dict[str, Column]:
    scores = {
        "missing_score": _above(missing, MISSING_BIAS, MISSING_SPAN),
        "mixed_score": mixed * 100.0 / MIXED_THRESHOLD,
        "private_score": _above(private, PRIVATE_TYPICAL, PRIVATE_CUTOFF),
        "frame_score": (shifts * FRAME_SHIFT_WEIGHT).cast("double"),
        "stop_score": (stops * STOP_CODON_WEIGHT).cast("double"),
    }
    overall = sum((s * s / 100.0 for s in scores.values()), F.lit(0.0))
    status = F.when(overall < GOOD_BELOW, "good").when(overall < MEDIOCRE_BELOW, "mediocre").otherwise("bad")
    return {**scores, "overall_score": overall, "overall_status": status}


def seq_qc(aligned: DataFrame, refs: DataFrame, ref_key: str = "ref_id") -> DataFrame:
    """Scores, status, coverage, first and last covered position of sequences on reference coordinates."""
    base = refs.select(F.col("id").alias(ref_key), F.col("seq").alias("_ref"))
    joined = aligned.join(base, ref_key)
    seq = F.col("seq")
    parts = seqfn.composition(seq)
    lead = F.length(seq) - F.length(F.regexp_replace(seq, "^-+", ""))
    tail = F.length(seq) - F.length(F.regexp_replace(seq, "-+$", ""))
    counted = joined.select(
        "id",
        parts["N"].alias("n_missing"),
        parts["other_iupac"].alias("n_mixed"),
        F.size(F.coalesce(seqfn.differences(seq, F.col("_ref")), F.array())).alias("n_private"),
        frame_shifts(seq).alias("n_frame_shifts"),
        stop_codons(seqfn.ungap(seq)).alias("n_stops"),
        (lead + 1).alias("align_start"),
        (F.length(seq) - tail).alias("align_end"),
        F.bround((F.length(seq) - parts["gap"] - parts["N"]) / F.length("_ref"), 4).alias("coverage"),
    )
    scores = quality_scores(*[F.col(c) for c in ("n_missing", "n_mixed", "n_private", "n_frame_shifts", "n_stops")])
    return counted.withColumns(scores)
