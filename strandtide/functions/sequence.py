"""Expressions over one sequence: composition, windows, translation, residues."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandtide.functions.binding import bind

# The ambiguity letters and the standard genetic code in TCAG order.
AMBIGUOUS = "RYSWKMBDHV"
CODE_BASES = "TCAG"
CODE_RESIDUES = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def codon_table() -> dict[str, str]:
    codons = [a + b + c for a in CODE_BASES for b in CODE_BASES for c in CODE_BASES]
    return dict(zip(codons, CODE_RESIDUES))


def letter_count(seq: Column, letters: str) -> Column:
    """How many of the letters occur, by dropping all others' complement in one pass."""
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def composition(seq: Column) -> dict[str, Column]:
    """Counts per class, ignoring case; the classes add up to the length."""
    s = F.upper(seq)
    counts = {b: letter_count(s, b) for b in "ACGTN"}
    counts["other_iupac"] = letter_count(s, AMBIGUOUS)
    counts["gap"] = letter_count(s, "-")
    counts["unknown"] = letter_count(s, "?")
    counts["invalid"] = F.length(F.translate(s, "ACGTN" + AMBIGUOUS + "-?", ""))
    return {**counts, "length": F.length(s)}


def ungap(seq: Column) -> Column:
    return F.replace(seq, F.lit("-"), F.lit(""))


def ungapped_length(seq: Column, start: int | Column | None = None, end: int | Column | None = None) -> Column:
    """Length without `-` and `N`, of the whole sequence or of a 1-based closed region."""
    part = seq
    if start is not None and end is not None:
        lo = F.lit(start) if isinstance(start, int) else start
        hi = F.lit(end) if isinstance(end, int) else end
        part = F.when(lo.isNull() | hi.isNull(), seq).otherwise(F.substr(seq, lo, hi - lo + 1))
    return F.length(F.translate(part, "-N", ""))


def mask_outside(seq: Column, start: Column, end: Column) -> Column:
    """Keep the 1-based closed window, write `-` elsewhere; null when the window holds no data."""
    window = F.substr(seq, start, end - start + 1)
    lead = F.repeat(F.lit("-"), F.least(start - 1, F.length(seq)))
    trail = F.repeat(F.lit("-"), F.greatest(F.length(seq) - end, F.lit(0)))
    empty = window.rlike("^(N*|-*)$")
    return F.when(~empty, F.concat(lead, window, trail))


def translate_seq(seq: Column) -> Column:
    """Protein of the first frame; codons that are not plain ACGT become X.

    Codons are closed with a separator and replaced one by one on the whole text: every step is one
    linear pass in generated code, whereas slicing codon by codon walks the text from its start.
    """
    whole = F.substr(seq, F.lit(1), F.length(seq) - F.length(seq) % 3)
    text = F.regexp_replace(F.upper(whole), "(.{3})", "$1;")
    for codon, residue in codon_table().items():
        # lower case marks what is done, so a residue is never read as part of a codon
        text = F.replace(text, F.lit(codon + ";"), F.lit(residue.lower()))
    return F.upper(F.regexp_replace(text, ".{3};", "x"))


def positions_string(seq: Column, positions: Sequence[int]) -> Column:
    """Letters at the 1-based positions, joined."""
    return F.concat(*[F.substr(seq, F.lit(p), F.lit(1)) for p in positions])


# Letters and their complements.
LETTERS = "ACGTURYSWKMBDHVN"
COMPLEMENTS = "TGCAAYRSWMKVHDBN"


def reverse_complement(seq: Column) -> Column:
    """The other strand; letters without a complement stay."""
    return F.reverse(F.translate(seq, LETTERS + LETTERS.lower(), COMPLEMENTS + COMPLEMENTS.lower()))


def cut_spans(seq: Column, spans: Column) -> Column:
    """The parts (start, end, strand; 1-based closed) in their order, those on the minus strand reverse-complemented."""

    def piece(p: Column) -> Column:
        letters = F.substr(seq, p["start"], p["end"] - p["start"] + 1)
        return F.when(p["strand"] == "-", reverse_complement(letters)).otherwise(letters)

    return F.concat_ws("", F.transform(spans, piece))


def differences(seq: Column, ref: Column, skip: str = "-N") -> Column:
    """Array of (pos, ref, alt) where both are known and unequal, over the shorter length.

    Letters are compared as bytes, whose slices are constant-time.
    """
    known = list(skip)
    letter = lambda raw, i: F.substr(raw, i, F.lit(1))

    def compare(pair: Column) -> Column:
        unequal = F.filter(
            F.when(pair["n"] >= 1, F.sequence(F.lit(1), pair["n"])),
            lambda i: letter(pair["a"], i) != letter(pair["b"], i),
        )
        cells = F.transform(
            unequal,
            lambda i: F.struct(
                i.alias("pos"),
                letter(pair["b"], i).cast("string").alias("ref"),
                letter(pair["a"], i).cast("string").alias("alt"),
            ),
        )
        return F.filter(cells, lambda c: ~c["alt"].isin(known) & ~c["ref"].isin(known))

    shorter = F.least(F.length(seq), F.length(ref))
    return bind(
        F.struct(F.encode(seq, "utf-8").alias("a"), F.encode(ref, "utf-8").alias("b"), shorter.alias("n")), compare
    )


@F.pandas_udf(T.IntegerType())
def _equal_positions(a: pd.Series, b: pd.Series) -> pd.Series:

    # row by row on the texts as they are: nothing that grows with the letters of a batch is made
    view = lambda x, n: np.frombuffer(x, np.uint8, n)
    sizes = [0 if x is None or y is None else min(len(x), len(y)) for x, y in zip(a, b, strict=True)]
    return pd.Series([np.count_nonzero(view(x, n) == view(y, n)) if n else 0 for x, y, n in zip(a, b, sizes, strict=True)], dtype="int32")


def equal_positions(a: Column, b: Column) -> Column:
    """How many positions of two binary columns agree over the shorter length.

    Marked as not deterministic, because a filter on the result would otherwise be pushed below it
    and compute it twice.
    """
    return _equal_positions.asNondeterministic()(a, b)


def pairwise_identity(a: Column, b: Column) -> Column:
    """Agreeing positions over the shorter length, divided by the longer length."""
    longer = F.greatest(F.length(a), F.length(b))
    same = equal_positions(F.encode(a, "utf-8"), F.encode(b, "utf-8"))
    return F.when(longer > 0, same / longer)


def project(seq: Column, offset: Column, ref_length: Column | int) -> Column:
    """Letters of `seq` on reference coordinates: query position p sits at p + offset."""
    n = F.lit(ref_length) if isinstance(ref_length, int) else ref_length
    skipped = F.greatest(-offset, F.lit(0))
    lead = F.repeat(F.lit("-"), F.least(F.greatest(offset, F.lit(0)), n))
    body = F.substr(seq, skipped + 1, F.length(seq))
    placed = F.concat(lead, body)
    return F.rpad(F.substr(placed, F.lit(1), n), n, F.lit("-"))
