"""Language identification by error-correcting output codes.

Each learned language has a codeword of bits. For every bit a linear n-gram classifier says on which side
of that split of the languages a text lies; a text's language is the codeword with the least
logistic loss, each bit weighted by how well its classifier does for that language on rows kept back from fitting. The
score is the share of the best codeword among all, and texts whose two best are close are marked ambiguous.

Features are hashed n-grams of one to four bytes over lower-case letters, everything else being one mark between
words; they are counted over whole texts in pieces of bounded size. The classifiers are fitted on the driver
on a bounded sample; applying them is a scan without any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandtide.llm.common import LETTERS, lists, map_batches, mix, row_count, utf8
from strandtide.runtime import cut_lineage

FEATURES = 4096
LONGEST = 4
#: At most so many rows are used for fitting, the same number of each language.
TRAINING_ROWS = 4000
TEXTS_AT_ONCE, PIECE_BYTES = 256, 1 << 20
UNDECIDED = "und"
#: Below this lead of the best codeword's share over the second one a text is ambiguous.
LEAD = 0.2

_LETTER = np.where(LETTERS & ~np.isin(np.arange(256), np.arange(ord("0"), ord("9") + 1)), np.arange(256), 0).astype(np.uint64)


def _grams(data: np.ndarray, lo: int, hi: int, ends: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place - lo, feature) of the n-grams that begin in data[lo:hi]; `ends` has the end of each place's text, `begins` its first places."""
    n = hi - lo
    letter = _LETTER[data[lo : hi + LONGEST - 1]]
    # a stretch of other bytes counts as one mark
    mark = letter[:n] == 0
    after = np.concatenate([_LETTER[data[max(lo - 1, 0) : lo]] == 0, mark])[-n - 1 : -1] if lo else np.concatenate([[False], mark[:-1]])
    fresh = begins | ~(mark & after)
    left = ends - np.arange(lo, hi)
    code, inner = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
    for size in range(1, LONGEST + 1):
        own = np.zeros(n, dtype=np.uint64)
        part = letter[size - 1 : size - 1 + n]
        own[: len(part)] = part
        code = code * np.uint64(257) + own + np.uint64(1)
        # letters inside, a mark only as first or last byte
        good = fresh & (left >= size) & ~inner
        if size == 1:
            good &= own != 0
        at = np.flatnonzero(good)
        yield at, (mix(code[at] ^ np.uint64(size)) & np.uint64(FEATURES - 1)).astype(np.int64)
        if size > 1:
            inner |= own == 0


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, rows of FEATURES numbers of length one) over the texts of a string column."""
    data, offsets = utf8(pc.utf8_lower(pc.fill_null(column, "")))
    for lo in range(0, len(offsets) - 1, TEXTS_AT_ONCE):
        hi = min(lo + TEXTS_AT_ONCE, len(offsets) - 1)
        bounds = offsets[lo : hi + 1] - offsets[lo]
        part = data[offsets[lo] : offsets[hi]]
        counts = np.zeros((hi - lo) * FEATURES, dtype=np.int64)
        for begin in range(0, len(part), PIECE_BYTES):
            stop = min(begin + PIECE_BYTES, len(part))
            places = np.arange(begin, stop)
            text_of = np.searchsorted(bounds, places, side="right") - 1
            for at, feature in _grams(part, begin, stop, bounds[1:][text_of], bounds[:-1][text_of] == places):
                counts += np.bincount(text_of[at] * FEATURES + feature, minlength=len(counts))
        x = np.log1p(counts.reshape(hi - lo, FEATURES)).astype(np.float32)
        yield lo, hi, x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """A row of -1 and 1 for each of k classes; no column is constant, repeats another or is its opposite.

    Up to five classes have all splits; more have 10 log2(k) random ones, the draw of 64 whose closest rows differ most.
    """
    if k < 2:
        return np.zeros((k, 0), dtype=np.int8)
    if k <= 5:
        splits = (np.arange(1, 1 << (k - 1))[None, :] >> np.arange(k)[:, None]) & 1
        return (2 * splits - 1).astype(np.int8)
    rng, best, most = np.random.default_rng(seed), None, -1
    length = int(np.ceil(10 * np.log2(k)))
    for _ in range(64):
        drawn = rng.choice(np.array([-1, 1], dtype=np.int8), size=(k, 2 * length))
        # the first row is all ones, so a column and its opposite are the same one
        drawn = drawn * drawn[:1]
        columns = np.unique(drawn[:, np.abs(drawn.sum(axis=0, dtype=np.int64)) < k], axis=1)
        columns = columns[:, rng.permutation(columns.shape[1])[:length]]
        apart = (columns[:, None, :] != columns[None, :, :]).sum(axis=2)
        closest = apart[~np.eye(k, dtype=bool)].min()
        if closest > most:
            best, most = columns, closest
    return best


def bit_classifiers(x: np.ndarray, bits: np.ndarray, weight: np.ndarray, rounds: int = 150, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and offsets of one logistic classifier for each column of `bits` (-1 or 1), by accelerated gradient steps."""
    n, columns = len(x), bits.shape[1]
    w, b = np.zeros((x.shape[1], columns), np.float32), np.zeros(columns, np.float32)
    w_before, b_before = w, b
    share = (weight / max(weight.sum(), 1e-9)).astype(np.float32)[:, None]
    # rows have length one, so the loss bends by at most a quarter of 2 (the offset counts as one more feature)
    step = np.float32(2.0)
    for r in range(rounds if n else 0):
        push = np.float32(r / (r + 3))
        w_ahead, b_ahead = w + push * (w - w_before), b + push * (b - b_before)
        margin = bits * (x @ w_ahead + b_ahead)
        slope = -share * bits / (1 + np.exp(np.minimum(margin, 60)))
        w_before, b_before = w, b
        w = w_ahead - step * (x.T @ slope + decay * w_ahead)
        b = b_ahead - step * slope.sum(axis=0)
    return w, b


@dataclass
class Languages:
    """Learned languages by code point, their codewords, the classifiers of the bits and the weight of each bit by language."""

    names: list[str]
    codes: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    trust: np.ndarray

    def shares(self, x: np.ndarray) -> np.ndarray:
        """A number for each text and language: the loss-weighted likelihood of the language's codeword; rows add up to 1."""
        margins = x @ self.weights + self.offsets
        loss = np.stack([np.logaddexp(0, -margins * code) @ trust for code, trust in zip(self.codes, self.trust, strict=True)], axis=1)
        likely = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        return likely / likely.sum(axis=1, keepdims=True)


def learned(x: np.ndarray, names_of: list[str]) -> Languages:
    """The model of rows `x` with their languages. Every fifth row of a language is kept back to weigh its bits."""
    names = sorted(set(names_of))
    codes = codewords(len(names))
    y = np.array([names.index(n) for n in names_of], dtype=np.int64)
    place = np.zeros(len(y), dtype=np.int64)
    for k in range(len(names)):
        place[y == k] = np.arange((y == k).sum())
    back = place % 5 == 4
    balance = 1 / np.maximum(np.bincount(y, minlength=len(names)), 1)[y] if len(y) else np.zeros(0)
    own, offset = bit_classifiers(x[~back], codes[y[~back]].astype(np.float32), balance[~back])
    right = (x @ own + offset) * codes[y] > 0
    trust = np.ones(codes.shape)
    for k in range(len(names)):
        seen = right[back & (y == k)]
        # half right is worth nothing; a language without rows kept back trusts all bits alike
        trust[k] = np.maximum(2 * (seen.sum(axis=0) + 1) / (len(seen) + 2) - 1, 0.01) if len(seen) else 1.0
    # every language's weights add up to the number of its bits
    trust *= codes.shape[1] / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)
    return Languages(names, codes.astype(np.float32), own, offset, trust)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, bound: int = TRAINING_ROWS) -> Languages:
    """Learns the languages of `docs` (doc_id, text, lang) from texts with a letter and non-null `lang`.

    At most `bound` rows are fetched, as many of each language as its share of the bound allows (one at least), those
    whose ids come first in hash order; only ids and languages are sorted, and of a frequent language only those whose
    hash is small enough to come first. Rows without id are not used. Without
    rows nothing is learned and every text is undecided.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where("lang is not null").where(has_letters(F.col("text")))
    ids = rows.select("doc_id", "lang").where("doc_id is not null")
    # one row for each language
    kinds = cut_lineage(ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    each = max(1, bound // max(row_count(kinds), 1))
    # three times the share that is needed and a hundred rows more: the first ones are always among them
    small = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.least(F.lit(1.0), (3 * each + 100) / F.col("n")) * (1 << 20)
    near = ids.join(kinds, "lang").where(small).select("doc_id", "lang").distinct()
    first = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)), "doc_id")
    chosen = near.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= each).drop("_r")
    sample = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "lang", "text")

    def run(batches):
        for batch in batches:
            for lo, hi, x in features(batch.column("text")):
                row, at = np.nonzero(x)
                bounds = np.searchsorted(row, np.arange(hi - lo + 1))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), lists(at.astype(np.int16), bounds), lists(x[row, at], bounds)], names=["doc_id", "lang", "at", "x"])

    found = map_batches(sample, run, "doc_id long, lang string, at array<short>, x array<float>")
    # ids may be repeated in `docs`: the bound holds for what is fetched, too
    again = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)), "doc_id", "at", "x")
    table = found.withColumn("_r", F.row_number().over(again)).where(F.col("_r") <= each).orderBy("lang", "_r").select("lang", "at", "x").toArrow()
    x = np.zeros((table.num_rows, FEATURES), dtype=np.float32)
    at, value = table.column("at").combine_chunks(), table.column("x").combine_chunks()
    sizes = pc.list_value_length(at).to_numpy(zero_copy_only=False).astype(np.int64) if table.num_rows else np.zeros(0, np.int64)
    x[np.repeat(np.arange(table.num_rows), sizes), at.flatten().to_numpy().astype(np.int64)] = value.flatten().to_numpy()
    return learned(x, table.column("lang").to_pylist())


def predict(docs: DataFrame, model: Languages) -> DataFrame:
    """`doc_id`, `lang_pred`, `score`, `second`, `ambiguous` for every row of `docs` (doc_id, text).

    `score` is the best codeword's share (0 to 1), `second` the language that follows; ties go to the name that comes first by
    code point. Texts that are null or have no letter are `und` with score 0 and ambiguous, as are all if nothing was learned.
    Repeated rows are handled one by one, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = ["doc_id", "lang_pred", "score", "second", "ambiguous"]

    def run(batches):
        model = shared.value
        names = np.array(model.names or [UNDECIDED], dtype=object)
        for batch in batches:
            said = batch.column("said").to_numpy(zero_copy_only=False) & bool(model.names)
            for lo, hi, x in features(batch.column("text")):
                shares = model.shares(x) if model.names else np.zeros((hi - lo, 1))
                # a stable order keeps the first of equals first
                order = np.argsort(-shares, axis=1, kind="stable")
                rows, sure = np.arange(hi - lo), said[lo:hi]
                best = np.where(sure, shares[rows, order[:, 0]], 0.0)
                second, follows = np.full(hi - lo, None, dtype=object), np.zeros(hi - lo)
                if len(names) > 1:
                    second, follows = np.where(sure, names[order[:, 1]], None), shares[rows, order[:, 1]]
                found = np.where(sure, names[order[:, 0]], UNDECIDED)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(found, type=pa.string()), pa.array(best), pa.array(second, type=pa.string()), pa.array(best - follows < LEAD)],
                    names=columns,
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", has_letters(F.col("text")).alias("said"))
    return map_batches(source, run, "doc_id long, lang_pred string, score double, second string, ambiguous boolean")
