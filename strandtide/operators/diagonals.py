"""Exact matches of k letters or more between two sets of texts, as runs along diagonals.

A seed is a pair of places with the same k letters of ACGT. Seeds that follow each other on a diagonal are one run, and
only the first and the last seed of a run are ever made: at the first one the letters before differ, at
the last one the letters behind. So a letter that is repeated n times in one text and m times in another makes
about n + m rows, not n * m.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BASES = "ACGT"
MOST_K = 31
PASS_LETTERS = 1 << 21
TOLD_BY = 12
#: Codes of letters beside a seed that equal no other letter: one for each side.
NOT_HERE, NOT_THERE = 4, 5
_CODE = np.full(256, NOT_HERE, dtype=np.int64)
_CODE[[ord(c) for c in BASES]] = range(4)


def _raw(texts: list[bytes]) -> np.ndarray:
    """The letters of the texts as `_laid` places them, with some foreign ones behind the last."""
    return np.frombuffer(b"-".join([*texts, b"-" * 2 * MOST_K]), dtype=np.uint8)


def _laid(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of the texts with one foreign code behind each, and where each begins."""
    letters = _CODE[np.frombuffer(b"-".join([*texts, b""]), dtype=np.uint8)]
    return letters, np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]


def _numbers(letters: np.ndarray, k: int) -> np.ndarray:
    """The number that each k codes in a row make, put together from windows of 1, 2, 4, ... codes."""
    n, done, size = len(letters) - k + 1, 0, 1
    window, out = (letters & 3).astype(np.int64), np.zeros(n, dtype=np.int64)
    while True:
        if k & size:
            out = out * 4**size + window[done : done + n]
            done += size
        if 2 * size > k:
            return out
        window = window[:-size] * 4**size + window[size:]
        size *= 2


def _kmers(letters: np.ndarray, k: int, own: np.ndarray | None = None, present: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of all k letters of ACGT in a row, their number, the code before and the code behind.

    `own` marks the places that count; of k-mers whose last letters are not `present` none is given.
    """
    n = len(letters) - k + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    foreign = np.concatenate([[0], np.cumsum(letters == NOT_HERE, dtype=np.int32)])
    here = foreign[k:] == foreign[:-k]
    number = _numbers(letters, k)
    if own is not None:
        here &= own[:n]
    if present is not None:
        here &= present[number & (len(present) - 1)]
    at = np.flatnonzero(here)
    edged = np.concatenate([[NOT_HERE], letters, [NOT_HERE]])
    return at, number[at], edged[at], edged[at + k + 1]


class _Index:
    """Places of the k-mers of the references, in order of the k-mer and the letter beside it."""

    def __init__(self, texts: list[bytes], k: int):
        letters, self.begins = _laid(texts)
        self.raw = _raw(texts)
        at, number, before, behind = _kmers(letters, k)
        # which last letters k-mers have here: most k-mers of a query are told by them
        self.present = np.zeros(4 ** min(k, TOLD_BY), dtype=bool)
        self.present[number & (len(self.present) - 1)] = True
        self.sides = []
        for beside in (before, behind):
            key = number * 8 + np.where(beside == NOT_HERE, NOT_THERE, beside)
            order = np.argsort(key, kind="stable")
            self.sides.append((key[order], at[order]))

    def unlike(self, number: np.ndarray, beside: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into `number`, place in the references) of equal k-mers with another letter beside them."""
        key, at = self.sides[side]
        first, last = np.searchsorted(key, number * 8), np.searchsorted(key, number * 8 + 8)
        same = np.searchsorted(key, number * 8 + beside), np.searchsorted(key, number * 8 + beside + 1)
        of, places = [], []
        for lo, hi in ((first, same[0]), (same[1], last)):
            sizes = hi - lo
            row = np.repeat(np.arange(len(number)), sizes)
            spot = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo, sizes)
            of.append(row)
            places.append(at[spot])
        return np.concatenate(of), np.concatenate(places)


@lru_cache(maxsize=2)
def _index(token: str, texts: tuple[bytes, ...], k: int) -> _Index:
    return _Index(list(texts), k)


def _segments(texts: list[bytes], leads: np.ndarray, index: _Index, k: int, chunk: int) -> tuple[np.ndarray, ...]:
    """(row, reference, diagonal, first seed, last seed, equal letters, near an open run) of seeds less than 2 k apart.

    Places are counted from 1 in each chunk, behind the `leads` letters that only stand before it. A run that goes on
    beyond its chunk is open: it has no first or no last seed here (-1), and nothing if neither is here.
    """
    letters, begins = _laid(texts)
    raw, own = _raw(texts), np.zeros(len(letters), dtype=bool)
    for begin, text, lead in zip(begins.tolist(), texts, leads.tolist(), strict=True):
        own[begin + lead : begin + min(lead + chunk, len(text))] = True
    at, number, before, behind = _kmers(letters, k, own, index.present)
    ends = []
    for side, beside in enumerate((before, behind)):
        of, there = index.unlike(number, beside, side)
        here = at[of]
        row = np.searchsorted(begins, here, side="right") - 1
        ref = np.searchsorted(index.begins, there, side="right") - 1
        place, spot = here - begins[row] - leads[row] + 1, there - index.begins[ref] + 1
        ends.append((row, ref, spot - place, place, np.full(len(row), side)))
    row, ref, diagonal, place, side = (np.concatenate(x) for x in zip(*ends, strict=True))
    order = np.lexsort((side, place, diagonal, ref, row))
    row, ref, diagonal, place, side = (x[order] for x in (row, ref, diagonal, place, side))
    n = len(row)
    # along a diagonal first and last seeds alternate; only a chunk's first mark can lack its first seed, only its last one the other
    alike = np.zeros(n, dtype=bool)
    alike[1:] = (row[1:] == row[:-1]) & (ref[1:] == ref[:-1]) & (diagonal[1:] == diagonal[:-1])
    closes = alike & (side == 1)
    begins_run = np.append(closes[1:], False)[:n] & (side == 0)
    is_open = ~closes & ~begins_run
    # runs: closed ones by both seeds, open ones by the seed that is here
    of_run = np.flatnonzero(begins_run | is_open)
    paired = begins_run[of_run]
    first = np.where(side[of_run] == 0, place[of_run], -1)
    last = np.where(paired, place[np.minimum(of_run + 1, max(n - 1, 0))] if n else -1, np.where(side[of_run] == 1, place[of_run], -1))
    row, ref, diagonal, of_line = row[of_run], ref[of_run], diagonal[of_run], alike[of_run]
    near = np.zeros(len(of_run), dtype=bool)
    near[1:] = of_line[1:] & (np.maximum(first[1:], last[1:] * (first[1:] < 0)) - np.where(last[:-1] < 0, first[:-1], last[:-1]) <= 2 * k)
    joins = near.copy()
    joins[1:] &= paired[1:] & paired[:-1]
    by_open = near & ~joins
    beside_open = ~paired | by_open | np.append(by_open[1:], False)[: len(by_open)]
    # letters between joined runs, at most k each
    gap_at = np.flatnonzero(joins)
    sizes = first[gap_at] - last[gap_at - 1] - k
    of_gap = np.repeat(gap_at, sizes)
    spot = np.arange(len(of_gap)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + (last + k - 1)[of_gap - 1]
    same = np.where(paired, last - first + k, 0)
    same_there = raw[begins[row[of_gap]] + leads[row[of_gap]] + spot] == index.raw[index.begins[ref[of_gap]] + spot + diagonal[of_gap]]
    same = same + np.bincount(of_gap, weights=same_there, minlength=len(same)).astype(np.int64)
    begin = np.flatnonzero(~joins)
    final = np.append(begin[1:], len(of_run)) - 1
    total = np.add.reduceat(same, begin) if len(begin) else same
    touches = np.logical_or.reduceat(beside_open, begin) if len(begin) else beside_open
    return row[begin], ref[begin], diagonal[begin], first[begin], last[final] if len(begin) else last, total, touches


def _letters_at(raw: np.ndarray, at: np.ndarray, k: int) -> pa.Array:
    """k letters from each place on."""
    cut = np.ascontiguousarray(raw[np.minimum(at[:, None] + np.arange(k), len(raw) - 1)])
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(k), len(at), [None, pa.py_buffer(cut.tobytes())]).cast(pa.binary())


def in_task(pieces: DataFrame, refs: list[tuple[str, str]], k: int, letters_of_refs: int, decay: float, ceiling: float, chunk: int) -> DataFrame:
    """(key, sseqid, diag, first, last, same, after, after_there, chars) of the segments of `pieces` that can matter.

    `refs` are few and travel with the job. A segment is dropped if it could not reach the threshold even with all letters
    alike, qlen * letters_of_refs * exp(-decay * length) > ceiling, unless it may go on in the next chunk of its text. A run that
    goes on beyond its chunk has a row for its first and one for its last seed, wherever these are. `same` counts the equal
    letters of a whole segment; `after` and `after_there` are the k letters behind it on both sides.
    """
    token = uuid.uuid4().hex
    shared = pieces.sparkSession.sparkContext.broadcast([(i, s.encode()) for i, s in refs])

    def run(batches):
        names = [i for i, _ in shared.value]
        index = _index(token, tuple(s for _, s in shared.value), k)
        listed = pa.array(names, type=pa.string())
        for batch in batches:
            raw, keys, chars = batch.column("raw").to_pylist(), batch.column("key"), batch.column("chars")
            begin, size, leads = (batch.column(c).to_numpy() for c in ("from", "qlen", "lead"))
            lo = 0
            while lo < len(raw):
                hi, total = lo + 1, len(raw[lo])
                while hi < len(raw) and total + len(raw[hi]) <= PASS_LETTERS:
                    total += len(raw[hi])
                    hi += 1
                row, ref, diagonal, first, last, same, touches = _segments(raw[lo:hi], leads[lo:hi], index, k, chunk)
                own = row + lo
                # a little slack for rounding: the exact test comes later
                reach = np.log(size[own].astype(float)) + np.log(float(max(letters_of_refs, 1))) - decay * (last - first + k) <= np.log(ceiling) + 1e-6
                before, behind = (begin[own] > 0) & (first <= 2 * k), (begin[own] + chunk + k - 1 < size[own]) & (chunk + 1 - last <= 2 * k)
                kept = reach | before | behind | touches
                row, own, ref, diagonal, first, last, same = (x[kept] for x in (row, own, ref, diagonal, first, last, same))
                starts = np.cumsum([0, *[len(t) + 1 for t in raw[lo:hi]]])[:-1]
                # behind the last seed; an open run without one has no use for these letters
                end = np.maximum(last, 0) + k - 1
                here, there = starts[row] + leads[own] + end, np.maximum(index.begins[ref] + end + diagonal, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(own)),
                        listed.take(pa.array(ref)),
                        pa.array(diagonal - begin[own]),
                        pa.array(first + begin[own], mask=first < 0),
                        pa.array(last + begin[own], mask=last < 0),
                        pa.array(same, mask=(first < 0) | (last < 0)),
                        _letters_at(_raw(raw[lo:hi]), here, k),
                        _letters_at(index.raw, there, k),
                        chars.take(pa.array(own)),
                    ],
                    names=["key", "sseqid", "diag", "first", "last", "same", "after", "after_there", "chars"],
                )
                lo = hi

    schema = "key binary, sseqid string, diag long, first long, last long, same long, after binary, after_there binary, chars int"
    columns = ["key", *[F.col(c).cast("long").alias(c) for c in ("from", "qlen", "lead")], "raw", "chars"]
    return pieces.select(*columns).mapInArrow(run, schema)


def letter_code(letter: Column, absent: int) -> Column:
    """0 to 3 for a letter of ACGT; anything else, a missing letter included, is `absent`."""
    place = F.instr(F.lit(BASES), letter)
    return F.when((F.length(letter) == 1) & (place > 0), place - 1).otherwise(F.lit(absent)).cast("int")


def by_join(query_kmers: DataFrame, ref_kmers: DataFrame) -> DataFrame:
    """(key, sseqid, diag, first, last, after, after_there, chars) of all runs of seeds, for references of any size.

    Both sides have pos, kmer, the codes `before` and `behind` and the letters `after` the k-mer. Each query row asks for the letters
    that differ from its own beside the k-mer, so the join makes the first and last seeds of runs only.
    """

    def ends(side: str) -> DataFrame:
        others = F.filter(F.array(*[F.lit(i) for i in (0, 1, 2, 3, NOT_THERE)]), lambda x: x != F.col(side))
        last = side == "behind"
        after = F.col("after") if last else F.lit(None).cast("binary")
        asked = query_kmers.select("key", "chars", F.col("pos").alias("qpos"), "kmer", after.alias("after"), F.explode(others).alias("beside"))
        there = ref_kmers.select("sseqid", F.col("pos").alias("spos"), "kmer", after.alias("after_there"), F.col(side).alias("beside"))
        met = asked.join(there.hint("merge"), ["kmer", "beside"])
        return met.select("key", "sseqid", (F.col("spos") - F.col("qpos")).alias("diag"), "qpos", F.lit(last).alias("last"), "after", "after_there", "chars")

    marks = ends("before").unionByName(ends("behind"))
    # in order of place the seeds that begin and end a run alternate; a run of one seed has its begin first
    line = Window.partitionBy("key", "sseqid", "diag").orderBy("qpos", "last")
    paired = marks.withColumn("_next", F.lead(F.struct("qpos", "after", "after_there")).over(line)).filter(~F.col("last"))
    return paired.select(
        "key", "sseqid", "diag", F.col("qpos").cast("long").alias("first"), F.col("_next.qpos").cast("long").alias("last"), "_next.after", "_next.after_there", "chars"
    )
