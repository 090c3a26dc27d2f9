"""Periodic runs of words, located by block convolution at dyadic scales.

A run is a stretch of consecutive words with smallest period q that is at least four periods (and six words)
long and that no neighbouring word extends. A run of that length with period q holds a whole aligned block
of B words together with its copy q words later whenever 2 B - 1 <= 3 q, so scale B looks at the periods
from ceil((2 B - 1) / 3) up to the next scale's first one, and every period belongs to one scale.

1. At each scale all aligned blocks are compared with the window behind them at once: words are replaced by
   16-bit numbers, and the sum of squared differences of block and window at every distance is
   computed exactly modulo the Fermat prime 65537 by number-theoretic transforms in int64 (sums of
   squares come from running sums, the mixed term from one correlation). Equal stretches give zero, so no
   occurrence is missed; a zero by chance is found out in the next step.
2. Each zero is a distance that seeds an extension to the left and right, by binary search over running sums of
   64-bit word hashes. Long enough stretches stay, unless a divisor of the distance is a period, too.

Blocks longer than MOST_BLOCK are compared by their first MOST_BLOCK words, which is still a necessary condition, and
windows are then taken piece by piece, so the transform's length is bounded and texts of any length are whole.
A scan of the table without any shuffle; the work is n log^2 n in the words of a text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandtide.llm.common import NOT_SPACE, Block, _powers, blocks, map_batches

PRIME, GENERATOR = 65537, 3
LEAST_LENGTH, LEAST_PERIODS = 6, 4
MOST_BLOCK = 1 << 15
CELLS = 1 << 20


@lru_cache(maxsize=None)
def _twiddles(n: int, inverse: bool) -> np.ndarray:
    """The first n / 2 powers of a root of unity of order n modulo the prime."""
    root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    out = np.ones(max(n // 2, 1), dtype=np.int64)
    for i in range(1, len(out)):
        out[i] = out[i - 1] * root % PRIME
    return out


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number of the same residue: 2^16 is -1 modulo 65537."""
    return (x & 0xFFFF) - (x >> 16)


def _twisted(x: np.ndarray, n: int, inverse: bool) -> np.ndarray:
    """`x` (groups, n / 2, m) times the twiddles along its middle axis."""
    w, m = _twiddles(n, inverse), x.shape[2]
    if len(w) == 1:
        return x
    # a long inner loop whatever the shape
    return (x.reshape(len(x), -1) * np.repeat(w, m)).reshape(x.shape) if m < 64 else x * w[:, None]


def transform(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform along axis 0 (a power of two up to 2^16), result in bit-reversed order.

    Values are kept lazily: they at most double and grow by 2^16 at each of 16 levels, far from 2^63.
    """
    n, m = x.shape
    size = n
    while size > 1:
        parts = x.reshape(n // size, 2, size // 2, m)
        out = np.empty_like(parts)
        u, v = parts[:, 0], parts[:, 1]
        np.add(u, v, out=out[:, 0])
        out[:, 1] = _fold(_twisted(u - v, size, False))
        x, size = out.reshape(n, m), size // 2
    return _fold(_fold(x))


def inverse_transform(x: np.ndarray) -> np.ndarray:
    """Back from bit-reversed order, n times too large."""
    n, m = x.shape
    size = 2
    while size <= n:
        parts = x.reshape(n // size, 2, size // 2, m)
        out = np.empty_like(parts)
        u, v = parts[:, 0], _fold(_twisted(parts[:, 1], size, True))
        np.add(u, v, out=out[:, 0])
        np.subtract(u, v, out=out[:, 1])
        x, size = out.reshape(n, m), size * 2
    return _fold(_fold(x))


def zero_distances(values: np.ndarray, squares: np.ndarray, starts: np.ndarray, width: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into `starts`, distance - first) where the squared differences of a block and its copy vanish modulo the prime.

    Blocks are values[s : s + width]; distances are first to first + width. `squares` are running sums of squared values.
    """
    n, m = 2 * width, len(starts)
    block = np.zeros((n, m), dtype=np.int64)
    # reversed, so that the product of transforms is a correlation
    block[(n - np.arange(width)) % n] = values[np.arange(width)[:, None] + starts]
    window = values[(np.arange(n) + first)[:, None] + starts]
    mixed = inverse_transform(_fold(transform(block) * transform(window)))[: width + 1]
    at = (np.arange(width + 1) + first)[:, None] + starts
    total = _fold(_fold(squares[starts + width] - squares[starts] + squares[at + width] - squares[at]))
    gone = n * total - 2 * mixed
    for _ in range(4):
        gone = _fold(gone)
    distance, block_of = np.nonzero(gone == 0)
    return block_of, distance


class _Extender:
    """How far two places of a sequence agree to the right and to the left, by binary search over hashes of runs."""

    def __init__(self, words: np.ndarray):
        self.up, self.down = _powers(1).upto(len(words) + 1)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.up[: len(words)])])

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        one = (self.total[a + length] - self.total[a]) * self.down[a]
        return one == (self.total[b + length] - self.total[b]) * self.down[b]

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, left: bool) -> np.ndarray:
        """The largest length up to `most` over which the stretches from (or, to the left, up to) `a` and `b` agree."""
        lo, hi = np.zeros(len(a), np.int64), most.copy()
        for _ in range(int(most.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) // 2
            same = self.equal(a - mid, b - mid, mid) if left else self.equal(a, b, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo


@lru_cache(maxsize=8)
def _sieve(n: int) -> np.ndarray:
    least = np.arange(n + 1)
    for p in range(2, int(n**0.5) + 1):
        if least[p] == p:
            own = least[p * p :: p]
            own[own == np.arange(p * p, n + 1, p)] = p
    return least


def _primitive(extender: _Extender, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether no proper divisor of the period is a period of the stretch; with four periods nothing else can be shorter."""
    fine = np.ones(len(start), dtype=bool)
    if not len(start):
        return fine
    least = _sieve(1 << int(period.max()).bit_length())
    rest = period.copy()
    while (rest > 1).any():
        some = np.flatnonzero((rest > 1) & fine)
        if not len(some):
            break
        shorter = period[some] // least[rest[some]]
        fine[some] &= ~extender.equal(start[some], start[some] + shorter, length[some] - shorter)
        rest = np.where(rest > 1, rest // least[rest], 1)
    return fine


def find_runs(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, ordered by text, start and period.

    `words` are 64-bit hashes of the words of several texts in a row, text i has those from first[i] to first[i + 1].
    """
    counts = np.diff(first)
    found = [np.zeros((0, 4), dtype=np.int64)]
    longest, block_words = int(counts.max(initial=0)), 2
    if longest < LEAST_LENGTH:
        return found[0]
    # runs hold at least six words, so texts with fewer stay out of every scale by their blocks' room
    text_of = np.repeat(np.arange(len(counts)), counts)
    end_of = first[1:][text_of]
    extender = _Extender(words)
    numbers = (words & np.uint64(0xFFFF)).astype(np.int64)
    while LEAST_PERIODS * (low := -(-(2 * block_words - 1) // 3)) <= longest:
        high = -(-(4 * block_words - 1) // 3)
        width = min(block_words, MOST_BLOCK)
        starts = np.arange(0, len(words), block_words)
        roomy = (starts + low + width <= end_of[starts]) & (counts[text_of[starts]] >= max(LEAST_LENGTH, LEAST_PERIODS * low))
        starts = starts[roomy]
        if len(starts):
            padded = np.concatenate([numbers, np.zeros(high + 3 * width + 2, dtype=np.int64)])
            squares = np.concatenate([np.zeros(1, np.int64), np.cumsum(padded * padded)])
            at_once = max(1, CELLS // (2 * width))
            for k in range(0, len(starts), at_once):
                some = starts[k : k + at_once]
                for piece in range(low, high, width + 1):
                    which, more = zero_distances(padded, squares, some, width, piece)
                    found.append(_extended(extender, some[which], more + piece, min(high, piece + width + 1), first, text_of, end_of))
        block_words *= 2
    return np.unique(np.concatenate(found), axis=0)


def _extended(extender, a, distance, below, first, text_of, end_of) -> np.ndarray:
    """Rows (text, start, length, period) of the runs that the seeds (place, distance) lie in."""
    inside = (distance < below) & (a + distance < end_of[a])
    a, distance = a[inside], distance[inside]
    if not len(a):
        return np.zeros((0, 4), dtype=np.int64)
    b = a + distance
    right = extender.reach(a, b, end_of[a] - b, left=False)
    left = extender.reach(a, b, a - first[text_of[a]], left=True)
    length = left + right + distance
    long = length >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * distance)
    rows = np.unique(np.stack([text_of[a], a - left, length, distance], axis=1)[long], axis=0)
    rows = rows[_primitive(extender, rows[:, 1], rows[:, 2], rows[:, 3])]
    rows[:, 1] -= first[rows[:, 0]]
    return rows


def repeated_words(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words lie in a run after its first period."""
    edge = np.zeros(int(first[-1]) + 1, dtype=np.int64)
    begin = first[rows[:, 0]] + rows[:, 1]
    np.add.at(edge, begin + rows[:, 3], 1)
    np.add.at(edge, begin + rows[:, 2], -1)
    return np.cumsum(edge)[:-1] > 0


def joined(block: Block, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    text_of = np.repeat(np.arange(len(block.counts)), block.counts)[kept]
    begin, end = block.starts[kept], block.stops[kept]
    if not len(begin):
        return pa.array([""] * len(block.counts), type=pa.string())
    # the byte behind a word that another one follows is white space of the same text
    follows = np.append(text_of[1:] == text_of[:-1], False)
    edge = np.zeros(len(block.data) + 2, dtype=np.int32)
    edge[begin] += 1
    np.add.at(edge, end + follows, -1)
    mask = np.cumsum(edge)[: len(block.data)] > 0
    data = block.data.copy()
    data[end[follows]] = 0x20
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(mask)])[block.offsets]
    binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(block.counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[mask].tobytes())])
    return binary.cast(pa.large_string()).cast(pa.string())


def periodic_runs(docs: DataFrame, texts: bool = True) -> DataFrame:
    """`doc_id`, `n_words`, `runs` (start, length, period, by start and period), `collapsed` for every row of `docs` (doc_id, text).

    Words are runs outside white space, numbered from 0; 64-bit hashes stand for them. `collapsed` has the words that lie
    in no run after its first period, joined by one blank; `texts=False` leaves it null. Null, empty and short texts have
    no runs and all their words. Rows are handled one by one, whatever their ids; other columns are ignored.
    """
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def run(batches):
        for batch in batches:
            for lo, hi, block in blocks(batch.column("text"), NOT_SPACE):
                rows = find_runs(block.words(), block.first)
                bounds = np.searchsorted(rows[:, 0], np.arange(hi - lo + 1))
                cells = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in (1, 2, 3)], names=["start", "length", "period"])
                collapsed = joined(block, ~repeated_words(rows, block.first)) if texts else pa.nulls(hi - lo, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(block.counts), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), cells), collapsed], names=names
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(source, run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
