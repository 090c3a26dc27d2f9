"""Hashes of words and word runs over whole Arrow batches, bit filters of fixed size, numbered slices.

Texts are handled as UTF-8 bytes. A word is a maximal run of bytes outside a separator table, and its
hash is a polynomial over its bytes modulo 2^64, taken from one running sum per block of texts; runs of
words are hashed the same way. No Python loop touches single words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 1 << 20
BLOCK_TEXTS = 2048
BATCH_ROWS = 1000
SEEDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from mixed 64-bit hashes."""
    return ((x >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) / np.float32(1 << 24)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, seed: int):
        base = (seed * 2 + 1) % (1 << 64)
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + BLOCK_BYTES // 4)
            self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, self.base)]))
            self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, self.inverse)]))
        return self.up[:n], self.down[:n]


@lru_cache(maxsize=None)
def _powers(which: int) -> _Powers:
    return _Powers(SEEDS[which])


@lru_cache(maxsize=None)
def _letters(which: int, lower: bool) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(SEEDS[1 - which]))
    if lower:
        table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    return table


def _table(separators) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: Bytes that belong to words: all but white space, or letters, digits and everything beyond ASCII.
NOT_SPACE = _table([0x20, *range(0x09, 0x0E)])
LETTERS = _table([b for b in range(128) if not chr(b).isalnum()])


# Scripts that are written without blanks between words.
UNSPACED = "Han Hiragana Katakana Thai Lao Khmer Myanmar".split()


def only_words(text: Column) -> Column:
    """`text` with blanks for everything beyond ASCII that is no letter, digit or mark on a letter, and between the
    letters of scripts that have no blanks: with LETTERS its words are then runs of letters and digits of any script."""
    alone = "".join(rf"\p{{Is{script}}}" for script in UNSPACED)
    plain = F.regexp_replace(text, r"[^\x00-\x7F\p{L}\p{N}\p{M}]+", " ")
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.regexp_replace(plain, f"([{alone}])", " $1 ")).otherwise(text)


class Block:
    """Word positions of some texts: `starts`, `stops` in bytes; words of text i are `first[i]` to `first[i + 1]`."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = word_bytes[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[offsets] = True
        before = np.empty(len(data), dtype=bool)
        after = np.empty(len(data), dtype=bool)
        if len(data):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
        self.starts = np.flatnonzero(inside & (~before | cut[:-1]))
        self.stops = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def words(self, which: int = 0, lower: bool = False) -> np.ndarray:
        """One hash for each word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        up, down = _powers(which).upto(len(self.data))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_letters(which, lower)[self.data] * up)])
        return mix((total[self.stops] - total[self.starts]) * down[self.starts] + (self.stops - self.starts).astype(np.uint64))

    def runs(self, words: np.ndarray, length: int, which: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all runs of `length` words inside one text: (hash, index of the first word, bounds for each text)."""
        n = len(words)
        if n < length:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(self.first), np.int64)
        up, down = _powers(which).upto(n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up)])
        per_text = np.maximum(self.counts - length + 1, 0)
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(per_text)])
        at = np.arange(bounds[-1]) + np.repeat(self.first[:-1] - bounds[:-1], per_text)
        return mix((total[at + length] - total[at]) * down[at] + np.uint64(length)), at, bounds

    def whole(self, words: np.ndarray, i: int) -> np.ndarray:
        """All words of text i as one run, as one-element array."""
        own = words[self.first[i] : self.first[i + 1]]
        return mix(np.sum(own * _powers(0).upto(len(own))[0], keepdims=True) + np.uint64(len(own)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary()) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, word_bytes: np.ndarray = NOT_SPACE, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """(from, to, block) over the rows of a string column; a block has at most `size` bytes and BLOCK_TEXTS texts, or one longer text."""
    data, offsets = utf8(column)
    rows, i = len(offsets) - 1, 0
    while i < rows:
        j = min(max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1), i + BLOCK_TEXTS)
        yield i, j, Block(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], word_bytes)
        i = j


def distinct_per_text(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and their bounds."""
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    return (np.concatenate(parts) if parts else values[:0]), np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; what they took is given back to the system at its end, as workers live on between tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """`mapInArrow` for rows that hold texts: batches of at most BATCH_ROWS rows, memory given back after each task.

    The batch size is a session setting; it is only lowered here, from its default.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(setting)) > BATCH_ROWS:
        df.sparkSession.conf.set(setting, str(BATCH_ROWS))
    return df.mapInArrow(lambda batches: function(tidy(batches)), schema)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def bit_filter(hashes: DataFrame, column: str, bits: int = 1 << 24) -> np.ndarray:
    """A bitmap of `bits` bits in which the low bits of every hash are set; its size is fixed, whatever the input.

    At most bits / 64 pairs of numbers reach the driver. A hash that is in the table always passes
    `passes`; others pass rarely while the table is small against the bitmap. It only thins out rows
    before an exact join, so a full bitmap costs time and changes no result.
    """
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    found = (
        hashes.where(F.col(column).isNotNull())
        .select(F.shiftright(place, 6).alias("cell"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"))
        .groupBy("cell")
        .agg(F.bit_or("bit").alias("bit"))
        .toArrow()
    )
    cells = np.zeros(bits // 64, dtype=np.uint64)
    cells[found.column("cell").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return cells


def passes(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(cells) * 64 - 1)
    return (cells[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Equal for rows of equal id and text only."""
    return F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text))


def known_id(doc_id: str = "doc_id") -> Column:
    """An id that can be joined on; a row without one has the empty text."""
    return F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit(""))


def in_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by `keys`; a group is never cut between two tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changes = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            column = batch.column(k)
            changes[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            changes[0] = True
        last = np.flatnonzero(changes)
        if len(last) and (held or last[-1]):
            if whole := [*held, batch.slice(0, int(last[-1]))]:
                yield pa.Table.from_batches(whole)
            held = [batch.slice(int(last[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    n = table.num_rows
    changes = np.zeros(n, dtype=bool)
    changes[:1] = True
    for k in keys:
        column = table.column(k).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        changes[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(changes), n)


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
