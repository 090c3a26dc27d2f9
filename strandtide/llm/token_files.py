"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A file holds the ids of consecutive documents without separators. Where documents end is a monotone
sequence; it is stored in Elias-Fano form: the low bits of each boundary packed one after the other, the
high bits as unary gaps in a bit string, with the place of every 256th one so that any boundary is found
by a short scan. Document ids ascend as well and are stored the same way. That is about two bits and the
logarithm of the mean length for each document instead of a 64-bit table.

Documents are range-partitioned by doc_id and cut into files inside the partition, so order across files is
(partition, number in it). Files are written and read through Spark's own writers and readers.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandtide.llm.common import map_batches, utf8
from strandtide.runtime import cut_lineage

MAGIC = b"TOKIDS01"
SAMPLE = 256
FILE_BYTES = 8 << 20
CACHED_WORDS = 600_000
_HEAD = struct.Struct("<8sIIQQQqBx")
_SEQUENCE = struct.Struct("<QBxxxxxxxQQ")
# letters whose lower case is one letter and does not depend on what follows; ASCII signs but the apostrophe
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != ord("'"))


class EliasFano:
    """A monotone sequence of non-negative numbers; `get` finds one, `all` decodes all."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, places: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.places = count, low_bits, low, high, places

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        most = int(values[-1]) if n else 0
        bits = max(0, (max(most, 1) // max(n, 1)).bit_length() - 1)
        low = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, dtype=np.uint8)
        high[at] = 1
        return cls(n, bits, np.packbits(low.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), at[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = _SEQUENCE.pack(self.count, self.low_bits, len(self.low), len(self.high))
        return head + self.places.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, bits, low, high = _SEQUENCE.unpack_from(data, at)
        at += _SEQUENCE.size
        samples = -(-n // SAMPLE)
        places = np.frombuffer(data, "<u4", samples, at)
        at += 4 * samples
        one = cls(n, bits, np.frombuffer(data, np.uint8, low, at), np.frombuffer(data, np.uint8, high, at + low), places)
        return one, at + low + high

    def select(self, k: int) -> int:
        """Place of the k-th one (from 0) in the high bits."""
        left, byte = k % SAMPLE, int(self.places[k // SAMPLE])
        bits = np.unpackbits(self.high[byte // 8 : byte // 8 + 32], bitorder="little")[byte % 8 :]
        done = byte
        while True:
            ones = np.flatnonzero(bits)
            if left < len(ones):
                return done + int(ones[left])
            left -= len(ones)
            done += len(bits)
            bits = np.unpackbits(self.high[done // 8 : done // 8 + 256], bitorder="little")

    def get(self, k: int) -> int:
        high = self.select(k) - k
        from_bit = k * self.low_bits
        cut = np.unpackbits(self.low[from_bit // 8 : (from_bit + self.low_bits + 7) // 8], bitorder="little")[from_bit % 8 :][: self.low_bits]
        return (high << self.low_bits) | sum(1 << i for i in np.flatnonzero(cut).tolist())

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little")).astype(np.uint64)[: self.count]
        out = (at - np.arange(self.count, dtype=np.uint64)) << np.uint64(self.low_bits)
        low = np.unpackbits(self.low, bitorder="little", count=self.count * self.low_bits).reshape(self.count, self.low_bits)
        for i in range(self.low_bits):
            out |= low[:, i].astype(np.uint64) << np.uint64(i)
        return out


def _four_bytes(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is printable, else one from 256 on."""
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in itself)
    return {b: 256 + i for i, b in enumerate(others)}


class WordCache(dict):
    """Ids of texts from ids of their white-space-separated pieces; maps a piece to its little-endian 32-bit ids.

    For byte-level tokenizers that treat white space as a separator and nothing more, lower-case letter by letter
    and take letters and other signs apart: then a text's ids are those of its pieces in order, and a piece of plain letters
    and ASCII signs after them is the lowered word's ids and the signs' ids. Plain words go straight to the library's model,
    all other pieces through its whole chain, and each once while it is cached.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.parts: dict[bytes, bytes] = {}

    def _word(self, word: bytes) -> bytes | None:
        """Ids of a word of plain letters whose ASCII letters are lowered; None for anything else."""
        if word.isalpha():
            seen = word.decode()
        elif _LETTERS.fullmatch(text := word.decode()):
            seen = text.lower().encode().decode("latin-1").translate(self.letters)
        else:
            return None
        found = self.parts[word] = _four_bytes([t.id for t in self.model.tokenize(seen)])
        return found

    def _whole(self, piece: bytes) -> bytes:
        return _four_bytes(self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids)

    def __missing__(self, piece: bytes) -> bytes:
        core = piece.rstrip(_SIGNS)
        word = core.lower()
        found = self.parts.get(word) or self._word(word)
        if found is None:
            found = self._whole(piece)
        elif len(core) < len(piece):
            signs = piece[len(core) :]
            found += self.parts.get(signs) or self.parts.setdefault(signs, self._whole(signs))
        self[piece] = found
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > CACHED_WORDS:
            self.clear()
        if len(self.parts) > CACHED_WORDS:
            self.parts.clear()
        return [b"".join(map(self.__getitem__, t.split())) for t in texts]


@lru_cache(maxsize=1)
def _cache(definition: str) -> WordCache:
    return WordCache(definition)


def _encoded(batches, definition: str, end_id: int) -> Iterator[tuple[int | None, bytes]]:
    cache, end = _cache(definition), struct.pack("<I", end_id)
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        raw, ids = data.tobytes(), batch.column("doc_id").to_pylist()
        for lo in range(0, len(ids), 256):
            hi = min(lo + 256, len(ids))
            for doc_id, found in zip(ids[lo:hi], cache.encode([raw[offsets[i] : offsets[i + 1]] for i in range(lo, hi)]), strict=True):
                yield doc_id, found + end


def build(docs: list[tuple[int | None, bytes]], part: int, number: int) -> bytes:
    """One file: header, boundaries, document ids (those that are null come last), ids in 16 or 32 bits."""
    ids = np.frombuffer(b"".join(x for _, x in docs), dtype="<u4")
    ends = np.cumsum([len(x) // 4 for _, x in docs])
    known = np.array([d for d, _ in docs if d is not None], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    gaps = known.view(np.uint64) - np.uint64(first % (1 << 64))
    head = _HEAD.pack(MAGIC, part, number, len(docs), len(ids), len(known), first, width)
    return head + EliasFano.of(ends).to_bytes() + EliasFano.of(gaps).to_bytes() + ids.astype(f"<u{width}").tobytes()


class TokenFile:
    """A file's documents: `doc_ids` (null where unknown), `bounds(k)`, `ids(k)`."""

    def __init__(self, content: bytes):
        magic, self.part, self.number, self.docs, self.total, known, first, self.width = _HEAD.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token file")
        view = memoryview(content)
        self.ends, at = EliasFano.from_bytes(view, _HEAD.size)
        gaps, at = EliasFano.from_bytes(view, at)
        self.known = (gaps.all() + np.uint64(first % (1 << 64))).view(np.int64)
        self.data = np.frombuffer(view, f"<u{self.width}", self.total, at)

    def doc_ids(self) -> list[int | None]:
        return self.known.tolist() + [None] * (self.docs - len(self.known))

    def bounds(self, k: int) -> tuple[int, int]:
        return (self.ends.get(k - 1) if k else 0), self.ends.get(k)

    def ids(self, k: int) -> np.ndarray:
        a, b = self.bounds(k)
        return self.data[a:b]


def write(docs: DataFrame, path: str, definition: str, end_id: int, file_bytes: int = FILE_BYTES) -> None:
    """Encodes every text of `docs` (doc_id, text, more) and writes the files below `path`.

    `definition` is the tokenizer's JSON (see `WordCache` for what it must be like); `end_id` closes each document;
    null texts count as empty. Documents go in ascending doc_id, null last, equal ids by a hash of the text. A file
    is closed once its ids reach `file_bytes`.
    """

    def run(batches):
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for doc_id, found in _encoded(batches, definition, end_id):
            held.append((doc_id, found))
            size += len(found) // 2
            if size >= file_bytes:
                yield pa.RecordBatch.from_arrays([pa.array([build(held, part, number)])], names=["content"])
                number, held, size = number + 1, [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([build(held, part, number)])], names=["content"])

    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("doc_id", "text")
    blobs = map_batches(ordered, run, "content binary")
    # the text writer puts bytes down as they are; the line end after a blob is beyond its lengths
    blobs.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the files below `path`: `doc_id`, `start` (ids before it in all files), `n_tokens`,
    `ids_crc32` (of its ids as little-endian 32-bit numbers), `part`, `number`, `place`."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                # a writer without rows leaves an empty file
                if not (raw := content.as_py()):
                    continue
                one = TokenFile(raw)
                ends = one.ends.all().astype(np.int64)
                starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
                wide = one.data.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                same = lambda x: pa.array(np.full(one.docs, x, dtype=np.int64))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [same(one.part), same(one.number), pa.array(np.arange(one.docs)), pa.array(one.doc_ids(), pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64()), same(one.total)],
                    names=["part", "number", "place", "doc_id", "inside", "n_tokens", "ids_crc32", "total"],
                )

    schema = "part long, number long, place long, doc_id long, inside long, n_tokens long, ids_crc32 long, total long"
    return map_batches(spark.read.format("binaryFile").load(path).select("content"), run, schema)


def with_starts(rows: DataFrame) -> DataFrame:
    """`start` for the rows of `read`: the ids of all files before, by one sum for each partition and one for each file in it."""
    rows = cut_lineage(rows)
    files = rows.where("place = 0").select("part", "number", "total")
    parts = files.groupBy("part").agg(F.sum("total").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    of_part = parts.select("part", before(Window.partitionBy(F.lit(0)).orderBy("part")).alias("base"))
    of_file = files.select("part", "number", F.col("total").alias("n")).withColumn("ahead", before(Window.partitionBy("part").orderBy("number"))).drop("n")
    shift = of_file.join(of_part, "part").select("part", "number", (F.col("base") + F.col("ahead")).alias("shift"))
    return rows.join(shift, ["part", "number"]).withColumn("start", F.col("inside") + F.col("shift")).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "number", "place")
