"""Fingerprints by consistent weighted sampling.

The weight of a word in a text is 1 + ln(occurrences). For each of the samples every word draws, from its
hash alone, two gamma variables and a uniform one; the word's weight picks a step t of a grid whose width
is the first gamma variable, and the word with the least value of the second one over the grid point above
t is the sample. Two texts draw the same sample with a probability that equals their generalised Jaccard
similarity, sum of least weights over sum of greatest. The least value depends on (word, t) alone, so its
low bits are the sample's name.

A text is compared with the document that follows it by id. Documents are range-partitioned and sorted, so
the next one is the next row; only the last text of a partition meets the first of the following one in a
second step, two texts for each partition.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandtide.llm.common import NOT_SPACE, Block, map_batches, mix
from strandtide.runtime import cut_lineage

SAMPLES = 64
PART_BYTES = 2 << 20


def _unit(x: np.ndarray) -> np.ndarray:
    """24 bits as numbers in (0, 1)."""
    return ((x & np.uint64(0xFFFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)


def signatures(texts: list[bytes]) -> np.ndarray:
    """16-bit samples, one row for each text; a text without words has zeros."""
    out = np.zeros((len(texts), SAMPLES), dtype=np.uint16)
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(t) for t in texts])])
    block = Block(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets, NOT_SPACE)
    hashed, first = block.words(), block.first.tolist()
    found = [np.unique(hashed[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
    sizes = np.array([len(x) for x, _ in found])
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    words, at = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
    weight = np.log1p(np.log(np.concatenate([n for _, n in found]))).astype(np.float32)
    several = np.flatnonzero(weight)
    of_several, log_weight = at[several], weight[several]
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes[full])[:-1]])
    for k in range(SAMPLES):
        one = mix(words + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        two = mix(one ^ np.uint64(0x2545F4914F6CDD1D))
        step = -np.log(_unit(one) * _unit(one >> np.uint64(24)))
        value = np.log(-np.log(_unit(two) * _unit(two >> np.uint64(24))))
        shift = ((one >> np.uint64(48)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-16)
        # a weight of 1 stands at step 0 of the grid
        least = (value - step * (np.float32(1) - shift))[at]
        s, b = step[of_several], shift[of_several]
        least[several] = value[of_several] - s * (np.floor(log_weight / s + b) + (np.float32(1) - b))
        lowest = np.minimum.reduceat(least, bounds)
        out[full, k] = (mix(lowest.view(np.uint32).astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many of the first of `following`, or all it has."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


_RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _results(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """Result columns for texts and the text after each."""
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    n = len(texts)
    # every following text but the last is mostly the next row itself; signing it again would be wasted
    ahead = [b for a, b in zip([*texts[1:], None], following, strict=True) if a is not b]
    raw = [x.encode() for x in changed]
    signs = signatures([*[x.encode() for x in texts], *raw, *[x.encode() for x in ahead]])
    own, other, extra = signs[:n], signs[n : 2 * n], iter(signs[2 * n :])
    after = np.stack([own[i + 1] if i + 1 < n and texts[i + 1] is following[i] else next(extra) for i in range(n)])
    name = lambda s, t: s.tobytes().hex() if t.strip(" \t\n\v\f\r") else ""
    both_empty = lambda a, b: not a.strip(" \t\n\v\f\r") and not b.strip(" \t\n\v\f\r")
    one_empty = lambda a, b: bool(a.strip(" \t\n\v\f\r")) != bool(b.strip(" \t\n\v\f\r"))
    fix = lambda v, x, y: [1.0 if both_empty(a, b) else 0.0 if one_empty(a, b) else float(p) for p, a, b in zip(v, x, y, strict=True)]
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
        pa.array([name(s, t) for s, t in zip(own, texts, strict=True)], pa.string()),
        pa.array([name(s, t) for s, t in zip(other, changed, strict=True)], pa.string()),
        pa.array(fix(likeness(own, other), texts, changed), pa.float64()),
        pa.array(fix(likeness(own, after), texts, following), pa.float64()),
    ]


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of `docs` (doc_id, text, more) and of its edited text, and how near they are.

    Columns as in `_SCHEMA`. The next document is that with the next doc_id, null ids last, equal ids by a hash of the
    text; after the last comes the first. Null texts count as empty. A fingerprint is 64 samples of 16 bits in hex, and
    empty for a text without words, which is like another such text (1) and unlike all others (0).
    """

    def run(batches):
        part, first, last = TaskContext.get().partitionId(), None, None
        extra = [("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string())]

        def row(kind, doc_id, text):
            columns = [pa.array([doc_id], pa.int64()), pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.string())] * 3, *[pa.nulls(1, pa.float64())] * 2, pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([text])]
            return pa.RecordBatch.from_arrays(columns, names=[*_RESULT, *[n for n, _ in extra]])

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            if not ids:
                continue
            if first is None:
                first = True
                yield row(1, None, texts[0])
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            last = ids[-1], texts[-1]
            lo = 0
            while lo < len(texts) - 1:
                hi, size = lo, 0
                while hi < len(texts) - 1 and (hi == lo or size < PART_BYTES):
                    size += len(texts[hi])
                    hi += 1
                columns = _results(ids[lo:hi], texts[lo:hi], texts[lo + 1 : hi + 1])
                yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(hi - lo, t) for _, t in extra]], names=[*_RESULT, *[n for n, _ in extra]])
                lo = hi
        if last is not None:
            yield row(2, *last)

    def resolve(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(_results(one.column("doc_id").to_pylist(), one.column("text").to_pylist(), one.column("following").to_pylist()), names=_RESULT)

    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("doc_id", "text")
    found = cut_lineage(map_batches(ordered, run, _SCHEMA + ", kind int, part int, text string"))
    ends, heads = found.where("kind = 2").select("doc_id", "text", "part"), found.where("kind = 1")
    # one number for each partition
    by_part = Window.partitionBy(F.lit(0)).orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = heads.select("part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(whole)).alias("to"))
    met = ends.join(turn, "part").join(heads.select(F.col("part").alias("to"), F.col("text").alias("following")), "to")
    return found.where("kind is null").select(*_RESULT).union(map_batches(met.select("doc_id", "text", "following"), resolve, _SCHEMA))
