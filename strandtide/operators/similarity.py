"""Identity between sequences, near-identical copies and nearest neighbours."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandtide.functions import sequence as seqfn
from strandtide.operators.dedup import top_n
from strandtide.operators.nearest import best_in_groups
from strandtide.operators.seeds import sequence_key
from strandtide.runtime import broadcast_when_small, cut_lineage, drop_stored

# Texts that a task remembers, and blocks that it gives at once.
TEXTS_MET, BLOCKS_A_BATCH = 1 << 16, 1 << 20


def strain_representatives(seqs: DataFrame, strain: str) -> DataFrame:
    """(strain, kept_id) for strains of two or more: the longest sequence, ties to the smallest id.

    Only ids and lengths are grouped, combined before the shuffle; no sequence moves here.
    """
    sizes = seqs.select(strain, "id", F.length("seq").alias("_n"))
    best = F.min_by("id", F.struct(-F.col("_n"), F.col("id"))).alias("kept_id")
    return sizes.dropna(subset=[strain]).groupBy(strain).agg(best, F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").drop("_rows")


def near_identical(seqs: DataFrame, strain: str, threshold: float) -> DataFrame:
    """Ids whose identity to their strain's longest sequence is above the threshold.

    Each sequence meets one partner only, so a strain that holds a third of all rows costs one pass;
    the partner side has one row per strain, which lets the planner split a hot strain.
    """
    texts = seqs.select(F.col("id").alias("kept_id"), F.col("seq").alias("_kept"))
    kept = strain_representatives(seqs, strain).join(texts, "kept_id")
    pairs = seqs.join(kept, strain).filter(F.col("id") != F.col("kept_id"))
    # the shorter over the longer bounds the identity, so most pairs need no comparison
    possible = F.least(F.length("seq"), F.length("_kept")) > threshold * F.greatest(F.length("seq"), F.length("_kept"))
    scored = pairs.filter(possible).withColumn("identity", seqfn.pairwise_identity(F.col("seq"), F.col("_kept")))
    return scored.filter(F.col("identity") > threshold).select("id", "kept_id", strain, "identity")


def dedup_near_identical(seqs: DataFrame, strain: str, threshold: float = 0.995) -> DataFrame:
    """Keep the longest of each strain and what differs enough from it; rows without a strain stay."""
    dropped = near_identical(seqs, strain, threshold).select("id")
    return seqs.join(dropped, "id", "left_anti")


def identity_pairs(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    return pairs.withColumn("identity", seqfn.pairwise_identity(F.col(a), F.col(b)))


def distinct_number(keys: DataFrame, key: str) -> Column:
    """An expression that gives each key of a table (one row each) a number of its own: a hash whose seed lets no two keys meet."""
    seed = 0
    while not keys.groupBy(F.xxhash64(key, F.lit(seed))).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
        seed += 1
    return F.xxhash64(key, F.lit(seed))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed number for each of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_hashes(text: np.ndarray, width: int) -> np.ndarray:
    """A hash of the place and the letters of each block of a text."""
    at = np.arange(len(text), dtype=np.uint64)
    factors = _mixed(at % np.uint64(width) + np.uint64(1)) | np.uint64(1)
    sums = np.add.reduceat((text + np.uint64(1)) * factors, np.arange(0, len(text), width))
    return _mixed(_mixed(sums) + at[: len(sums)] * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def block_rows(width: int):
    """(g, t): the hashed blocks of texts (t, raw). A copy that a task meets again is left out, as far as its memory of texts goes."""

    def run(batches):
        met: set[int] = set()
        for batch in batches:
            found, owners, held = [], [], 0
            for t, raw in zip(batch.column("t").to_pylist(), batch.column("raw"), strict=True):
                if t in met:
                    continue
                if len(met) >= TEXTS_MET:
                    met.clear()
                met.add(t)
                found.append(block_hashes(np.frombuffer(raw.as_buffer(), dtype=np.uint8), width))
                owners.append(np.full(len(found[-1]), t, dtype=np.int64))
                held += len(found[-1])
                if held >= BLOCKS_A_BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found, owners)], names=["g", "t"])
                    found, owners, held = [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found, owners)], names=["g", "t"])

    return run


def of_near_lengths(members: DataFrame, bound: float) -> DataFrame:
    """(g, key) of `members` (g, key, n), each group cut where lengths leave a gap that no pair within the bound spans; nobody is alone."""
    by_length = Window.partitionBy("g").orderBy("n")
    gap = F.when(F.lag("n").over(by_length) < F.col("n") * bound - 1e-6, 1).otherwise(0)
    runs = members.withColumn("_gap", gap).withColumn("_run", F.sum("_gap").over(by_length))
    sized = runs.withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy("g", "_run")))
    return sized.filter("_m > 1").select(F.xxhash64("g", "_run").alias("g"), "key")


def neighbours(seqs: DataFrame, k: int, min_identity: float = 0.995) -> DataFrame:
    """The k nearest sequences with identity of at least `min_identity`: (id, neighbour, identity, rank).

    A text without a partner at the bound has no row, and one with fewer than k has as many. Letters are bytes.

    Exact for that bound. Copies are grouped first and only k + 1 ids of a group can ever be
    neighbours, so groups of copies produce no pairs. For the rest, texts are cut into blocks by
    position: partners differ in few blocks, so they share one of the rarest blocks of each (prefix filter). A block is
    shuffled as two numbers, and only letters of texts that share a rare block with one of a fitting length move.
    Texts that share such a block are compared in their group (`nearest.best_in_groups`), which gives the k best
    of each text and never the pairs of a cluster.
    """
    if not 0.5 < min_identity <= 1.0:
        raise ValueError("min_identity must be above 0.5: below it texts need not share a block")
    slack = 1.0 - min_identity
    # with n / width > slack * n / min_identity every text has more blocks than a partner's differing positions can spoil; three
    # quarters of that width leave a quarter of its blocks over, so a text that shares fewer with any other has no candidates
    width = max((math.ceil(min_identity / slack - 1e-9) - 1) * 3 // 4, 1) if slack > 0 else 1 << 30
    # the letters are made and stored once; a text is told by its digest, which is numbered below
    stored = cut_lineage(seqs.select("id", sequence_key("seq"), F.encode("seq", "utf-8").alias("raw")).withColumn("n", F.length("raw")).filter("n > 0"), codec="zstd")
    firsts = stored.groupBy("key").agg(F.min("id").alias("first"), F.first("n").alias("n"))
    texts = cut_lineage(firsts)
    number = distinct_number(texts, "key").alias("t")
    numbered = texts.select("key", "n", number)

    # a block that two texts have comes once for each of them; all others are known by their count
    blocks = stored.select(number, "raw").mapInArrow(block_rows(width), "g long, t long")
    in_block = Window.partitionBy("g").orderBy("t")
    before = F.lag("t").over(in_block)
    once = blocks.withColumn("_new", F.when(before == F.col("t"), 0).otherwise(1))
    shared = once.withColumn("_df", F.sum("_new").over(Window.partitionBy("g"))).filter("_new = 1 and _df > 1").select("g", "t", "_df")
    # partners of a text of n letters have at most n / min_identity letters
    longest = F.floor(F.col("n") / min_identity + F.lit(1e-9))
    budget = F.floor(slack * longest + F.lit(1e-9)).cast("int")
    alone = F.ceil(F.col("n") / width) - F.count(F.lit(1)).over(Window.partitionBy("t"))
    rarity = Window.partitionBy("t").orderBy("_df", "g")
    ranked = shared.join(numbered, "t").withColumns({"_alone": alone, "_r": F.row_number().over(rarity)})
    prefix = ranked.filter(F.col("_alone") + F.col("_r") <= budget + 1).select("g", "key", "n")
    members = cut_lineage(of_near_lengths(prefix, min_identity))
    wanted = cut_lineage(texts.join(members.select("key").distinct(), "key", "left_semi").select("key", "first"))
    lettered = stored.select("key", "raw").join(broadcast_when_small(wanted), "key")
    compared = cut_lineage(lettered.groupBy("key", "first").agg(F.first("raw").alias("raw")), codec="zstd")
    ids = cut_lineage(stored.select("id", "key"), replaces=stored)
    both = best_in_groups(members, compared, k, min_identity)
    for used in (members, wanted, compared):
        drop_stored(used)
    # ids worth naming: the first k + 1 of each group of copies
    named = top_n(ids.select("key", "id"), ["key"], ["id"], k + 1)
    # a text needs only its k best partner texts, each with its first k + 1 ids
    near = top_n(both, ["key_a"], [F.desc("identity"), F.asc("first_b")], k).select("key_a", "key_b", "identity")
    own = texts.select(F.col("key").alias("key_a"), F.col("key").alias("key_b"), F.lit(1.0).alias("identity"))
    partners = near.unionByName(own).join(
        named.select(F.col("key").alias("key_b"), F.col("id").alias("neighbour")), "key_b"
    )
    short = top_n(partners.drop("key_b"), ["key_a"], [F.desc("identity"), F.asc("neighbour")], k + 1)
    rows = ids.select("id", F.col("key").alias("key_a")).join(short, "key_a").filter(F.col("id") != F.col("neighbour"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("identity"), F.asc("neighbour")))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("id", "neighbour", "identity", "rank")
