"""Finds test items inside documents of any length, by size-partitioned MinHash containment.

Signatures of whole documents say nothing about a short item inside a long text: the two sets differ too
much in size. So only items have signatures, and a document is asked which of an item's minima it
contains. Items are partitioned by size, powers of two of their shingle count, and each partition has as
many minima as its largest items need so that whatever share of shingles may be missing, at least one
minimum is still there: more minima than shingles that may be missing. Candidates are therefore complete.
They are verified by counting the item's shingles in the document's whole set.

The order behind the minima puts shingles of few items first and is random otherwise, so a phrase that
many items share does not bring every document with it together with every item.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandtide.llm.common import LETTERS, bit_filter, blocks, distinct_per_text, map_batches, only_words, passes, row_key, signed
from strandtide.runtime import cut_lineage

FILTER_BITS = 1 << 26


def _shingles(batch: pa.RecordBatch, lengths: list[int]):
    """(from, to, sorted distinct hashes of word runs of any of `lengths`, bounds, runs of the last length by text); letters lowered."""
    for lo, hi, block in blocks(pc.utf8_lower(batch.column("text")), LETTERS):
        words = block.words()
        found = [block.runs(words, n) for n in lengths]
        if len(found) == 1:
            values, bounds = found[0][0], found[0][2]
        else:
            sizes = np.stack([np.diff(b) for _, _, b in found])
            bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes.sum(axis=0))])
            values = np.empty(bounds[-1], dtype=np.uint64)
            at = bounds[:-1].copy()
            for (own, _, of), size in zip(found, sizes, strict=True):
                values[np.arange(len(own)) + np.repeat(at - of[:-1], size)] = own
                at += size
        values, bounds = distinct_per_text(values, bounds)
        yield lo, hi, block, words, values, bounds


def item_shingles(items: DataFrame, words: int) -> DataFrame:
    """`item`, `item_id`, `n_item`, `n_words`, `hash`: the distinct shingles of each item; an item of fewer words is one as a whole.

    `n_words` are the words of a shingle of the item: `words`, or all of a shorter one.
    """

    def run(batches):
        for batch in batches:
            for lo, hi, block, hashed, values, bounds in _shingles(batch, [words]):
                short = np.flatnonzero((block.counts > 0) & (block.counts < words))
                own = {int(i): block.whole(hashed, int(i)) for i in short}
                parts = [own.get(i, values[bounds[i] : bounds[i + 1]]) for i in range(hi - lo)]
                sizes = np.array([len(x) for x in parts])
                of = np.repeat(np.arange(hi - lo), sizes)
                at = pa.array(of + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(at), batch.column("item_id").take(at), pa.array(np.repeat(sizes, sizes)), pa.array(np.minimum(block.counts, words)[of]), pa.array(signed(np.concatenate([np.zeros(0, np.uint64), *parts])))],
                    names=["item", "item_id", "n_item", "n_words", "hash"],
                )

    source = items.select(row_key("item_id").alias("item"), F.col("item_id").cast("long").alias("item_id"), "text").dropDuplicates(["item"]).withColumn("text", only_words(F.col("text")))
    return map_batches(source, run, "item long, item_id long, n_item long, n_words long, hash long")


def minima(shingles: DataFrame, share: float) -> DataFrame:
    """The minima of each item: (item, n_item, hash), as many as its size partition has."""
    spread = shingles.groupBy("hash").agg(F.count(F.lit(1)).alias("items"))
    order = Window.partitionBy("item").orderBy("items", F.xxhash64("hash"), "hash")
    largest = F.expr("shiftleft(2L, cast(floor(log2(n_item)) as int)) - 1")
    needed = F.floor(largest * (1 - share) + 1e-9) + 1
    return shingles.join(spread, "hash").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= needed).select("item", "n_item", "hash")


def contained(docs: DataFrame, items: DataFrame, words: int = 5, share: float = 0.8) -> DataFrame:
    """`row`, `doc_id`, `item_id`, `n_item`, `n_found`, `containment` for every document that has at least `share`
    of the distinct shingles of an item.

    `docs` has doc_id and text, `items` item_id and text; other columns are ignored. Words are runs of letters and
    digits of any script in lower case, so marks between words do not hide a passage; letters of scripts without blanks are words of
    their own. An item of fewer than `words` words has one shingle, all of its words in order. Texts without words match nothing. Repeated rows give one result for each distinct (id, text) pair. `row` is `common.row_key()`.
    """
    wanted = cut_lineage(item_shingles(items, words))
    cells = bit_filter(wanted, "hash", FILTER_BITS)
    # at most `words` numbers: the lengths of shorter items
    lengths = sorted({words, *(r["n_words"] for r in wanted.select("n_words").distinct().collect())})

    def run(batches):
        for batch in batches:
            for lo, _, _, _, values, bounds in _shingles(batch, lengths):
                found = np.flatnonzero(passes(cells, values))
                text = np.searchsorted(bounds, found, side="right") - 1
                of = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays([batch.column("row").take(of), batch.column("doc_id").take(of), pa.array(np.diff(bounds)[text]), pa.array(signed(values[found]))], names=["row", "doc_id", "n_doc", "hash"])

    source = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), only_words(F.col("text")).alias("text"))
    hits = cut_lineage(map_batches(source, run, "row long, doc_id long, n_doc long, hash long").distinct())
    needed = lambda c: F.ceil(F.col(c) * share - 1e-9)
    candidates = hits.join(minima(wanted, share), "hash").where(F.col("n_doc") >= needed("n_item")).select("row", "item").distinct()
    asked = cut_lineage(candidates).join(wanted, "item")
    counted = asked.join(hits.select("row", "doc_id", "hash"), ["row", "hash"]).groupBy("row", "doc_id", "item", "item_id", "n_item").agg(F.count(F.lit(1)).alias("n_found"))
    return counted.where(F.col("n_found") >= needed("n_item")).select("row", "doc_id", "item_id", "n_item", "n_found", (F.col("n_found") / F.col("n_item")).alias("containment"))


def without_items(docs: DataFrame, items: DataFrame, words: int = 5, share: float = 0.8) -> DataFrame:
    """The rows of `docs` that contain no item, unchanged."""
    rows = cut_lineage(contained(docs, items, words, share).select("row").distinct())
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_key().alias("row"))
    return marked.join(rows, "row", "left_anti").select("doc.*")
