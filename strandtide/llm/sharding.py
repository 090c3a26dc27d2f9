"""Sharding by best-fit-decreasing packing of indivisible groups.

Rows of equal text form one group and stay together. Groups larger than a grain (a small share of a
shard) are packed one by one; smaller ones share a bin of the hash of their text, and such a bin is packed
like a group. Both kinds are limited in number by the shard count over the grain, whatever the table
holds, so the packing itself is a small sorted list, and rows find their shard by two broadcast tables of
that bounded size.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandtide.llm.common import group_bounds, in_groups
from strandtide.runtime import cut_lineage

GRAINS_PER_SHARD = 256
SHARDS_PER_REGION = 64


class CapacityTree:
    """Remaining capacities in a balanced search tree (a treap whose priorities come from the bin number)."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    @staticmethod
    def _node(key):
        return [key, (key[1] * 2654435761) & 0xFFFFFFFF, None, None]

    def _split(self, node, key):
        """Trees of the keys below `key` and of the rest."""
        if node is None:
            return None, None
        if node[0] < key:
            left, right = self._split(node[3], key)
            node[3] = left
            return node, right
        left, right = self._split(node[2], key)
        node[2] = right
        return left, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def add(self, room: int, number: int) -> None:
        left, right = self._split(self.root, (room, number))
        self.root = self._join(self._join(left, self._node((room, number))), right)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes out the bin with the least room that is at least `size`."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        at = right
        while at[2] is not None:
            at = at[2]
        found = at[0]
        _, rest = self._split(right, (found[0], found[1] + 1))
        self.root = self._join(left, rest)
        return found


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size, for sizes in descending order; a new bin opens only when none has room.

    A size above the capacity gets a bin of its own.
    """
    tree, bins, out = CapacityTree(), 0, []
    for size in sizes:
        found = tree.tightest(size)
        if found is None:
            found, bins = (max(capacity, size), bins), bins + 1
        tree.add(found[0] - size, found[1])
        out.append(found[1])
    return out


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """Bins 0 to `shards` - 1 for sizes in descending order: best fit at the least capacity that needs no more bins.

    A size above the mean of what is left takes a bin alone, so one giant group does not raise the capacity
    of the others.
    """
    alone, total = 0, sum(sizes)
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) > total:
        total -= sizes[alone]
        alone += 1
    rest, room = sizes[alone:], shards - alone
    if not rest:
        return list(range(alone))
    low = max(rest[0], math.ceil(total / room))
    high = low + rest[0]
    step = max(1, low // 2000)
    best = best_fit_decreasing(rest, high)
    while max(best) >= room:
        high += rest[0]
        best = best_fit_decreasing(rest, high)
    while high - low > step:
        middle = (low + high) // 2
        tried = best_fit_decreasing(rest, middle)
        if max(tried) < room:
            best, high = tried, middle
        else:
            low = middle + 1
    return list(range(alone)) + [alone + b for b in best]


def _packed(items, shards: int | None, capacity: int | None) -> list[tuple]:
    ordered = sorted(items, key=lambda r: (-r["bytes"], r["kind"], r["key"]))
    sizes = [int(r["bytes"]) for r in ordered]
    bins = pack_into(sizes, shards) if capacity is None else best_fit_decreasing(sizes, capacity)
    return [(r["kind"], r["key"], b) for r, b in zip(ordered, bins, strict=True)]


def shard(docs: DataFrame, shards: int | None = 24, capacity: int | None = None, overhead: int = 8) -> DataFrame:
    """`doc_id`, `size`, `text_crc32`, `text_key`, `shard`, `slot` for every row of `docs` (doc_id, text, more).

    With `shards`, the sizes of that many shards are made nearly equal; with `capacity` (bytes), as few shards
    of that size as best fit finds are filled, region by region (see `_by_capacity`). A size is the text's UTF-8 bytes plus
    `overhead`; null counts as empty text, and both are one group. `slot` numbers a shard's rows without gaps, by doc_id
    (nulls first). Equal rows are interchangeable. Other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lean = cut_lineage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key"),
        )
    )
    total = lean.agg(F.sum("size").alias("n")).first()["n"] or 0
    placed = _by_capacity(lean, total, capacity) if capacity is not None else _by_count(lean, total, shards)
    return number(placed, "shard", ["doc_id", "text_key"], "slot")


def _items(lean: DataFrame, grain: int, bucket: Column, *by: Column) -> DataFrame:
    """(*by, kind, key, bytes): groups of at least `grain` bytes (kind 0), and the hash bins of smaller ones (kind 1)."""
    groups = lean.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    # at most total / grain groups reach the grain
    marked = cut_lineage(groups.where(F.col("bytes") >= grain).select("text_key", "bytes"))
    large = marked.select(*by, F.lit(0).alias("kind"), F.hex("text_key").alias("key"), "bytes")
    names = [c for c in large.columns if c not in ("kind", "key", "bytes")]
    small = groups.where(F.col("bytes") < grain).groupBy(*by, bucket.cast("string").alias("key")).agg(F.sum("bytes").alias("bytes")).select(*names, F.lit(1).alias("kind"), "key", "bytes")
    return large.union(small)


def _by_count(lean: DataFrame, total: int, shards: int) -> DataFrame:
    grain = max(1, (total // shards) // GRAINS_PER_SHARD)
    bins = max(1, total // grain)
    bucket = F.pmod(F.xxhash64("text_key"), F.lit(bins))
    # there are as many hash bins as groups that reach the grain
    found = _packed(_items(lean, grain, bucket).collect(), shards, None)
    spark = lean.sparkSession
    names = "key string, shard int"
    of_large = spark.createDataFrame([(k, b) for kind, k, b in found if kind == 0], names).select(F.unhex("key").alias("text_key"), F.col("shard").alias("own"))
    of_small = spark.createDataFrame([(int(k), b) for kind, k, b in found if kind == 1], "bucket long, shard int").select("bucket", F.col("shard").alias("shared"))
    return (
        lean.join(F.broadcast(of_large), "text_key", "left")
        .withColumn("bucket", bucket)
        .join(F.broadcast(of_small), "bucket", "left")
        .withColumn("shard", F.coalesce("own", "shared"))
        .drop("own", "shared", "bucket")
    )


def _by_capacity(lean: DataFrame, total: int, capacity: int) -> DataFrame:
    """Shards of `capacity` bytes, packed in the tasks.

    Groups are dealt by hash into regions of about SHARDS_PER_REGION shards, each of which one task packs on its own: at
    most 2 * GRAINS_PER_SHARD items for a shard, whatever the table holds. Shards are numbered through region after region.
    Against packing everything together a region may have one shard more that is not full.
    """
    regions = max(1, -(-total // (capacity * SHARDS_PER_REGION)))
    grain = max(1, capacity // GRAINS_PER_SHARD)
    region = F.pmod(F.xxhash64("text_key", F.lit("region")), F.lit(regions)).cast("int").alias("region")
    bucket = F.pmod(F.xxhash64("text_key"), F.lit(max(1, total // grain // regions)))

    def run(batches):
        for table in in_groups(batches, ["region"]):
            bounds = group_bounds(table, ["region"])
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                part = table.slice(lo, hi - lo).to_pylist()
                kinds, keys, bins = zip(*_packed(part, None, capacity), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([part[0]["region"]] * len(kinds), pa.int32()), pa.array(kinds, pa.int32()), pa.array(keys), pa.array(bins, pa.int64())], names=["region", "kind", "key", "bin"])

    items = _items(lean, grain, bucket, region).repartition("region").sortWithinPartitions("region")
    bins = cut_lineage(items.mapInArrow(run, "region int, kind int, key string, bin long"))
    # one row for each region
    counts = bins.groupBy("region").agg((F.max("bin") + 1).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("region").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("region", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = bins.join(first, "region").withColumn("shard", (F.col("first") + F.col("bin")).cast("int"))
    of_large = numbered.where("kind = 0").select(F.unhex("key").alias("text_key"), F.col("shard").alias("own"))
    of_small = numbered.where("kind = 1").select("region", F.col("key").cast("long").alias("bucket"), F.col("shard").alias("shared"))
    placed = lean.join(of_large, "text_key", "left").withColumns({"region": region, "bucket": bucket}).join(of_small, ["region", "bucket"], "left")
    return placed.withColumn("shard", F.coalesce("own", "shared")).drop("own", "shared", "bucket", "region")


def number(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Numbers the rows of each group from 0 in the given order, however large a group is.

    Rows are range-partitioned and sorted; the id that Spark gives them in that order holds the partition
    and the place in it, and the counts of each group by partition, one row for each of them, shift it.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(partitions, group, *order).sortWithinPartitions(group, *order)
    stored = cut_lineage(spread.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
    counts = stored.groupBy(group, "_part").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_from")).alias("_shift"))
    # at most one row for each partition and group that meet: partitions + groups
    return stored.join(F.broadcast(shift), [group, "_part"]).withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
