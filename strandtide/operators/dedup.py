"""Keep-first and keep-last, best rows, top-n per group, ranks and running ids.

File order is a column here, never the order of rows. `row_number() <= n` lets Spark cut every
partition to n rows per key before the shuffle, so a key that holds a third of all rows stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandtide.names import quoted
from strandtide.runtime import cut_lineage

Order = Sequence[str | Column]


def keep_first(df: DataFrame, key: Sequence[str], order: Order) -> DataFrame:
    return top_n(df, key, order, 1)


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_n(df, key, [F.desc(c) for c in order], 1)


def top_n(df: DataFrame, key: Sequence[str], order: Order, n: int) -> DataFrame:
    spot = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    if n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return df.withColumn("_rn", spot).filter(F.col("_rn") <= n).drop("_rn")
    # above the planner's own limit: the same cut in two steps, first per salted part of a group
    part = Window.partitionBy(*key, "_salt").orderBy(*order)
    cut = (
        df.withColumn("_salt", F.pmod(F.xxhash64(*quoted(df.columns)), F.lit(64)))
        .withColumn("_rn", F.row_number().over(part))
        .filter(F.col("_rn") <= n)
        .drop("_salt", "_rn")
    )
    return cut.withColumn("_rn", spot).filter(F.col("_rn") <= n).drop("_rn")


def rmdup_sequences(seqs: DataFrame) -> DataFrame:
    return keep_first(seqs, ["id"], ["ord"])


def best_hit(hits: DataFrame) -> DataFrame:
    """One hit per query: longest, then smallest e-value, then file order."""
    return top_n(hits, ["qseqid"], [F.desc("length"), F.asc("evalue"), F.asc("ord")], 1)


def seeded_order(id_col: str, seed: str) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed)))


def subsample_per_group(
    df: DataFrame, keys: Sequence[str], n: int, id_col: str, seed: str = "0", force_keep: Column | None = None
) -> DataFrame:
    """At most n rows per group in seeded order; rows with a null group key drop out; forced rows are added back."""
    forced = F.lit(False) if force_keep is None else F.coalesce(force_keep, F.lit(False))
    pool = df.filter(~forced).dropna(subset=list(keys))
    sample = top_n(pool, keys, [seeded_order(id_col, seed), F.col(id_col)], n)
    return sample if force_keep is None else sample.unionByName(df.filter(forced))


def sample_n(df: DataFrame, n: int, id_col: str, seed: str = "0") -> DataFrame:
    """n rows in seeded order: every partition keeps its own n first."""
    return df.orderBy(seeded_order(id_col, seed), id_col).limit(n)


def sort_by(df: DataFrame, *order: str | Column) -> DataFrame:
    return df.orderBy(*order)


def rank_in_group(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """Exact 1-based rank within each group without bringing a group together in one task.

    Rows are range-partitioned by (key, order) and that layout is checkpointed; ranks are counted
    inside each slice and shifted by the slices before it, of which there are few.
    """
    group, cols = quoted(key), quoted([*key, *order])
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    laid = cut_lineage(df.repartitionByRange(parts, *cols).withColumn("_slice", F.spark_partition_id()))
    sizes = laid.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(*group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*cols))
    ranked = laid.withColumn("_rn", inside)
    # null keys must find their shift, too
    on = [F.col("l._slice") == F.col("s._slice"), *[F.col(f"l.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in key]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = ranked.alias("l").join(shift.alias("s"), cond, "left")
    return joined.select(*[F.col(f"l.`{c}`") for c in df.columns], (F.col("l._rn") + F.col("s._shift")).alias(name))


def assign_sequential_ids(names: DataFrame, col: str, start: int | DataFrame, fmt: str = "X%07d") -> DataFrame:
    """New ids in name order, continuing after `start` (a number, or a one-row table with column `max_id`)."""
    ranked = rank_in_group(names, [], [col], "_i")
    if isinstance(start, int):
        return ranked.select(*names.columns, F.format_string(fmt, F.col("_i") + F.lit(start)).alias("new_id"))
    base = start.first()["max_id"]
    return ranked.select(*names.columns, F.format_string(fmt, F.col("_i") + F.lit(base)).alias("new_id"))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
