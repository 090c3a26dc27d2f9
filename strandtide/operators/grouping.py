"""Aggregations; each one combines map-side before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandtide.names import quoted
from strandtide.functions import sequence as seqfn
from strandtide.operators.dedup import rank_in_group
from strandtide.runtime import cut_lineage, drop_stored


def collect_per_group(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Ordered members per group, one row per member with its position.

    Long form on purpose: an array per group would bring a group of any size into one task.
    """
    return rank_in_group(df.select(key, value, *[c for c in order if c not in (key, value)]), [key], order).select(
        key, "position", value
    )


def value_counts_on_tips(nodes: DataFrame, feature: str, value: str) -> DataFrame:
    return nodes.filter("is_tip").groupBy(feature, value).agg(F.count(F.lit(1)).alias("n"))


def collapse_rare(
    df: DataFrame, value: str, min_count: int, counted: Column | None = None, by: Sequence[str] = (), other: str = "other"
) -> DataFrame:
    """Values seen fewer than `min_count` times among the counted rows become `other`."""
    rows = df if counted is None else df.filter(counted)
    frequent = (
        rows.groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= min_count)
        .select(*by, value, F.lit(True).alias("_frequent"))
    )
    joined = df.join(frequent, [*by, value], "left")
    out = F.when(F.col("_frequent"), F.col(value)).otherwise(F.lit(other))
    return joined.withColumn(value, out).select(quoted(df.columns))


def max_numeric_suffix(df: DataFrame, col: str) -> DataFrame:
    """Largest number inside the ids, 0 when there is none."""
    number = F.regexp_extract(F.col(col), r"(\d+)", 1).try_cast("long")
    return df.agg(F.coalesce(F.max(number), F.lit(0)).cast("long").alias("max_id"))


def change_class(delta: Column) -> Column:
    return F.when(delta > 0, "more").when(delta < 0, "fewer").otherwise("same")


def record_count_delta(new: DataFrame, old: DataFrame) -> DataFrame:
    """Row counts of two tables, their difference and its class, in one grouping."""
    both = new.select(F.lit(1).alias("_new")).unionAll(old.select(F.lit(0).alias("_new")))
    counts = both.agg(
        F.coalesce(F.sum("_new"), F.lit(0)).alias("n_new"),
        F.coalesce(F.sum(1 - F.col("_new")), F.lit(0)).alias("n_old"),
    ).withColumn("delta", F.col("n_new") - F.col("n_old"))
    return counts.withColumn("change", change_class(F.col("delta")))


def retention_summary(df: DataFrame, kept: Column) -> DataFrame:
    n_kept = F.count_if(F.coalesce(kept, F.lit(False)))
    total = F.count(F.lit(1))
    return df.agg(total.alias("n_input"), n_kept.alias("n_kept"), (total - n_kept).alias("n_removed"))


def composition_index(seqs: DataFrame, seq: str = "seq") -> DataFrame:
    return seqs.select("id", *[c.alias(f"n_{k}") for k, c in seqfn.composition(F.col(seq)).items()])


def exact_quantiles(df: DataFrame, col: str, shares: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation, from global ranks: no task ever holds all values.

    Equal values are counted first, so a value that most rows share is one row of what is ranked.
    """
    counted = df.select(F.col(f"`{col}`").alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("_n"))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    laid = cut_lineage(counted.repartitionByRange(parts, "v").withColumn("_slice", F.spark_partition_id()))
    sizes = laid.groupBy("_slice").agg(F.sum("_n").alias("_size"))
    # one row for each slice
    before = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    inside = F.sum("_n").over(Window.partitionBy("_slice").orderBy("v"))
    ranked = laid.withColumn("_last", inside).join(F.broadcast(shift), "_slice").select("v", (F.col("_last") + F.col("_shift")).alias("_last"), "_n")
    n = sizes.agg(F.sum("_size").alias("n")).first()["n"]
    if n is None:
        return [None] * len(shares)
    spots = [(n - 1) * q for q in shares]
    wanted = sorted({int(x) + d for x in spots for d in (1, 2) if int(x) + d <= n})
    # at most two rows per share come back
    holds = F.exists(F.array(*[F.lit(w) for w in wanted]), lambda w: (w <= F.col("_last")) & (w > F.col("_last") - F.col("_n")))
    rows = ranked.filter(holds).collect()
    drop_stored(laid)
    at = {w: r["v"] for r in rows for w in wanted if r["_last"] - r["_n"] < w <= r["_last"]}
    return [at[int(x) + 1] + (at.get(int(x) + 2, at[int(x) + 1]) - at[int(x) + 1]) * (x - int(x)) for x in spots]
