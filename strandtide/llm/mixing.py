"""Mixing sources to target weights by weighted fair queueing.

Every document gets a place in a shuffled order of its source and there a virtual finish time: the words
of its source up to and including it, divided by the source's target. A source may be passed through more
than once; later passes go on counting. All sources served side by side in order of finish time keep their
targets at any moment, and the mix ends where the total budget is used up.

Running sums go in two steps: rows fall into slices of the shuffled order (leading digits of a hash, so
slices of one source are alike in size however large the source is), are summed inside a slice, and are
shifted by the sums of the slices before. The end of the mix is found the same way over slices of virtual
time. Only the end itself, one row, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandtide.llm.common import WORD, known_id, row_count, row_key
from strandtide.runtime import cut_lineage

ROWS_PER_SLICE = 4096
MAX_DIGITS = 6


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def shares(sources: DataFrame, budget: float, passes: int, weight_of: Callable[[Column], Column]) -> DataFrame:
    """`sources` (source, source_size) with `target`: the budget by weight, no source above `passes` times its size.

    What a source cannot take is shared by weight among the others until none is above. With sources in
    ascending order of size by weight, the first k are full exactly if the rate left for the others exceeds
    their own ratio, so one running sum finds all targets. One row for each source.
    """
    place = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    total = sources.agg(F.sum("source_size").alias("all_size"))
    weighed = sources.withColumn("weight", weight_of(F.row_number().over(place) - 1)).crossJoin(F.broadcast(total))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("all_size") * budget - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * passes
    rate = left / F.sum("weight").over(rest)
    full = weighed.withColumn("rate", rate).withColumn("full", F.col("rate") * F.col("weight") > F.col("source_size") * passes)
    return (
        full.withColumn("open_rate", F.max(F.when(~F.col("full"), F.col("rate"))).over(Window.partitionBy(F.lit(0))))
        .withColumn("target", F.when(F.col("full"), (F.col("source_size") * passes).cast("double")).otherwise(F.col("open_rate") * F.col("weight")))
        .select("source", "source_size", "target")
    )


def _digits(rows: int) -> int:
    digits = 0
    while 16**digits * ROWS_PER_SLICE < rows and digits < MAX_DIGITS:
        digits += 1
    return digits


def mix(docs: DataFrame, weight_of: Callable[[Column], Column], budget: float = 1.5, passes: int = 2, seed: int = 7) -> DataFrame:
    """`doc_id`, `size`, `source`, `source_size`, `target`, `copies`, `taken` and `row` for every row of `docs`.

    `weight_of` turns the place of a source (code-point order, null last, from 0) into its weight; `budget`
    times all words are shared out. `size` counts words outside white space, `copies` says how often the mix
    takes the document, `taken` the words this makes. Rows without words are never taken. Null sources form
    one source; rows of equal id and text are alike in order and stand next to each other. Result and order
    depend on the rows alone, not on their partitions.
    """
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    base = cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in().alias("size"), key.alias("place"), F.md5(F.coalesce("text", F.lit(""))).alias("content"), row_key().alias("row")))
    rows = row_count(base)
    digits = _digits(rows)
    sliced = base.withColumn("slice", F.substring("place", 1, digits))
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    ahead = sums.select(
        "source", "slice", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead")
    )
    targets = cut_lineage(shares(base.groupBy("source").agg(F.sum("size").alias("source_size")), budget, passes, weight_of))
    inside = Window.partitionBy("source", "slice").orderBy("place", "content").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sliced.withColumn("inside", F.sum("size").over(inside))
    same_slice = placed["source"].eqNullSafe(ahead["source"]) & (placed["slice"] == ahead["slice"])
    queued = placed.join(ahead, same_slice).select(placed["*"], "ahead")
    queued = queued.join(targets, queued["source"].eqNullSafe(targets["source"])).select(queued["*"], "source_size", "target")
    queued = cut_lineage(queued.withColumn("through", F.col("ahead") + F.col("inside")).drop("ahead", "inside", "slice"))

    # the queue: one entry for each document and pass, without entries that take no words
    entry = queued.where("size > 0").select("size", "place", "content", "source", F.explode(F.array(*[_finish(p) for p in range(passes)])).alias("finish"))
    per_time = max(1, rows // ROWS_PER_SLICE)
    entry = entry.withColumn("tick", F.floor(F.col("finish") * per_time))
    ticks = entry.groupBy("tick").agg(F.sum("size").alias("n"))
    through = ticks.withColumn("through", F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("tick")))
    limit = targets.agg(F.sum("target").alias("budget"))
    crossing = through.crossJoin(F.broadcast(limit)).where("through > budget").orderBy("tick").select("tick", (F.col("budget") - F.col("through") + F.col("n")).alias("room")).limit(1)
    order = Window.partitionBy("tick").orderBy("finish", "source", "place", "content").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        entry.join(F.broadcast(crossing), "tick")
        .withColumn("used", F.sum("size").over(order))
        .where("used > room")
        .orderBy("used")
        .select("finish", "source", "place", "content")
        .first()
    )
    taken = sum((F.when(_before(p, last), 1).otherwise(0) for p in range(passes)), F.lit(0)) if last else F.lit(passes)
    return queued.withColumn("copies", F.when(F.col("size") > 0, taken).otherwise(0)).withColumn("taken", F.col("copies") * F.col("size")).select(
        "doc_id", "row", "size", "source", "source_size", "target", "copies", "taken"
    )


def _finish(turn: int) -> Column:
    return (F.col("through") + F.col("source_size") * turn) / F.col("target")


def _before(turn: int, end) -> Column:
    """Whether this pass of a document comes before the first entry that no longer fits."""
    mine = F.struct(_finish(turn).alias("a"), F.col("source").alias("b"), F.col("place").alias("c"), F.col("content").alias("d"))
    then = F.struct(F.lit(end["finish"]).alias("a"), F.lit(end["source"]).cast("string").alias("b"), F.lit(end["place"]).alias("c"), F.lit(end["content"]).alias("d"))
    return mine < then


def mixed(docs: DataFrame, weight_of: Callable[[Column], Column], budget: float = 1.5, passes: int = 2, seed: int = 7) -> DataFrame:
    """The documents of the mix, each as often as `mix` takes it, with the columns of `docs` unchanged."""
    # rows are told apart by their id and a hash: two keys of 64 bits
    taken = mix(docs, weight_of, budget, passes, seed).groupBy("row", known_id().alias("id")).agg(F.sum("copies").cast("int").alias("copies"))
    copies = cut_lineage(taken.where("copies > 0"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_key().alias("row"), known_id().alias("id"))
    one = marked.join(copies, ["row", "id"]).dropDuplicates(["row", "id"])
    return one.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
