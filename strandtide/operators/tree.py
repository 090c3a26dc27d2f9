"""Tree tables (node, parent, is_tip, branch_length): paths, inheritance, parsimony.

Paths to the root are followed by doubling: each round every node jumps twice as far, so a tree of
any shape needs about log2(depth) joins. Finished nodes leave the join, and only nodes that are pointed at are
looked up. The few that very many nodes point at are broadcast, so their rows are neither shuffled nor sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandtide.names import quoted
from strandtide.operators.parsimony import by_contraction
from strandtide.runtime import cut_lineage, drop_folder, drop_stored, fresh_path

MAX_ROUNDS = 64  # doubling covers 2**64 levels; only a cycle runs longer
SHALLOW_ROUNDS = 4  # up to so many doublings a tree counts as shallow
PROBES, PROBED_NODES = 64, 1 << 20  # so many paths are walked in a tree of more than so many nodes, to see whether it is deep
MANY_POINTERS = 100_000  # a node that more nodes point at is broadcast: at most one in so many rows


def _double(state: DataFrame, carry: dict[str, callable]) -> DataFrame:
    """One round, stored in place of `state`: each pointer becomes the pointer of its target, combining what is carried."""
    open_rows = state.filter(F.col("ptr").isNotNull())
    target = state.select(
        F.col("node").alias("ptr"), F.col("ptr").alias("_ptr"), *[F.col(c).alias(f"_{c}") for c in carry]
    )
    # every pointer that occurs has a row here, whether or not there is such a node
    pointed = cut_lineage(open_rows.groupBy("ptr").agg(F.count(F.lit(1)).alias("_n")).join(target, "ptr", "left"))
    many, few = pointed.filter(F.col("_n") > MANY_POINTERS).drop("_n"), pointed.filter(F.col("_n") <= MANY_POINTERS).drop("_n")
    parts = [open_rows.join(few, "ptr")]
    if not many.isEmpty():
        crowded = F.broadcast(many.select("ptr").distinct())
        parts = [open_rows.join(crowded, "ptr", "left_anti").join(few, "ptr"), open_rows.join(F.broadcast(many), "ptr")]
    done = state.filter(F.col("ptr").isNull())
    for part in parts:
        done = done.unionByName(
            part.select("node", F.col("_ptr").alias("ptr"), *[f(F.col(c), F.col(f"_{c}")).alias(c) for c, f in carry.items()])
        )
    out = cut_lineage(done, replaces=state)
    drop_stored(pointed)
    return out


def _to_root(state: DataFrame, carry: dict[str, callable]) -> DataFrame:
    state = cut_lineage(state)
    for _ in range(MAX_ROUNDS):
        if state.filter(F.col("ptr").isNotNull()).isEmpty():
            return state.drop("ptr")
        state = _double(state, carry)
    raise ValueError("the parent pointers form a cycle")


def root_paths(tree: DataFrame) -> DataFrame:
    """Depth and summed branch length per node: (node, depth, divergence). The root has depth 0."""
    own = F.when(F.col("parent").isNull(), F.lit(0.0)).otherwise(F.col("branch_length"))
    state = tree.select(
        "node",
        F.col("parent").alias("ptr"),
        F.when(F.col("parent").isNull(), 0).otherwise(1).cast("int").alias("depth"),
        own.alias("divergence"),
    )
    plus = lambda a, b: a + F.coalesce(b, F.lit(0))
    return _to_root(state, {"depth": plus, "divergence": plus})


def shallow_depths(tree: DataFrame, rounds: int = SHALLOW_ROUNDS) -> DataFrame | None:
    """(node, depth) if no path is longer than 2 ** rounds edges, else nothing."""
    state = cut_lineage(tree.select("node", F.col("parent").alias("ptr"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("int").alias("depth")))
    for _ in range(rounds + 1):
        if state.filter(F.col("ptr").isNotNull()).isEmpty():
            return state.drop("ptr")
        state = _double(state, {"depth": lambda a, b: a + F.coalesce(b, F.lit(0))})
    drop_stored(state)
    return None


def shows_deep(tree: DataFrame, levels: int) -> bool:
    """Whether one of a few nodes has a path of more than `levels` edges; a walk over them spares a deep tree the doubling of all its nodes."""
    if tree.count() <= PROBED_NODES:
        return False
    first = tree.where("parent is not null").orderBy(F.xxhash64("node")).select("parent").limit(PROBES)
    at = {r["parent"] for r in first.collect()}
    for _ in range(levels):
        if not at:
            return False
        at = {r["parent"] for r in tree.where(F.col("node").isin(list(at)) & F.col("parent").isNotNull()).select("parent").distinct().limit(PROBES).collect()}
    return bool(at)


def with_parents(tree: DataFrame) -> DataFrame:
    """Node, parent and depth."""
    return tree.select("node", "parent").join(root_paths(tree).select("node", "depth"), "node")


def root_to_tip(tree: DataFrame) -> DataFrame:
    return root_paths(tree).select("node", "divergence")


def nearest_resolved(nodes: DataFrame, value: str, resolved: Column) -> DataFrame:
    """Per node the value of the nearest node on its path, itself included, that is resolved.

    A path without a resolved node ends at the root, whose own value is then taken.
    Returns (node, value). `nodes` has (node, parent, value).
    """
    settled = F.coalesce(resolved, F.lit(False)) | F.col("parent").isNull()
    state = nodes.select(
        "node",
        F.when(~settled, F.col("parent")).alias("ptr"),
        # the boolean tells a settled null from an open one
        settled.alias("ok"),
        F.when(settled, F.col(value)).alias(value),
    )
    state = cut_lineage(state)
    for _ in range(MAX_ROUNDS):
        if state.filter(F.col("ptr").isNotNull()).isEmpty():
            return state.select("node", value)
        target = state.select(
            F.col("node").alias("ptr"), F.col("ptr").alias("_ptr"), F.col("ok").alias("_ok"), F.col(value).alias("_v")
        )
        moved = (
            state.filter(F.col("ptr").isNotNull())
            .drop("ok", value)
            .join(target, "ptr", "left")
            .select("node", F.col("_ptr").alias("ptr"), F.coalesce("_ok", F.lit(True)).alias("ok"), F.col("_v").alias(value))
        )
        state = cut_lineage(moved.unionByName(state.filter(F.col("ptr").isNull())), replaces=state)
    raise ValueError("the parent pointers form a cycle")


def inherit_when_unknown(nodes: DataFrame, col: str, marker: str = "X") -> DataFrame:
    """Values that contain the marker take the parent's resolved value; a root keeps its own."""
    known = ~F.col(col).contains(marker)
    return nodes.drop(col).join(nearest_resolved(nodes, col, known), "node").select(quoted(nodes.columns))


def branch_mutations(nodes: DataFrame, seqs: DataFrame) -> DataFrame:
    """Differences between each node's sequence and its parent's: (node, pos, ref, alt)."""
    from strandtide.operators.quality import substitutions

    child = nodes.select(F.col("node").alias("id"), F.col("parent").alias("ref_id")).dropna().join(seqs, "id")
    return substitutions(child, seqs).withColumnRenamed("id", "node")


class _Levels:
    """Rows stored by depth below one folder: a round reads and writes its own level, one read sees all of them."""

    def __init__(self, spark, label: str):
        self.spark, self.path, self.schema = spark, fresh_path(spark, label), None

    def store(self, df: DataFrame) -> _Levels:
        """All levels at once, by the column `depth`; ranges of (depth, node) make even tasks and few files per level."""
        self.schema = df.drop("depth").schema
        df.repartitionByRange("depth", "node").write.partitionBy("depth").parquet(self.path)
        return self

    def put(self, depth: int, df: DataFrame) -> DataFrame:
        self.schema = df.schema
        df.write.parquet(f"{self.path}/depth={depth}")
        return self.get(depth)

    def get(self, depth: int) -> DataFrame:
        """One level; empty if no row has that depth."""
        return self.everything().filter(F.col("depth") == depth).drop("depth")

    def everything(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("depth", T.IntegerType())])).parquet(self.path)

    def drop(self) -> None:
        drop_folder(self.spark, self.path)


UNKNOWN_STATES = ("N", "X", "?", "-")


def parsimony_states(tree: DataFrame, tips: DataFrame, by: Sequence[str] = (), unknown: Sequence[str] = UNKNOWN_STATES) -> DataFrame:
    """States of all nodes by two passes: (node, *by, state).

    Up: a node keeps the states that most of its children hold. Down: the parent's state if the node
    has it, else the first in the alphabet. `tips` has (node, *by, state); `by` may name sites or
    trait columns, which are then handled together. Nodes without any informed tip are absent, and tips that the tree
    lacks are left out. A shallow tree takes a round for each level; beyond 2 ** SHALLOW_ROUNDS levels the tree is
    contracted, in phases that follow the logarithm of its nodes. The stored table behind the result stays below the
    shared folder.
    """
    informed = tips.filter(F.col("state").isNotNull() & ~F.col("state").isin(list(unknown)))
    depths = None if shows_deep(tree, 2**SHALLOW_ROUNDS) else shallow_depths(tree)
    if depths is None:
        return by_contraction(tree, informed.select("node", *by, F.col("state").cast("string").alias("state")), by)
    return _by_levels(tree.select("node", "parent").join(depths, "node"), informed, list(by))


def _by_levels(rooted: DataFrame, informed: DataFrame, by: list[str]) -> DataFrame:
    """The two passes level by level over tables stored by depth; `rooted` has node, parent, depth."""
    spark = rooted.sparkSession
    placed = _Levels(spark, "levels").store(rooted)
    tip_sets = _Levels(spark, "tips").store(informed.join(placed.everything(), "node").select("node", "parent", "depth", *by, "state").distinct())
    sets, chosen = _Levels(spark, "sets"), _Levels(spark, "chosen")
    deepest = placed.everything().agg(F.max("depth").alias("d")).first()["d"] or 0
    below = None
    for depth in range(deepest, -1, -1):
        here = tip_sets.get(depth)
        if below is not None:
            votes = below.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node"), *by, "state").agg(
                F.count(F.lit(1)).alias("_n")
            )
            top = votes.groupBy("node", *by).agg(F.max("_n").alias("_n"))
            held = votes.join(top, ["node", *by, "_n"], "left_semi").drop("_n")
            inner = held.join(placed.get(depth).select("node", "parent"), "node").select("node", "parent", *by, "state")
            here = here.unionByName(inner).distinct()
        below = sets.put(depth, here)
    # down: one choice per node, from the root's level to the deepest
    above = None
    for depth in range(deepest + 1):
        level = sets.get(depth)
        if above is None:
            picked = level.groupBy("node", *by).agg(F.min("state").alias("state"))
        else:
            up = above.select(F.col("node").alias("parent"), *by, F.col("state").alias("_up"))
            joined = level.join(up, ["parent", *by], "left")
            picked = joined.groupBy("node", *by).agg(
                F.coalesce(F.min(F.when(F.col("state") == F.col("_up"), F.col("state"))), F.min("state")).alias("state")
            )
        above = chosen.put(depth, picked)
    for used in (placed, tip_sets, sets):
        used.drop()
    return chosen.everything().drop("depth")
