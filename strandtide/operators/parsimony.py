"""Parsimony on trees of any shape by contraction: phases follow the logarithm of the nodes, not the depth.

Up. A node keeps the states that most of its children hold. In each phase the leaves are finished (rake); a node with
one child left is a function of that child's states, written as a short list of cases. Chains of such nodes are cut
into runs (compress): in each round a node whose hash is below its neighbours' joins the run above it, which takes a third
of the nodes away, until few runs are left. A run is composed inside a task and is one node of the next phase. What is left
after the phases, at most CELL_NODES nodes, is ordered once and then done site by site, a site in a task.

A case (a, c, b) reads: if the child has a state of `a` (null: always), the result is `c` and what the child has
of `b` (null: all it has). The first case that holds counts. The `a` of a list are disjoint and hold their `b`, so a
list is never longer than the alphabet and one, and neither is a composition. A list whose cases all give the same is
written as one case, and no further one is composed with it.

Down. A node takes its parent's state if it holds it, else the first of its own. A run is a short table of the state
above it and the state of its last node; the phases are walked back and the members of a run are told inside a task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandtide.functions.binding import bind
from strandtide.operators.runs_of_nodes import cell_choices, cell_sets, run_choices, run_functions, run_sets, run_tables
from strandtide.runtime import broadcast_when_small, cut_lineage, drop_folder, fresh_path, tables_for_a_while

# So many nodes are ordered on the driver and done site by site; chains are cut into runs in at most so many rounds.
CELL_NODES, RUN_ROUNDS = 1 << 18, 12
_CASES = "array<struct<a: array<string>, c: array<string>, b: array<string>>>"


def _case(a: Column, c: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), c.alias("c"), b.alias("b"))


def _none() -> Column:
    return F.lit(None).cast("array<string>")


def _empty() -> Column:
    return F.array().cast("array<string>")


def simplified(cases: Column) -> Column:
    """The same function; if every case gives the same whatever the child has, that is its one case."""

    def plain(r: Column) -> Column:
        # the child has the state of `a` if that is one
        one = F.coalesce(F.size(r["a"]) == 1, F.lit(False))
        c = F.when(one, F.array_union(r["c"], F.when(r["b"].isNull(), r["a"]).otherwise(F.array_intersect(r["a"], r["b"])))).otherwise(r["c"])
        return _case(r["a"], F.array_sort(c), F.when(one, _empty()).otherwise(F.array_except(r["b"], c)))

    def one_case(plain_cases: Column) -> Column:
        first = F.get(plain_cases, F.lit(0))["c"]
        same = F.forall(plain_cases, lambda r: r["b"].isNotNull() & (F.size(r["b"]) == 0) & (r["c"] == first))
        return F.when(same, F.array(_case(_none(), first, _empty()))).otherwise(plain_cases)

    return bind(F.transform(cases, plain), one_case)


def is_constant(cases: Column) -> Column:
    """Whether `simplified` cases give the same for every child."""
    case = F.get(cases, F.lit(0))
    return (F.size(cases) == 1) & case["a"].isNull() & case["b"].isNotNull() & (F.size(case["b"]) == 0)


def votes_as_cases(votes: Column, own: Column) -> Column:
    """The function of a node's open child, from `votes` (state, n) of the others and the node's own states."""
    most = F.coalesce(F.array_max(F.transform(votes, lambda v: v["n"])), F.lit(0))
    with_n = lambda n: F.transform(F.filter(votes, lambda v: v["n"] == n), lambda v: v["state"])
    top, next_ = with_n(most), with_n(most - 1)
    shared = _case(top, own, top)
    # with one vote at most, every state of the child has as many votes as the top ones
    rest = _case(_none(), F.array_union(top, own), F.when(most > 1, next_))
    return F.when(most == 0, F.array(_case(_none(), own, _none()))).otherwise(F.array(shared, rest))


def applied(cases: Column, states: Column) -> Column:
    """The function's value for the states of the child."""
    holds = F.filter(cases, lambda r: r["a"].isNull() | F.coalesce(F.arrays_overlap(r["a"], states), F.lit(False)))
    case = F.get(holds, F.lit(0))
    return F.array_union(case["c"], F.when(case["b"].isNull(), states).otherwise(F.array_intersect(states, case["b"])))


def composed(outer: Column, inner: Column) -> Column:
    """The cases of `outer` after `inner`."""

    def both(r: Column, s: Column) -> Column:
        sure = s["a"].isNull() | F.coalesce(F.arrays_overlap(r["c"], s["a"]), F.lit(False))
        seen = F.when(r["b"].isNull(), s["a"]).otherwise(F.array_intersect(r["b"], s["a"]))
        kept = F.when(s["b"].isNull(), r["c"]).otherwise(F.array_intersect(r["c"], s["b"]))
        passed = F.when(r["b"].isNull(), s["b"]).when(s["b"].isNull(), r["b"]).otherwise(F.array_intersect(r["b"], s["b"]))
        return _case(F.when(sure, r["a"]).otherwise(seen), F.array_union(s["c"], kept), passed)

    every = F.flatten(F.transform(inner, lambda r: F.transform(outer, lambda s: both(r, s))))

    def add(acc: Column, x: Column) -> Column:
        fresh = F.array_except(x["a"], acc["seen"])
        less = F.when(x["b"].isNull(), F.lit(None)).otherwise(F.array_except(x["b"], acc["seen"]))
        last = F.struct(F.array_append(acc["out"], x).alias("out"), acc["seen"].alias("seen"), F.lit(True).alias("closed"))
        more = F.struct(F.array_append(acc["out"], _case(fresh, x["c"], less)).alias("out"), F.array_union(acc["seen"], fresh).alias("seen"), F.lit(False).alias("closed"))
        return F.when(acc["closed"], acc).when(x["a"].isNull(), last).when(F.size(fresh) > 0, more).otherwise(acc)

    start = F.struct(F.array().cast(_CASES).alias("out"), _empty().alias("seen"), F.lit(False).alias("closed"))
    return simplified(F.aggregate(every, start, add, lambda acc: acc["out"]))


class _Store:
    """Tables of the rounds below one folder, read as one."""

    def __init__(self, spark, label: str):
        self.spark, self.path, self.schema = spark, fresh_path(spark, label), None

    def put(self, number: int, df: DataFrame) -> DataFrame:
        path = f"{self.path}/round={number}"
        self.schema = df.schema
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def everything(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.path)

    def drop(self) -> None:
        drop_folder(self.spark, self.path)


class _Phase(NamedTuple):
    """What one phase took away: its leaves with their states, and the runs it made with what their members hold."""

    leaves: DataFrame  # node, up, _site, states
    runs: DataFrame  # run, kid, nodes
    held: DataFrame  # run, _site, entries, funcs


class _Tree(NamedTuple):
    """What is left: nodes, what finished children and the nodes themselves say, and the functions of runs."""

    nodes: DataFrame  # node, up
    said: DataFrame  # node, _site, state, n, own
    funcs: DataFrame  # node, _site, f


def _with_kids(nodes: DataFrame) -> DataFrame:
    """(node, up, leaf); a parent that is no node is none."""
    count = nodes.where("up is not null").groupBy(F.col("up").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    both = cut_lineage(nodes.join(count, F.col("node") == F.col("_of"), "full"))
    lost = both.where("node is null").select(F.col("_of").alias("up"))
    if not lost.isEmpty():
        rooted = nodes.join(lost.withColumn("_lost", F.lit(True)), "up", "left")
        return _with_kids(cut_lineage(rooted.select("node", F.when(F.col("_lost").isNull(), F.col("up")).alias("up"))))
    return both.select("node", "up", F.col("_n").isNull().alias("leaf"))


def _runs(inner: DataFrame) -> DataFrame:
    """(run, kid, nodes): the nodes with one child in runs from above; `run` is the first of them and `kid` the child of the last."""
    only = inner.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("_n"), F.min("node").alias("kid")).where("_n = 1").drop("_n")
    only = cut_lineage(only)
    above = only.select(F.col("kid").alias("node"), F.col("node").alias("prev"))
    chains = cut_lineage(only.join(above, "node", "left").withColumn("nodes", F.array("node")))
    for number in range(RUN_ROUNDS):
        if chains.count() <= CELL_NODES // 4:
            break
        place = lambda c: F.xxhash64(c, F.lit(number))  # noqa: E731, B023
        joins = F.coalesce((place("node") < place("prev")) & (place("node") < place("kid")), F.lit(False))
        going = chains.where(joins)
        longer = going.select(F.col("prev").alias("node"), F.col("kid").alias("_kid"), F.col("nodes").alias("_nodes"))
        moved = going.select(F.col("kid").alias("node"), F.col("prev").alias("_prev"))
        left = chains.where(~joins).join(longer, "node", "left").join(moved, "node", "left")
        grown = F.when(F.col("_nodes").isNull(), F.col("nodes")).otherwise(F.concat("nodes", "_nodes"))
        chains = cut_lineage(left.select("node", F.coalesce("_kid", "kid").alias("kid"), F.coalesce("_prev", "prev").alias("prev"), grown.alias("nodes")), replaces=chains)
    return chains.select(F.col("node").alias("run"), "kid", "nodes")


def _contracted(tree: _Tree, begins: bool) -> tuple[_Phase, _Tree]:
    """One phase: leaves are finished, and chains become runs."""
    known = _with_kids(tree.nodes)
    told = tree.said.join(known, "node")
    if begins:
        # nothing is finished yet: a leaf has its own states only
        finished = told.where("leaf").groupBy("node", "up", "_site").agg(F.collect_set("state").alias("states"))
    else:
        of_leaves = told.where("leaf").groupBy("node", "up", "_site").agg(F.collect_list(F.struct("state", "n", "own")).alias("all"))
        composed_ = tree.funcs.join(known.where("leaf"), "node").select("node", F.col("up").alias("_up"), "_site", "f")
        both = of_leaves.join(composed_, ["node", "_site"], "full").select("node", "_site", F.coalesce("up", "_up").alias("up"), "f", F.coalesce("all", F.array().cast("array<struct<state: string, n: bigint, own: boolean>>")).alias("all"))
        states = lambda those: F.transform(those, lambda v: v["state"])
        votes = F.transform(F.filter("all", lambda v: v["n"] > 0), lambda v: F.struct(v["state"].alias("state"), v["n"].alias("n")))
        value = F.when(F.col("f").isNull(), applied(votes_as_cases(votes, states(F.filter("all", lambda v: v["own"]))), _empty())).otherwise(applied(F.col("f"), states(F.col("all"))))
        finished = both.select("node", "up", "_site", value.alias("states")).where(F.size("states") > 0)
    leaves = cut_lineage(finished)
    votes = leaves.where("up is not null").select(F.col("up").alias("node"), "_site", F.explode("states").alias("state"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("own"))
    inner = cut_lineage(known.where("not leaf").select("node", "up"))
    runs = cut_lineage(_runs(inner))
    members = runs.select("run", F.posexplode("nodes").alias("pos", "node"))
    below = runs.select(F.col("kid").alias("node"), F.col("run").alias("_up"))
    nodes = cut_lineage(inner.join(members.where("pos > 0"), "node", "left_anti").join(below, "node", "left").select("node", F.coalesce("_up", "up").alias("up")))
    said = told.where("not leaf").select("node", "_site", "state", "n", "own").unionByName(votes).join(members, "node", "left")
    said = cut_lineage(said.groupBy("node", "run", "pos", "_site", "state").agg(F.sum("n").alias("n"), F.bool_or("own").alias("own")))
    entries = said.where("run is not null").groupBy("run", "_site").agg(F.collect_list(F.struct("pos", "state", "n", "own")).alias("entries"))
    if begins:
        held, kept = entries.withColumn("funcs", F.lit(None).cast(f"array<struct<pos: int, f: {_CASES}>>")), tree.funcs
    else:
        inside = tree.funcs.join(members, "node").groupBy("run", "_site").agg(F.collect_list(F.struct("pos", "f")).alias("funcs"))
        held = entries.join(inside, ["run", "_site"], "full")
        kept = tree.funcs.join(members, "node", "left_anti").join(known.where("leaf"), "node", "left_anti")
    held = cut_lineage(held)
    funcs = held.mapInArrow(run_functions, f"node string, _site long, f {_CASES}").unionByName(kept)
    return _Phase(leaves, runs, held), _Tree(nodes, said.where("run is null").drop("run", "pos"), cut_lineage(funcs))


def _ordered(nodes: DataFrame, runs: set) -> list[tuple]:
    """(node, its parent, whether it is a run), parents first; at most CELL_NODES."""
    kids, order = {}, []
    rows = nodes.collect()
    for r in rows:
        kids.setdefault(r["up"], []).append(r["node"])
    order = [(v, None) for v in kids.get(None, [])]
    for v, _ in order:
        order.extend((c, v) for c in kids.get(v, ()))
    if len(order) < len(rows):
        raise ValueError("the parent pointers form a cycle")
    return [(v, up, v in runs) for v, up in order]


def _with_members(phase: _Phase, sets: DataFrame) -> DataFrame:
    """A row for each run and site that has states: what the run's members hold, the states of the child below, the nodes."""
    informed = phase.runs.join(sets.select(F.col("node").alias("run"), "_site"), "run")
    child = sets.select(F.col("node").alias("kid"), "_site", F.col("states").alias("below"))
    return informed.join(phase.held, ["run", "_site"], "left").join(child, ["kid", "_site"], "left").drop("kid")


def _with_tables(rows: DataFrame, phase: _Phase, tables: DataFrame | None) -> DataFrame:
    """The same with the tables of members that are runs themselves."""
    if tables is None:
        return rows.withColumn("tables", F.lit(None).cast("array<struct<pos: int, other: string, held: map<string, string>>>"))
    members = phase.runs.select("run", F.posexplode("nodes").alias("pos", "node"))
    inside = tables.join(members, "node").groupBy("run", "_site").agg(F.collect_list(F.struct("pos", "other", "held")).alias("tables"))
    return rows.join(inside, ["run", "_site"], "left")


def _but_runs(df: DataFrame, phase: _Phase) -> DataFrame:
    return df.join(phase.runs.select(F.col("run").alias("node")), "node", "left_anti")


def _states(tree: _Tree, chosen: Callable[[DataFrame], None]) -> None:
    """Gives `chosen` tables of (node, _site, state), which together hold every informed node."""
    phases: list[_Phase] = []
    size = tree.nodes.count()
    while size > CELL_NODES:
        phase, tree = _contracted(tree, not phases)
        phases.append(phase)
        before, size = size, tree.nodes.count()
        if size == before:
            raise ValueError("the parent pointers form a cycle")
        if len(phases) == 1:
            # what needs no look at the parent
            chosen(phase.leaves.where("size(states) = 1 or up is null").select("node", "_site", F.array_min("states").alias("state")))

    # the nodes that are left, site by site
    last = {r["run"] for r in phases[-1].runs.select("run").collect()} if phases else set()
    order = _ordered(tree.nodes, last | {r["node"] for r in tree.funcs.select("node").distinct().collect()})
    said = tree.said.withColumn("f", F.lit(None).cast(_CASES)).unionByName(tree.funcs, allowMissingColumns=True)
    sets = [cut_lineage(said.groupBy("_site").applyInArrow(cell_sets(order), "node string, _site long, states array<string>"))]

    # states inside the runs, from the last phase to the second; the first one's are made where they are read
    for phase in reversed(phases[1:]):
        inside = _with_members(phase, sets[0]).mapInArrow(run_sets, "node string, _site long, states array<string>")
        sets.insert(0, cut_lineage(phase.leaves.select("node", "_site", "states").unionByName(_but_runs(sets[0], phase)).unionByName(inside)))
    tables: list[DataFrame | None] = [None]
    for phase, known in zip(phases, sets, strict=False):
        made = _with_tables(_with_members(phase, known), phase, tables[-1]).mapInArrow(run_tables, "node string, _site long, other string, held map<string, string>")
        if tables[-1] is not None:
            # a run that is left to the next phase as it is
            made = made.unionByName(tables[-1].join(known, ["node", "_site"], "left_semi").join(phase.runs.select(F.explode("nodes").alias("node")), "node", "left_anti"))
        tables.append(cut_lineage(made))

    # down
    known = sets[-1] if tables[-1] is None else sets[-1].join(tables[-1], ["node", "_site"], "left")
    known = known if tables[-1] is not None else known.withColumn("other", F.lit(None).cast("string")).withColumn("held", F.lit(None).cast("map<string, string>"))
    result = "node string, _site long, above string, state string"
    here = cut_lineage(known.groupBy("_site").applyInArrow(cell_choices(order), result))
    for number in range(len(phases) - 1, -1, -1):
        phase = phases[number]
        rows = _with_tables(_with_members(phase, sets[number]), phase, tables[number])
        given = here.select(F.col("node").alias("run"), "_site", "above")
        inside = rows.join(given, ["run", "_site"]).mapInArrow(run_choices, result)
        kept = _but_runs(here, phase)
        here = cut_lineage(inside.unionByName(kept))
        open_ = phase.leaves.where("size(states) > 1 and up is not null") if number == 0 else phase.leaves
        up = here.select(F.col("node").alias("up"), "_site", F.col("state").alias("above"))
        met = open_.join(up, ["up", "_site"], "left")
        own = F.when(F.array_contains("states", F.col("above")), F.col("above")).otherwise(F.array_min("states"))
        if number:
            met = met.join(tables[number], ["node", "_site"], "left")
            own = F.when(F.col("other").isNull(), own).otherwise(F.coalesce(F.col("held")[F.col("above")], F.col("other")))
        leaves = met.select("node", "_site", "above", own.alias("state"))
        if number:
            here = cut_lineage(here.unionByName(leaves))
        else:
            chosen(leaves.select("node", "_site", "state"))
    chosen(here.select("node", "_site", "state"))


def by_contraction(tree: DataFrame, informed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of all nodes of a tree of any depth: (node, *by, state), from informed states (node, *by, state).

    A row that comes twice counts once.
    """
    by, spark = list(by), tree.sparkSession
    store = _Store(spark, "chosen")
    with tables_for_a_while(spark):
        edges = tree.where("node is not null").select(F.col("node").cast("string").alias("node"), F.col("parent").cast("string").alias("up"))
        nodes = cut_lineage(edges.distinct())
        # sites are told by a number; null is a site like any other
        sites = cut_lineage(informed.select(*by).distinct().withColumn("_site", F.monotonically_increasing_id())) if by else None
        said = informed.select(F.col("node").cast("string").alias("node"), *by, F.col("state").cast("string").alias("state"))
        if by:
            few = broadcast_when_small(sites.select(F.col("_site"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]))
            alike = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
            said = said.join(few, alike)
        else:
            said = said.withColumn("_site", F.lit(0).cast("long"))
        said = said.select("node", "_site", "state", F.lit(0).cast("long").alias("n"), F.lit(True).alias("own"))
        funcs = spark.createDataFrame([], f"node string, _site long, f {_CASES}")

        def chosen(df: DataFrame) -> None:
            named = df.join(broadcast_when_small(sites), "_site") if by else df
            store.put(len(put), named.select(F.col("node").cast(tree.schema["node"].dataType).alias("node"), *by, "state"))
            put.append(True)

        put: list[bool] = []
        _states(_Tree(nodes, said, funcs), chosen)
    return store.everything()
