"""Parsimony by levels and by contraction against a recursive version, on trees of many shapes."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandtide.operators import parsimony
from strandtide.operators import tree as treeops

TREE, TIPS = "node string, parent string", "node string, site string, state string"


def plain(edges, tips, sites):
    """(node, site, state) by one pass up and one down."""
    kids = {}
    for v, p in edges:
        kids.setdefault(p, []).append(v)
    order = [v for v, p in edges if p is None]
    for v in order:
        order.extend(kids.get(v, []))
    parent, out = dict(edges), []
    for site in sites:
        own, sets, chosen = {}, {}, {}
        for v, s, state in tips:
            if s == site and state is not None:
                own.setdefault(v, set()).add(state)
        for v in reversed(order):
            votes = Counter(s for c in kids.get(v, []) for s in sets[c])
            top = max(votes.values(), default=0)
            sets[v] = {s for s, n in votes.items() if n == top} | own.get(v, set())
        for v in order:
            if sets[v]:
                up = chosen.get(parent[v])
                chosen[v] = up if up in sets[v] else min(sets[v])
        out += [(v, site, s) for v, s in chosen.items()]
    return sorted(out)


def shaped(rng, n, kind):
    """Parents of n nodes: any node before, mostly the one before (long chains), or one of the last few."""
    edges = [("n0", None)]
    for i in range(1, n):
        up = {"any": rng.randrange(i), "ladder": i - 1 if rng.random() < 0.6 else rng.randrange(max(0, i - 3), i), "chain": i - 1, "caterpillar": i - 1 - (i % 2 == 0 and i > 1)}[kind]
        edges.append((f"n{i}", f"n{up}"))
    return edges


def informed(rng, edges, states):
    leaves = {v for v, _ in edges} - {p for _, p in edges}
    tips = [(v, site, rng.choice(states)) for v in sorted(leaves) for site in ("x", "y") if rng.random() < 0.8]
    # states of inner nodes, several of one node, and a site that few nodes have
    tips += [(v, "x", rng.choice(states)) for v, _ in edges if rng.random() < 0.05]
    tips += [(v, "z", rng.choice(states)) for v, _ in edges[:3]]
    return tips


@pytest.mark.parametrize("kind", ["any", "ladder", "caterpillar"])
def test_contraction_and_levels_equal_recursion(spark, kind):
    rng = random.Random(kind)
    edges = shaped(rng, 60, kind) + [("other", None), ("o1", "other"), ("o2", "o1")]
    tips = informed(rng, edges, "abcd") + [("o2", "x", "q"), ("gone", "x", "a")]
    want = plain(edges, [t for t in tips if t[0] != "gone"], ["x", "y", "z"])
    tree, given = spark.createDataFrame(edges, TREE).repartition(3), spark.createDataFrame(tips, TIPS)
    got = parsimony.by_contraction(tree, given, ["site"])
    assert sorted(map(tuple, got.select("node", "site", "state").collect())) == want
    depths = treeops.shallow_depths(tree, 10)
    got = treeops._by_levels(tree.join(depths, "node"), given, ["site"])
    assert sorted(map(tuple, got.select("node", "site", "state").collect())) == want


def test_rounds_follow_the_logarithm_of_a_ladder(spark, monkeypatch):
    stored = []
    put = parsimony._Store.put
    monkeypatch.setattr(parsimony._Store, "put", lambda self, number, df: stored.append(number) or put(self, number, df))
    n = 200
    rng = random.Random(3)
    edges = [(f"i{k}", f"i{k - 1}" if k else None) for k in range(n)] + [(f"t{k}", f"i{k}") for k in range(n)]
    tips = [(f"t{k}", "x", rng.choice("ab")) for k in range(n)]
    got = treeops.parsimony_states(spark.createDataFrame(edges, TREE), spark.createDataFrame(tips, TIPS), ["site"])
    assert sorted(map(tuple, got.select("node", "site", "state").collect())) == plain(edges, tips, ["x"])
    # two passes of about log2(200) rounds
    assert len(stored) <= 24


def subsets(letters):
    return [[c for i, c in enumerate(letters) if m >> i & 1] for m in range(1 << len(letters))]


def test_composed_cases_equal_functions_one_after_the_other(spark):
    rng = random.Random(4)
    votes = lambda: [(s, rng.randrange(1, 4)) for s in rng.sample("abcd", rng.randrange(0, 4))]
    made = [(i, [(votes(), rng.sample("abcd", rng.choice((0, 0, 0, 1)))) for _ in range(4)], states) for i in range(40) for states in subsets("abcd")]
    df = spark.createDataFrame(made, "i int, nodes array<struct<votes: array<struct<state: string, n: bigint>>, own: array<string>>>, states array<string>")
    cases = lambda k: parsimony.votes_as_cases(F.col("nodes")[k]["votes"], F.col("nodes")[k]["own"])
    step = df.select("states", *[cases(k).alias(f"f{k}") for k in range(4)])
    both = step.withColumn("g", parsimony.composed(F.col("f1"), F.col("f0"))).withColumn("h", parsimony.composed(F.col("f3"), F.col("f2")))
    whole = both.withColumn("all", parsimony.composed(F.col("h"), F.col("g")))
    one = parsimony.applied(F.col("all"), F.col("states"))
    slow = F.col("states")
    for k in range(4):
        slow = parsimony.applied(F.col(f"f{k}"), slow)
    got = whole.select(F.array_sort(one).alias("one"), F.array_sort(slow).alias("slow"), F.size("all").alias("n")).collect()
    assert all(r.one == r.slow for r in got)
    assert max(r.n for r in got) <= 5


def test_without_sites_and_with_loops(spark):
    edges = shaped(random.Random(1), 40, "chain")
    tips = spark.createDataFrame([("n39", "b"), ("n20", "a"), ("n10", "N"), ("n5", None)], "node string, state string")
    got = dict(rows(treeops.parsimony_states(spark.createDataFrame(edges, TREE), tips)))
    assert got == dict(rows(parsimony.by_contraction(spark.createDataFrame(edges, TREE), tips.where("state in ('a', 'b')"))))
    assert got["n39"] == "b" and got["n0"] == "a" and len(got) == 40
    assert treeops.parsimony_states(spark.createDataFrame([], TREE), tips).count() == 0


def test_a_cycle_is_an_error(spark):
    loop = spark.createDataFrame([("a", "c"), ("b", "a"), ("c", "b"), ("t", "a")], TREE)
    with pytest.raises(ValueError, match="cycle"):
        treeops.parsimony_states(loop, spark.createDataFrame([("t", "x", "a")], TIPS), ["site"])


@pytest.mark.parametrize(("kind", "cell", "rounds"), [("caterpillar", 12, 1), ("ladder", 8, 3), ("any", 6, 2)])
def test_phases_of_leaves_and_runs_equal_recursion(spark, monkeypatch, kind, cell, rounds):
    monkeypatch.setattr(parsimony, "CELL_NODES", cell)
    monkeypatch.setattr(parsimony, "RUN_ROUNDS", rounds)
    rng = random.Random(kind)
    edges = shaped(rng, 60, kind) + [("other", None), ("o1", "other"), ("o2", "o1")]
    tips = informed(rng, edges, "abcd") + [("o2", "x", "q"), ("gone", "x", "a")]
    want = plain(edges, [t for t in tips if t[0] != "gone"], ["x", "y", "z"])
    # rows that come twice count once; a parent that is no node is none
    told = [e if e[0] != "other" else ("other", "nobody") for e in [*edges, *edges[5:9]]]
    got = parsimony.by_contraction(spark.createDataFrame(told, TREE).repartition(3), spark.createDataFrame([*tips, *tips[:3]], TIPS), ["site"])
    assert sorted(map(tuple, got.select("node", "site", "state").collect())) == want


def test_the_chain_of_a_ladder_is_cut_into_runs(spark, monkeypatch):
    """All rungs are one chain: one phase is enough, and what is carried is two rows a rung, not one a rung and round."""
    monkeypatch.setattr(parsimony, "CELL_NODES", 40)
    sizes = []
    made = parsimony._contracted
    monkeypatch.setattr(parsimony, "_contracted", lambda tree, begins: (lambda out: (sizes.append((out[0].runs.count(), out[1].nodes.count())), out)[1])(made(tree, begins)))
    n = 300
    edges = [(f"i{k}", f"i{k - 1}" if k else None) for k in range(n)] + [(f"t{k}", f"i{k}") for k in range(n)]
    tips = [(f"t{k}", "x", random.Random(k).choice("abc")) for k in range(n)]
    got = parsimony.by_contraction(spark.createDataFrame(edges, TREE), spark.createDataFrame(tips, TIPS), ["site"])
    assert sorted(map(tuple, got.select("node", "site", "state").collect())) == plain(edges, tips, ["x"])
    assert len(sizes) == 1 and sizes[0][0] <= 40 and sizes[0][1] <= 40


def test_numbers_as_nodes_and_sites(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 2)], "node int, parent long")
    tips = spark.createDataFrame([(3, 7, 1, "b"), (4, 7, 1, "b"), (4, 8, None, "c")], "node long, x int, y int, state string")
    got = parsimony.by_contraction(tree, tips, ["x", "y"])
    assert got.schema["node"].dataType == tree.schema["node"].dataType
    assert rows(got) == rows(spark.createDataFrame([(i, 7, 1, "b") for i in (1, 2, 3, 4)] + [(i, 8, None, "c") for i in (1, 2, 4)], "node int, x int, y int, state string"))


def test_a_cycle_is_an_error_in_any_phase(spark, monkeypatch):
    monkeypatch.setattr(parsimony, "CELL_NODES", 3)
    loop = spark.createDataFrame([(f"a{i}", f"a{(i + 1) % 7}") for i in range(7)] + [("t", "a0"), ("u", "t")], TREE)
    with pytest.raises(ValueError, match="cycle"):
        parsimony.by_contraction(loop, spark.createDataFrame([("u", "x", "a")], TIPS), ["site"])


def test_a_walk_tells_deep_trees(spark, monkeypatch):
    monkeypatch.setattr(treeops, "PROBED_NODES", 0)
    chain = lambda n: spark.createDataFrame([(f"n{i}", f"n{i - 1}" if i else None) for i in range(n)], TREE)
    assert treeops.shows_deep(chain(18), 16) and not treeops.shows_deep(chain(17), 16)
    assert not treeops.shows_deep(spark.createDataFrame([], TREE), 16)


def test_run_functions_equal_one_after_the_other():
    from strandtide.operators import runs_of_nodes as runs

    rng = random.Random(6)
    for _ in range(300):
        made = [runs.of_votes([(1 << i, rng.randrange(1, 4)) for i in rng.sample(range(4), rng.randrange(0, 4))], rng.choice((0, 0, 0, 1 << rng.randrange(4)))) for _ in range(4)]
        whole = runs.IDENTITY
        for f in made:
            whole = runs.composed(f, whole)
        assert len(whole) <= 5
        for states in range(16):
            one = states
            for f in made:
                one = runs.applied(f, one)
            assert runs.applied(whole, states) == one
