"""Joins of long sequences, of crowded tree nodes and the cases of a ladder stay bounded."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from strandtide.operators import features, parsimony
from strandtide.operators import tree as treeops


def test_sequences_and_features_are_not_sorted_to_cut(spark):
    seqs = spark.createDataFrame([("a", "AACCGGTT"), ("b", "TTTTCCCC")], "id string, seq string")
    found = spark.createDataFrame(
        [("a", 0, "CDS", 3, 6, {"product": "P1"}), ("a", 1, "CDS", 4, 5, {"product": "VP1"}), ("b", 0, "CDS", 5, 8, {"product": "P1"})],
        "seqid string, ord int, type string, start int, end int, attrs map<string, string>",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut, moved = features.extract_feature(seqs, found, "p1")
        for df in (cut, moved):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert rows(cut) == [("a", "CCGG"), ("b", "CCCC")]
        assert rows(moved.select("seqid", "start", "end")) == [("a", 1, 4), ("a", 2, 3), ("b", 1, 4)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nodes_that_many_point_at_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(treeops, "MANY_POINTERS", 5)
    joined = []
    cut = treeops.cut_lineage
    monkeypatch.setattr(treeops, "cut_lineage", lambda df, replaces=None: joined.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df, replaces))
    edges = [("r", None, 7.0), ("m", "r", 1.0)] + [(f"t{i}", "m", float(i)) for i in range(20)] + [("c", "t3", 0.5)]
    # parents that are no nodes, of one node and of many, and a node that comes twice
    edges += [("x", "gone", 2.0), ("z", "m", 4.0), ("z", "m", 4.0), ("y", "z", 1.0)] + [(f"w{i}", "lost", 3.0) for i in range(9)]
    got = treeops.root_paths(spark.createDataFrame(edges, "node string, parent string, branch_length double"))
    want = [("r", 0, 0.0), ("m", 1, 1.0), ("c", 3, 4.5), ("x", 1, 2.0), ("z", 2, 5.0), ("z", 2, 5.0), ("y", 3, 6.0), ("y", 3, 6.0)]
    want += [(f"t{i}", 2, i + 1.0) for i in range(20)] + [(f"w{i}", 1, 3.0) for i in range(9)]
    assert sorted(map(tuple, got.select("node", "depth", "divergence").collect())) == sorted(want)
    assert any("strategy=broadcast" in plan for plan in joined)


def test_a_composition_that_no_longer_depends_on_the_child_is_one_case(spark):
    step = lambda state: parsimony.votes_as_cases(F.array(F.struct(F.lit(state).alias("state"), F.lit(1).cast("long").alias("n"))), F.array().cast("array<string>"))
    row = spark.range(1).select(step("a").alias("a"), step("b").alias("b"))
    pairs = row.select(parsimony.composed(F.col("a"), F.col("a")).alias("same"), parsimony.composed(F.col("a"), F.col("b")).alias("other"))
    got = pairs.select("same", parsimony.is_constant(F.col("same")).alias("fixed"), parsimony.is_constant(F.col("other")).alias("open")).first()
    assert [tuple(r) for r in got["same"]] == [(None, ["a"], [])]
    assert got["fixed"] and not got["open"]
