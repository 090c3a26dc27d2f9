"""Locations, snapshots, ledgers, rule tables and trees in the shapes that earlier versions got wrong."""

from __future__ import annotations

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandtide.functions.locations import location_parts
from strandtide.operators import clades, features, history
from strandtide.sources import sequences as seqio
from strandtide.sources import tables as tabio
from strandtide.streaming import flows

RULES = "clade string, gene string, site string, alt string"


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("5..9", [(5, 9, "+", None)]),
        ("<5..>9", [(5, 9, "+", None)]),
        ("7", [(7, 7, "+", None)]),
        ("12^13", [(12, 13, "+", None)]),
        ("complement(5..9)", [(5, 9, "-", None)]),
        ("complement(join(1..2,4..5))", [(4, 5, "-", None), (1, 2, "-", None)]),
        ("join(complement(4..5),complement(1..2))", [(4, 5, "-", None), (1, 2, "-", None)]),
        ("complement(join(1..2,complement(order(4..5,7..8)),9))", [(9, 9, "-", None), (4, 5, "+", None), (7, 8, "+", None), (1, 2, "-", None)]),
        ("join(J00194.1:100..202,1..245, complement(U5:3..4))", [(100, 202, "+", "J00194.1"), (1, 245, "+", None), (3, 4, "-", "U5")]),
        ("complement(complement(complement(3..4)))", [(3, 4, "-", None)]),
        ("1..2)", [(1, 2, "+", None)]),
        ("", []),
    ],
)
def test_locations(one, text, parts):
    assert [tuple(p) for p in one(location_parts(F.col("t")), t=text)] == parts


def test_parts_of_other_records_are_not_cut(spark, tmp_path):
    flat = "LOCUS       A\nACCESSION   A\nVERSION     A.1\nFEATURES             Location/Qualifiers\n     CDS             {}\n" + " " * 21 + '/product="P1"\n     CDS             2..3\n' + " " * 21 + '/product="x"\nORIGIN\n        1 acgtacgt\n//\n'
    for name, location, letters, inside in (("far", "join(J1.1:1..3,4..6)", None, []), ("own", "join(A.1:1..3,A:5..6)", "ACGAC", ["P1", "x"])):
        path = tmp_path / name
        path.write_text(flat.format(location))
        records = seqio.read_genbank(spark, str(path))
        found = seqio.genbank_features(records)
        cut, moved = features.extract_feature(seqio.genbank_sequences(records), found, "p1")
        assert rows(cut) == [("A.1", letters)]
        assert sorted(r["attrs"]["product"] for r in moved.collect()) == inside
        assert [r["end"] for r in found.orderBy("ord").collect()] == [6, 3]


def test_snapshots_tell_names_and_types_apart(spark):
    old = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    unchanged = lambda new: history.snapshot_unchanged(old, new).first()[0]
    assert unchanged(old.repartition(3)) and unchanged(old.select("b", "a"))
    assert not unchanged(old.toDF("c", "d")) and not unchanged(old.withColumn("a", F.col("a").cast("long")))
    assert not unchanged(old.limit(1)) and not unchanged(old.withColumn("z", F.lit(None).cast("int")))


@pytest.mark.parametrize("levels", [0, 1, 6])
def test_digest_trees_find_changed_keys(spark, levels):
    rng = random.Random(levels)
    old = [(i % 40, str(i), rng.choice(["p", "q", None])) for i in range(120)] + [(None, "n", "p")]
    new = [(k, i, "changed" if i in ("7", "50") else v) for k, i, v in old if i != "11"] + [(3, "extra", "p"), (99, "late", None), (99, "late", None)]
    schema = "k int, `i.d` string, v string"
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).repartition(4)
    got = history.snapshot_changes(a, b, ["k", "i.d"], levels)
    assert rows(got) == rows(spark.createDataFrame([(7, "7", "changed"), (10, "50", "changed"), (11, "11", "removed"), (3, "extra", "added"), (99, "late", "added")], "k int, `i.d` string, change string"))
    assert history.snapshot_changes(a, a.repartition(2), ["k", "i.d"], levels).count() == 0
    tree = history.digest_tree(a, ["k", "i.d"], levels)
    assert tree.where("level = 0").first()["n"] == 121
    differing = history.differing_ranges(tree, history.digest_tree(b, ["k", "i.d"], levels))
    assert differing.where("level = 0").count() == 1 and differing.where(f"level = {levels}").count() <= 5


def test_a_null_never_enters_the_ledger(spark):
    ledger = spark.createDataFrame([("a", None), (None, None)], "accession string, date_added date")
    ids = spark.createDataFrame([(None,), ("b",), ("a",)], "accession string")
    once = history.first_seen_ledger(ledger, ids, "2024-01-01")
    again = history.first_seen_ledger(once, ids, "2024-02-02")
    assert rows(again) == rows(once) and once.count() == 3


def test_rule_tables_of_6000_sites(spark):
    rng = random.Random(6)
    length = 6100
    base = "".join(rng.choice("ACGT") for _ in range(length))
    long = [("L", "nuc", str(i + 1), base[i]) for i in range(6000)]
    rules = [*long, ("L2", "clade", "L", None), ("L2", "nuc", "6050", base[6049]), ("M", "nuc", "1", base[0]), ("P", "VP", "3", "M")]
    other = "C" if base[4999] != "C" else "G"
    late = "C" if base[6049] != "C" else "G"
    seqs = spark.createDataFrame([("whole", base), ("one off", base[:4999] + other + base[5000:]), ("late off", base[:6049] + late + base[6050:]), ("short", base[:10]), ("protein", "N" + base[1:6] + "ATG"), ("none", "")], "id string, seq string")
    got = dict(rows(clades.clades_from_table(seqs, spark.createDataFrame(rules, RULES), {"VP": (1, 9)})))
    assert got == {"whole": "L2", "one off": "M", "late off": "L", "short": "M", "protein": "P", "none": "unassigned"}


def test_key_mutations_at_positions_of_any_number(spark):
    rng = random.Random(8)
    codons = {"M": "ATG", "W": "TGG", "F": "TTT"}
    proteins = {f"n{i}": "".join(rng.choice("MWF") for _ in range(5200)) for i in range(3)}
    nodes = spark.createDataFrame([(n, n != "n0", "".join(codons[c] for c in p)) for n, p in proteins.items()], "node string, is_tip boolean, seq string")
    positions = spark.createDataFrame([("all", i) for i in range(1, 5201)] + [("two", 5100), ("two", 7), ("two", 7)], "feature_set string, position int")
    got = {r["node"]: (r["all"], r["two"]) for r in clades.key_mutations_at(nodes, positions).collect()}
    tips = {(p, p[6] + p[5099]) for n, p in proteins.items() if n != "n0"}
    shown = lambda p: (p if p in {a for a, _ in tips} else "other", p[6] + p[5099] if p[6] + p[5099] in {b for _, b in tips} else "other")
    assert got == {n: shown(p) for n, p in proteins.items()}
    assert clades.key_mutations_at(nodes, positions.limit(0)).columns == ["node"]


def test_trimmed_labels(spark):
    made = spark.createDataFrame([(" a b\t", 1), ("\n", 2), (None, 3)], "`l.x` string, n int")
    assert [r[0] for r in clades.trim_labels(made, ["l.x"]).orderBy("n").collect()] == ["a b", "", None]


def files_of(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_an_upsert_writes_only_the_buckets_it_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(f"k{i}", i, "a") for i in range(400)], "`k.y` string, ord int, v string").repartition(3)
    assert history.upsert_buckets(path, first, "k.y", "ord", buckets=16) == list(range(16))
    before = files_of(tmp_path / "t")
    batch = spark.createDataFrame([("k7", 1000, "b"), ("new", 1, "c"), ("new", 2, "d")], first.schema)
    touched = history.upsert_buckets(path, batch, "k.y", "ord")
    after = files_of(tmp_path / "t")
    assert 1 <= len(touched) <= 2
    written = {p.split("/")[1] for p in set(after) - set(before)}
    assert written == {f"_bucket={b}" for b in touched} == {p.split("/")[1] for p in set(before) - set(after)}
    got = {r["k.y"]: (r["ord"], r["v"]) for r in history.read_buckets(spark, path).collect()}
    assert got == {**{f"k{i}": (i, "a") for i in range(400)}, "k7": (1000, "b"), "new": (2, "d")}
    # the same batch again, an older one and an empty one change nothing
    assert history.upsert_buckets(path, batch, "k.y", "ord") == []
    assert history.upsert_buckets(path, batch.limit(0), "k.y", "ord") == []
    assert files_of(tmp_path / "t") == after
    wider = spark.createDataFrame([("k8", 5000, "z", 1.5), (None, 1, None, None)], "`k.y` string, ord int, v string, extra double")
    history.upsert_buckets(path, wider, "k.y", "ord")
    wide = {r["k.y"]: (r["v"], r["extra"]) for r in history.read_buckets(spark, path).collect()}
    assert wide["k8"] == ("z", 1.5) and wide["k9"] == ("a", None) and wide[None] == (None, None) and len(wide) == 402


def test_a_ledger_of_200_batches_is_written_a_few_times(spark, tmp_path, monkeypatch):
    folder, written = str(tmp_path / "ledger"), []
    least = flows._least
    monkeypatch.setattr(flows, "_least", lambda *a: written.append(len(a[1])) or least(*a))
    for i in range(200):
        batch = spark.range(i % 50, i % 50 + 3, 1, 1).select("id", F.lit(1000 - i).alias("ts"))
        flows.add_to_ledger(batch, folder, i, fan=4)
    # 200 tables at fan 4: 50 merges of the lowest tier, 12 of the next, 3 of the third
    assert len(written) == 65 and max(written) == 4
    assert {d.name: len(list(d.iterdir())) for d in (tmp_path / "ledger").iterdir()} == {"parts": 0, "tier1": 2, "tier2": 0, "tier3": 3} or sum(len(list(d.iterdir())) for d in (tmp_path / "ledger").iterdir()) <= 12
    want = {}
    for i in range(200):
        for k in range(i % 50, i % 50 + 3):
            want[k] = min(want.get(k, 10**9), 1000 - i)
    assert {r["id"]: r["first_seen"] for r in flows.compact_ledger(spark, folder).collect()} == want
    # a merge whose sources were not yet deleted when it failed is finished, not repeated
    for i in range(200, 204):
        spark.range(1).select("id", F.lit(0).alias("first_seen")).write.parquet(f"{folder}/parts/{i}")
    spark.range(1).select("id", F.lit(0).alias("first_seen")).write.parquet(f"{folder}/tier1/203")
    count = len(written)
    flows._merge_tiers(spark, folder, "id", 4)
    assert len(written) == count and not list((tmp_path / "ledger" / "parts").iterdir())


@pytest.mark.parametrize("splits", [1, 40])
def test_one_document_is_read_by_several_tasks(spark, tmp_path, splits):
    rng = random.Random(splits)
    odd = ['}', '{', '"', "\\", '\\"}', "é}", "", "a\nb", "[", ',"x":{']
    nodes = {f"N{i}{rng.choice(odd)}": {f"k{j}": rng.choice(odd) * rng.randrange(4) for j in range(rng.randrange(4))} for i in range(400)}
    document = {"version": '}{"', "meta": {"nodes": {"N": {"k": "wrong"}}, "m": {"n": 1}}, "flat": {}, "list": [{"a": {"b": "c"}}, [], "}"], "n": None, "nodes": nodes, "after": {"N1": {"k": "wrong"}}, "end": "}}"}
    (tmp_path / "a.json").write_text(json.dumps(document, indent=2 if splits > 1 else None))
    (tmp_path / "b.json").write_text(json.dumps({"nodes": {}}) + "\n" + json.dumps({"nodes": {"only": {"k": "v", "deep": {"x": [1, "}"]}}}}) + "\n")
    size = (tmp_path / "a.json").stat().st_size
    settings = {"spark.sql.files.maxPartitionBytes": str(size // splits + 1), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        parts = spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions()
        assert parts >= splits
        got = rows(tabio.read_node_documents(spark, str(tmp_path)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = [(n, k, v) for n, values in nodes.items() for k, v in values.items()] + [("only", "k", "v"), ("only", "deep", '{"x":[1,"}"]}')]
    assert got == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
