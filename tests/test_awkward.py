"""Cases that one row per key, one strand and short chains never show."""

from __future__ import annotations

import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandtide import runtime
from strandtide.functions import dates, mining
from strandtide.functions import sequence as seqfn
from strandtide.operators import clades, dedup, features, grouping, history, joins
from strandtide.operators import tree as treeops
from strandtide.plans.registry import all_queries
from strandtide.sources import sequences as seqio
from strandtide.sources import tables as tabio
from strandtide.streaming import flows


def test_a_chain_of_200_clades(spark):
    rules = [("C0", "nuc", "1", "A")] + [r for i in range(1, 200) for r in ((f"C{i}", "clade", f"C{i - 1}", None), (f"C{i}", "nuc", str(i % 7 + 2), "G"))]
    needed, depth = clades.inherited_rules(spark.createDataFrame(rules, "clade string, gene string, site string, alt string"))
    deep = {r["clade"]: r["depth"] for r in depth.collect()}
    assert deep == {f"C{i}": i for i in range(200)}
    assert needed.filter("clade = 'C199'").count() == 8 and needed.filter("clade = 'C0'").count() == 1


@pytest.mark.parametrize("edges", [[("P", "P")], [("P", "Q"), ("Q", "P")], [("A", "B"), ("B", "C"), ("C", "D"), ("D", "B")]])
def test_true_cycles_of_clades(spark, edges):
    rules = spark.createDataFrame([(a, "clade", b, None) for a, b in edges], "clade string, gene string, site string, alt string")
    with pytest.raises(ValueError, match="cycle"):
        clades.inherited_rules(rules)


def test_a_clade_with_two_ways_up_has_the_longer_depth(spark):
    rules = spark.createDataFrame([("B", "clade", "A", None), ("C", "clade", "B", None), ("C", "clade", "A", None), ("A", "nuc", "1", "A")], "clade string, gene string, site string, alt string")
    assert {r["clade"]: r["depth"] for r in clades.inherited_rules(rules)[1].collect()} == {"A": 0, "B": 1, "C": 2}


def test_rules_without_a_window_or_sites(spark):
    seqs = spark.createDataFrame([("x", "ACG")], "id string, seq string")
    with pytest.raises(ValueError, match="VP9"):
        clades.clades_from_table(seqs, spark.createDataFrame([("A", "VP9", "1", "M")], "clade string, gene string, site string, alt string"), {})
    none = spark.createDataFrame([], "clade string, gene string, site string, alt string")
    assert rows(clades.clades_from_table(seqs, none, {})) == [("x", "unassigned")]


@pytest.mark.parametrize("n", [5, 1500])
def test_top_n_of_any_size_with_dotted_columns(spark, n):
    made = [(i % 2, i, f"q{i}") for i in range(4000)]
    df = spark.createDataFrame(made, "g int, v int, `qc.score` string")
    got = dedup.top_n(df, ["g"], ["v"], n).groupBy("g").agg(F.count("*").alias("n"), F.max("v").alias("v")).orderBy("g").collect()
    assert [tuple(r) for r in got] == [(0, n, 2 * n - 2), (1, n, 2 * n - 1)]


def test_ranks_with_dotted_names(spark):
    df = spark.createDataFrame([("a", 2, 1.0), ("a", 1, 2.0), (None, 1, 3.0)], "`g.x` string, `o.y` int, `qc.score` double")
    got = dedup.rank_in_group(df, ["g.x"], ["o.y"])
    assert rows(got) == sorted([("a", 1, 2.0, 1), ("a", 2, 1.0, 2), (None, 1, 3.0, 1)], key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_repeated_keys_do_not_depend_on_partitions(spark, parts):
    made = [(1, f"v{i:04d}", i) for i in range(1000)]
    random.Random(parts).shuffle(made)
    batch = spark.createDataFrame(made, "k int, v string, ord int").repartition(parts)
    nothing = batch.limit(0)
    assert [tuple(r) for r in history.upsert_latest(nothing, batch, "k", order="ord").select("k", "v").collect()] == [(1, "v0999")]
    assert [tuple(r) for r in history.upsert_latest(nothing, batch.drop("ord"), "k").select("k", "v").collect()] == [(1, "v0999")]
    back = batch.withColumn("ord", -F.col("ord"))
    assert [tuple(r) for r in history.upsert_latest(batch, back, "k", order="ord").select("k", "v").collect()] == [(1, "v0000")]
    assert [tuple(r) for r in joins.merge_many([back, nothing], "k", order="ord").collect()] == [(1, "v0000")]
    assert [tuple(r) for r in joins.merge_many([batch.drop("ord")], "k").collect()] == [(1, "v0999")]
    path = history.upsert_table(None, batch, "k", "ord")
    assert spark.read.parquet(path).select("v").first()["v"] == "v0999"


def test_merge_prefers_later_tables_and_skips_blanks(spark):
    one = spark.createDataFrame([(1, "a", 9), (1, "b", 1)], "k int, v string, ord int")
    two = spark.createDataFrame([(1, " ", 5)], "k int, v string, ord int")
    assert [tuple(r) for r in joins.merge_many([one, two], "k", order="ord").collect()] == [(1, "a")]


def test_a_moved_null_is_a_change(spark):
    schema = "a string, b string"
    old, new = spark.createDataFrame([(None, "x")], schema), spark.createDataFrame([("x", None)], schema)
    assert history.snapshot_unchanged(old, new).first()["unchanged"] is False
    assert history.snapshot_unchanged(old, old).first()["unchanged"] is True
    assert history.snapshot_unchanged(old, spark.createDataFrame([("", "x")], schema)).first()["unchanged"] is False


def test_local_ids_are_ordered_as_numbers(spark):
    schema = "internal_accession string, sample_name string, gb_accession string, date_added string, seq_accession string"
    registry = spark.createDataFrame([("X9999999", "s", "NA", "d", "X9999999"), ("X10000000", "s", "NA", "d", "X10000000")], schema)
    names = spark.createDataFrame([("new",)], "name string")
    got = {r["sample_name"]: r["internal_accession"] for r in history.local_id_registry(registry, names, None, "d").collect()}
    assert got == {"s": "X10000000", "new": "X10000001"}


SEQ = "AAACCCGGGTTT"


def test_strands_and_parts(spark):
    seqs = spark.createDataFrame([(i, SEQ) for i in "abcd"], "id string, seq string")
    schema = "seqid string, ord int, type string, start int, end int, strand string, spans array<struct<start:int,end:int,strand:string>>, attrs map<string,string>"
    part = lambda s, e, t="+": {"start": s, "end": e, "strand": t}
    found = spark.createDataFrame(
        [
            ("a", 0, "CDS", 1, 12, "+", [part(1, 3), part(10, 12)], {"product": "VP1"}), ("a", 1, "CDS", 11, 12, "+", [part(11, 12)], {"product": "tail"}),
            ("b", 0, "CDS", 2, 6, "-", [part(2, 6, "-")], {"product": "VP1"}), ("b", 1, "CDS", 3, 4, "+", [part(3, 4)], {"product": "in"}),
            ("c", 0, "CDS", 1, 12, "-", [part(10, 12, "-"), part(1, 3, "-")], {"product": "VP1"}), ("c", 1, "CDS", 5, 6, "+", [part(5, 6)], {"product": "between"}),
            ("d", 0, "CDS", 1, 4, "+", [part(1, 4)], {"gene": "VP1", "product": "other"}),
        ],
        schema,
    )
    cut, moved = features.extract_feature(seqs, found, "VP1")
    assert rows(cut) == [("a", "AAATTT"), ("b", "GGGTT"), ("c", "AAATTT")]
    assert rows(moved.select("seqid", F.col("attrs")["product"], "start", "end", "strand")) == [
        ("a", "VP1", 1, 6, "+"), ("a", "tail", 5, 6, "+"), ("b", "VP1", 1, 5, "+"), ("b", "in", 3, 4, "-"), ("c", "VP1", 1, 6, "+"),
    ]
    plain = found.drop("spans", "strand").filter("seqid = 'b'")
    assert features.extract_feature(seqs, plain, "VP1")[0].first()["seq"] == "AACCC"


def test_reverse_complement_twice_is_the_same(spark):
    df = spark.createDataFrame([("ACGTRYSWKMBDHVNacgn-",), ("",), (None,)], "s string")
    for r in df.select("s", seqfn.reverse_complement(seqfn.reverse_complement(F.col("s"))).alias("t")).collect():
        assert r["s"] == r["t"]


def test_locations_of_flat_files(spark, tmp_path):
    pad = " " * 21
    record = f"""LOCUS       X
ACCESSION   X
VERSION     X.1
FEATURES             Location/Qualifiers
     CDS             join(1..3,10..12)
{pad}/product="first"
{pad}/product="capsid VP1"
     CDS             complement(join(<1..3,
{pad}10..>12))
{pad}/gene="back"
     CDS             join(complement(10..12),J00194.1:1..3)
     variation       7
{pad}/gene="one"
ORIGIN
        1 aaacccgggt tt
//
"""
    (tmp_path / "x.gb").write_text(record)
    records = seqio.read_genbank(spark, str(tmp_path / "x.gb"))
    found = seqio.genbank_features(records)
    spans = [[tuple(p) for p in r["spans"]] for r in found.orderBy("ord").collect()]
    assert spans == [[(1, 3, "+"), (10, 12, "+")], [(10, 12, "-"), (1, 3, "-")], [(10, 12, "-"), (1, 3, "+")], [(7, 7, "+")]]
    seqs = seqio.genbank_sequences(records)
    assert features.extract_feature(seqs, found, "VP1")[0].first()["seq"] == "AAATTT"
    assert features.extract_feature(seqs, found, "back")[0].first()["seq"] == "AAATTT"


def test_a_repeated_attribute(spark, tmp_path):
    (tmp_path / "x.gff").write_text("c\ts\tCDS\t1\t9\t.\t+\t0\tName=a;Name=b;note=x=y\n")
    assert seqio.read_gff3(spark, str(tmp_path / "x.gff")).first()["attrs"] == {"Name": "b", "note": "x=y"}


def test_null_records_in_fasta(spark, tmp_path):
    seqio.write_fasta(spark.createDataFrame([("a", None), (None, "ACGT")], "id string, seq string").coalesce(1), str(tmp_path / "f"))
    assert rows(seqio.read_fasta(spark, str(tmp_path / "f")).select("id", "seq")) == [("a", "")]


@pytest.mark.parametrize(("span", "share"), [((20, 30), 0.5), ((10, 30), 1.0), ((0, 40), 1.0), ((0, 5), 0.0), ((30, 40), 0.0), ((10, 20), 0.5), ((12, 14), 0.1), ((25, 99), 0.25)])
def test_interval_coverage(one, span, share):
    assert one(dates.interval_coverage(F.lit(10.0), F.lit(30.0), F.lit(float(span[0])), F.lit(float(span[1])))) == pytest.approx(share)


def test_no_symptoms(one):
    assert one(mining.worth_mining(F.col("t"), {}), t="nasal swab") is False
    assert one(mining.worth_mining(F.col("t"), {}), t="male, 3") is True
    assert one(F.col("t").rlike(mining.term_pattern([])), t="") is False


def test_one_row_a_million_times(spark):
    old = spark.range(1_000_000).select(F.lit("x").alias("a"))
    new = spark.range(3).select(F.lit("x").alias("a")).unionByName(spark.range(2).select(F.lit("y").alias("a")))
    got = {(r["a"], r["side"]): r["n"] for r in joins.row_diff(old, new).groupBy("a", "side").agg(F.count("*").alias("n")).collect()}
    assert got == {("x", "removed"): 999_997, ("y", "added"): 2}


def test_quantiles_of_equal_values(spark):
    import numpy as np

    values = [5.0] * 3000 + [float(i) for i in range(100)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "`d.x` double").repartition(3)
    shares = [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]
    assert grouping.exact_quantiles(df, "d.x", shares) == pytest.approx(np.quantile([v for v in values if v is not None], shares).tolist())
    assert grouping.exact_quantiles(df.limit(0), "d.x", [0.5]) == [None]


def test_join_qc_keeps_metadata_columns(spark):
    meta = spark.createDataFrame([("a", "en")], "accession string, lang string")
    qc = spark.createDataFrame([("a |x", "zz", 3)], "seqName string, lang string, `q.c` int")
    assert joins.join_qc(meta, qc, "accession", "seqName").collect()[0].asDict() == {"accession": "a", "lang": "en", "q.c": 3}


def test_ledger_takes_the_file_date(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("a\nb\n")
    os.utime(tmp_path / "ids.txt", (1_600_000_000, 1_600_000_000))
    found = spark.read.text(str(tmp_path)).select(F.col("value").alias("accession"), history.file_date().alias("date_added"))
    ledger = spark.createDataFrame([("a",)], "accession string").withColumn("date_added", F.lit("2000-01-01").cast("date"))
    assert {r["accession"]: str(r["date_added"]) for r in history.first_seen_ledger(ledger, found).collect()} == {"a": "2000-01-01", "b": "2020-09-13"}


def test_node_lines(spark, tmp_path):
    nodes = spark.createDataFrame([("n1", "a", "1"), ("n1", "b", "x\ny"), ("n2", "a", "é")], "node string, key string, value string")
    tabio.write_node_lines(nodes, str(tmp_path / "nodes"))
    assert rows(tabio.read_node_lines(spark, str(tmp_path / "nodes"))) == rows(nodes)


def test_rounds_leave_one_folder(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(runtime, "shared_folder", lambda _: str(tmp_path))
    chain = spark.createDataFrame([(str(i), str(i - 1) if i else None, 1.0) for i in range(40)], "node string, parent string, branch_length double")
    got = treeops.root_to_tip(chain)
    assert got.agg(F.max("divergence")).first()[0] == 39.0
    assert len(list(tmp_path.iterdir())) == 1


def test_ledger_tables_are_merged(spark, tmp_path):
    schema = "id long, ts long"
    for i in range(7):
        spark.createDataFrame([(k, 100 - i) for k in range(i, 10)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    folder = str(tmp_path / "ledger")
    got = flows.first_seen_stream(stream, folder, str(tmp_path / "c"), merge_every=3)
    assert rows(got) == sorted([(k, 100 - min(k, 6)) for k in range(10)], key=lambda t: tuple((False, str(v)) for v in t))
    assert len(os.listdir(f"{folder}/parts")) == 1 and os.listdir(f"{folder}/merged") == ["5"]
    # a merge that is repeated after a failure changes nothing
    before = rows(got)
    flows._merge(spark, folder, 5, "id")
    flows._merge(spark, folder, 6, "id")
    assert rows(flows.compact_ledger(spark, folder)) == before and os.listdir(f"{folder}/merged") == ["6"]


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.range(10).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("t"))
    plan = lambda bound: wide.join(runtime.broadcast_when_small(wide, bound=bound), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(100_000) and "SortMergeJoin" in plan(5_000)


def test_customers_of_seven_digits_have_accessions_of_their_own(spark, tmp_path):
    keys = [2, 9, 16, 100, 99_999, 100_002, 100_005, 999_999, 1_000_000, *range(1_000_001, 1_000_200), *range(1_428_000, 1_428_100), 9_999_999, 14_999_999]
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("c_name")
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").select("c_custkey", name).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k,) for k in range(25)], "n_nationkey int").write.parquet(f"{tmp_path}/nation.parquet")
    documents = [(k * 10 + 1, f"text {'a' * (k % 97)}c{'g' * (k % 89)}") for k in keys] + [(k, f"u {'t' * i}") for i, k in enumerate(keys) if k % 14 == 2]
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    queries = all_queries()
    shaped = queries["looks_like_accession"](spark, str(tmp_path)).collect()
    assert len({r.accession for r in shaped}) == len(keys) and all(r.is_accession == (r.c_custkey % 4 < 2) for r in shaped)
    registered = queries["local_id_registry"](spark, str(tmp_path)).collect()
    given = [r.seq_accession for r in registered]
    assert len(set(given)) == len(given) and sum(a.startswith("ML") for a in given) > 20
    parts = queries["update_sequences"](spark, str(tmp_path)).collect()
    for part in ("ledger", "registry"):
        named = [(r.id, r.detail)[part == "registry"] for r in parts if r.part == part]
        assert len(set(named)) == len(named)
    late = [k for k in keys if k % 14 == 2 and k % 3 and 1_000_000 <= k < 2_000_000]
    assert len(late) > 5 and {r.id for r in parts if r.part == "ledger" and r.id.startswith("M")} >= {f"ML{k - 1_000_000:06d}" for k in late}
