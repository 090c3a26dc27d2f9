from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandtide.operators import clades, dedup, features, fuzzy, grouping, history, joins, quality, seeds, select, similarity
from strandtide.operators import tree as treeops
from strandtide.plans import curation
from strandtide.sources.tables import mapping_table


def edit_distance(a: str, b: str) -> int:
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        line, old = [i], line
        for j, y in enumerate(b, 1):
            line.append(min(old[j] + 1, line[j - 1] + 1, old[j - 1] + (x != y)))
    return line[-1]


@pytest.mark.parametrize("cutoff", [55.0, 75.0, 90.0, 100.0])
def test_vocabulary_match_equals_brute_force(spark, cutoff):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    vocab = {word(rng.randint(1, 9)): f"v{i}" for i in range(40)}
    tokens = sorted({word(rng.randint(1, 10)) for _ in range(150)})
    got = {r["token"]: (r["value"], round(r["score"], 9)) for r in fuzzy.match_vocabulary(spark.createDataFrame([(t,) for t in tokens], "token string"), mapping_table(spark, vocab), cutoff).collect()}
    want = {}
    for t in tokens:
        scored = [(100 * (1 - edit_distance(t, k) / max(len(t), len(k))), -i, v) for i, (k, v) in enumerate(vocab.items())]
        score, _, value = max(scored)
        if score >= cutoff:
            want[t] = (value, round(score, 9))
    assert got == want


def test_standardize_keeps_short_forms_and_nulls(spark):
    df = spark.createDataFrame([(1, "HFMD"), (2, "fevr, COUGH"), (3, None), (4, "odd one"), (5, " ; ")], "id int, d string")
    vocab = mapping_table(spark, {"Cough": "Respiratory", "fever": "Fever"})
    out = fuzzy.standardize_terms(df, "d", vocab, 75, "title", ["HFMD"])
    assert rows(out) == [(1, "HFMD"), (2, "Fever; Respiratory"), (3, None), (4, "Odd One"), (5, "")]


def test_neighbours_equal_brute_force_with_a_hot_group_of_copies(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("ACGT") for _ in range(120))
    texts = []
    for i in range(60):
        if i % 3 == 0:
            texts.append(base)  # a third of all rows are copies
        else:
            s = list(rng.choice([base, base[:117], base + "AC"]))
            for _ in range(rng.randint(0, 8)):
                s[rng.randrange(len(s))] = rng.choice("ACGT")
            texts.append("".join(s))
    ids = [f"s{i:03d}" for i in range(60)]
    for bound in (0.95, 0.98, 1.0):
        got = rows(similarity.neighbours(spark.createDataFrame(list(zip(ids, texts)), "id string, seq string"), 4, bound).select("id", "rank", "neighbour"))
        want = []
        for i, a in zip(ids, texts):
            near = []
            for j, b in zip(ids, texts):
                same = sum(x == y for x, y in zip(a, b)) / max(len(a), len(b))
                if i != j and same >= bound - 1e-12:
                    near.append((-same, j))
            want += [(i, r, j) for r, (_, j) in enumerate(sorted(near)[:4], 1)]
        assert got == sorted(want, key=lambda t: tuple((False, str(v)) for v in t))
    with pytest.raises(ValueError):
        similarity.neighbours(spark.createDataFrame([("a", "A")], "id string, seq string"), 1, 0.5)


def test_near_identical_keeps_the_longest_and_is_idempotent(spark):
    seq = "ACGT" * 100
    data = [("a", "s", seq[:-1]), ("b", "s", seq), ("c", "s", seq), ("d", "s", "T" * 400), ("e", "t", seq), ("f", None, seq)]
    df = spark.createDataFrame(data, "id string, strain string, seq string")
    out = similarity.dedup_near_identical(df, "strain", 0.995)
    assert sorted(r["id"] for r in out.collect()) == ["b", "d", "e", "f"]
    assert rows(similarity.dedup_near_identical(out, "strain", 0.995)) == rows(out)


def test_rank_in_group_is_exact_under_skew(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"), F.col("id").alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "k string, v long"))
    got = rows(dedup.rank_in_group(df, ["k"], ["v"]))
    seen: dict = {}
    for k, v, p in sorted(got, key=lambda t: (str(t[0]), t[1])):
        seen[k] = seen.get(k, 0) + 1
        assert p == seen[k]
    assert len(got) == 3002


def test_exact_quantiles(spark):
    df = spark.range(101).select((F.col("id") * 2.0).alias("x")).unionByName(spark.createDataFrame([(None,)], "x double"))
    assert grouping.exact_quantiles(df, "x", (0.0, 0.25, 0.505, 1.0)) == pytest.approx([0, 50, 101, 200])
    assert grouping.exact_quantiles(df.filter("x < 0"), "x", (0.5,)) == [None]


def test_top_n_above_the_planner_limit(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), "id")
    assert dedup.top_n(df, ["k"], [F.desc("id")], 1500).agg(F.min("id"), F.count("id")).first()[:] == (3500, 1500)
    assert dedup.keep_first(df, ["k"], ["id"]).collect()[0]["id"] == 0


def test_keep_first_cuts_before_the_shuffle(spark):
    plan = dedup.keep_first(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_subsample_forced_rows_do_not_count(spark):
    df = spark.range(40).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") < 30, "x").alias("country"))
    out = dedup.subsample_per_group(df, ["country"], 5, "id", "s", F.col("id").isin("1", "35"))
    ids = {r["id"] for r in out.collect()}
    assert len(ids) == 7 and {"1", "35"} <= ids


def test_reasons_partition_the_input(spark):
    df = spark.range(20).select(F.col("id"))
    rules = [select.DropRule("even", F.col("id") % 2 == 0), select.DropRule("big", F.col("id") > 10)]
    kept, reasons = select.filter_with_reasons(df, rules, F.col("id") == 4)
    why = {r["id"]: r["reason"] for r in reasons.collect()}
    assert why[4] == "force_include" and why[12] == "even" and why[13] == "big"
    assert {r["id"] for r in kept.collect()} == {1, 3, 4, 5, 7, 9}


def test_guards(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    with pytest.raises(ValueError):
        select.duplicate_column(df, "z", "w")
    with pytest.raises(ValueError):
        select.duplicate_column(df, "x", "y")
    with pytest.raises(ValueError):
        select.length_class(df, "x", "other")
    assert select.rename_fields(df, {"x": "a", "q": "b"})[1] == ["q"]
    out, unknown = select.resolve_columns(spark.createDataFrame([("F",)], "sex string"), ["gender", "nope"])
    assert out.columns == ["gender"] and unknown == ["nope"]


def test_names_with_dots_survive(spark):
    df = spark.createDataFrame([("a", "good")], "`id` string, `qc.overallStatus` string")
    dim = spark.createDataFrame([("a", "b", 1)], "key string, value string, ord int")
    assert joins.replace_ids(df, dim, "id", "ord").collect()[0][:] == ("b", "good")


def test_wildcards(spark):
    rules = spark.createDataFrame([("A/*/*/*", "Z/*/*/*", 0), ("A/b/*/*", "*/B//*", 1), ("A/b/*/*", "*/BB//*", 2), ("*/*/c/", "*/*/C/x", 3)], "raw string, corrected string, ord int")
    df = spark.createDataFrame([(1, "A", "b", "d", "e"), (2, "A", "q", None, None), (3, "Q", "q", "c", None), (4, "Q", "q", "c", "l"), (5, None, None, None, None)], "id int, region string, country string, division string, location string")
    out = joins.wildcard_rules(df, rules, ["region", "country", "division", "location"])
    assert rows(out) == [(1, "A", "BB", None, "e"), (2, "Z", "q", None, None), (3, "Q", "q", "C", "x"), (4, "Q", "q", "c", "l"), (5, None, None, None, None)]


def test_annotations_last_edit_wins_even_with_null(spark):
    df = spark.createDataFrame([("a", "x", "y"), ("b", "x", "y")], "id string, f string, g string")
    edits = spark.createDataFrame([("a", "f", "1", 1), ("a", "f", "2", 2), ("b", "g", "3", 1), ("b", "g", None, 4), ("c", "f", "9", 1)], "id string, field string, value string, ord int")
    assert rows(joins.apply_annotations(df, edits, "id", ["f", "g"])) == [("a", "2", "y"), ("b", "x", None)]


def test_merge_many_later_non_empty_wins(spark):
    a = spark.createDataFrame([("k", "1", "x")], "id string, p string, q string")
    b = spark.createDataFrame([("k", "", "y"), ("m", "2", None)], "id string, p string, q string")
    assert rows(joins.merge_many([a, b], "id").select("id", "p", "q")) == [("k", "1", "y"), ("m", "2", None)]


def test_attach_sequences_does_not_multiply(spark):
    meta = spark.createDataFrame([("a", i) for i in range(3)] + [("b", 9)], "id string, m int")
    seqs = spark.createDataFrame([("a", f"S{i}", i) for i in range(4)] + [("c", "S", 1)], "id string, seq string, ord int")
    matched, unmatched, repeated = joins.attach_sequences(meta, seqs, "id", "ord")
    assert rows(matched.select("m", "seq")) == [(0, "S0"), (1, "S0"), (2, "S0")]
    assert rows(unmatched) == [("b", "metadata"), ("c", "sequences")]
    assert rows(repeated) == [("a", 3, "metadata"), ("a", 4, "sequences")]


def test_find_new_without_known_tables(spark):
    df = spark.createDataFrame([("a",), ("b",)], "id string")
    assert joins.find_new(df, [None], "id").count() == 2
    assert rows(joins.find_new(df, [df.filter("id = 'a'"), None], "id")) == [("b",)]


def test_seed_hits(spark):
    ref = "ACGTTGCATGCCTAGGATCCATTGCAAGTCCGATTACGGCATCGATTAGC"
    query = "GGGG" + ref[5:25] + "C" + ref[26:45]
    q = spark.createDataFrame([("q1", query, 1), ("q2", "GGGGGGGG", 2), ("q3", query, 3)], "id string, seq string, ord int")
    r = spark.createDataFrame([("r", ref)], "id string, seq string")
    hits = seeds.kmer_hits(q, r, max_evalue=10.0).collect()
    assert sorted(h["qseqid"] for h in hits) == ["q1", "q3"]
    h = hits[0]
    assert (h["qstart"], h["qend"], h["sstart"], h["send"], h["length"], h["mismatch"], h["qcovs"]) == (5, 44, 6, 45, 40, 1, 90)
    ordered = seeds.with_hit_order(seeds.kmer_hits(q, r, max_evalue=10.0))
    assert rows(seeds.cut_region(q, ordered, 39, 40).select("id", "seq")) == [("q1", query[4:]), ("q3", query[4:])]
    assert seeds.project_ungapped(q, ordered, r).filter("id = 'q1'").first()["aligned"][5:45] == query[4:]


def test_seed_hits_without_broadcast_are_the_same(spark, monkeypatch):
    rng = random.Random(5)
    ref = "".join(rng.choice("ACGT") for _ in range(400))
    q = spark.createDataFrame([(f"q{i}", ref[i * 7 : i * 7 + 60] + "N" + ref[i : i + 30], i) for i in range(30)], "id string, seq string, ord int")
    r = spark.createDataFrame([("r1", ref), ("r2", ref[100:300])], "id string, seq string")
    small = rows(seeds.kmer_hits(q, r))
    monkeypatch.setattr(seeds, "BROADCAST_LETTERS", 1)
    assert rows(seeds.kmer_hits(q, r)) == small and small


def test_mutation_positions(spark):
    coords = spark.createDataFrame([("VP4", 1, 207), ("VP2", 208, 969)], "protein string, start int, end int")
    muts = lambda *r: spark.createDataFrame(list(r), "feature_set string, protein string, label string")
    assert rows(features.mutation_positions(muts(("C", "VP2", "170V"), ("C", "VP2", "170I"), ("C", "VP4", "7A")), coords)) == [("C", 239), ("C", 7)]
    for bad in (("C", "VP4", "70A"), ("C", "VP4", "A"), ("C", "VP9", "1A")):
        with pytest.raises(Exception, match="out of range"):
            features.mutation_positions(muts(bad), coords).collect()


def test_quality(spark):
    r = spark.createDataFrame([("r", "ATGAAATTTTAA")], "id string, seq string")
    a = spark.createDataFrame([("x", "-TGA-ATTTTAA", "r"), ("y", "ATGTAATTTNNN", "r")], "id string, seq string, ref_id string")
    out = {x["id"]: x for x in quality.seq_qc(a, r).collect()}
    assert (out["x"]["n_frame_shifts"], out["x"]["align_start"], out["x"]["align_end"]) == (1, 2, 12)
    assert (out["y"]["n_stops"], out["y"]["n_missing"], out["y"]["overall_status"]) == (1, 3, "good")


TREE = [("r", None, False, 0.0), ("a", "r", False, 1.0), ("b", "r", False, 2.0), ("a1", "a", True, 0.5), ("a2", "a", True, 0.5), ("b1", "b", True, 1.0), ("b2", "b", True, 1.0), ("b3", "b", True, 1.0), ("c", "r", True, 9.0)]


@pytest.fixture(scope="module")
def small_tree(spark):
    return spark.createDataFrame(TREE, "node string, parent string, is_tip boolean, branch_length double")


def test_paths_and_cycles(spark, small_tree):
    depth = {r["node"]: r["depth"] for r in treeops.with_parents(small_tree).collect()}
    assert depth == {"r": 0, "a": 1, "b": 1, "c": 1, "a1": 2, "a2": 2, "b1": 2, "b2": 2, "b3": 2}
    assert {r["node"]: r["divergence"] for r in treeops.root_to_tip(small_tree).collect()}["b1"] == 3.0
    chain = spark.createDataFrame([(str(i), str(i - 1) if i else None, 1.0) for i in range(150)], "node string, parent string, branch_length double")
    assert treeops.with_parents(chain).agg(F.max("depth")).first()[0] == 149


def test_cycle_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(treeops, "MAX_ROUNDS", 5)
    loop = spark.createDataFrame([("x", "y", 1.0), ("y", "x", 1.0)], "node string, parent string, branch_length double")
    with pytest.raises(ValueError, match="cycle"):
        treeops.root_paths(loop)


def test_inherit_through_unknown_parents_and_root(spark):
    nodes = spark.createDataFrame([("r", None, "XX"), ("a", "r", "AX"), ("b", "a", "XB"), ("c", "a", "CC"), ("d", "c", "X")], "node string, parent string, v string")
    assert rows(treeops.inherit_when_unknown(nodes, "v").select("node", "v")) == [("a", "XX"), ("b", "XX"), ("c", "CC"), ("d", "CC"), ("r", "XX")]


def test_parsimony(spark, small_tree):
    tips = spark.createDataFrame([("a1", "A"), ("a2", "G"), ("b1", "G"), ("b2", "G"), ("b3", "N"), ("c", "T")], "node string, state string")
    got = dict(rows(treeops.parsimony_states(small_tree, tips)))
    assert got == {"r": "G", "a": "G", "b": "G", "a1": "A", "a2": "G", "b1": "G", "b2": "G", "c": "T"}


def test_clades(spark):
    rules = spark.createDataFrame([("B", "nuc", "1", "C"), ("B1", "clade", "B", None), ("B1", "nuc", "2", "T"), ("A9", "nuc", "2", "T")], "clade string, gene string, site string, alt string")
    seqs = spark.createDataFrame([("x", "CTA"), ("y", "CAA"), ("z", "GGG"), ("w", "CTA"), ("v", "ATA")], "id string, seq string")
    states = clades.site_states(seqs, [("nuc", 1), ("nuc", 2)], {})
    assert rows(clades.clade_by_rules(seqs, states, rules)) == [("v", "A9"), ("w", "B1"), ("x", "B1"), ("y", "B"), ("z", "unassigned")]
    # duplicated states change nothing
    assert rows(clades.clade_by_rules(seqs, states.unionAll(states), rules)) == rows(clades.clade_by_rules(seqs, states, rules))
    loop = spark.createDataFrame([("P", "clade", "Q", None), ("Q", "clade", "P", None)], "clade string, gene string, site string, alt string")
    with pytest.raises(ValueError, match="cycle"):
        clades.inherited_rules(loop)


def test_clock_filter_without_rows(spark):
    assert clades.clock_filter(spark.createDataFrame([], "divergence double, date double")).count() == 0


def test_ledger_keeps_the_first_date(spark):
    led = spark.createDataFrame([("a", "2020-01-01")], "accession string, d string").select("accession", F.col("d").cast("date").alias("date_added"))
    ids = spark.createDataFrame([("a",), ("b",), ("b",)], "accession string")
    out = history.first_seen_ledger(led, ids, "2024-01-01")
    assert rows(out.select("accession", F.col("date_added").cast("string"))) == [("a", "2020-01-01"), ("b", "2024-01-01")]


def test_registry(spark):
    cols = "internal_accession string, sample_name string, gb_accession string, date_added string, seq_accession string"
    reg = spark.createDataFrame([("X0000004", "s1", "bad", "d", "X0000004"), ("X0000002", "s2", "AB123456", "d", "AB123456")], cols)
    names = spark.createDataFrame([("s1",), ("zz",), ("AB999999",), ("aa",)], "name string")
    acc = spark.createDataFrame([("s1", "MK000001"), ("s2", "MK000002")], "sample_name string, accession string")
    out = history.local_id_registry(reg, names, acc, "now")
    assert rows(out.select("sample_name", "internal_accession", "gb_accession", "seq_accession")) == [
        ("aa", "X0000005", "NA", "X0000005"), ("s1", "X0000004", "MK000001", "MK000001"), ("s2", "X0000002", "AB123456", "AB123456"), ("zz", "X0000006", "NA", "X0000006"),
    ]
    empty = history.local_id_registry(reg.filter("false"), names.filter("name = 'zz'"), None, "now")
    assert empty.first()["internal_accession"] == "X0000001"


def test_snapshots(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(2, None), (1, "x"), (1, "x")], "i int, s string")
    assert history.snapshot_unchanged(a, b).first()[0] is True
    assert history.snapshot_unchanged(a, b.distinct()).first()[0] is False
    assert history.snapshot_unchanged(a.filter("i > 5"), b.filter("i > 5")).first()[0] is True
    rep = history.snapshot_report(a, b.distinct()).first()
    assert (rep["n_added"], rep["n_removed"], rep["delta"], rep["change"]) == (0, 1, -1, "fewer")


def test_source_records_null_diagnosis_and_note(spark):
    cols = "accession organism strain isolate geo_loc_name isolation_source host note collection_date title pubmed_id".split()
    data = [
        ("a", "E", "s", None, "NL: Delft", None, "Homo sapiens", None, "2011-05", "plain", None),
        ("b", "E", None, "iso-Utrecht", "NL", "stool", "human, 3 years, fever", "patient 4 years; severity score: 2 outcome: ok", None, "type B5", "77"),
        ("c", "other", "s", None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    out = {r["accession"]: r for r in curation.source_record(df, "E", {"fever": "Fever"}, ["Utrecht"]).collect()}
    assert set(out) == {"a", "b"}
    assert (out["a"]["diagnosis"], out["a"]["location"], out["a"]["collection_yr"], out["a"]["doi"]) == (None, "Delft", "2011", "genbank corrections")
    b = out["b"]
    assert (b["strain"], b["location"], b["age_yrs"], b["diagnosis"], b["isolation"], b["subgenogroup"], b["doi"]) == ("iso-Utrecht", "Utrecht", 4.0, "severity 2; ok", "stool", "B5", "PMID: 77")
