from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandtide.sources import sequences as seqio
from strandtide.sources import tables as tabio
from strandtide.streaming import flows


def put(tmp_path, name, content):
    path = tmp_path / name
    path.write_bytes(content.encode())
    return str(path)


def test_fasta_wrapped_lines_crlf_and_order(spark, tmp_path):
    path = put(tmp_path, "x.fasta", ">a one\r\nAC\r\nGT\r\n>b\n\n>a two words\nTT-N\n")
    got = seqio.read_fasta(spark, path).orderBy("ord").collect()
    assert [(r["id"], r["description"], r["seq"]) for r in got] == [("a", "a one", "ACGT"), ("b", "b", ""), ("a", "a two words", "TT-N")]


def test_fasta_over_many_splits(spark, tmp_path):
    n = 4000
    path = put(tmp_path, "big.fasta", "".join(f">s{i} x\n{'ACGT' * (i % 30 + 1)}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = seqio.read_fasta(spark, path)
        assert df.rdd.getNumPartitions() > 3
        got = df.orderBy("ord").select("id", F.length("seq").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r["id"], r["n"]) for r in got] == [(f"s{i}", 4 * (i % 30 + 1)) for i in range(n)]


def test_header_fields_and_guards(spark):
    df = spark.createDataFrame([("s1 | NL |2020", "acgt")], "description string, seq string")
    out = seqio.fasta_header_fields(df, ["Strain", "country", "date"], "|", ["date"])
    assert out.columns == ["strain", "country", "sequence"] and out.first()[:] == ("s1", "NL", "ACGT")
    for fields, exclude in ((["country"], []), (["strain", "sequence"], []), (["strain"], ["strain"]), (["strain"], ["x"])):
        with pytest.raises(ValueError):
            seqio.fasta_header_fields(df, fields, "|", exclude)


GENBANK = '''LOCUS       U1 20 bp
DEFINITION  Some virus,
            complete genome.
ACCESSION   U1
VERSION     U1.1
FEATURES             Location/Qualifiers
     source          1..20
                     /organism="Enterovirus A71"
                     /note="long
                     note"
     CDS             complement(join(2..4,
                     7..9))
                     /product="VP1"
                     /pseudo
                     /db_xref="a"
                     /db_xref="b"
ORIGIN
        1 acgtacgtac gtacgtacgt
//
LOCUS       U2
DEFINITION  Two.
ACCESSION   U2
VERSION     U2.3
FEATURES             Location/Qualifiers
     source          <1..>4
ORIGIN
        1 aaaa
//
'''


def test_genbank(spark, tmp_path):
    rec = seqio.read_genbank(spark, put(tmp_path, "x.gb", GENBANK))
    assert rows(rec.select("accession", "version", "definition")) == [("U1", "U1.1", "Some virus, complete genome."), ("U2", "U2.3", "Two.")]
    assert rows(seqio.genbank_sequences(rec)) == [("U1.1", "ACGT" * 5), ("U2.3", "AAAA")]
    f = {(r["seqid"], r["type"]): r for r in seqio.genbank_features(rec).collect()}
    cds = f[("U1.1", "CDS")]
    assert (cds["start"], cds["end"], cds["strand"], cds["attrs"]["product"], cds["attrs"]["db_xref"]) == (2, 9, "-", "VP1", "a")
    assert f[("U1.1", "source")]["attrs"]["note"] == "long note"
    assert f[("U2.3", "source")]["end"] == 4


def test_gff3_names(spark, tmp_path):
    row = "s\tx\t{}\t{}\t{}\t.\t+\t.\tName={};product=p=q"
    path = put(tmp_path, "x.gff3", "##gff\n\n" + "\n".join([row.format("CDS", 1, 207, "VP4"), row.format("CDS", 208, 969, "VP2"), row.format("region", 1, 9, "VP1"), "bad line"]))
    assert rows(seqio.read_gff3(spark, path, ["CDS"], ["VP4"]).select("start", "end", F.col("attrs")["product"])) == [(1, 207, "p=q")]
    with pytest.raises(ValueError, match="VP1"):
        seqio.read_gff3(spark, path, ["CDS"], ["VP4", "VP1"])


def test_tables(spark, tmp_path):
    path = put(tmp_path, "x.tsv", "a\tb\n1\tNA\n\t x y\n")
    assert rows(tabio.read_table(spark, path).drop("ord")) == [("1", None), (None, " x y")]
    assert rows(tabio.read_table(spark, path, null_tokens=()).drop("ord")) == [("", " x y"), ("1", "NA")]
    bare = put(tmp_path, "y.csv", "q,1\nr,2\n")
    assert rows(tabio.read_table(spark, bare, columns=["id", "n"]).drop("ord")) == [("q", "1"), ("r", "2")]


def test_write_tsv_fills_and_drops_columns(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "x"', 1)], "id string, note string, extra int")
    path = str(tmp_path / "out")
    tabio.write_tsv(df, path, ["note", "gone", "id"])
    back = tabio.read_table(spark, path, sep="\t").drop("ord")
    assert back.columns == ["note", "gone", "id"] and back.first()[:] == ('say "x"', None, "a")


def test_id_list_rules_and_node_data(spark, tmp_path):
    ids = put(tmp_path, "ids.txt", "# head\nA1\t\t\nB2  # why\n\nA1\n")
    assert rows(tabio.read_id_list(spark, ids)) == [("A1",), ("B2",)]
    rules = put(tmp_path, "r.tsv", "clade\tgene\tsite\talt\r\nB\tnuc\t204\tC\r\n\r\nB1\tclade\tB\r\n")
    assert rows(tabio.read_rule_table(spark, rules).drop("ord")) == [("B", "nuc", "204", "C"), ("B1", "clade", "B", None)]
    geo = put(tmp_path, "g.tsv", "# note\nA/b/*/*\tA/B//*\nx/y/z/w\tX/Y/Z/W # trailing\n")
    assert rows(tabio.read_geo_rules(spark, geo).drop("ord")) == [("A/b/*/*", "A/B//*"), ("x/y/z/w", "X/Y/Z/W")]
    node = put(tmp_path, "n.json", '{"generated": 1,\n "nodes": {"n1": {"clade": "B"}, "n2": {"clade": "C"}}}')
    assert rows(tabio.read_node_data(spark, node)) == [("n1", "clade", "B"), ("n2", "clade", "C")]
    nd = put(tmp_path, "n.ndjson", '{"a": 1, "b": "x"}\n{"a": 2}\n')
    assert rows(tabio.read_ndjson(spark, nd, "a string, b string")) == [("1", "x"), ("2", None)]


def test_repeated_stream_batch_replaces_itself(spark, tmp_path):
    ids = spark.createDataFrame([("a", 3), ("b", 1), ("a", 2)], "id string, ts int")
    src = str(tmp_path / "src")
    ids.repartition(3).write.parquet(src)
    for _ in range(2):  # the second run finds nothing new and must not change the ledger
        stream = spark.readStream.schema(ids.schema).option("maxFilesPerTrigger", 1).parquet(src)
        out = flows.first_seen_stream(stream, str(tmp_path / "led"), str(tmp_path / "ckpt"))
        assert rows(out) == [("a", 2), ("b", 1)]
