"""Filters, joins, aggregations, windows and set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandtide.operators import dedup, grouping, joins, select
from strandtide.operators.fuzzy import match_vocabulary, standardize_terms
from strandtide.operators.select import DropRule
from strandtide.plans.registry import query
from strandtide.plans.standins import (
    SQL_CUSTOMER_NAMES,
    SQL_SEQS,
    customer_names,
    sequences,
    table,
)
from strandtide.sources.sequences import fasta_header_fields
from strandtide.sources.tables import mapping_table, union_files

# ---- scans on columns


@query(
    "fasta_header_fields",
    f"WITH {SQL_SEQS} SELECT id AS strain, lang AS country, seq AS sequence FROM seqs JOIN documents ON doc_id = ord",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), "lang", "source")
    records = sequences(spark, sf).join(d, "ord")
    described = records.select(F.concat_ws(" | ", "id", "lang", "source").alias("description"), F.lower("seq").alias("seq"))
    return fasta_header_fields(described, ["strain", "country", "Origin"], "|", exclude=["origin"])


@query(
    "union_files",
    "SELECT doc_id, source, CASE source WHEN 'src0' THEN 0 WHEN 'src1' THEN 1 ELSE 2 END AS source_ord FROM documents",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    first = [d.filter(F.col("source") == s) for s in ("src0", "src1")]
    return union_files([*first, d.filter(~F.col("source").isin("src0", "src1"))])


_MAP = {"Building": "house", "MACHINERY": "engine", "furniture": "chair"}


@query(
    "mapping_table",
    "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'house' WHEN 'MACHINERY' THEN 'engine' WHEN 'FURNITURE' THEN 'chair' ELSE c_mktsegment END AS segment FROM customer",
)
def _(spark, sf):
    dim = mapping_table(spark, _MAP, lower_keys=True).withColumn("key", F.upper("key"))
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return joins.replace_ids(rows, dim, "segment", "ord")


# ---- filters


@query("length_between", f"WITH {SQL_SEQS} SELECT id, length(seq) AS n FROM seqs WHERE length(seq) BETWEEN 600 AND 900")
def _(spark, sf):
    lo, hi = select.SEGMENT_BOUNDS["vp1"]
    return select.length_between(sequences(spark, sf), "seq", lo, hi).select("id", F.length("seq").cast("long").alias("n"))


@query(
    "length_class",
    f"WITH {SQL_SEQS} SELECT id, 'vp1' AS class FROM seqs WHERE length(seq) > 600 AND length(seq) < 8000 UNION ALL SELECT id, 'whole_genome' FROM seqs WHERE length(seq) > 6000 AND length(seq) < 8000",
)
def _(spark, sf):
    s = sequences(spark, sf)
    part = lambda c: select.length_class(s, "seq", c).select("id", F.lit(c).alias("class"))
    return part("vp1").unionByName(part("whole_genome"))


def _id_lists(spark, sf):
    """Ids to exclude (toxic) and to include whatever happens (good quality, every fifth)."""
    labels = table(spark, sf, "labels")
    out = labels.filter("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    keep = labels.filter("quality = 1 AND doc_id % 5 = 0").select(F.col("doc_id").cast("string").alias("id"))
    return out, keep


_REASON_SQL = f"""WITH {SQL_SEQS}, j AS (SELECT s.id, s.seq, d.lang, d.source, coalesce(l.toxic = 1, false) AS listed_out, coalesce(l.quality = 1 AND l.doc_id % 5 = 0, false) AS listed_in
    FROM seqs s JOIN documents d ON d.doc_id = s.ord LEFT JOIN labels l ON l.doc_id = s.ord),
  r AS (SELECT *, CASE WHEN listed_in THEN 'force_include' WHEN listed_out THEN 'exclude' WHEN length(seq) < 600 THEN 'too_short' WHEN lower(lang) = 'de' THEN 'exclude_where' END AS reason FROM j)"""


def _flagged(spark, sf):
    out, keep = _id_lists(spark, sf)
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), "lang", "source")
    rows = sequences(spark, sf).join(d, "ord")
    rows = select.mark_listed(select.mark_listed(rows, out, "id", "listed_out"), keep, "id", "listed_in")
    rules = [
        DropRule("exclude", F.col("listed_out")),
        DropRule("too_short", F.length("seq") < 600),
        DropRule("exclude_where", select.equals_ci(F.col("lang"), "DE")),
    ]
    return rows, rules


@query("filter_with_reasons", _REASON_SQL + " SELECT id, reason FROM r WHERE reason IS NOT NULL")
def _(spark, sf):
    rows, rules = _flagged(spark, sf)
    _kept, reasons = select.filter_with_reasons(rows, rules, F.col("listed_in"))
    return reasons.select("id", "reason")


@query("exclude_include_ids", _REASON_SQL + " SELECT id, lang FROM r WHERE reason IS NULL OR reason = 'force_include'")
def _(spark, sf):
    rows, rules = _flagged(spark, sf)
    kept, _reasons = select.filter_with_reasons(rows, rules, F.col("listed_in"))
    return kept.select("id", "lang")


@query("retention_summary", _REASON_SQL + " SELECT count(*) AS n_input, count(*) FILTER (reason IS NULL OR reason = 'force_include') AS n_kept, count(*) FILTER (reason <> 'force_include') AS n_removed FROM r")
def _(spark, sf):
    rows, rules = _flagged(spark, sf)
    flagged = select.with_drop_reason(rows, rules, F.col("listed_in"))
    return grouping.retention_summary(flagged, F.col("reason").isNull() | (F.col("reason") == "force_include"))


@query("exclude_where", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def _(spark, sf):
    return select.exclude_where(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "f")


@query(
    "drop_sparse",
    "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS segment FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0",
)
def _(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(k, F.when(k % 2 == 0, F.col("c_name")).alias("name"), F.when(k % 3 == 0, F.col("c_mktsegment")).alias("segment"))
    return select.drop_sparse(rows, 2)


@query("drop_null_key", "SELECT c_name AS accession, c_custkey FROM customer WHERE c_custkey % 4 > 0")
def _(spark, sf):
    key = F.when(F.col("c_custkey") % 4 > 0, F.col("c_name"))
    return select.drop_null_key(table(spark, sf, "customer").select(key.alias("accession"), "c_custkey"), "accession")


@query("organism_is", "SELECT doc_id, 'kept' AS side, 1 AS n FROM documents WHERE lang = 'fr' UNION ALL SELECT ascii(lang), lang, count(*) FROM documents WHERE lang <> 'fr' GROUP BY lang")
def _(spark, sf):
    kept, others = select.organism_is(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "fr")
    rows = kept.select("doc_id", F.lit("kept").alias("side"), F.lit(1).cast("long").alias("n"))
    return rows.unionByName(others.select(F.ascii("organism").cast("long").alias("doc_id"), F.col("organism").alias("side"), "n"))


@query(
    "split_records",
    f"""WITH {SQL_SEQS} SELECT CASE WHEN ord % 7 = 0 THEN '' ELSE id END AS id, CASE WHEN ord % 7 = 0 THEN 'no sequence id' WHEN ord % 5 = 0 THEN 'no sequence' ELSE 'kept' END AS part,
      CASE WHEN ord % 7 > 0 AND ord % 5 > 0 THEN lang END AS country, CASE WHEN ord % 7 > 0 AND ord % 5 > 0 THEN seq END AS seq, CAST(NULL AS VARCHAR) AS absent FROM seqs JOIN documents ON doc_id = ord""",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), F.col("lang").alias("country"))
    k = F.col("ord")
    rows = sequences(spark, sf).join(d, "ord").select(
        F.when(k % 7 != 0, F.col("id")).otherwise("").alias("accession"), F.when(k % 5 != 0, F.col("seq")).alias("sequence"), "country"
    )
    meta, seqs, rejected = select.split_records(rows, "accession", "sequence", ["accession", "country", "absent"])
    good = meta.join(seqs, meta["accession"] == seqs["id"]).select("id", F.lit("kept").alias("part"), "country", "seq", "absent")
    none = F.lit(None).cast("string")
    return good.unionByName(rejected.select(F.col("accession").alias("id"), F.col("reject").alias("part"), none.alias("country"), none.alias("seq"), none.alias("absent")))


# ---- joins


@query(
    "merge_metadata",
    """WITH m AS (SELECT CASE WHEN doc_id % 50 = 7 THEN NULL ELSE doc_id - doc_id % 2 END AS k, source, doc_id FROM documents), l AS (SELECT doc_id + 3 AS k, quality, doc_id FROM labels),
    a AS (SELECT k, arg_min(source, doc_id) AS source FROM m WHERE k IS NOT NULL GROUP BY k), b AS (SELECT k, arg_min(quality, doc_id) AS quality FROM l GROUP BY k)
    SELECT coalesce(a.k, b.k) AS accession, a.source, b.quality, coalesce(a.source, 'q' || b.quality) AS either FROM a FULL JOIN b ON a.k = b.k""",
)
def _(spark, sf):
    k = F.col("doc_id")
    base = table(spark, sf, "documents").select(F.when(k % 50 != 7, k - k % 2).alias("accession"), "source", k.alias("ord"))
    extra = table(spark, sf, "labels").select((k + 3).alias("accession"), "quality", k.alias("ord"))
    both = joins.merge_sides(base, extra, "accession", "ord", "ord")
    source, quality = F.col("base")["source"], F.col("extra")["quality"]
    return both.select(
        "accession", source.alias("source"), quality.alias("quality"), F.coalesce(source, F.concat(F.lit("q"), quality.cast("string"))).alias("either")
    )


@query(
    "merge_many",
    """WITH a AS (SELECT c_custkey AS id, c_mktsegment AS segment, c_name AS name FROM customer),
    b AS (SELECT o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS segment FROM orders GROUP BY 1),
    c AS (SELECT c_custkey + 10 AS id, CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE 'late' END AS name FROM customer)
    SELECT coalesce(a.id, b.id, c.id) AS id, coalesce(b.segment, a.segment) AS segment, coalesce(nullif(trim(c.name), ''), a.name) AS name
    FROM a FULL JOIN b ON a.id = b.id FULL JOIN c ON coalesce(a.id, b.id) = c.id""",
)
def _(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    first = c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    second = o.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("segment"), F.col("o_orderkey").alias("ord"))
    third = c.select((F.col("c_custkey") + 10).alias("id"), F.when(F.col("c_custkey") % 2 == 0, " ").otherwise("late").alias("name"))
    return joins.merge_many([first, second, third], "id", order="ord")


@query(
    "left_enrich",
    "SELECT d.doc_id, d.lang, CASE WHEN l.quality IS NOT NULL THEN 'first' END AS note, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
)
def _(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    twice = labels.withColumns({"note": F.lit("second"), "ord": F.lit(2)}).unionByName(labels.withColumns({"note": F.lit("first"), "ord": F.lit(1)}))
    return joins.left_enrich(table(spark, sf, "documents").select("doc_id", "lang"), twice, "doc_id", "ord")


@query(
    "join_qc",
    "SELECT CAST(d.doc_id AS VARCHAR) AS accession, d.lang, l.quality AS missing_data, l.toxic AS divergence, d.source, d.n_chars FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
)
def _(spark, sf):
    meta = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("accession"), "lang", "source", "n_chars")
    qc = table(spark, sf, "labels").select(F.concat(F.col("doc_id").cast("string"), F.lit(" |extra|text")).alias("seqName"), F.col("quality").alias("total.Missing"), F.col("toxic").alias("totalSubstitutions"))
    return joins.join_qc(meta, qc, "accession", "seqName", {"total.Missing": "missing_data", "totalSubstitutions": "divergence"}, tail=2)


@query(
    "join_qc_all",
    "SELECT CAST(d.doc_id AS VARCHAR) AS accession, d.lang, l.quality AS \"total.Missing\", l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
)
def _(spark, sf):
    meta = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("accession"), "lang")
    qc = table(spark, sf, "labels").select(F.concat(F.col("doc_id").cast("string"), F.lit(" |extra")).alias("seqName"), F.lit("qc").alias("lang"), F.col("quality").alias("total.Missing"), "toxic")
    return joins.join_qc(meta, qc, "accession", "seqName")


_ATTACH_SQL = """WITH m AS (SELECT doc_id || '.1' AS id, lang FROM documents WHERE doc_id % 6 > 0 UNION ALL SELECT doc_id || '.1', lang FROM documents WHERE doc_id % 30 = 1),
  s AS (SELECT doc_id || '.1' AS id, quality FROM labels)"""


@query(
    "attach_sequences",
    _ATTACH_SQL + """ SELECT m.id, 'matched' AS part, 1 AS n FROM m JOIN s ON m.id = s.id UNION ALL SELECT id, 'metadata', 0 FROM m WHERE id NOT IN (SELECT id FROM s)
    UNION ALL SELECT id, 'sequences', 0 FROM s WHERE id NOT IN (SELECT id FROM m) UNION ALL SELECT id, 'twice', count(*) FROM m GROUP BY id HAVING count(*) > 1""",
)
def _(spark, sf):
    version = F.concat(F.col("doc_id").cast("string"), F.lit(".1")).alias("id")
    d = table(spark, sf, "documents")
    meta = d.filter("doc_id % 6 > 0").select(version, "lang").unionByName(d.filter("doc_id % 30 = 1").select(version, "lang"))
    seqs = table(spark, sf, "labels").select(version, "quality", F.col("doc_id").alias("ord"))
    matched, unmatched, repeated = joins.attach_sequences(meta, seqs, "id", "ord")
    row = lambda df, part, n: df.select("id", part.alias("part"), n.cast("long").alias("n"))
    return (
        row(matched, F.lit("matched"), F.lit(1))
        .unionByName(row(unmatched, F.col("side"), F.lit(0)))
        .unionByName(row(repeated, F.lit("twice"), F.col("n")))
    )


@query("semi_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, sf):
    ids = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.semi_filter(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ids, "o_orderkey")


@query("anti_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(spark, sf):
    ids = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti_filter(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ids, "o_orderkey")


def _nation_names(spark, sf):
    n = table(spark, sf, "nation")
    return n.select(F.concat(F.lit("Customer#"), F.lpad((F.col("n_nationkey") * 40).cast("string"), 9, "0")).alias("key"), F.col("n_name").alias("value"), F.col("n_nationkey").alias("ord"))


_LOOKUP_SQL = "WITH dict AS (SELECT 'Customer#' || lpad(CAST(n_nationkey * 40 AS VARCHAR), 9, '0') AS key, n_name AS value FROM nation) "


@query("lookup_override", _LOOKUP_SQL + "SELECT c_name AS strain, coalesce(value, c_mktsegment) AS accession FROM customer LEFT JOIN dict ON key = c_name")
def _(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_name").alias("strain"), F.col("c_mktsegment").alias("accession"))
    return joins.lookup_override(rows, _nation_names(spark, sf), "strain", "accession", "ord")


@query("replace_ids", _LOOKUP_SQL + "SELECT coalesce(value, c_name) AS id, c_custkey FROM customer LEFT JOIN dict ON key = c_name")
def _(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_name").alias("id"), "c_custkey")
    return joins.replace_ids(rows, _nation_names(spark, sf), "id", "ord")


@query(
    "apply_annotations",
    """WITH e AS (SELECT user_id AS id, CASE event_id % 3 WHEN 0 THEN 'name' WHEN 1 THEN 'segment' ELSE 'other' END AS field, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS value, event_id AS ord FROM events),
    last AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY id, field ORDER BY ord DESC) = 1)
    SELECT c_custkey AS id, CASE WHEN a.id IS NULL THEN c_name ELSE a.value END AS name, CASE WHEN b.id IS NULL THEN c_mktsegment ELSE b.value END AS segment FROM customer
    LEFT JOIN last a ON a.id = c_custkey AND a.field = 'name' LEFT JOIN last b ON b.id = c_custkey AND b.field = 'segment'""",
)
def _(spark, sf):
    k = F.col("event_id")
    edits = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.when(k % 3 == 0, "name").when(k % 3 == 1, "segment").otherwise("other").alias("field"),
        F.when(k % 11 != 0, F.col("event_type")).alias("value"), k.alias("ord"),
    )
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return joins.apply_annotations(rows, edits, "id", ["name", "segment"])


GEO_RULES = (
    ("AFRICA/*/*/*", "Africa/*/*/*"),
    ("*/NATION_7/*/*", "Seven//*/north"),
    ("ASIA/NATION_2/BUILDING/*", "Asia/Two/*/*"),
    ("ASIA/NATION_2/BUILDING/", "Asia/Two/none/x"),
    ("*/*/MACHINERY/*", "*/*/Machines/*"),
    ("*/*/FURNITURE/loc1", "*/*/Chairs/*"),
    ("EUROPE/*/*/loc2", "Europe/*/*/Two"),
    ("EUROPE/*/*/loc2", "Europe/*/*/Two later"),
)
_PLACES_SQL = f"""WITH {SQL_CUSTOMER_NAMES}, places AS (SELECT c_custkey, r_name AS region, n_name AS country, c_mktsegment AS division, CASE WHEN c_custkey % 4 > 0 THEN 'loc' || c_custkey % 4 END AS location FROM names),
  rules AS (SELECT * FROM (VALUES {", ".join(f"({i}, string_split('{a}', '/'), string_split('{b}', '/'), {a.count('*')})" for i, (a, b) in enumerate(GEO_RULES))}) v(ord, f, t, stars)),
  hits AS (SELECT c_custkey, t FROM places JOIN rules ON f[1] IN ('*', coalesce(region, '')) AND f[2] IN ('*', coalesce(country, '')) AND f[3] IN ('*', coalesce(division, '')) AND f[4] IN ('*', coalesce(location, ''))
    QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY stars, ord DESC) = 1)"""


def geo_rules(spark):
    return spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(GEO_RULES)], "raw string, corrected string, ord int")


def places(spark, sf):
    k = F.col("c_custkey")
    loc = F.when(k % 4 > 0, F.concat(F.lit("loc"), (k % 4).cast("string")))
    return customer_names(spark, sf).select("c_custkey", F.col("r_name").alias("region"), F.col("n_name").alias("country"), F.col("c_mktsegment").alias("division"), loc.alias("location"))


@query(
    "wildcard_rule_join",
    _PLACES_SQL + " SELECT c_custkey, " + ", ".join(
        f"CASE WHEN t IS NULL OR t[{i}] = '*' THEN {c} ELSE nullif(t[{i}], '') END AS {c}" for i, c in enumerate(("region", "country", "division", "location"), 1)
    ) + " FROM places LEFT JOIN hits USING (c_custkey)",
)
def _(spark, sf):
    return joins.wildcard_rules(places(spark, sf), geo_rules(spark), ["region", "country", "division", "location"])


_COUNTRY_SQL = "CASE c_custkey % 4 WHEN 0 THEN n_name WHEN 1 THEN replace(n_name, '_', ' ') WHEN 2 THEN 'Atlantis' END"


@query(
    "country_region",
    f"""WITH {SQL_CUSTOMER_NAMES} SELECT c_custkey, {_COUNTRY_SQL} AS country, CASE c_custkey % 4 WHEN 2 THEN 'Na' WHEN 3 THEN '' ELSE
      array_to_string(list_transform(regexp_extract_all(replace(r_name, '_', ' ') || ' Part-One', '\\p{{L}}+|\\P{{L}}+'), lambda w: upper(w[1:1]) || lower(w[2:])), '') END AS region FROM names""",
)
def _(spark, sf):
    k, n = F.col("c_custkey") % 4, F.col("n_name")
    rows = customer_names(spark, sf).select("c_custkey", F.when(k == 0, n).when(k == 1, F.replace(n, F.lit("_"), F.lit(" "))).when(k == 2, "Atlantis").alias("country"))
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    dim = nation.join(region, nation.n_regionkey == region.r_regionkey).select(n.alias("country"), F.concat("r_name", F.lit("_part-one")).alias("region"), F.col("n_nationkey").alias("ord"))
    return joins.country_region(rows, "country", dim)


@query(
    "dimension_attach",
    f"""WITH {SQL_CUSTOMER_NAMES} SELECT c_custkey, r_name AS region, CASE r_name WHEN 'ASIA' THEN '#aa0000' WHEN 'EUROPE' THEN '#0000bb' END AS region_color,
      CASE r_name WHEN 'ASIA' THEN 1.5::DOUBLE WHEN 'AFRICA' THEN -3.0 END AS lat, CASE r_name WHEN 'ASIA' THEN 100.25::DOUBLE WHEN 'AFRICA' THEN 20.0 END AS lon FROM names""",
)
def _(spark, sf):
    colors = spark.createDataFrame([("region", "asia", "#aa0000"), ("region", "Europe", "#0000bb"), ("country", "africa", "#123456")], "field string, value string, hex string")
    spots = spark.createDataFrame([("region", "Asia", 1.5, 100.25), ("region", "africa", -3.0, 20.0), ("country", "Europe", 9.0, 9.0)], "level string, name string, lat double, lon double")
    rows = customer_names(spark, sf).select("c_custkey", F.col("r_name").alias("region"))
    return joins.dimension_attach(rows, colors, spots, "region", "region")


# ---- vocabulary matching: part names against misspelt keys

VOCAB = {
    "smal ring": "little ring", "red widget": "crimson widget", "bleu bolt": "azure bolt", "Hot Gear": "warm gear", "hot gears": "too late", "cog": "cog",
    "wigdet": "widget", "smal": "little", "large": "large", "gold": "golden", "red": "crimson", "green": "green", "blu": "azure", "boltt": "bolt", "rings": "ring",
}
_VOCAB_SQL = "vocab AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{k.lower()}', '{v}')" for i, (k, v) in enumerate(VOCAB.items())) + ") v(ord, key, value))"


def _sql_match(tokens: str) -> str:
    return f"""hits AS (SELECT token, value, 100 * (1 - levenshtein(lower(token), key) / greatest(length(token), length(key))) AS score, ord FROM {tokens} JOIN vocab ON true
      WHERE 100 * (1 - levenshtein(lower(token), key) / greatest(length(token), length(key))) >= 75 QUALIFY row_number() OVER (PARTITION BY token ORDER BY score DESC, ord) = 1)"""


@query(
    "dictionary_fuzzy_join",
    f"""WITH {_VOCAB_SQL}, tokens AS (SELECT DISTINCT unnest(string_split(p_name, ' ') || [p_name, upper(p_name), p_type, p_brand]) AS token FROM part), {_sql_match('tokens')}
    SELECT token, coalesce(value, token) AS value, round(coalesce(score, 0), 6) AS score FROM tokens LEFT JOIN hits USING (token)""",
)
def _(spark, sf):
    name = F.col("p_name")
    words = F.concat(F.split(name, " "), F.array(name, F.upper(name), F.col("p_type"), F.col("p_brand")))
    tokens = table(spark, sf, "part").select(F.explode(words).alias("token")).distinct()
    hits = match_vocabulary(tokens, mapping_table(spark, VOCAB))
    return tokens.join(hits, "token", "left").select(
        "token", F.coalesce("value", "token").alias("value"), F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score")
    )


_TERM_TEXT_SQL = "CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', ' or ') WHEN 2 THEN p_type || ', ' || replace(p_name, ' ', '/') ELSE CASE WHEN p_partkey % 8 = 3 THEN 'widget' END END"


def _term_text():
    k, name = F.col("p_partkey") % 4, F.col("p_name")
    slash = F.concat("p_type", F.lit(", "), F.replace(name, F.lit(" "), F.lit("/")))
    return F.when(k == 0, name).when(k == 1, F.replace(name, F.lit(" "), F.lit(" or "))).when(k == 2, slash).otherwise(F.when(F.col("p_partkey") % 8 == 3, "widget"))


def _sql_standard(fallback: str, lower: bool, short: str = "''") -> str:
    value = f"coalesce(value, {fallback})"
    return f"""WITH {_VOCAB_SQL}, t AS (SELECT p_partkey, {_TERM_TEXT_SQL} AS term FROM part),
    parts AS (SELECT DISTINCT p_partkey, unnest(list_filter(list_transform(string_split(replace(regexp_replace(term, ',|/| or ', ';', 'g'), '  ', ' '), ';'), lambda x: trim(x)), lambda x: x <> '')) AS token FROM t),
    tokens AS (SELECT DISTINCT token FROM parts), {_sql_match('tokens')},
    done AS (SELECT p_partkey, array_to_string(list_sort(list_distinct(list({'lower(' + value + ')' if lower else value}))), '; ') AS out FROM parts LEFT JOIN hits USING (token) GROUP BY p_partkey)
    SELECT p_partkey, CASE WHEN term = {short} THEN term ELSE out END AS term FROM t LEFT JOIN done USING (p_partkey)"""


@query("standardize_isolation", _sql_standard("token", True))
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", _term_text().alias("term"))
    return standardize_terms(rows, "term", mapping_table(spark, VOCAB), 75, "lower")


@query("standardize_diagnosis", _sql_standard("CASE WHEN token = 'widget' THEN token ELSE array_to_string(list_transform(regexp_extract_all(token, '\\p{L}+|\\P{L}+'), lambda w: upper(w[1:1]) || lower(w[2:])), '') END", False, "'widget'"))
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", _term_text().alias("term"))
    return standardize_terms(rows, "term", mapping_table(spark, VOCAB), 75, "title", ["widget"])


# ---- aggregations


@query("collect_per_group", "SELECT source AS strain, row_number() OVER (PARTITION BY source ORDER BY -n_chars, doc_id) AS position, doc_id AS accession FROM documents")
def _(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("source").alias("strain"), F.col("doc_id").alias("accession"), (-F.col("n_chars")).alias("minus_length"))
    return grouping.collect_per_group(rows, "strain", "accession", ["minus_length", "accession"])


@query("collapse_rare", "WITH c AS (SELECT p_size, count(*) FILTER (p_partkey % 2 = 0) AS n FROM part GROUP BY p_size) SELECT p_partkey, CASE WHEN n >= 20 THEN CAST(part.p_size AS VARCHAR) ELSE 'other' END AS size FROM part JOIN c USING (p_size)")
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("string").alias("size"))
    return grouping.collapse_rare(rows, "size", 20, F.col("p_partkey") % 2 == 0)


@query("max_numeric_suffix", "SELECT max(CAST(regexp_extract(c_name, '(\\d+)', 1) AS BIGINT)) AS max_id FROM customer")
def _(spark, sf):
    return grouping.max_numeric_suffix(table(spark, sf, "customer"), "c_name")


@query("record_count_delta", "WITH n AS (SELECT CAST(count(*) FILTER (event_type <> 'error') AS BIGINT) AS a, CAST(count(*) FILTER (user_id % 2 = 0) AS BIGINT) AS b FROM events) SELECT a AS n_new, b AS n_old, a - b AS delta, CASE WHEN a > b THEN 'more' WHEN a < b THEN 'fewer' ELSE 'same' END AS change FROM n")
def _(spark, sf):
    e = table(spark, sf, "events")
    return grouping.record_count_delta(e.filter("event_type <> 'error'"), e.filter("user_id % 2 = 0"))


@query("duplicate_report", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf):
    return joins.duplicate_report(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


# ---- windows, sorts, samples


@query("dedup_keep_first", "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def _(spark, sf):
    return dedup.keep_first(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


@query("dedup_keep_last", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def _(spark, sf):
    return dedup.keep_last(table(spark, sf, "events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])


@query("rmdup_sequences", f"WITH {SQL_SEQS} SELECT id, seq, ord * 2 AS ord FROM seqs")
def _(spark, sf):
    s = sequences(spark, sf).withColumn("ord", F.col("ord") * 2)
    return dedup.rmdup_sequences(s.unionByName(s.withColumns({"ord": F.col("ord") + 1, "seq": F.lit("second copy")})))


@query(
    "subsample_per_group",
    """WITH o AS (SELECT o_orderkey, o_orderpriority AS country, CASE WHEN o_orderkey % 13 > 0 THEN year(o_orderdate) END AS yr, o_orderkey % 97 = 0 AS forced FROM orders),
    s AS (SELECT * FROM o WHERE NOT forced AND yr IS NOT NULL QUALIFY row_number() OVER (PARTITION BY country, yr ORDER BY md5(o_orderkey || 'seed'), o_orderkey) <= 50)
    SELECT o_orderkey, country, yr FROM s UNION ALL SELECT o_orderkey, country, yr FROM o WHERE forced""",
)
def _(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(k, F.col("o_orderpriority").alias("country"), F.when(k % 13 > 0, F.year("o_orderdate")).alias("yr"))
    return dedup.subsample_per_group(rows, ["country", "yr"], 50, "o_orderkey", "seed", k % 97 == 0)


@query(
    "assign_sequential_ids",
    "WITH n AS (SELECT DISTINCT c_mktsegment || '/' || c_name AS name FROM customer) SELECT name, 'X' || lpad(CAST(row_number() OVER (ORDER BY name) + (SELECT count(*) FROM nation) AS VARCHAR), 7, '0') AS new_id FROM n",
)
def _(spark, sf):
    names = table(spark, sf, "customer").select(F.concat_ws("/", "c_mktsegment", "c_name").alias("name")).distinct()
    start = table(spark, sf, "nation").agg(F.count(F.lit(1)).alias("max_id"))
    return dedup.assign_sequential_ids(names, "name", start)


@query("drop_duplicate_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(spark, sf):
    ids = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    rows = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", "o_custkey")
    return dedup.drop_duplicate_rows(joins.semi_filter(rows, ids, "o_custkey"))


@query("sort_by", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem ORDER BY l_quantity DESC, l_extendedprice")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return dedup.sort_by(rows, F.desc("l_quantity"), F.asc("l_extendedprice"))


@query("sample_n", "SELECT event_id, event_type FROM events ORDER BY md5(event_id || 'seed'), event_id LIMIT 100")
def _(spark, sf):
    return dedup.sample_n(table(spark, sf, "events").select("event_id", "event_type"), 100, "event_id", "seed")


# ---- set operations


@query("find_new", "SELECT o_orderkey AS id, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') AND o_orderkey NOT IN (SELECT c_custkey FROM customer)")
def _(spark, sf):
    first = table(spark, sf, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("id"))
    second = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    return joins.find_new(rows, [first, None, second], "id")


@query("union_by_name", "SELECT event_id, event_type, value, NULL::BIGINT AS user_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, event_type, NULL, user_id FROM events WHERE event_id % 2 = 1")
def _(spark, sf):
    e = table(spark, sf, "events")
    return joins.union_by_name(e.filter("event_id % 2 = 0").select("event_id", "event_type", "value"), e.filter("event_id % 2 = 1").select("user_id", "event_type", "event_id"))


@query(
    "row_diff",
    """WITH a AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 10 < 7), b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 10 > 2)
    SELECT *, 'removed' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'added' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    part = lambda cond: o.filter(cond).select("o_custkey", "o_orderstatus")
    return joins.row_diff(part("o_orderkey % 10 < 7"), part("o_orderkey % 10 > 2"))


@query("distinct_values", "SELECT DISTINCT o_custkey FROM orders")
def _(spark, sf):
    return joins.distinct_values(table(spark, sf, "orders"), "o_custkey")


# ---- the minimum slice: scan to counts

SLICE_SQL = f"""WITH {SQL_SEQS}, comp AS (SELECT id, ord, length(seq) AS n FROM seqs WHERE length(seq) BETWEEN 200 AND 8000),
  uniq AS (SELECT c.*, d.lang, d.source, l.quality, l.toxic FROM comp c JOIN documents d ON d.doc_id = c.ord LEFT JOIN labels l ON l.doc_id = c.ord
    QUALIFY row_number() OVER (PARTITION BY md5(d.text) ORDER BY c.ord) = 1),
  kept AS (SELECT * FROM uniq WHERE coalesce(quality = 1 AND ord % 5 = 0, false) OR NOT coalesce(toxic = 1, false)),
  sampled AS (SELECT * FROM kept WHERE NOT coalesce(quality = 1 AND ord % 5 = 0, false) QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY md5(id || '0'), id) <= 5
    UNION ALL SELECT * FROM kept WHERE coalesce(quality = 1 AND ord % 5 = 0, false))
  SELECT lang AS country, count(*) AS n_sequences, CAST(sum(n) AS BIGINT) AS n_letters FROM sampled GROUP BY lang"""


@query("sampled_counts_by_country", SLICE_SQL)
def sampled_counts_by_country(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), "lang", "source", F.md5("text").alias("text_key"))
    index = grouping.composition_index(select.length_between(sequences(spark, sf), "seq", 200, 8000))
    rows = index.select("id", F.col("id").cast("long").alias("ord"), "n_length").join(d, "ord")
    unique = dedup.keep_first(rows, ["text_key"], ["ord"])
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "ord").withColumn("_o", F.col("ord"))
    enriched = joins.left_enrich(unique, labels.select("ord", "quality", "toxic", F.col("ord").alias("o2")), "ord", "o2")
    forced = (F.col("quality") == 1) & (F.col("ord") % 5 == 0)
    kept, _reasons = select.filter_with_reasons(enriched, [DropRule("exclude", F.col("toxic") == 1)], forced)
    sampled = dedup.subsample_per_group(kept, ["lang", "source"], 5, "id", "0", forced)
    return sampled.groupBy(F.col("lang").alias("country")).agg(F.count(F.lit(1)).alias("n_sequences"), F.sum("n_length").alias("n_letters"))

