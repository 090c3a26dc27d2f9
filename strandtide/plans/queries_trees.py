"""Tree and clade operators over trees derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandtide.functions import sequence as seqfn
from strandtide.functions.dates import numeric_date
from strandtide.operators import clades, features, grouping, tree as treeops
from strandtide.operators.joins import dimension_attach
from strandtide.plans.queries_sequences import SQL_HITS, search_hits, sql_protein
from strandtide.plans.registry import query
from strandtide.plans.standins import GAPPED, SQL_GAPPED, SQL_TREE, as_bases, sequences, table, tree
from strandtide.operators.seeds import hit_lengths
from strandtide.runtime import cut_lineage, fresh_path, spread_when_few
from strandtide.sources.tables import read_rule_table

# ---- paths


@query(
    "with_parents",
    f"""WITH RECURSIVE {SQL_TREE}, walk AS (SELECT node, parent, 0 AS depth FROM tree WHERE parent IS NULL UNION ALL SELECT t.node, t.parent, depth + 1 FROM tree t JOIN walk w ON t.parent = w.node)
    SELECT node, parent, depth FROM walk""",
)
def _(spark, sf):
    return treeops.with_parents(tree(spark, sf))


@query(
    "root_to_tip",
    f"""WITH RECURSIVE {SQL_TREE}, walk AS (SELECT node, 0.0::DOUBLE AS divergence FROM tree WHERE parent IS NULL UNION ALL SELECT t.node, divergence + branch_length FROM tree t JOIN walk w ON t.parent = w.node)
    SELECT node, round(divergence, 6) AS divergence FROM walk""",
)
def _(spark, sf):
    return treeops.root_to_tip(tree(spark, sf)).withColumn("divergence", F.round("divergence", 6))


# ---- a tree over documents: root, language, source, document; inner nodes carry their first document's letters


def document_tree(spark, sf):
    """(node, parent, is_tip, seq), stored once: queries read the node table several times and `documents` once."""
    d = spread_when_few(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"))
    cells = lambda node, parent, tip: [node.alias("node"), parent.cast("string").alias("parent"), F.lit(tip).alias("is_tip")]
    source = F.concat(F.lit("S-"), "lang", F.lit("-"), "source")
    lang = F.concat(F.lit("L-"), "lang")
    seq = as_bases(F.col("text"), GAPPED).alias("seq")
    tips = cut_lineage(d.select(F.col("doc_id").alias("ord"), "lang", "source", seq))
    # inner nodes carry the letters of their first document, found by number: no letters are grouped
    firsts = cut_lineage(tips.groupBy("lang", "source").agg(F.min("ord").alias("ord")))
    by_source = firsts.select(*cells(source, lang, False), "ord")
    by_lang = firsts.groupBy("lang").agg(F.min("ord").alias("ord")).select(*cells(lang, F.lit("root"), False), "ord")
    root = firsts.agg(F.min("ord").alias("ord")).where("ord is not null").select(*cells(F.lit("root"), F.lit(None), False), "ord")
    inner = by_source.unionByName(by_lang).unionByName(root).join(tips.select("ord", "seq"), "ord").drop("ord")
    return cut_lineage(tips.select(*cells(F.concat(F.lit("D"), F.col("ord").cast("string")), source, True), "seq").unionByName(inner))


SQL_DOC_TREE = f"""{SQL_GAPPED}, sd AS (SELECT ord, seq, lang, source FROM seqs JOIN documents ON doc_id = ord),
  nodes AS (SELECT 'D' || ord AS node, 'S-' || lang || '-' || source AS parent, true AS is_tip, seq FROM sd
    UNION ALL SELECT 'S-' || lang || '-' || source, 'L-' || lang, false, arg_min(seq, ord) FROM sd GROUP BY lang, source
    UNION ALL SELECT 'L-' || lang, 'root', false, arg_min(seq, ord) FROM sd GROUP BY lang UNION ALL SELECT 'root', NULL, false, arg_min(seq, ord) FROM sd)"""


@query(
    "inherit_when_unknown",
    f"""WITH RECURSIVE {SQL_DOC_TREE}, c AS (SELECT node, parent, array_to_string(list_transform([{', '.join(map(str, clades.EPITOPES["CTERM"]))}], lambda p: substr(seq, p, 1)), '') AS v FROM nodes),
    walk AS (SELECT node, v FROM c WHERE parent IS NULL UNION ALL SELECT c.node, CASE WHEN contains(c.v, 'N') THEN w.v ELSE c.v END FROM c JOIN walk w ON c.parent = w.node)
    SELECT node, parent, walk.v AS cterm FROM walk JOIN c USING (node)""",
)
def _(spark, sf):
    n = document_tree(spark, sf).select("node", "parent", seqfn.positions_string(F.col("seq"), clades.EPITOPES["CTERM"]).alias("cterm"))
    return treeops.inherit_when_unknown(n, "cterm", "N")


@query(
    "branch_mutations",
    f"""WITH {SQL_DOC_TREE}, pair AS (SELECT a.node, a.seq AS s, b.seq AS r FROM nodes a JOIN nodes b ON a.parent = b.node),
    p AS (SELECT node, unnest(range(1, least(length(s), length(r)) + 1)) AS pos, unnest(string_split(left(s, least(length(s), length(r))), '')) AS s, unnest(string_split(left(r, least(length(s), length(r))), '')) AS r FROM pair)
    SELECT node, CAST(pos AS INTEGER) AS pos, r AS ref, s AS alt FROM p WHERE r <> s AND r NOT IN ('-', 'N') AND s NOT IN ('-', 'N')""",
)
def branch_mutations(spark, sf):
    n = document_tree(spark, sf)
    return treeops.branch_mutations(n, n.select(F.col("node").alias("id"), "seq"))


@query("value_counts_on_tips", f"WITH {SQL_TREE} SELECT 'priority' AS feature, trait AS value, count(*) AS n FROM tree WHERE is_tip GROUP BY trait")
def _(spark, sf):
    t = tree(spark, sf).select("is_tip", F.lit("priority").alias("feature"), F.col("trait").alias("value"))
    return grouping.value_counts_on_tips(t, "feature", "value")


@query("validate_set", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'other' END AS value FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", clades.validate_set(F.col("event_type"), ["click", "view"]).alias("value"))


_EPI = {name: "array_to_string(list_transform([" + ", ".join(map(str, p)) + f"], lambda p: substr(protein, p, 1)), '')" for name, p in clades.EPITOPES.items()}


@query(
    "epitope_strings",
    f"""WITH RECURSIVE {SQL_DOC_TREE}, pr AS (SELECT node, parent, is_tip, {sql_protein('seq')} AS protein FROM nodes),
    e AS (SELECT node, parent, is_tip, {', '.join(f'{x} AS "{n}"' for n, x in _EPI.items())} FROM pr),
    walk AS (SELECT node, "CTERM" AS v FROM e WHERE parent IS NULL UNION ALL SELECT e.node, CASE WHEN contains(e."CTERM", 'X') THEN w.v ELSE e."CTERM" END FROM e JOIN walk w ON e.parent = w.node),
    r AS (SELECT e.* REPLACE (walk.v AS "CTERM", CASE WHEN "Esc_CHN" IN ('SA', 'TA', 'TX', 'TS', 'SS', 'XX') THEN "Esc_CHN" ELSE 'other' END AS "Esc_CHN") FROM e JOIN walk USING (node))
    SELECT node, {', '.join(f'CASE WHEN count(*) FILTER (is_tip) OVER (PARTITION BY "{n}") >= 6 THEN "{n}" ELSE ' + "'other'" + f' END AS "{n}"' for n in _EPI)} FROM r""",
)
def _(spark, sf):
    n = document_tree(spark, sf).withColumn("protein", seqfn.translate_seq(F.col("seq")))
    return clades.epitope_strings(n)


_KEY_POSITIONS = {"C1": [1, 16, 19, 119], "C2": [22, 2, 31]}


@query(
    "key_mutation_strings",
    f"""WITH {SQL_DOC_TREE}, pr AS (SELECT node, is_tip, {sql_protein('seq')} AS protein FROM nodes),
    k AS (SELECT node, is_tip, array_to_string(list_transform([1, 16, 19, 119], lambda p: substr(protein, p, 1)), '') AS c1, array_to_string(list_transform([2, 22, 31], lambda p: substr(protein, p, 1)), '') AS c2 FROM pr)
    SELECT node, CASE WHEN count(*) FILTER (is_tip) OVER (PARTITION BY c1) >= 1 THEN c1 ELSE 'other' END AS "C1", CASE WHEN count(*) FILTER (is_tip) OVER (PARTITION BY c2) >= 1 THEN c2 ELSE 'other' END AS "C2" FROM k""",
)
def _(spark, sf):
    return clades.key_mutation_strings(document_tree(spark, sf), _KEY_POSITIONS)


@query(
    "key_mutations_from_labels",
    f"""WITH {SQL_DOC_TREE}, pr AS (SELECT node, is_tip, {sql_protein('seq')} AS protein FROM nodes),
    pos AS (SELECT DISTINCT 'VP4' AS s, CAST(p_size AS INTEGER) AS p FROM part WHERE p_size <= 30 UNION SELECT 'VP1', CAST(565 + p_size % 4 + 1 AS INTEGER) FROM part),
    k AS (SELECT node, is_tip, coalesce(string_agg(substr(protein, p, 1), '' ORDER BY p) FILTER (s = 'VP1'), '') AS c1, coalesce(string_agg(substr(protein, p, 1), '' ORDER BY p) FILTER (s = 'VP4'), '') AS c4 FROM pr, pos GROUP BY ALL)
    SELECT node, CASE WHEN count(*) FILTER (is_tip) OVER (PARTITION BY c1) >= 1 THEN c1 ELSE 'other' END AS "VP1", CASE WHEN count(*) FILTER (is_tip) OVER (PARTITION BY c4) >= 1 THEN c4 ELSE 'other' END AS "VP4" FROM k""",
)
def _(spark, sf):
    size = F.col("p_size")
    part = table(spark, sf, "part")
    label = lambda n: F.concat(n.cast("string"), F.lit("M"))
    late = part.select(F.lit("VP4").alias("feature_set"), F.lit("VP4").alias("protein"), label(size).alias("label")).filter("cast(replace(label, 'M', '') as int) <= 30")
    muts = late.unionByName(part.select(F.lit("VP1").alias("feature_set"), F.lit("VP1").alias("protein"), label(size % 4 + 1).alias("label")))
    coords = spark.createDataFrame([("VP1", 1696, 2586), ("VP4", 1, 207)], "protein string, start int, end int")
    return clades.key_mutations_at(document_tree(spark, sf), features.mutation_positions(muts, coords))


# ---- clade rules

RULES = (
    ("A", "nuc", "1", "A"), ("B", "nuc", "1", "C"), ("B1", "clade", "B", None), ("B1", "nuc", "3", "G"), ("B2", "clade", "B1", None), ("B2", "nuc", "7", "A"),
    ("C", "VP", "2", "T"), ("C1", "clade", "C", None), ("C1", "nuc", "2", "C"), ("D", "nuc", "2", "G"),
)
SITES = tuple(dict.fromkeys((g, int(s)) for _, g, s, _alt in RULES if g != "clade"))


def clade_rules(spark):
    return spark.createDataFrame(list(RULES), "clade string, gene string, site string, alt string")


def doc_states(spark, sf, nodes):
    return clades.site_states(nodes, SITES, {"VP": (1, 30)})


_RULE_ROWS = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in r) + ")" for r in RULES)
SQL_CLADES = f"""rules AS (SELECT * FROM (VALUES {_RULE_ROWS}) v(clade, gene, site, alt)),
  up AS (SELECT DISTINCT clade, clade AS src, 0 AS depth FROM rules UNION ALL SELECT up.clade, r.site, depth + 1 FROM up JOIN rules r ON r.clade = up.src AND r.gene = 'clade'),
  need AS (SELECT DISTINCT up.clade, r.gene, CAST(r.site AS INTEGER) AS site, r.alt FROM up JOIN rules r ON r.clade = up.src WHERE r.gene <> 'clade'),
  deep AS (SELECT clade, max(depth) AS depth FROM up GROUP BY clade),
  held AS (SELECT t.id, n.clade, any_value(d.depth) AS depth FROM texts t JOIN need n ON true JOIN deep d ON d.clade = n.clade
    GROUP BY t.id, n.clade HAVING bool_and(CASE WHEN n.gene = 'nuc' THEN substr(t.seq, n.site, 1) ELSE substr(t.protein, n.site, 1) END = n.alt)),
  best AS (SELECT id, arg_min(clade, lpad(CAST(100 - depth AS VARCHAR), 3, '0') || clade) AS clade FROM held GROUP BY id)"""


@query(
    "clade_by_rules",
    f"WITH RECURSIVE {SQL_GAPPED}, texts AS (SELECT id, seq, {sql_protein('substr(seq, 1, 30)')} AS protein FROM seqs), {SQL_CLADES} SELECT t.id, coalesce(clade, 'unassigned') AS clade FROM texts t LEFT JOIN best USING (id)",
)
def clade_by_rules(spark, sf):
    s = sequences(spark, sf, GAPPED)
    return clades.clade_by_rules(s, doc_states(spark, sf, s), clade_rules(spark))


@query(
    "clades_from_table",
    f"WITH RECURSIVE {SQL_GAPPED}, texts AS (SELECT id, seq, {sql_protein('substr(seq, 1, 30)')} AS protein FROM seqs), {SQL_CLADES} SELECT t.id, coalesce(clade, 'unassigned') AS clade FROM texts t LEFT JOIN best USING (id)",
)
def _(spark, sf):
    path = fresh_path(spark, "rules")
    lines = clade_rules(spark).select(F.concat_ws("\t", "clade", "gene", "site", F.coalesce("alt", F.lit(""))).alias("value"))
    lines.write.text(path)
    return clades.clades_from_table(sequences(spark, sf, GAPPED), read_rule_table(spark, path).drop("ord"), {"VP": (1, 30)})


@query(
    "clade_on_tree",
    f"""WITH RECURSIVE {SQL_DOC_TREE}, texts AS (SELECT node AS id, seq, {sql_protein('substr(seq, 1, 30)')} AS protein FROM nodes), {SQL_CLADES},
    own AS (SELECT node, parent, coalesce(clade, 'unassigned') AS c FROM nodes LEFT JOIN best ON best.id = node),
    walk AS (SELECT node, c FROM own WHERE parent IS NULL UNION ALL SELECT own.node, CASE WHEN own.c = 'unassigned' THEN w.c ELSE own.c END FROM own JOIN walk w ON own.parent = w.node)
    SELECT node, c AS clade FROM walk""",
)
def clade_on_tree(spark, sf):
    n = document_tree(spark, sf)
    return clades.clade_on_tree(n, doc_states(spark, sf, n.select(F.col("node").alias("id"), "seq")), clade_rules(spark))


@query(
    "clade_label",
    f"""WITH RECURSIVE {SQL_GAPPED}, texts AS (SELECT id, seq, {sql_protein('substr(seq, 1, 30)')} AS protein FROM seqs), {SQL_CLADES},
    cl AS (SELECT t.id, coalesce(clade, 'unassigned') AS clade FROM texts t LEFT JOIN best USING (id) WHERE CAST(t.id AS BIGINT) IN (SELECT doc_id FROM labels))
    SELECT 'metadata' AS side, id AS id, CASE WHEN clade = 'unassigned' THEN '' ELSE clade END AS subgenogroup FROM cl
    UNION ALL SELECT 'sequences', CASE WHEN clade = 'unassigned' THEN id ELSE id || '-Clade' || clade END, md5(seq) FROM cl JOIN seqs USING (id)""",
)
def _(spark, sf):
    s = sequences(spark, sf, GAPPED)
    meta = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    assigned = clade_by_rules(spark, sf).join(table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id")), "id", "left_semi")
    m, q = clades.clade_label(meta, s.select("id", "seq"), assigned)
    return m.select(F.lit("metadata").alias("side"), "id", "subgenogroup").unionByName(q.select(F.lit("sequences").alias("side"), "id", F.md5("seq").alias("subgenogroup")))


# ---- parsimony on the order tree: two columns of states at once


def _sql_parsimony() -> str:
    """Written level by level: orders, customers, nations, regions, root."""
    out = [
        f"WITH {SQL_TREE}",
        "tips AS (SELECT node, parent, 'priority' AS site, trait AS state FROM tree WHERE is_tip AND trait <> '5-LOW' UNION ALL SELECT 'O' || o_orderkey, 'C' || o_custkey, 'status', CAST(o_orderstatus AS VARCHAR) FROM orders WHERE o_orderstatus <> 'X')",
        "s4 AS (SELECT * FROM tips)",
    ]
    for d in (3, 2, 1, 0):
        out.append(
            f"s{d} AS (SELECT v.node, t.parent, v.site, v.state FROM (SELECT parent AS node, site, state, count(*) AS n, max(count(*)) OVER (PARTITION BY parent, site) AS top FROM s{d + 1} GROUP BY parent, site, state) v JOIN tree t ON t.node = v.node WHERE n = top)"
        )
    out.append("c0 AS (SELECT node, site, min(state) AS state FROM s0 GROUP BY node, site)")
    for d in (1, 2, 3, 4):
        out.append(
            f"c{d} AS (SELECT s.node, s.site, coalesce(min(s.state) FILTER (s.state = u.state), min(s.state)) AS state FROM s{d} s LEFT JOIN c{d - 1} u ON u.node = s.parent AND u.site = s.site GROUP BY s.node, s.site)"
        )
    return ", ".join(out) + " " + " UNION ALL ".join(f"SELECT node, site, state FROM c{d}" for d in range(5))


@query("parsimony_states", _sql_parsimony())
def _(spark, sf):
    t = tree(spark, sf)
    o = table(spark, sf, "orders")
    first = t.filter("is_tip").select("node", F.lit("priority").alias("site"), F.col("trait").alias("state"))
    second = o.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("node"), F.lit("status").alias("site"), F.col("o_orderstatus").alias("state"))
    return treeops.parsimony_states(t, first.unionByName(second), ["site"], unknown=("5-LOW", "X"))


# a ladder of all events: every rung has one tip and the next rung, two columns of states
SQL_LADDER = """st AS (SELECT event_id AS e, 'type' AS site, event_type AS s FROM events UNION ALL SELECT event_id, 'size', CASE WHEN value >= 2 THEN CASE WHEN value > 20 THEN 'high' ELSE 'low' END END FROM events),
  up(e, site, s) AS (SELECT e, site, CASE WHEN s IS NULL THEN []::VARCHAR[] ELSE [s] END FROM st WHERE e = (SELECT max(event_id) FROM events)
    UNION ALL SELECT st.e, st.site, CASE WHEN st.s IS NULL THEN up.s WHEN list_contains(up.s, st.s) THEN [st.s] ELSE list_append(up.s, st.s) END FROM up JOIN st ON st.e = up.e - 1 AND st.site = up.site),
  down(e, site, s) AS (SELECT e, site, list_min(s) FROM up WHERE e = (SELECT min(event_id) FROM events)
    UNION ALL SELECT u.e, u.site, CASE WHEN list_contains(u.s, d.s) THEN d.s ELSE list_min(u.s) END FROM down d JOIN up u ON u.e = d.e + 1 AND u.site = d.site)"""


@query(
    "parsimony_ladder",
    f"WITH RECURSIVE {SQL_LADDER} SELECT 'I' || e AS node, site, s AS state FROM down WHERE s IS NOT NULL UNION ALL SELECT 'T' || e, site, s FROM st WHERE s IS NOT NULL",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    name = lambda letter, n: F.concat(F.lit(letter), n.cast("string"))
    k = F.col("event_id")
    first = F.lit(e.agg(F.min("event_id")).first()[0])
    rungs = e.select(name("I", k).alias("node"), F.when(k > first, name("I", k - 1)).alias("parent"))
    leaves = e.select(name("T", k).alias("node"), name("I", k).alias("parent"))
    size = F.when(F.col("value") >= 2, F.when(F.col("value") > 20, "high").otherwise("low"))
    tips = e.select(name("T", k).alias("node"), F.lit("type").alias("site"), F.col("event_type").alias("state")).unionByName(e.select(name("T", k).alias("node"), F.lit("size").alias("site"), size.alias("state")))
    return treeops.parsimony_states(rungs.unionByName(leaves), tips, ["site"])


@query(
    "clock_filter",
    """WITH t AS (SELECT o_orderkey, o_totalprice / 100000.0::DOUBLE - 0.004::DOUBLE * round_even(year(o_orderdate) + (month(o_orderdate) - 1) / 12 + (day(o_orderdate) - 1) / 365.25, 2) AS d FROM orders),
    s AS (SELECT avg(d) AS m, quantile_cont(d, 0.25) AS q1, quantile_cont(d, 0.5) AS q2, quantile_cont(d, 0.75) AS q3 FROM t)
    SELECT o_orderkey, round(d - m, 6) AS residual, abs(d - q2) <= 0.9 * (q3 - q1) AS kept FROM t, s""",
)
def _(spark, sf):
    tips = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 100000.0).alias("divergence"), numeric_date(F.col("o_orderdate")).alias("date"))
    out = clades.clock_filter(tips, 0.004, 0.9)
    return out.select("o_orderkey", F.round("residual", 6).alias("residual"), "kept")


# ---- enrichment and export


@query(
    "published_clades",
    f"""WITH {SQL_HITS}, len AS (SELECT qseqid AS accession, abs(send - sstart) AS n FROM best)
    SELECT CAST(d.doc_id AS VARCHAR) AS accession, d.lang AS country, doc_id % 2 = 0 AS "Age available", doc_id % 3 = 0 AS "Diagnosis available", CASE WHEN doc_id % 4 = 0 THEN 'C1' WHEN doc_id % 4 = 1 THEN upper(d.lang) END AS subgenogroup, CASE WHEN q.quality IS NOT NULL THEN 'g' || q.quality END AS subgenotype,
      CASE WHEN d.source NOT IN ('src1', 'src2') THEN upper(d.source) END AS "RIVM_subgenogroup", CAST(n AS VARCHAR) || 'nt' AS length_blast, CASE WHEN q.toxic = 1 THEN '#f00' END AS color,
      'https://www.ncbi.nlm.nih.gov/nuccore/' || d.doc_id AS url FROM documents d LEFT JOIN labels q USING (doc_id) LEFT JOIN len ON len.accession = CAST(d.doc_id AS VARCHAR)""",
)
def _(spark, sf):
    d, q = table(spark, sf, "documents"), table(spark, sf, "labels")
    key = F.col("doc_id").cast("string").alias("accession")
    k, ord_ = F.col("doc_id"), F.col("doc_id").alias("ord")
    meta = d.select(key, F.col("lang").alias("country"), (k % 2 == 0).alias("has_age"), (k % 3 == 0).alias("has_diagnosis"), F.when(k % 4 == 0, "C1").alias("subgenogroup"), ord_)
    spare = d.filter("doc_id % 4 < 2").select(key, F.concat(F.lit(" "), F.upper("lang")).alias("subgenogroup"), ord_)
    sub = q.select(key, F.concat(F.lit("g"), F.col("quality").cast("string")).alias("subgenotype"), ord_)
    group = F.when(F.col("source") == "src1", "Could not assign").otherwise(F.concat(F.lit(" "), F.upper("source"), F.lit("  ")))
    typed = d.select(k.cast("string").alias("name"), group.alias("VP1 subgenogroup"), F.when(F.col("source") == "src2", "other").otherwise("EV-A71").alias("type"), ord_)
    lengths = hit_lengths(search_hits(spark, sf)).select(F.col("qseqid").alias("accession"), F.col("diff_length_ref").alias("length"), F.lit(0).alias("ord"))
    colors = q.filter("toxic = 1").select(key, F.lit("#f00").alias("color"), ord_)
    return clades.published_clades(meta.unionByName(meta.withColumn("ord", F.col("ord") + 1000000)), sub, typed, lengths, colors, "accession", "EV-A71", "nt", spare)


@query(
    "export_nodes",
    f"""WITH {SQL_TREE} SELECT node, parent, is_tip, trait, o_orderstatus AS status, CASE WHEN node[1:1] = 'R' THEN r_name END AS region, CASE r_name WHEN 'ASIA' THEN '#aa0000' END AS region_color,
      CASE r_name WHEN 'ASIA' THEN 1.5::DOUBLE END AS lat, CASE r_name WHEN 'ASIA' THEN 100.25::DOUBLE END AS lon FROM tree LEFT JOIN orders ON node = 'O' || o_orderkey LEFT JOIN region ON node = 'R' || r_regionkey""",
)
def _(spark, sf):
    t = tree(spark, sf).select("node", "parent", "is_tip", "trait")
    meta = table(spark, sf, "orders").select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("node"), F.col("o_orderstatus").alias("status"))
    region = table(spark, sf, "region").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("node"), F.col("r_name").alias("region"))
    colors = spark.createDataFrame([("region", "asia", "#aa0000")], "field string, value string, hex string")
    spots = spark.createDataFrame([("region", "Asia", 1.5, 100.25)], "level string, name string, lat double, lon double")
    return dimension_attach(clades.export_nodes(t, meta, region), colors, spots, "region", "region")
