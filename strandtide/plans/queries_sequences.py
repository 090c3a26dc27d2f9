"""Sequence operators over sequences derived from documents and references derived from benchmark."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandtide.functions import sequence as seqfn
from strandtide.operators import dedup, features, grouping, quality, seeds, similarity
from strandtide.plans.registry import query
from strandtide.plans.standins import (
    GAPPED,
    SQL_GAPPED,
    SQL_REFS,
    SQL_SEQS,
    references,
    sequences,
    table,
)

_CLASSES = {"A": "[A]", "C": "[C]", "G": "[G]", "T": "[T]", "N": "[N]", "other_iupac": "[RYSWKMBDHV]", "gap": "[-]", "unknown": "[?]", "invalid": "[^ACGTNRYSWKMBDHV?-]"}


@query(
    "composition_index",
    f"WITH {SQL_GAPPED}, s AS (SELECT id, upper(seq || repeat('ry?x1é', CAST(ord % 3 AS BIGINT))) AS seq FROM seqs) SELECT id, "
    + ", ".join(f"CAST(len(regexp_extract_all(seq, '{c}')) AS INTEGER) AS n_{n}" for n, c in _CLASSES.items())
    + ", CAST(length(seq) AS INTEGER) AS n_length FROM s",
)
def _(spark, sf):
    s = sequences(spark, sf, GAPPED)
    return grouping.composition_index(s.withColumn("seq", F.concat("seq", F.repeat(F.lit("ry?x1é"), (F.col("ord") % 3).cast("int")))))


@query("ungap", f"WITH {SQL_GAPPED} SELECT id, replace(seq, '-', '') AS seq FROM seqs")
def _(spark, sf):
    return sequences(spark, sf, GAPPED).select("id", seqfn.ungap(F.col("seq")).alias("seq"))


@query(
    "ungapped_length",
    f"WITH {SQL_GAPPED} SELECT id, CAST(length(regexp_replace(seq, '[-N]', '', 'g')) AS INTEGER) AS n_total, CAST(length(regexp_replace(CASE WHEN ord % 2 = 0 THEN substr(seq, 11, 90) ELSE seq END, '[-N]', '', 'g')) AS INTEGER) AS n_region FROM seqs",
)
def _(spark, sf):
    lo, hi = F.when(F.col("ord") % 2 == 0, 11), F.when(F.col("ord") % 2 == 0, 100)
    seq = F.col("seq")
    return sequences(spark, sf, GAPPED).select("id", seqfn.ungapped_length(seq).alias("n_total"), seqfn.ungapped_length(seq, lo, hi).alias("n_region"))


SQL_CODONS = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in seqfn.codon_table().items()) + "}"


def sql_protein(seq: str) -> str:
    return f"array_to_string(list_transform(range(0, length({seq}) // 3), lambda i: coalesce({SQL_CODONS}[substr({seq}, CAST(3 * i + 1 AS BIGINT), 3)], 'X')), '')"


@query("translate_seq", f"WITH {SQL_GAPPED} SELECT id, {sql_protein('seq')} AS protein FROM seqs")
def _(spark, sf):
    return sequences(spark, sf, GAPPED).select("id", seqfn.translate_seq(F.col("seq")).alias("protein"))


@query("positions_string", f"WITH {SQL_SEQS} SELECT id, array_to_string(list_transform([3, 283, 293, 95, 96], lambda p: substr(seq, p, 1)), '') AS letters FROM seqs")
def _(spark, sf):
    return sequences(spark, sf).select("id", seqfn.positions_string(F.col("seq"), [3, 283, 293, 95, 96]).alias("letters"))


@query(
    "mask_outside",
    f"""WITH {SQL_GAPPED} SELECT id, repeat('-', least(99, length(seq))) || substr(seq, 100, 301) || repeat('-', greatest(length(seq) - 400, 0)) AS seq FROM seqs
    WHERE NOT regexp_matches(substr(seq, 100, 301), '^(N*|-*)$')""",
)
def _(spark, sf):
    return features.mask_outside(sequences(spark, sf, GAPPED), 100, 400).select("id", "seq")


WINDOWS = (("VP4", 1, 207), ("VP2", 208, 969), ("VP3", 970, 1695), ("VP1", 1696, 2586))


@query(
    "extract_all_features",
    f"WITH {SQL_GAPPED}, f AS (SELECT * FROM (VALUES {', '.join(f'''('{n}', {a}, {b})''' for n, a, b in WINDOWS)}) v(feature, lo, hi)), "
    "p AS (SELECT id, feature, substr(seq, lo, hi - lo + 1) AS part FROM seqs, f) SELECT * FROM p WHERE NOT regexp_matches(part, '^(N*|-*)$')",
)
def _(spark, sf):
    return features.extract_all_features(sequences(spark, sf, GAPPED), WINDOWS)


def _doc_features(spark, sf):
    """Four features per document: a VP1 inside a P1, a gene-only one and another VP10."""
    n, i = F.col("n_chars").cast("int"), F.col("doc_id").cast("string")
    attr = lambda k, v: F.create_map(F.lit(k), F.lit(v))
    row = lambda o, t, lo, hi, a: F.struct(F.lit(o).alias("ord"), F.lit(t).alias("type"), lo.alias("start"), hi.alias("end"), a.alias("attrs"))
    cells = F.array(
        row(0, "gene", F.lit(1), F.lit(9), attr("product", "VP1")),
        row(1, "CDS", n % 40 + 1, n % 40 + 300, attr("product", "polyprotein P1")),
        row(2, "CDS", n % 40 + 11, n % 40 + 100, attr("product", "capsid VP1, mature")),
        row(3, "CDS", n % 40 + 50, n % 40 + 400, attr("gene", "VP10")),
    )
    return table(spark, sf, "documents").select(i.alias("seqid"), F.inline(cells))


@query(
    "extract_feature",
    f"""WITH {SQL_SEQS}, d AS (SELECT s.id, s.seq, CAST(n_chars % 40 AS INTEGER) AS o FROM seqs s JOIN documents ON doc_id = s.ord)
    SELECT id, 'sequence' AS label, 0 AS first, 0 AS last, substr(seq, o + 1, 300) AS seq FROM d
    UNION ALL SELECT id, 'polyprotein P1', 1, 300, '' FROM d UNION ALL SELECT id, 'capsid VP1, mature', 11, 100, '' FROM d
    UNION ALL SELECT id, 'VP1', 1, 9, '' FROM d WHERE o = 0""",
)
def _(spark, sf):
    cut, moved = features.extract_feature(sequences(spark, sf), _doc_features(spark, sf), "p1")
    label = F.coalesce(F.try_element_at("attrs", F.lit("product")), F.try_element_at("attrs", F.lit("gene")))
    zero = F.lit(0)
    rows = cut.select("id", F.lit("sequence").alias("label"), zero.alias("first"), zero.alias("last"), "seq")
    return rows.unionByName(moved.select(F.col("seqid").alias("id"), label.alias("label"), F.col("start").alias("first"), F.col("end").alias("last"), F.lit("").alias("seq")))


@query(
    "extract_feature_strands",
    f"""WITH {SQL_SEQS}, d AS (SELECT s.id, s.seq, s.ord % 3 AS k, CAST(n_chars % 40 AS INTEGER) AS o FROM seqs s JOIN documents ON doc_id = s.ord), t AS (SELECT *, translate(seq, 'ACGT', 'TGCA') AS c FROM d)
    SELECT id, 'sequence' AS label, 0 AS first, 0 AS last, '.' AS strand, CASE k WHEN 0 THEN substr(seq, o + 1, 90) WHEN 1 THEN reverse(substr(c, o + 1, 90)) ELSE reverse(substr(c, o + 61, 30)) || reverse(substr(c, o + 1, 30)) END AS seq FROM t
    UNION ALL SELECT id, 'P1', 1, CASE WHEN k = 2 THEN 60 ELSE 90 END, '+', '' FROM t
    UNION ALL SELECT id, 'VP1', CASE WHEN k = 0 THEN 11 ELSE 51 END, CASE WHEN k = 0 THEN 40 ELSE 80 END, CASE WHEN k = 0 THEN '+' ELSE '-' END, '' FROM t WHERE k < 2
    UNION ALL SELECT id, 'VP2', CASE k WHEN 0 THEN 66 WHEN 1 THEN 16 ELSE 16 END, CASE k WHEN 0 THEN 75 WHEN 1 THEN 25 ELSE 25 END, CASE WHEN k = 0 THEN '-' ELSE '+' END, '' FROM t""",
)
def _(spark, sf):
    k, o = F.col("doc_id") % 3, (F.col("n_chars") % 40).cast("int")
    plus, minus = F.lit("+"), F.lit("-")
    part = lambda lo, hi, strand: F.struct((o + lo).alias("start"), (o + hi).alias("end"), strand.alias("strand"))
    own = F.when(k == 2, F.array(part(61, 90, minus), part(1, 30, minus))).otherwise(F.array(part(1, 90, F.when(k == 0, plus).otherwise(minus))))
    row = lambda n, name, lo, hi, strand, spans: F.struct(F.lit(n).alias("ord"), F.lit("CDS").alias("type"), (o + lo).alias("start"), (o + hi).alias("end"), strand.alias("strand"), spans.alias("spans"), F.create_map(F.lit("product"), F.lit(name)).alias("attrs"))
    cells = F.array(
        row(0, "P1", 1, 90, F.when(k == 0, plus).otherwise(minus), own),
        row(1, "VP1", 11, 40, plus, F.array(part(11, 40, plus))),
        row(2, "VP2", 66, 75, minus, F.array(part(66, 75, minus))),
    )
    found = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("seqid"), F.inline(cells))
    cut, moved = features.extract_feature(sequences(spark, sf), found, "P1")
    rows = cut.select("id", F.lit("sequence").alias("label"), F.lit(0).alias("first"), F.lit(0).alias("last"), F.lit(".").alias("strand"), "seq")
    return rows.unionByName(moved.select(F.col("seqid").alias("id"), F.col("attrs")["product"].alias("label"), F.col("start").alias("first"), F.col("end").alias("last"), "strand", F.lit("").alias("seq")))


@query(
    "unique_feature_names",
    """WITH n AS (SELECT p_partkey, translate(p_name || '.' || (p_size % 3), ' ,.;:()[]', '_________') AS name FROM part),
    r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY p_partkey) AS nth FROM n)
    SELECT p_partkey, CASE WHEN nth > 1 THEN name || '_' || lpad(CAST(nth AS VARCHAR), CAST(greatest(3, length(CAST(nth AS VARCHAR))) AS INTEGER), '0') ELSE name END AS name FROM r""",
)
def _(spark, sf):
    name = F.concat("p_name", F.lit("."), (F.col("p_size") % 3).cast("string"))
    return features.unique_feature_names(table(spark, sf, "part").select("p_partkey", name.alias("name")), "name", ["p_partkey"])


_PROTEINS = (("VP1", 1696, 2586), ("VP2", 208, 969), ("VP3", 970, 1695), ("VP4", 1, 207))


@query(
    "mutation_positions",
    f"""WITH f AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {a}, {b})" for n, a, b in _PROTEINS)}) v(protein, lo, hi))
    SELECT DISTINCT p_type AS feature_set, CAST((lo - 1) // 3 + p_size AS INTEGER) AS position FROM part JOIN f ON protein = 'VP' || (p_partkey % 4 + 1)""",
)
def _(spark, sf):
    muts = table(spark, sf, "part").select(
        F.col("p_type").alias("feature_set"),
        F.concat(F.lit("VP"), (F.col("p_partkey") % 4 + 1).cast("string")).alias("protein"),
        F.concat(F.col("p_size").cast("string"), F.lit("M")).alias("label"),
    )
    coords = spark.createDataFrame(list(_PROTEINS), "protein string, start int, end int")
    return features.mutation_positions(muts, coords)


@query(
    "pairwise_identity",
    f"""WITH {SQL_GAPPED} SELECT a.id AS id, b.id AS next_id, round((least(length(a.seq), length(b.seq)) - hamming(left(a.seq, least(length(a.seq), length(b.seq))), left(b.seq, least(length(a.seq), length(b.seq)))))
      / greatest(length(a.seq), length(b.seq)), 9) AS identity FROM seqs a JOIN seqs b ON b.ord = a.ord + 1""",
)
def _(spark, sf):
    s = sequences(spark, sf, GAPPED)
    nxt = s.select((F.col("ord") - 1).alias("ord"), F.col("id").alias("next_id"), F.col("seq").alias("next_seq"))
    scored = similarity.identity_pairs(s.join(nxt, "ord"), "seq", "next_seq")
    return scored.select("id", "next_id", F.round("identity", 9).alias("identity"))


_SAME = "(least(length(a.seq), length(b.seq)) - hamming(left(a.seq, least(length(a.seq), length(b.seq))), left(b.seq, least(length(a.seq), length(b.seq)))))"


@query(
    "dedup_near_identical",
    f"""WITH {SQL_SEQS}, s AS (SELECT seqs.*, CAST(n_chars AS VARCHAR) AS strain FROM seqs JOIN documents ON doc_id = ord), rep AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY strain ORDER BY length(seq) DESC, id) = 1)
    SELECT id, strain FROM s a WHERE NOT EXISTS (SELECT 1 FROM rep b WHERE b.strain = a.strain AND b.id <> a.id AND {_SAME} / greatest(length(a.seq), length(b.seq)) > 0.995)""",
)
def _(spark, sf):
    named = table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), F.col("n_chars").cast("string").alias("strain"))
    s = sequences(spark, sf).join(named, "ord")
    return similarity.dedup_near_identical(s, "strain", 0.995).select("id", "strain")


@query(
    "neighbours",
    f"""WITH {SQL_SEQS}, p AS (SELECT a.id AS id, b.id AS neighbour, {_SAME} / greatest(length(a.seq), length(b.seq)) AS identity FROM seqs a JOIN seqs b ON a.id <> b.id
      WHERE least(length(a.seq), length(b.seq)) >= 0.95 * greatest(length(a.seq), length(b.seq)))
    SELECT id, neighbour, round(identity, 9) AS identity, row_number() OVER (PARTITION BY id ORDER BY identity DESC, neighbour) AS rank FROM p WHERE identity >= 0.95
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY identity DESC, neighbour) <= 3""",
)
def _(spark, sf):
    near = similarity.neighbours(sequences(spark, sf), 3, 0.95)
    return near.withColumn("identity", F.round("identity", 9))


# near copies of one text: every customer changes a letter of the first reference, every fifth one a second letter
SQL_VARIANTS = f"""{SQL_REFS}, base AS (SELECT repeat(seq, 3) AS seq FROM refs WHERE id = (SELECT min(id) FROM refs)),
  spots AS (SELECT c_custkey AS k, seq, (c_custkey * 7 % length(seq))::BIGINT AS p, (c_custkey // length(seq) + c_custkey % 3)::BIGINT AS l, (CASE WHEN c_custkey % 5 = 0 THEN c_custkey % 11 END)::BIGINT AS q FROM customer, base),
  once AS (SELECT k, p, q, substr(seq, 1, p) || substr('ACGT', l % 4 + 1, 1) || substr(seq, p + 2) AS seq FROM spots),
  variants AS (SELECT 'V' || k AS id, CASE WHEN q IS NULL THEN seq ELSE substr(seq, 1, q) || 'T' || substr(seq, q + 2) END AS seq FROM once)"""


def variants(spark, sf):
    """(id, seq): as many near copies of one text as there are customers."""
    base = references(spark, sf).agg(F.repeat(F.min_by("seq", "id"), F.lit(3)).alias("seq")).withColumn("one", F.length("seq") % 1)
    k, n = F.col("c_custkey"), F.length("seq")
    put = lambda seq, p, letter: F.concat(F.substr(seq, F.lit(1), p), letter, F.substr(seq, p + 2))
    spots = table(spark, sf, "customer").select("c_custkey", (k % 1).cast("int").alias("one")).join(base, "one").withColumns({"p": (k * 7 % n).cast("int"), "l": ((F.floor(k / n) + k % 3) % 4 + 1).cast("int"), "q": (k % 11).cast("int")})
    once = spots.withColumn("seq", put(F.col("seq"), F.col("p"), F.substr(F.lit("ACGT"), F.col("l"), F.lit(1))))
    return once.select(F.concat(F.lit("V"), k.cast("string")).alias("id"), F.when(k % 5 == 0, put(F.col("seq"), F.col("q"), F.lit("T"))).otherwise(F.col("seq")).alias("seq"))


@query(
    "neighbours_of_variants",
    f"""WITH {SQL_VARIANTS}, p AS (SELECT a.id AS id, b.id AS neighbour, {_SAME} / greatest(length(a.seq), length(b.seq)) AS identity FROM variants a JOIN variants b ON a.id <> b.id)
    SELECT id, neighbour, round(identity, 9) AS identity, row_number() OVER (PARTITION BY id ORDER BY identity DESC, neighbour) AS rank FROM p WHERE identity >= 0.98
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY identity DESC, neighbour) <= 3""",
)
def _(spark, sf):
    near = similarity.neighbours(variants(spark, sf), 3, 0.98)
    return near.withColumn("identity", F.round("identity", 9))


# ---- seed search

_SQL_SEARCH = """
  qs AS (SELECT id, unnest(range(1, length(seq) - 9)) AS pos, seq FROM seqs WHERE length(seq) >= 11),
  rs AS (SELECT id, unnest(range(1, length(seq) - 9)) AS pos, seq FROM refs WHERE length(seq) >= 11),
  qk AS (SELECT id, pos, substr(seq, pos, 11) AS kmer FROM qs), rk AS (SELECT id, pos, substr(seq, pos, 11) AS kmer FROM rs),
  line AS (SELECT qk.id AS q, rk.id AS r, rk.pos - qk.pos AS diag, qk.pos AS p FROM qk JOIN rk USING (kmer)),
  marked AS (SELECT *, CASE WHEN p - lag(p) OVER w <= 22 THEN 0 ELSE 1 END AS fresh FROM line WINDOW w AS (PARTITION BY q, r, diag ORDER BY p)),
  numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY q, r, diag ORDER BY p) AS seg FROM marked),
  segs AS (SELECT q, r, diag, min(p) AS qs, max(p) + 10 AS qe FROM numbered GROUP BY q, r, diag, seg),
  sized AS (SELECT segs.*, qe - qs + 1 AS len, hamming(substr(s.seq, qs, qe - qs + 1), substr(f.seq, qs + diag, qe - qs + 1)) AS mm, length(s.seq) AS qlen FROM segs JOIN seqs s ON s.id = q JOIN refs f ON f.id = r),
  valued AS (SELECT *, 2 * (len - mm) - 3 * mm AS score FROM sized),
  kept AS (SELECT *, 0.41 * qlen * (SELECT sum(length(seq)) FROM refs) * exp(-0.625::DOUBLE * score) AS ev FROM valued),
  good AS (SELECT * FROM kept WHERE ev <= 0.0005),
  cover AS (SELECT q, r, count(DISTINCT u) AS covered FROM (SELECT q, r, unnest(range(qs, qe + 1)) AS u FROM good) GROUP BY q, r),
  hits AS (SELECT q AS qseqid, r AS sseqid, round_even(100.0::DOUBLE * (len - mm) / len, 3) AS pident, CAST(len AS INTEGER) AS length, CAST(mm AS INTEGER) AS mismatch, 0 AS gapopen, CAST(qs AS INTEGER) AS qstart, CAST(qe AS INTEGER) AS qend,
    CAST(qs + diag AS INTEGER) AS sstart, CAST(qe + diag AS INTEGER) AS send, ev AS evalue, round_even((0.625::DOUBLE * score - ln(0.41::DOUBLE)) / ln(2.0::DOUBLE), 1) AS bitscore, CAST(floor(100.0::DOUBLE * covered / qlen) AS INTEGER) AS qcovs
    FROM good JOIN cover USING (q, r)),
  best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY qseqid ORDER BY length DESC, evalue, sseqid || '|' || lpad(CAST(qstart AS VARCHAR), 9, '0') || '|' || lpad(CAST(sstart AS VARCHAR), 9, '0')) = 1)"""
SQL_HITS = f"{SQL_SEQS}, {SQL_REFS},{_SQL_SEARCH}"


def search_hits(spark, sf):
    return seeds.with_hit_order(seeds.kmer_hits(sequences(spark, sf), references(spark, sf)))


@query("kmer_hits", f"WITH {SQL_HITS} SELECT qseqid, sseqid, pident, length, mismatch, gapopen, qstart, qend, sstart, send, round(log10(evalue), 6) AS log_evalue, bitscore, qcovs FROM hits")
def kmer_hits(spark, sf):
    hits = seeds.kmer_hits(sequences(spark, sf), references(spark, sf))
    return hits.withColumn("log_evalue", F.round(F.log10("evalue"), 6)).drop("evalue")


# one letter many times over on both sides: nations of many customers against regions of many suppliers
SQL_HOMOPOLYMERS = """seqs AS (SELECT 'N' || c_nationkey AS id, repeat(substr('ACGT', (c_nationkey % 4 + 1)::BIGINT, 1), 12 * count(*)) AS seq, c_nationkey AS ord FROM customer GROUP BY c_nationkey),
  refs AS (SELECT 'R' || r_regionkey AS id, repeat(substr('ACGT', (r_regionkey % 4 + 1)::BIGINT, 1), 6 * count(*)) || 'GATTACA' AS seq FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey)"""


@query("kmer_hits_of_repeats", f"WITH {SQL_HOMOPOLYMERS},{_SQL_SEARCH} SELECT qseqid, sseqid, pident, length, mismatch, gapopen, qstart, qend, sstart, send, round(log10(evalue), 6) AS log_evalue, bitscore, qcovs FROM hits")
def _(spark, sf):
    c, s, n = (table(spark, sf, t) for t in ("customer", "supplier", "nation"))
    letter = lambda key: F.substr(F.lit("ACGT"), (F.col(key) % 4 + 1).cast("int"), F.lit(1))
    name = lambda first, key: F.concat(F.lit(first), F.col(key).cast("string")).alias("id")
    seqs = c.groupBy("c_nationkey").agg(F.count("*").cast("int").alias("k")).select(name("N", "c_nationkey"), F.repeat(letter("c_nationkey"), F.col("k") * 12).alias("seq"))
    by_region = s.join(n, s.s_nationkey == n.n_nationkey).groupBy("n_regionkey").agg(F.count("*").cast("int").alias("k"))
    refs = by_region.select(name("R", "n_regionkey"), F.concat(F.repeat(letter("n_regionkey"), F.col("k") * 6), F.lit("GATTACA")).alias("seq"))
    return seeds.kmer_hits(seqs, refs).withColumn("log_evalue", F.round(F.log10("evalue"), 6)).drop("evalue")


@query("best_hit", f"WITH {SQL_HITS} SELECT qseqid, sseqid, length, qstart, sstart FROM best")
def _(spark, sf):
    return dedup.best_hit(search_hits(spark, sf)).select("qseqid", "sseqid", "length", "qstart", "sstart")


@query("abs_span", f"WITH {SQL_HITS} SELECT qseqid, sseqid, qstart, sstart, abs(send - sstart) AS diff_length_ref FROM hits")
def _(spark, sf):
    return seeds.abs_span(search_hits(spark, sf)).select("qseqid", "sseqid", "qstart", "sstart", "diff_length_ref")


@query("hit_lengths", f"WITH {SQL_HITS} SELECT qseqid, abs(send - sstart) AS diff_length_ref FROM best")
def _(spark, sf):
    return seeds.hit_lengths(search_hits(spark, sf))


@query("cut_region", f"WITH {SQL_HITS} SELECT id, substr(seq, qstart, qend - qstart + 1) AS seq FROM seqs JOIN best ON qseqid = id WHERE abs(send - sstart) BETWEEN 40 AND 400 AND length(substr(seq, qstart, qend - qstart + 1)) BETWEEN 40 AND 400")
def _(spark, sf):
    return seeds.cut_region(sequences(spark, sf), search_hits(spark, sf), 40, 400).select("id", "seq")


@query(
    "project_ungapped",
    f"""WITH {SQL_HITS}, placed AS (SELECT s.id, sseqid, sstart - qstart AS o, s.seq, length(f.seq) AS n FROM seqs s JOIN best ON qseqid = s.id JOIN refs f ON f.id = sseqid)
    SELECT id, sseqid, array_to_string(list_transform(range(1, n + 1), lambda i: CASE WHEN i - o BETWEEN 1 AND length(seq) THEN substr(seq, i - o, 1) ELSE '-' END), '') AS aligned FROM placed""",
)
def _(spark, sf):
    return seeds.project_ungapped(sequences(spark, sf), search_hits(spark, sf), references(spark, sf))


# ---- quality and substitutions against a reference named per sequence

_PAIR_SQL = f"{SQL_GAPPED}, {SQL_REFS}, pair AS (SELECT s.id, s.seq, f.seq AS ref FROM seqs s JOIN refs f ON f.id = 'R' || s.ord % 40)"


def with_reference(spark, sf):
    s = sequences(spark, sf, GAPPED)
    return s.select("id", "seq", F.concat(F.lit("R"), (F.col("ord") % 40).cast("string")).alias("ref_id"))


@query(
    "substitutions",
    f"""WITH {_PAIR_SQL}, p AS (SELECT id, unnest(range(1, least(length(seq), length(ref)) + 1)) AS pos, seq, ref FROM pair)
    SELECT id, CAST(pos AS INTEGER) AS pos, substr(ref, pos, 1) AS ref, substr(seq, pos, 1) AS alt FROM p WHERE substr(ref, pos, 1) <> substr(seq, pos, 1) AND substr(seq, pos, 1) NOT IN ('-', 'N') AND substr(ref, pos, 1) NOT IN ('-', 'N')""",
)
def _(spark, sf):
    return quality.substitutions(with_reference(spark, sf), references(spark, sf))


@query(
    "seq_qc",
    rf"""WITH {_PAIR_SQL}, body AS (SELECT id, seq, ref, regexp_replace(regexp_replace(seq, '^-+', ''), '-+$', '') AS mid, {sql_protein("replace(seq, '-', '')")} AS protein FROM pair),
    c AS (SELECT id, CAST(len(regexp_extract_all(seq, 'N')) AS INTEGER) AS n_missing, CAST(len(regexp_extract_all(seq, '[RYSWKMBDHV]')) AS INTEGER) AS n_mixed,
      CAST(len(list_filter(range(1, least(length(seq), length(ref)) + 1), lambda i: substr(ref, i, 1) <> substr(seq, i, 1) AND substr(seq, i, 1) NOT IN ('-', 'N'))) AS INTEGER) AS n_private,
      CAST(len(list_filter(regexp_extract_all(mid, '-+'), lambda g: length(g) % 3 <> 0)) AS INTEGER) AS n_frame_shifts, CAST(len(regexp_extract_all(regexp_replace(protein, '\*$', ''), '\*')) AS INTEGER) AS n_stops,
      CAST(length(seq) - length(regexp_replace(seq, '^-+', '')) + 1 AS INTEGER) AS align_start, CAST(length(regexp_replace(seq, '-+$', '')) AS INTEGER) AS align_end,
      round_even(len(regexp_extract_all(seq, '[^-N]')) / length(ref), 4) AS coverage FROM body),
    s AS (SELECT *, greatest((n_missing - 500) * 100.0::DOUBLE / 2000, 0) AS missing_score, n_mixed * 100.0::DOUBLE / 40 AS mixed_score, greatest((n_private - 600) * 100.0::DOUBLE / 700, 0) AS private_score,
      (n_frame_shifts * 20)::DOUBLE AS frame_score, (n_stops * 40)::DOUBLE AS stop_score FROM c),
    o AS (SELECT *, missing_score * missing_score / 100 + mixed_score * mixed_score / 100 + private_score * private_score / 100 + frame_score * frame_score / 100 + stop_score * stop_score / 100 AS overall FROM s)
    SELECT * EXCLUDE (overall), round(overall, 6) AS overall_score, CASE WHEN overall < 30 THEN 'good' WHEN overall < 100 THEN 'mediocre' ELSE 'bad' END AS overall_status FROM o""",
)
def _(spark, sf):
    return quality.seq_qc(with_reference(spark, sf), references(spark, sf)).withColumn("overall_score", F.round("overall_score", 6))
