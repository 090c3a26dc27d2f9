"""Ledgers, snapshots, curation in batch and stream, and file round trips over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandtide.operators import history
from strandtide.operators.features import extract_feature
from strandtide.plans import curation
from strandtide.plans.registry import query
from strandtide.plans.standins import (
    SQL_CUSTOMER_NAMES,
    SQL_DIRTY_DATES,
    SQL_SEQS,
    accession,
    customer_names,
    dirty_dates,
    sequences,
    short_accession,
    table,
)
from strandtide.runtime import fresh_path
from strandtide.sources import sequences as seqio
from strandtide.sources import tables as tabio
from strandtide.streaming import flows

# ---- ledgers and upserts


def _seen(events, cond):
    return events.filter(cond).select(F.col("user_id").cast("string").alias("accession"), F.to_date("ts").alias("date_added"))


@query(
    "first_seen_ledger",
    """WITH old AS (SELECT CAST(user_id AS VARCHAR) AS accession, min(CAST(ts AS DATE)) AS d FROM events WHERE user_id % 3 = 0 GROUP BY user_id),
    new AS (SELECT CAST(user_id AS VARCHAR) AS accession, min(CAST(ts AS DATE)) AS d FROM events WHERE event_id % 2 = 1 GROUP BY user_id)
    SELECT accession, CAST(d AS VARCHAR) AS date_added FROM old UNION ALL SELECT accession, CAST(d AS VARCHAR) FROM new WHERE accession NOT IN (SELECT accession FROM old)""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    old = _seen(e, "user_id % 3 = 0").groupBy("accession").agg(F.min("date_added").alias("date_added"))
    out = history.first_seen_ledger(old, _seen(e, "event_id % 2 = 1"))
    return out.withColumn("date_added", F.col("date_added").cast("string"))


@query("ledger_from_files", "SELECT CAST(c_custkey AS VARCHAR) AS accession, CASE WHEN c_custkey % 2 = 0 THEN '2020-02-02' ELSE CAST(current_date AS VARCHAR) END AS date_added FROM customer")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("accession"), "c_custkey")
    path = fresh_path(spark, "accessions")
    c.select("accession").write.text(path)
    found = spark.read.text(path).select(F.col("value").alias("accession"), history.file_date().alias("date_added"))
    old = c.filter("c_custkey % 2 = 0").select("accession", F.lit("2020-02-02").cast("date").alias("date_added"))
    return history.first_seen_ledger(old, found).withColumn("date_added", F.col("date_added").cast("string"))


_UPSERT_SQL = """WITH u AS (SELECT user_id AS accession, CASE WHEN event_id % 2 = 0 OR user_id % 4 <> 0 THEN event_type END AS kind, event_id AS ord, event_id % 2 AS r FROM events),
  l AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY accession ORDER BY r DESC, ord DESC) = 1)"""


def _history_and_batch(spark, sf):
    """Even events as history, odd ones as batch; both repeat keys, and `ord` says which row is the last."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("accession"), F.col("event_type").alias("kind"), F.col("event_id").alias("ord"))
    new = e.filter("ord % 2 = 1").withColumn("kind", F.when(F.col("accession") % 4 != 0, F.col("kind")))
    return e.filter("ord % 2 = 0"), new


@query("upsert_latest", _UPSERT_SQL + " SELECT accession, kind, ord FROM l WHERE kind IS NOT NULL")
def _(spark, sf):
    old, new = _history_and_batch(spark, sf)
    return history.upsert_latest(old, new, "accession", min_non_null=3, order="ord")


@query("upsert_table", _UPSERT_SQL + " SELECT accession, kind, ord FROM l")
def _(spark, sf):
    old, new = _history_and_batch(spark, sf)
    first = history.upsert_table(None, old, "accession", "ord")
    return spark.read.parquet(history.upsert_table(first, new, "accession", "ord"))


@query("upsert_buckets", _UPSERT_SQL + " SELECT accession, kind, ord FROM l")
def _(spark, sf):
    old, new = _history_and_batch(spark, sf)
    path = fresh_path(spark, "buckets")
    history.upsert_buckets(path, old, "accession", "ord", buckets=8)
    history.upsert_buckets(path, new, "accession", "ord")
    return history.read_buckets(spark, path)


# ---- snapshots


@query("snapshot_unchanged", "SELECT 'same rows' AS pair, true AS unchanged UNION ALL SELECT 'one removed', false UNION ALL SELECT 'null moved', false UNION ALL SELECT 'renamed', false UNION ALL SELECT 'other type', false UNION ALL SELECT 'other order of columns', true")
def _(spark, sf):
    o = table(spark, sf, "orders")
    shuffled = o.repartition(7, "o_custkey")
    same = history.snapshot_unchanged(o, shuffled).withColumn("pair", F.lit("same rows"))
    fewer = history.snapshot_unchanged(o, shuffled.filter("o_orderkey <> 1")).withColumn("pair", F.lit("one removed"))
    key, none = F.col("o_orderkey"), F.lit(None).cast("string")
    ahead, behind = o.select(key, none.alias("a"), F.col("o_orderstatus").cast("string").alias("b")), o.select(key, F.col("o_orderstatus").cast("string").alias("a"), none.alias("b"))
    moved = history.snapshot_unchanged(ahead, behind).withColumn("pair", F.lit("null moved"))
    more = {
        "renamed": o.withColumnsRenamed({"o_orderstatus": "status"}),
        "other type": o.withColumn("o_custkey", F.col("o_custkey").cast("decimal(20,0)")),
        "other order of columns": o.select(sorted(o.columns, reverse=True)),
    }
    out = same.unionByName(fewer).unionByName(moved)
    for pair, other in more.items():
        out = out.unionByName(history.snapshot_unchanged(o, other).withColumn("pair", F.lit(pair)))
    return out.select("pair", "unchanged")


@query(
    "snapshot_changes",
    """WITH a AS (SELECT o_orderkey AS k, o_custkey AS c, count(*) AS n, string_agg(o_orderstatus, '') AS s FROM orders WHERE o_orderkey % 90 <> 7 GROUP BY ALL),
    b AS (SELECT o_orderkey AS k, o_custkey AS c, count(*) AS n, string_agg(CASE WHEN o_orderkey % 70 = 5 THEN 'Z' ELSE o_orderstatus END, '') AS s FROM orders WHERE o_orderkey % 80 <> 3 GROUP BY ALL)
    SELECT coalesce(a.k, b.k) AS o_orderkey, coalesce(a.c, b.c) AS o_custkey, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM a FULL JOIN b ON a.k = b.k AND a.c = b.c WHERE a.k IS NULL OR b.k IS NULL OR a.s <> b.s""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = F.when(F.col("o_orderkey") % 70 == 5, "Z").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    old, new = o.filter("o_orderkey % 90 <> 7"), o.filter("o_orderkey % 80 <> 3").select("o_orderkey", "o_custkey", changed)
    key = ["o_orderkey", "o_custkey"]
    return history.snapshot_changes(old, new, key, old_tree=history.digest_tree(old, key))


@query(
    "snapshot_report",
    """WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 < 7), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 5 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 10 > 2),
    n AS (SELECT (SELECT count(*) FROM b) AS n_new, (SELECT count(*) FROM a) AS n_old, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS n_added, (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS n_removed)
    SELECT n_new, n_old, n_new - n_old AS delta, CASE WHEN n_new > n_old THEN 'more' WHEN n_new < n_old THEN 'fewer' ELSE 'same' END AS change, n_added, n_removed FROM n""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    changed = F.when(F.col("o_orderkey") % 10 == 5, "Z").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    return history.snapshot_report(o.filter("o_orderkey % 10 < 7"), o.filter("o_orderkey % 10 > 2").select("o_orderkey", changed))


# ---- local ids


def _sql_accession(k):
    letter = lambda n: f"chr((({k} // {n}) % 26 + 65)::INTEGER)"
    return f"{letter(26000000)} || {letter(1000000)} || lpad(CAST({k} % 1000000 AS VARCHAR), 6, '0')"


_REGISTRY_SQL = """reg AS (SELECT 'X' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 7, '0') AS internal_accession, 'Customer#' || lpad(CAST(n_nationkey * 2 AS VARCHAR), 9, '0') AS sample_name,
    CASE WHEN n_nationkey % 5 = 0 THEN 'AB' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') ELSE 'pending' END AS gb_accession, '2024-01-01' AS date_added,
    CASE WHEN n_nationkey % 5 = 0 THEN 'AB' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') ELSE 'X' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 7, '0') END AS seq_accession FROM nation),
  acc AS (SELECT 'Customer#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS sample_name, 'MK' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS accession FROM customer WHERE c_custkey % 7 = 2),"""


def _registry(spark, sf):
    k = F.col("n_nationkey")
    local = F.concat(F.lit("X"), F.lpad((k + 1).cast("string"), 7, "0"))
    gb = F.concat(F.lit("AB"), F.lpad(k.cast("string"), 6, "0"))
    return table(spark, sf, "nation").select(
        local.alias("internal_accession"), F.concat(F.lit("Customer#"), F.lpad((k * 2).cast("string"), 9, "0")).alias("sample_name"),
        F.when(k % 5 == 0, gb).otherwise("pending").alias("gb_accession"), F.lit("2024-01-01").alias("date_added"), F.when(k % 5 == 0, gb).otherwise(local).alias("seq_accession"),
    )


def _accessions(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").filter("c_custkey % 7 = 2")
    return rows.select(F.concat(F.lit("Customer#"), F.lpad(k.cast("string"), 9, "0")).alias("sample_name"), accession(k, "MK").alias("accession"))


_REGISTERED_SQL = """fresh AS (SELECT DISTINCT name FROM names WHERE NOT regexp_matches(name, '^[A-Z]{1,2}\\d{5,6}$') AND name NOT IN (SELECT sample_name FROM reg) AND name NOT IN (SELECT seq_accession FROM reg)),
  num AS (SELECT name, 'X' || lpad(CAST(row_number() OVER (ORDER BY name) + (SELECT max(CAST(internal_accession[2:] AS BIGINT)) FROM reg) AS VARCHAR), 7, '0') AS id FROM fresh),
  both_ AS (SELECT * FROM reg UNION ALL SELECT id, name, 'NA', '2024-05-01', id FROM num),
  registered AS (SELECT internal_accession, b.sample_name, CASE WHEN regexp_matches(gb_accession, '^[A-Z]{1,2}\\d{5,6}$') THEN gb_accession ELSE coalesce(acc.accession, 'NA') END AS gb_accession, date_added,
    CASE WHEN regexp_matches(gb_accession, '^[A-Z]{1,2}\\d{5,6}$') THEN seq_accession ELSE coalesce(acc.accession, seq_accession) END AS seq_accession FROM both_ b LEFT JOIN acc ON acc.sample_name = b.sample_name)"""


@query(
    "local_id_registry",
    f"WITH {_REGISTRY_SQL} names AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'U' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') ELSE c_name END AS name FROM customer), {_REGISTERED_SQL} SELECT * FROM registered",
)
def _(spark, sf):
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, short_accession(k, "U")).otherwise(F.col("c_name"))
    names = table(spark, sf, "customer").select(name.alias("name"))
    return history.local_id_registry(_registry(spark, sf), names, _accessions(spark, sf), "2024-05-01")


@query(
    "update_sequences",
    f"""WITH {_REGISTRY_SQL} {SQL_SEQS}, heads AS (SELECT CASE ord % 3 WHEN 0 THEN {_sql_accession('ord')} ELSE 'Customer#' || lpad(CAST(ord AS VARCHAR), 9, '0') END AS head, seq, ord FROM seqs),
    led AS (SELECT {_sql_accession('c_custkey')} AS accession FROM customer WHERE c_custkey % 9 = 0),
    unseen AS (SELECT head AS name FROM heads WHERE head NOT IN (SELECT accession FROM led)), names AS (SELECT * FROM unseen), {_REGISTERED_SQL},
    entries AS (SELECT DISTINCT coalesce(seq_accession, name) AS accession FROM unseen LEFT JOIN registered ON sample_name = name WHERE name NOT IN (SELECT sample_name FROM reg) AND name NOT IN (SELECT seq_accession FROM reg))
    SELECT 'sequence' AS part, coalesce(seq_accession, head) AS id, md5(seq) AS detail FROM heads LEFT JOIN registered ON sample_name = head
    UNION ALL SELECT 'ledger', accession, '2020-02-02' FROM led UNION ALL SELECT 'ledger', accession, '2024-05-01' FROM entries WHERE accession NOT IN (SELECT accession FROM led)
    UNION ALL SELECT 'registry', sample_name, seq_accession FROM registered""",
)
def _(spark, sf):
    k = F.col("ord")
    head = F.when(k % 3 == 0, accession(k)).otherwise(F.concat(F.lit("Customer#"), F.lpad(k.cast("string"), 9, "0")))
    seqs = sequences(spark, sf).withColumn("id", head)
    seqs = seqs.withColumn("ord", k * 2).unionByName(seqs.withColumns({"ord": k * 2 + 1, "seq": F.lit("second copy")}))
    ledger = table(spark, sf, "customer").filter("c_custkey % 9 = 0").select(accession(F.col("c_custkey")).alias("accession"), F.lit("2020-02-02").cast("date").alias("date_added"))
    out, registry, led = history.update_sequences(seqs, _registry(spark, sf), ledger, _accessions(spark, sf), "2024-05-01")
    part = lambda n: F.lit(n).alias("part")
    return (
        out.select(part("sequence"), "id", F.md5("seq").alias("detail"))
        .unionByName(led.select(part("ledger"), F.col("accession").alias("id"), F.col("date_added").cast("string").alias("detail")))
        .unionByName(registry.select(part("registry"), F.col("sample_name").alias("id"), F.col("seq_accession").alias("detail")))
    )


# ---- curation: raw records from customers, their nations and the date of their latest order

RAW_SCHEMA = "`isolate-lineage` string, accession string, `geo-region` string, `geo-location` string, `isolate-collection-date` string, `host-name` string, `submitter-names` string, sequence string"


def raw_records(spark, sf):
    n = customer_names(spark, sf)
    latest = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("o_orderkey"))
    dates = latest.join(dirty_dates(spark, sf), "o_orderkey").drop("o_orderkey")
    k = F.col("c_custkey")
    place = F.concat("n_name", F.when(k % 2 == 0, F.concat(F.lit(":  "), F.lower("c_mktsegment"), F.lit(" of THE north, loc"), (k % 4).cast("string"))).otherwise(""))
    authors = F.when(k % 3 == 0, F.concat("c_name", F.lit(", B"))).when(k % 3 == 1, F.col("c_name")).otherwise("")
    return n.join(dates, "c_custkey", "left").select(
        F.when(k % 4 > 0, F.concat(F.lit(" strain  "), k.cast("string"))).otherwise("").alias("isolate-lineage"),
        F.concat(F.lit("C"), k.cast("string")).alias("accession"), F.col("r_name").alias("geo-region"), place.alias("geo-location"), F.col("raw_date").alias("isolate-collection-date"),
        F.lit("Homo   sapiens ").alias("host-name"), authors.alias("submitter-names"), F.when(k % 6 > 0, F.repeat(F.lit("ACGT"), (k % 5 + 1).cast("int"))).alias("sequence"),
    )


def record_edits(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id")
    return e.select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("id"),
        F.when(k % 3 == 0, "country").when(k % 3 == 1, "date").otherwise("strain").alias("field"), F.col("event_type").alias("value"), k.alias("ord"),
    )


_TITLE = "array_to_string(list_transform(string_split({x}, ' '), lambda w: CASE WHEN upper(w) = 'USA' THEN 'USA' WHEN lower(w) IN ('of', 'the', 'and') THEN lower(w) ELSE upper(w[1:1]) || lower(w[2:]) END), ' ')"
_CURATE_RULES = ", ".join(f"({i}, string_split('{a}', '/'), string_split('{b}', '/'), {a.count('*')})" for i, (a, b) in enumerate((("Africa/Nation_1/*/*", "Africa/One//*"), ("*/*/Building of the North/Loc2", "*/*/Build/Two"), ("Asia/*/*/*", "Asia of Old/*/*/*"))))
_SQL_CURATE = f"""WITH {SQL_CUSTOMER_NAMES}, {SQL_DIRTY_DATES}, raw AS (SELECT c_custkey AS k, 'C' || c_custkey AS accession, CASE WHEN c_custkey % 4 > 0 THEN 'strain ' || c_custkey ELSE 'C' || c_custkey END AS strain,
    {_TITLE.format(x="r_name")} AS region, {_TITLE.format(x="n_name")} AS country, CASE WHEN c_custkey % 2 = 0 THEN {_TITLE.format(x="lower(c_mktsegment) || ' of THE north'")} END AS division, CASE WHEN c_custkey % 2 = 0 THEN 'Loc' || c_custkey % 4 END AS location,
    CASE WHEN raw_date IS NULL THEN NULL ELSE CASE ok % 10 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-XX-XX') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-XX') WHEN 4 THEN strftime(o_orderdate, '%Y-%m-XX')
      WHEN 6 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 8 THEN strftime(o_orderdate, '%Y-%m-XX') WHEN 9 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'XXXX-XX-XX' END END AS date,
    CASE c_custkey % 3 WHEN 0 THEN c_name || ' et al' WHEN 1 THEN c_name ELSE '?' END AS abbr_authors, 'Homo sapiens' AS host, CASE WHEN c_custkey % 6 > 0 THEN repeat('ACGT', c_custkey % 5 + 1) END AS sequence
    FROM names LEFT JOIN (SELECT o_custkey AS ck, max(o_orderkey) AS ok FROM orders GROUP BY o_custkey) ON ck = c_custkey LEFT JOIN dirty ON dirty.o_orderkey = ok LEFT JOIN orders ON orders.o_orderkey = ok),
  rules AS (SELECT * FROM (VALUES {_CURATE_RULES}) v(ord, f, t, stars)),
  hit AS (SELECT k, t FROM raw JOIN rules ON f[1] IN ('*', region) AND f[2] IN ('*', country) AND f[3] IN ('*', coalesce(division, '')) AND f[4] IN ('*', coalesce(location, '')) QUALIFY row_number() OVER (PARTITION BY k ORDER BY stars, ord DESC) = 1),
  placed AS (SELECT raw.* REPLACE ({", ".join(f"CASE WHEN t IS NULL OR t[{i}] = '*' THEN {c} ELSE nullif(t[{i}], '') END AS {c}" for i, c in enumerate(curation.PLACE_LEVELS, 1))}) FROM raw LEFT JOIN hit USING (k)),
  e AS (SELECT 'C' || user_id AS id, CASE event_id % 3 WHEN 0 THEN 'country' WHEN 1 THEN 'date' ELSE 'strain' END AS field, event_type AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id DESC) = 1),
  done AS (SELECT p.* REPLACE (coalesce(a.value, country) AS country, coalesce(b.value, date) AS date, coalesce(c.value, strain) AS strain) FROM placed p LEFT JOIN e a ON a.id = accession AND a.field = 'country' LEFT JOIN e b ON b.id = accession AND b.field = 'date' LEFT JOIN e c ON c.id = accession AND c.field = 'strain')"""
_SHOWN = ["accession", "strain", "date", "region", "country", "division", "location", "host", "abbr_authors"]
_CHAIN_RULES = (("Africa/Nation_1/*/*", "Africa/One//*", 0), ("*/*/Building of the North/Loc2", "*/*/Build/Two", 1), ("Asia/*/*/*", "Asia of Old/*/*/*", 2))


def chain_rules(spark):
    return spark.createDataFrame(list(_CHAIN_RULES), "raw string, corrected string, ord int")


@query("curate_chain", _SQL_CURATE + f" SELECT {', '.join(_SHOWN)}, length(sequence) AS n FROM done WHERE sequence IS NOT NULL UNION ALL SELECT accession, {', '.join(['NULL'] * 7)}, 'no sequence', 0 FROM done WHERE sequence IS NULL")
def _(spark, sf):
    meta, seqs, rejected = curation.curate_and_split(raw_records(spark, sf), chain_rules(spark), record_edits(spark, sf))
    good = meta.join(seqs.select(F.col("id").alias("accession"), F.length("seq").cast("long").alias("n")), "accession").select(*_SHOWN, "n")
    blank = [F.lit(None).cast("string").alias(c) for c in _SHOWN[1:-1]]
    return good.unionByName(rejected.select("accession", *blank, F.col("reject").alias("abbr_authors"), F.lit(0).cast("long").alias("n")))


@query("curate_stream", _SQL_CURATE + f" SELECT {', '.join(_SHOWN)} FROM done")
def _(spark, sf):
    source, out = fresh_path(spark, "records"), fresh_path(spark, "curated")
    raw_records(spark, sf).repartition(4).write.json(source)
    stream = flows.ndjson_stream(spark, source, RAW_SCHEMA, files_per_trigger=2)
    flows.curate_stream(stream, chain_rules(spark), record_edits(spark, sf), out, fresh_path(spark, "stream"))
    return spark.read.parquet(out).select(*_SHOWN)


@query("first_seen_stream", "SELECT user_id AS id, CAST(min(ts) AS VARCHAR) AS first_seen FROM events GROUP BY user_id")
def _(spark, sf):
    source = fresh_path(spark, "events")
    events = table(spark, sf, "events").select(F.col("user_id").alias("id"), "ts")
    events.repartition(6).write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    out = flows.first_seen_stream(stream, fresh_path(spark, "ledger"), fresh_path(spark, "stream"))
    return out.select("id", F.col("first_seen").cast("string").alias("first_seen"))


# ---- the final metadata table

_ISO_MAP = {"stool": "feces", "throat swab": "oronasopharynx", "serum": "serum", "blood": "serum"}
_SYMPTOMS = {"fever": "Fever", "pyrexia": "Fever", "hfmd": "HFMD", "rash": "Rash"}
_MAJOR = {"HFMD": "HFMD", "Rash": "Rash-associated", "Fever": "Other"}


def add_metadata_inputs(spark, sf):
    d, q, n = (table(spark, sf, t) for t in ("documents", "labels", "nation"))
    k = F.col("doc_id")
    acc = accession(k)
    text_or = lambda *pairs: F.coalesce(*[F.when(c, F.lit(v)) for c, v in pairs])
    meta = d.select(
        acc.alias("accession"), F.concat(acc, F.lit(".1")).alias("accession_version"), F.when(k % 4 == 0, acc).otherwise(F.col("source")).alias("strain"), F.lit("2001-XX-XX").alias("date"),
        F.when(k % 3 == 0, "uk").otherwise(F.concat(F.lit("NATION_"), (k % 30).cast("string"))).alias("country"), F.lit("div").alias("division"), F.when(k % 2 == 0, "loc").alias("location"),
        F.lit("Homo sapiens").alias("host"), F.col("n_chars").cast("string").alias("length"), F.when(k % 5 == 0, "Stools, bloods").alias("sample_type"), F.lit("authors").alias("authors"), F.lit("good").alias("qc.overallStatus"), k.alias("ord"),
    )
    extra = q.select(
        F.when(k % 7 == 0, "unknown").otherwise(acc).alias("accession"), F.concat(F.lit("lab"), k.cast("string")).alias("strain"), F.when(k % 2 == 0, "XXXX-XX-XX").otherwise("1999-05-05").alias("date"),
        F.when(k % 10 == 0, "FRANCE").alias("country"), F.when(k % 3 == 1, "Rotterdam").alias("place"), F.when(F.col("quality") == 1, "C4").alias("subgenogroup"), text_or((k % 4 == 0, "Female"), (k % 4 == 1, "male")).alias("gender"),
        F.when(k % 6 == 0, "n/a").otherwise((k % 30).cast("string")).alias("age_yrs"), text_or((k % 5 == 0, "HFMD"), (k % 5 == 1, "fevr or rash"), (k % 5 == 2, "odd thing")).alias("diagnosis"), F.when(k % 8 == 0, "throat swabs").alias("isolation"),
        F.when(k % 9 == 0, "enpen set").alias("origin"), F.lit("Private: Doe").alias("doi"), k.alias("ord"),
    )
    local = q.filter("doc_id % 7 = 0").select(F.concat(F.lit("lab"), k.cast("string")).alias("key"), acc.alias("value"), k.alias("ord"))
    ledger = d.filter("doc_id % 2 = 1").select(acc.alias("accession"), F.lit("2024-07-15").alias("date_added"))
    regions = n.select("n_name", F.col("n_nationkey").alias("ord")).select(F.col("n_name").alias("country"), F.lit("south-east_asia").alias("region"), "ord")
    overrides = d.filter("doc_id % 11 = 0").select(acc.alias("accession"), F.when(k % 2 == 0, "C1").alias("subgenogroup"), F.lit("10.1/x").alias("doi"), k.alias("ord"))
    vocab = curation.Vocabularies(tabio.mapping_table(spark, _SYMPTOMS), tabio.mapping_table(spark, _ISO_MAP), sorted(set(_SYMPTOMS.values())), _MAJOR)
    return meta, extra, local, ledger, regions, overrides, vocab


@query(
    "add_metadata",
    f"""WITH m AS (SELECT doc_id, {_sql_accession('doc_id')} AS accession, source, n_chars, l.doc_id AS x, quality FROM documents d LEFT JOIN labels l USING (doc_id)),
    j AS (SELECT *, doc_id AS k, x IS NOT NULL AS has_x, coalesce(x IS NOT NULL AND x % 9 = 0, false) AS en FROM m),
    f AS (SELECT *, CASE WHEN has_x AND k % 10 = 0 THEN 'France' WHEN k % 3 = 0 THEN 'United Kingdom' ELSE 'Nation ' || k % 30 END AS country_out,
      CASE WHEN NOT has_x THEN NULL WHEN k % 5 = 0 THEN 'HFMD' WHEN k % 5 = 1 THEN 'Fever; Rash' WHEN k % 5 = 2 THEN 'Odd Thing' END AS diag FROM j)
    SELECT accession, accession || '.1' AS accession_version, CASE WHEN k % 4 = 0 AND NOT has_x THEN accession WHEN has_x THEN 'lab' || k ELSE source END AS strain, CASE WHEN has_x AND k % 2 = 1 THEN '1999-05-05' ELSE '2001-XX-XX' END AS date,
      CASE WHEN k % 3 = 0 OR (has_x AND k % 10 = 0) OR k % 30 >= 25 THEN 'Na' ELSE 'South-East Asia' END AS region, CASE WHEN has_x AND k % 3 = 1 THEN 'Rotterdam' WHEN k % 2 = 0 THEN 'loc' ELSE 'div' END AS place, country_out AS country, 'Homo sapiens' AS host,
      CASE WHEN has_x THEN CASE k % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END END AS gender, CASE WHEN has_x AND k % 6 <> 0 THEN (k % 30)::DOUBLE END AS age_yrs,
      CASE WHEN NOT has_x OR k % 6 = 0 THEN 'nan' WHEN k % 30 >= 18 THEN '18+ y/o' WHEN k % 30 >= 11 THEN '11-17 y/o' WHEN k % 30 >= 6 THEN '6-10 y/o' WHEN k % 30 >= 1 THEN '1-5 y/o' ELSE '0-3 m/o' END AS age_range,
      has_x AND k % 6 <> 0 AS has_age, has_x AND k % 5 < 3 AS has_diagnosis, diag AS med_diagnosis_all, CASE diag WHEN 'HFMD' THEN 'HFMD' WHEN 'Fever; Rash' THEN 'Other; Rash-associated' END AS med_diagnosis_major,
      CASE WHEN has_x AND k % 8 = 0 THEN 'oronasopharynx' WHEN k % 5 = 0 THEN 'feces; serum' END AS isolation_source, CAST(n_chars AS VARCHAR) AS "NCBI_length_genome", CASE WHEN k % 11 = 0 AND k % 2 = 0 THEN 'C1' WHEN quality = 1 THEN 'C4' END AS subgenogroup,
      CASE WHEN en THEN 'Doe' ELSE 'authors' END AS authors, en AS "ENPEN", CASE WHEN en THEN 'Private' WHEN k % 11 = 0 THEN '10.1/x' WHEN has_x THEN 'Private: Doe' END AS doi, 'good' AS overall_status,
      CASE WHEN k % 2 = 1 THEN '2024-07-15' END AS date_added, CASE WHEN k % 2 = 1 THEN 2024.54::DOUBLE END AS date_added_num FROM f""",
)
def _(spark, sf):
    out = curation.add_metadata(*add_metadata_inputs(spark, sf))
    named = out.withColumnRenamed("qc.overallStatus", "overall_status").withColumn("date_added", F.col("date_added").cast("string"))
    shown = "accession accession_version strain date region place country host gender age_yrs age_range has_age has_diagnosis med_diagnosis_all med_diagnosis_major isolation_source NCBI_length_genome subgenogroup authors ENPEN doi overall_status date_added date_added_num"
    return named.select(*shown.split())


@query(
    "source_records",
    """SELECT CAST(doc_id AS VARCHAR) AS accession, CASE WHEN doc_id % 2 = 0 THEN 'iso/' || source || '/Utrecht' ELSE 'st' || doc_id END AS strain, CASE WHEN doc_id % 3 > 0 THEN 'Netherlands' END AS country,
      CASE WHEN doc_id % 3 = 2 THEN 'Delft' WHEN doc_id % 2 = 0 THEN 'Utrecht' END AS location, CASE WHEN doc_id % 4 = 0 THEN 'of' END AS subgenogroup, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'undated' ELSE '2011' END AS collection_yr,
      CASE WHEN doc_id % 6 = 0 THEN 'F' END AS sex, CASE WHEN doc_id % 6 = 0 THEN (n_chars % 90)::DOUBLE END AS age_yrs, CASE WHEN doc_id % 6 = 0 THEN 'Fever' WHEN doc_id % 4 = 1 THEN 'HFMD' END AS diagnosis,
      CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'stool' END AS isolation, 'Homo sapiens' AS origin, CASE WHEN doc_id % 7 = 0 THEN 'PMID: ' || doc_id ELSE 'genbank corrections' END AS doi FROM documents WHERE lang = 'fr' AND doc_id % 6 <> 0
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'iso/' || source || '/Utrecht', CASE WHEN doc_id % 3 > 0 THEN 'Netherlands' END, CASE WHEN doc_id % 3 = 2 THEN 'Delft' ELSE 'Utrecht' END, CASE WHEN doc_id % 4 = 0 THEN 'of' END,
      CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'undated' ELSE '2011' END, 'F', (n_chars % 90)::DOUBLE, 'Fever', 'female', 'Homo sapiens', CASE WHEN doc_id % 7 = 0 THEN 'PMID: ' || doc_id ELSE 'genbank corrections' END FROM documents WHERE lang = 'fr' AND doc_id % 6 = 0""",
)
def _(spark, sf):
    k, s = F.col("doc_id"), F.col("doc_id").cast("string")
    records = table(spark, sf, "documents").select(
        s.alias("accession"), F.when(F.col("lang") == "fr", "Enterovirus A71").otherwise(F.col("lang")).alias("organism"),
        F.when(k % 2 == 1, F.concat(F.lit("st"), s)).otherwise("i").alias("strain"), F.when(k % 2 == 0, F.concat(F.lit("iso/"), "source", F.lit("/Utrecht"))).alias("isolate"),
        F.when(k % 3 == 1, "Netherlands").when(k % 3 == 2, "Netherlands: Delft").alias("geo_loc_name"),
        F.when(k % 6 == 0, F.concat(F.lit("female patient "), (F.col("n_chars") % 90).cast("string"), F.lit(" years with fever"))).otherwise("stool").alias("isolation_source"),
        F.lit("Homo sapiens").alias("host"), F.lit(None).cast("string").alias("note"), F.when(k % 5 == 1, "undated").when(k % 5 > 1, "12-May-2011").alias("collection_date"),
        F.when(k % 4 == 0, "Outbreak of subgenogroup C4").when(k % 4 == 1, "HFMD in children").otherwise("Direct submission").alias("title"), F.when(k % 7 == 0, s).alias("pubmed_id"),
    )
    out = curation.source_record(records, "Enterovirus A71", {"fever": "Fever", "HFMD": "HFMD"}, ["Utrecht", "Leiden"])
    return out.select("accession", "strain", "country", "location", "subgenogroup", "collection_yr", "sex", "age_yrs", "diagnosis", "isolation", "origin", "doi")


# ---- file round trips: written below the shared folder, read back by the loaders


@query("fasta_round_trip", f"WITH {SQL_SEQS} SELECT id, id || ' ' || lang AS description, seq FROM seqs JOIN documents ON doc_id = ord")
def _(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), "lang")
    path = fresh_path(spark, "fasta")
    seqio.write_fasta(sequences(spark, sf).join(d, "ord").withColumn("head", F.concat_ws(" ", "id", "lang")), path, "head", "seq")
    return seqio.read_fasta(spark, path).select("id", "description", "seq")


@query("table_round_trip", "SELECT CAST(c_custkey AS VARCHAR) AS accession, c_name AS strain, NULL AS absent, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS segment FROM customer")
def _(spark, sf):
    path = fresh_path(spark, "table.tsv")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("accession"), F.col("c_name").alias("strain"), F.when(F.col("c_custkey") % 3 == 0, "NA").otherwise(F.col("c_mktsegment")).alias("segment"), "c_acctbal")
    tabio.write_tsv(rows, path, ["accession", "strain", "absent", "segment"])
    return tabio.read_table(spark, path, sep="\t").drop("ord")


@query("id_list_round_trip", "SELECT 'D' || doc_id AS id FROM labels")
def _(spark, sf):
    path = fresh_path(spark, "ids")
    d = F.concat(F.lit("D"), F.col("doc_id").cast("string"))
    line = F.when(F.col("quality") == 1, F.concat(d, F.lit("\t # kept"))).otherwise(F.concat(F.lit("# note\n\n"), d, F.lit("\t\t")))
    table(spark, sf, "labels").select(line.alias("value")).write.text(path)
    return tabio.read_id_list(spark, path)


@query("rule_table_round_trip", "SELECT p_brand AS clade, CASE WHEN p_partkey % 4 = 0 THEN 'clade' ELSE 'nuc' END AS gene, CASE WHEN p_partkey % 4 = 0 THEN p_type ELSE CAST(p_size AS VARCHAR) END AS site, CASE WHEN p_partkey % 4 > 0 THEN 'A' END AS alt FROM part")
def _(spark, sf):
    path = fresh_path(spark, "rules")
    k = F.col("p_partkey") % 4
    row = F.when(k == 0, F.concat_ws("\t", "p_brand", F.lit("clade"), "p_type")).otherwise(F.concat_ws("\t", "p_brand", F.lit("nuc"), F.col("p_size").cast("string"), F.lit("A")))
    table(spark, sf, "part").select(F.concat(row, F.lit("\r\n\r")).alias("value")).write.text(path)
    return tabio.read_rule_table(spark, path).drop("ord")


@query("gff3_round_trip", "SELECT 'chr' || p_size AS seqid, 'CDS' AS type, CAST(p_partkey AS INTEGER) AS start, CAST(p_partkey AS INTEGER) + 9 AS \"end\", p_name AS name, p_brand AS product FROM part WHERE p_partkey % 3 > 0")
def _(spark, sf):
    path = fresh_path(spark, "gff3")
    k = F.col("p_partkey")
    line = F.concat_ws(
        "\t", F.concat(F.lit("chr"), F.col("p_size").cast("string")), F.lit("src"), F.when(k % 3 > 0, "CDS").otherwise("region"), k.cast("string"), (k + 9).cast("string"), F.lit("."), F.lit("+"), F.lit("."),
        F.concat(F.lit("Name=first;Name="), "p_name", F.lit(";product="), "p_brand"),
    )
    table(spark, sf, "part").select(F.concat(F.lit("##sequence-region\n"), line).alias("value")).write.text(path)
    out = seqio.read_gff3(spark, path, ["CDS"])
    return out.select("seqid", "type", "start", "end", F.col("attrs")["Name"].alias("name"), F.col("attrs")["product"].alias("product"))


@query(
    "genbank_round_trip",
    f"""WITH {SQL_SEQS} SELECT 'D' || id || '.1' AS seqid, 'Document ' || id || ' of ' || source AS definition, 'source' AS type, 1 AS start, CAST(length(seq) AS INTEGER) AS "end", '+' AS strand, lang || ' long text' AS label, seq FROM seqs JOIN documents ON doc_id = ord
    UNION ALL SELECT 'D' || id || '.1', 'Document ' || id || ' of ' || source, 'CDS', 5, 90, '-', 'VP1', reverse(translate(substr(seq, 5, 16) || substr(seq, 61, 30), 'ACGT', 'TGCA')) FROM seqs JOIN documents ON doc_id = ord""",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), "lang", "source")
    s = sequences(spark, sf).join(d, "ord")
    blocks = F.regexp_replace(F.lower("seq"), "(.{1,60})", "\n        1 $1")
    pad = " " * 21
    record = F.concat(
        F.lit("LOCUS       D"), "id", F.lit("\nDEFINITION  Document "), "id", F.lit("\n            of "), "source", F.lit("\nACCESSION   D"), "id", F.lit("\nVERSION     D"), "id", F.lit(".1\nFEATURES             Location/Qualifiers\n     source          1.."),
        F.length("seq").cast("string"), F.lit(f'\n{pad}/organism="Enterovirus A71"\n{pad}/note="'), "lang", F.lit(f' long\n{pad}text"\n     CDS             complement(join(5..20,\n{pad}61..90))\n{pad}/product="first"\n{pad}/product="VP1"\nORIGIN'), blocks, F.lit("\n//"),
    )
    path = fresh_path(spark, "genbank")
    s.select(record.alias("value")).write.text(path)
    records = seqio.read_genbank(spark, path)
    feats = seqio.genbank_features(records)
    label = F.coalesce(F.try_element_at(F.try_element_at("values", F.lit("product")), F.lit(2)), F.try_element_at("attrs", F.lit("note")))
    seqs = seqio.genbank_sequences(records)
    cut, _inside = extract_feature(seqs, feats, "vp1")
    letters = seqs.select(F.col("id").alias("seqid"), F.lit("source").alias("type"), "seq").unionByName(cut.select(F.col("id").alias("seqid"), F.lit("CDS").alias("type"), "seq"))
    named = records.select(F.col("version").alias("seqid"), "definition")
    return feats.join(named, "seqid").join(letters, ["seqid", "type"]).select("seqid", "definition", "type", "start", "end", "strand", label.alias("label"), "seq")


@query(
    "genbank_locations",
    f"""WITH {SQL_SEQS}, d AS (SELECT id, seq, ord % 5 AS k, translate(seq, 'ACGT', 'TGCA') AS c FROM seqs)
    SELECT 'D' || id || '.1' AS seqid, CASE k WHEN 0 THEN '1-30+ 61-70+ 41-50+ 81-90-' WHEN 1 THEN '21-30+ 1-10-' WHEN 2 THEN '1-9- 4-6+' WHEN 3 THEN '5-9+ 1-3+' ELSE '7-9-' END AS spans,
      CASE WHEN k = 2 THEN 'X' || id || '.7:1-9-' ELSE '' END AS remote,
      CASE k WHEN 0 THEN substr(seq, 1, 30) || substr(seq, 61, 10) || substr(seq, 41, 10) || reverse(substr(c, 81, 10)) WHEN 1 THEN substr(seq, 21, 10) || reverse(substr(c, 1, 10))
        WHEN 3 THEN substr(seq, 5, 5) || substr(seq, 1, 3) WHEN 4 THEN reverse(substr(c, 7, 3)) END AS seq FROM d""",
)
def _(spark, sf):
    k, name = F.col("ord") % 5, F.col("id")
    location = (
        F.when(k == 0, F.lit("join(1..30,complement(join(complement(41..50),complement(61..70))),order(complement(81..90)))"))
        .when(k == 1, "complement(join(1..10,complement(21..30)))")
        .when(k == 2, F.concat(F.lit("join(complement(X"), name, F.lit(".7:1..9),4..>6)")))
        .when(k == 3, F.concat(F.lit("order(D"), name, F.lit(".1:5..9,join(D"), name, F.lit(":<1..3))")))
        .otherwise("complement(7^9)")
    )
    blocks = F.regexp_replace(F.lower("seq"), "(.{1,60})", "\n        1 $1")
    pad = " " * 21
    # locations go on in the next line after a comma, as flat files have them
    wrapped = F.regexp_replace(location, r"\),", f"),\n{pad}")
    record = F.concat(
        F.lit("LOCUS       D"), name, F.lit("\nACCESSION   D"), name, F.lit("\nVERSION     D"), name, F.lit(".1\nFEATURES             Location/Qualifiers\n     CDS             "), wrapped,
        F.lit(f'\n{pad}/product="P9"\nORIGIN'), blocks, F.lit("\n//"),
    )
    path = fresh_path(spark, "genbank")
    sequences(spark, sf).select(record.alias("value")).write.text(path)
    records = seqio.read_genbank(spark, path)
    feats = seqio.genbank_features(records)
    cut, _inside = extract_feature(seqio.genbank_sequences(records), feats, "p9")
    part = lambda p: F.concat(p["start"].cast("string"), F.lit("-"), p["end"].cast("string"), p["strand"])
    shown = feats.select(
        "seqid", F.concat_ws(" ", F.transform("spans", part)).alias("spans"), F.concat_ws(" ", F.transform("remote", lambda p: F.concat(p["record"], F.lit(":"), part(p)))).alias("remote")
    )
    return shown.join(cut.select(F.col("id").alias("seqid"), "seq"), "seqid")
