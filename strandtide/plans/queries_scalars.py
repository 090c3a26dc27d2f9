"""Column functions over the given tables: text, mining, precedence, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandtide.functions import dates, mining, precedence, text
from strandtide.names import quoted
from strandtide.operators import select
from strandtide.operators.clades import trim_labels
from strandtide.plans.registry import query
from strandtide.plans.standins import (
    SQL_CUSTOMER_NAMES,
    SQL_DIRTY_DATES,
    accession,
    customer_names,
    dirty_dates,
    short_accession,
    table,
)
from strandtide.runtime import fresh_path, spread_when_few
from strandtide.sources.tables import node_rows, parse_json, read_node_documents

# word characters and title case as SQL sees them
_WORD = r"[\p{L}\p{M}\p{N}\p{Pc}]"
_EDGE_L, _EDGE_R = r"(?:^|[^\p{L}\p{M}\p{N}\p{Pc}])", r"(?:$|[^\p{L}\p{M}\p{N}\p{Pc}])"


def _sql_title(x: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({x}, '\p{{L}}+|\P{{L}}+'), "
        r"lambda w: upper(w[1:1]) || lower(w[2:])), '')"
    )


@query(
    "normalize_strings",
    r"SELECT doc_id, md5(nfc_normalize(trim(regexp_replace(replace('  ' || text, 'é', 'e' || chr(769)), '[\s\p{Z}]+', ' ', 'g')))) AS text_md5 FROM documents",
)
def _(spark, sf):
    d = spread_when_few(table(spark, sf, "documents"))
    # composed letters are taken apart first, so that there is something to compose
    apart = F.replace(F.concat(F.lit("  "), F.col("text")), F.lit("é"), F.lit("é"))
    out = text.normalize_strings(d.select("doc_id", apart.alias("text")), ["text"])
    return out.select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "transform_strain",
    """WITH s AS (SELECT c_custkey, c_mktsegment AS strain, CASE WHEN c_custkey % 3 = 0 THEN 'S' || c_custkey ELSE c_name END AS backup FROM customer)
    SELECT c_custkey, CASE WHEN regexp_matches(strain, '^[BMS].+$') THEN strain WHEN regexp_matches(backup, '^[BMS].+$') THEN backup ELSE strain END AS strain FROM s""",
)
def _(spark, sf):
    c = table(spark, sf, "customer")
    backup = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("S"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_name"))
    return c.select("c_custkey", text.transform_strain(F.col("c_mktsegment"), [backup], "^[BMS].+$").alias("strain"))


@query(
    "parse_location",
    f"""WITH {SQL_CUSTOMER_NAMES}
    SELECT c_custkey, n_name AS country, CASE WHEN c_custkey % 3 > 0 THEN r_name END AS division,
      CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment || ', ' || c_name END AS location FROM names""",
)
def _(spark, sf):
    n = customer_names(spark, sf)
    k = F.col("c_custkey") % 3
    place = F.concat(
        F.lit("  "), F.col("n_name"),
        F.when(k > 0, F.concat(F.lit(" : "), F.col("r_name"))).otherwise(F.lit("")),
        F.when(k == 2, F.concat(F.lit(",  "), F.col("c_mktsegment"), F.lit(", "), F.col("c_name"))).otherwise(F.lit("")),
    )
    return n.select("c_custkey", text.parse_location(place).alias("p")).select("c_custkey", "p.*")


@query(
    "titlecase",
    """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: CASE WHEN upper(w) IN ('RED', 'HOT') THEN upper(w)
      WHEN lower(w) IN ('ring', 'bolt') THEN lower(w) ELSE upper(w[1:1]) || lower(w[2:]) END), ' ') AS name FROM part""",
)
def _(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", text.title_words(F.col("p_name"), ["ring", "bolt"], ["RED", "HOT"]).alias("name"))


@query(
    "abbreviate_authors",
    "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '?' WHEN 1 THEN source ELSE source || ' et al' END AS abbr_authors FROM documents",
)
def _(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id") % 3
    authors = F.when(k == 0, F.lit("  ")).when(k == 1, F.col("source")).otherwise(F.concat_ws(", ", "source", "lang", F.lit("Z")))
    return d.select("doc_id", text.abbreviate_authors(authors).alias("abbr_authors"))


@query(
    "correct_country",
    f"""WITH {SQL_CUSTOMER_NAMES}, raw AS (SELECT c_custkey, n_name, r_name FROM names)
    SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'United Kingdom' WHEN 1 THEN 'Vietnam' WHEN 2 THEN 'USA'
      WHEN 3 THEN 'Côte D''Ivoire' WHEN 4 THEN NULL WHEN 5 THEN 'Hong Kong'
      WHEN 6 THEN {_sql_title("r_name || '-EAST D''' || replace(n_name, '_', ' ')")}
      ELSE {_sql_title("replace(n_name, '_', ' ')")} END AS country FROM raw""",
)
def _(spark, sf):
    n, k = customer_names(spark, sf), F.col("c_custkey") % 8
    raw = (
        F.when(k == 0, F.lit(" UK ")).when(k == 1, "Viet Nam").when(k == 2, "usa").when(k == 3, "Ivory Coast").when(k == 4, "  ")
        .when(k == 5, "HongKong").when(k == 6, F.concat("r_name", F.lit("-EAST  D'"), "n_name")).otherwise(F.col("n_name"))
    )
    return n.select("c_custkey", text.correct_country(raw).alias("country"))


@query(
    "split_multi",
    r"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(replace(regexp_replace(text, ',|/| or ', ';', 'g'), '  ', ' '), ';'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS parts FROM documents)
    SELECT doc_id, CAST(len(parts) AS INTEGER) AS n_parts, md5(array_to_string(parts, '|')) AS parts_md5 FROM p""",
)
def _(spark, sf):
    d = spread_when_few(table(spark, sf, "documents")).select("doc_id", text.split_multi(F.col("text")).alias("parts"))
    return d.select("doc_id", F.size("parts").alias("n_parts"), F.md5(F.array_join("parts", "|")).alias("parts_md5"))


_EVENT_TERMS = "CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN event_type || '; view' WHEN 2 THEN 'Active' WHEN 3 THEN event_type || '; nothing; click' ELSE 'nothing' END"


def _event_terms():
    k, e = F.col("event_id") % 5, F.col("event_type")
    return (
        F.when(k == 0, e).when(k == 1, F.concat(e, F.lit("; view"))).when(k == 2, "Active")
        .when(k == 3, F.concat(e, F.lit("; nothing; click"))).otherwise("nothing")
    )


@query(
    "major_group",
    f"""WITH t AS (SELECT event_id, {_EVENT_TERMS} AS term FROM events)
    SELECT event_id, CASE WHEN term IN ('Active', 'Passive') THEN term ELSE nullif(array_to_string(list_sort(list_distinct(list_filter(
      list_transform(string_split(term, '; '), lambda x: CASE WHEN x IN ('click', 'purchase') THEN 'Active' WHEN x = 'view' THEN 'Passive' END), lambda x: x IS NOT NULL))), '; '), '') END AS major FROM t""",
)
def _(spark, sf):
    groups = {"click": "Active", "purchase": "Active", "view": "Passive"}
    e = table(spark, sf, "events")
    return e.select("event_id", text.major_group(_event_terms(), groups).alias("major"))


@query(
    "distinct_sorted_join",
    f"""WITH t AS (SELECT event_id, {_EVENT_TERMS} || '; ' || event_type AS term FROM events)
    SELECT event_id, array_to_string(list_sort(list_distinct(string_split(term, '; '))), '; ') AS terms FROM t""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    parts = F.split(F.concat_ws("; ", _event_terms(), F.col("event_type")), "; ")
    return e.select("event_id", text.distinct_sorted_join(parts).alias("terms"))


@query(
    "parse_gender",
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'M' WHEN 3 THEN event_type END AS gender FROM events",
)
def _(spark, sf):
    e, k = table(spark, sf, "events"), F.col("event_id") % 5
    raw = F.when(k == 0, "Female adult").when(k == 1, F.lit(" male ")).when(k == 2, "MALE").when(k == 3, F.col("event_type"))
    return e.select("event_id", text.parse_gender(raw).alias("gender"))


_HOST_SQL = """CASE doc_id % 8 WHEN 0 THEN 'Homo sapiens; Female; ' || n_chars % 90 || ' years' WHEN 1 THEN 'stool of a boy ' || n_chars % 12 || ' months, skin rash'
  WHEN 2 THEN 'Human man two years 3 months fever' WHEN 3 THEN 'CSF; ' || n_chars % 300 || ' days; HFMD and fever' WHEN 4 THEN '7 h'
  WHEN 5 THEN 'child, throat swab' WHEN 6 THEN 'serum girl 1.5 y' ELSE lang END || chr(10) || text"""
SYMPTOMS = {"fever": "Fever", "skin rash": "Rash", "rash": "Rash", "hfmd": "HFMD"}


def _host_field():
    k, n, s = F.col("doc_id") % 8, F.col("n_chars"), lambda c: c.cast("string")
    lead = (
        F.when(k == 0, F.concat(F.lit("Homo sapiens; Female; "), s(n % 90), F.lit(" years")))
        .when(k == 1, F.concat(F.lit("stool of a boy "), s(n % 12), F.lit(" months, skin rash")))
        .when(k == 2, "Human man two years 3 months fever")
        .when(k == 3, F.concat(F.lit("CSF; "), s(n % 300), F.lit(" days; HFMD and fever")))
        .when(k == 4, "7 h").when(k == 5, "child, throat swab").when(k == 6, "serum girl 1.5 y").otherwise(F.col("lang"))
    )
    return F.concat(lead, F.lit("\n"), F.col("text"))


def _sql_mine(field: str) -> str:
    age = r"(\d+\.?\d*|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve)\s*(years?|months?|days?|y|m|d)"
    words = "['one','two','three','four','five','six','seven','eight','nine','ten','eleven','twelve']"
    word = lambda t: rf"regexp_matches(t, '{_EDGE_L}{t}{_EDGE_R}')"
    sex = rf"regexp_extract(t, '{_EDGE_L}(male|female|m|f|man|woman|boy|girl|h){_EDGE_R}', 1)"
    iso = rf"regexp_extract(t, '{_EDGE_L}(feces|throat|plasma|csf|cerebro spinal fluid|mouth swab|vesicle|stool|blood|serum){_EDGE_R}', 1)"
    cap = lambda x: f"nullif(upper({x}[1:1]) || {x}[2:], '')"
    return rf"""WITH src AS (SELECT doc_id, lower({field}) AS t FROM documents),
    hit AS (SELECT *, regexp_extract_all(t, '{age}', 1) AS v, regexp_extract_all(t, '{age}', 2) AS u FROM src),
    num AS (SELECT *, list_transform(range(1, len(v) + 1), lambda i: {{'x': coalesce(TRY_CAST(v[i] AS DOUBLE), list_position({words}, v[i])::DOUBLE), 'k': u[i][1:1]}}) AS p FROM hit),
    pick AS (SELECT *, list_filter(p, lambda e: e.k IN ('d', 'y'))[-1] AS y, list_filter(p, lambda e: e.k = 'm')[-1].x AS mo FROM num),
    yrs AS (SELECT *, CASE WHEN y.k = 'd' THEN round_even(y.x / 365, 3) ELSE y.x END AS yr FROM pick),
    tot AS (SELECT *, coalesce(yr, 0) + round_even(coalesce(mo, 0) / 12, 3) AS total FROM yrs)
    SELECT doc_id, {cap("regexp_extract(t, '(homo sapiens|human|other hosts|child)', 1)")} AS host,
      coalesce({cap(iso)}, CASE WHEN length(regexp_extract(trim(t), '^(\S+)', 1)) >= 2 AND NOT regexp_matches(regexp_extract(trim(t), '^(\S+)', 1), '^\d+$') THEN regexp_extract(trim(t), '^(\S+)', 1) END) AS isolation,
      CASE WHEN {sex} IN ('f', 'girl', 'woman', 'female') THEN 'F' WHEN {sex} <> '' THEN 'M' END AS sex,
      CASE WHEN len(p) > 1 THEN round_even(total, 3) ELSE coalesce(yr, round_even(mo / 12, 3)) END AS age_yrs,
      CASE WHEN len(p) > 1 THEN round_even(total * 12, 3) ELSE coalesce(round_even(yr * 12, 3), mo) END AS age_mo,
      nullif(array_to_string(list_filter([CASE WHEN {word('fever')} THEN 'Fever' END, CASE WHEN {word('hfmd')} THEN 'HFMD' END, CASE WHEN {word('rash')} THEN 'Rash' END], lambda x: x IS NOT NULL), '; '), '') AS diagnosis
    FROM tot"""


@query("mine_host_text", _sql_mine(_HOST_SQL))
def _(spark, sf):
    d = spread_when_few(table(spark, sf, "documents"))
    mined = d.select("doc_id", mining.mine_host_text(_host_field(), SYMPTOMS).alias("m")).select("doc_id", "m.*")
    # binary sums such as 2 + 0.25 keep more digits than the rule's three
    return mined.withColumns({"age_yrs": F.bround("age_yrs", 3), "age_mo": F.bround("age_mo", 3)})


_TITLE_SQL = """CASE p_partkey % 5 WHEN 0 THEN 'Outbreak of subgenogroup ' || p_type || ' in ' || p_name WHEN 1 THEN p_name || ' C4a genogroup found'
  WHEN 2 THEN 'the ' || p_type || 'type study' WHEN 3 THEN 'Type B' || p_size || ' ' || p_name ELSE p_name END"""


def _title():
    k = F.col("p_partkey") % 5
    return (
        F.when(k == 0, F.concat(F.lit("Outbreak of subgenogroup "), "p_type", F.lit(" in "), "p_name"))
        .when(k == 1, F.concat("p_name", F.lit(" C4a genogroup found")))
        .when(k == 2, F.concat(F.lit("the "), "p_type", F.lit("type study")))
        .when(k == 3, F.concat(F.lit("Type B"), F.col("p_size").cast("string"), F.lit(" "), "p_name"))
        .otherwise(F.col("p_name"))
    )


@query(
    "mine_genotype",
    rf"""WITH t AS (SELECT p_partkey, {_TITLE_SQL} AS title, CASE WHEN p_partkey % 7 = 0 THEN 'genogroup: ' || p_type END AS note FROM part),
    g AS (SELECT *, '(?i)\b([A-Za-z0-9\-\.]+)\s*(?:subgenogroup|genogroup|type)\b|\b(?:subgenogroup|genogroup|type)\s*([A-Za-z0-9\-\.]+)\b' AS re FROM t)
    SELECT p_partkey, coalesce(nullif(regexp_extract(note, '(?i)(type|genogroup)[\s:]*([A-Za-z0-9\-\.]+)', 2), ''),
      nullif(regexp_extract(title, '(?i)\b([A-Za-z0-9\-\.]+)\s*(?:subgenogroup|genogroup|type)\b|\b(?:subgenogroup|genogroup|type)\s*([A-Za-z0-9\-\.]+)\b', 1), ''),
      nullif(regexp_extract(title, '(?i)\b([A-Za-z0-9\-\.]+)\s*(?:subgenogroup|genogroup|type)\b|\b(?:subgenogroup|genogroup|type)\s*([A-Za-z0-9\-\.]+)\b', 2), '')) AS genotype FROM g""",
)
def _(spark, sf):
    note = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("genogroup: "), "p_type"))
    return table(spark, sf, "part").select("p_partkey", mining.mine_genotype(_title(), note).alias("genotype"))


@query(
    "mine_severity",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'HFMD; severity ' || n_chars % 5 || '; ' || source WHEN 1 THEN 'severity ' || lang || '; died'
      WHEN 2 THEN 'HFMD' END AS diagnosis FROM documents""",
)
def _(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id") % 4
    note = (
        F.when(k == 0, F.concat(F.lit("severity score: "), (F.col("n_chars") % 5).cast("string"), F.lit(", outcome: "), "source"))
        .when(k == 1, F.concat(F.lit("note severity  score:"), "lang", F.lit(" and outcome:died")))
        .when(k == 2, "score unknown")
    )
    had = F.when(k % 2 == 0, F.when(k < 3, "HFMD"))
    return d.select("doc_id", mining.mine_severity(had, note).alias("diagnosis"))


@query(
    "pick_strain",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN c_name WHEN 2 THEN c_name ELSE c_name END AS strain FROM customer""",
)
def _(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey") % 4
    strain = F.when(k == 0, F.col("c_mktsegment")).when(k == 1, F.lit("")).when(k == 2, F.col("c_name")).otherwise(F.col("c_mktsegment"))
    isolate = F.when(k == 0, F.lit(None).cast("string")).when(k == 2, F.col("c_mktsegment")).otherwise(F.col("c_name"))
    return c.select("c_custkey", text.pick_strain(strain, isolate).alias("strain"))


_DESC_SQL = """CASE doc_id % 6 WHEN 0 THEN 'Enterovirus A71 strain ' || source || '/' || doc_id || ' complete genome' WHEN 1 THEN 'EV-A71 isolate ' || source || '.x, VP1 gene'
  WHEN 2 THEN 'ev-a71 ' || lang || ' partial cds' WHEN 3 THEN 'Coxsackievirus strain B' || n_chars || ' complete genome' WHEN 4 THEN 'EV-A71 VP1b ' || source ELSE 'EV-A711 VP1' END || ' ' || text"""


def _description():
    k, s = F.col("doc_id") % 6, lambda c: F.col(c).cast("string")
    lead = (
        F.when(k == 0, F.concat(F.lit("Enterovirus A71 strain "), "source", F.lit("/"), s("doc_id"), F.lit(" complete genome")))
        .when(k == 1, F.concat(F.lit("EV-A71 isolate "), "source", F.lit(".x, VP1 gene")))
        .when(k == 2, F.concat(F.lit("ev-a71 "), "lang", F.lit(" partial cds")))
        .when(k == 3, F.concat(F.lit("Coxsackievirus strain B"), s("n_chars"), F.lit(" complete genome")))
        .when(k == 4, F.concat(F.lit("EV-A71 VP1b "), "source"))
        .otherwise("EV-A711 VP1")
    )
    return F.concat(lead, F.lit(" "), F.col("text"))


@query(
    "description_is_target",
    rf"""WITH t AS (SELECT doc_id, {_DESC_SQL} AS d FROM documents)
    SELECT doc_id, regexp_matches(d, '(?i)\b(Enterovirus A71|EV-A71)\b') AND (regexp_matches(d, '(?i)\bVP1\b') OR regexp_matches(d, '(?i)\bcomplete \b') OR regexp_matches(d, '(?i)\bpartial cds\b')) AS is_target FROM t""",
)
def _(spark, sf):
    return spread_when_few(table(spark, sf, "documents")).select("doc_id", mining.description_is_target(_description(), "Enterovirus A71|EV-A71").alias("is_target"))


@query(
    "strain_from_title",
    rf"""WITH t AS (SELECT doc_id, {_DESC_SQL} AS d, doc_id % 3 AS n FROM documents),
    s AS (SELECT *, nullif(regexp_extract(d, '(strain|isolate)\s+([\w\-\./]+)', 2), '') AS name FROM t)
    SELECT doc_id, CASE WHEN regexp_matches(d, '(?i)\bcomplete \b') AND n > 1 THEN name || 'c' ELSE name END AS strain FROM s""",
)
def _(spark, sf):
    return spread_when_few(table(spark, sf, "documents")).select("doc_id", mining.strain_from_title(_description(), F.col("doc_id") % 3).alias("strain"))


@query(
    "extract_digits",
    "SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g')[1:4] AS first_digits, right(regexp_replace(c_name, '[^0-9]', '', 'g'), 4) AS last_digits FROM customer",
)
def _(spark, sf):
    name = F.col("c_name")
    return table(spark, sf, "customer").select(
        "c_custkey", text.extract_digits(name, 4).alias("first_digits"), text.extract_digits(name, 4, "last").alias("last_digits")
    )


@query(
    "private_authors",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN source ELSE lang END AS authors, CASE WHEN doc_id % 4 = 0 THEN 'Private' ELSE 'Private: ' || source END AS doi, doc_id % 4 = 0 AS "ENPEN" FROM documents""",
)
def _(spark, sf):
    d = table(spark, sf, "documents")
    origin = F.when(F.col("doc_id") % 4 == 0, "lab enpen 2020").when(F.col("doc_id") % 4 == 1, "other")
    rows = d.select("doc_id", F.col("lang").alias("authors"), F.concat(F.lit("Private: "), "source").alias("doi"), text.contains_ci(origin, "ENPEN").alias("ENPEN"))
    return text.private_authors(rows)


@query(
    "parse_attributes",
    "SELECT p_partkey, p_name AS name, p_brand || '=' || p_type AS note, CASE WHEN p_partkey % 2 = 0 THEN 'late' ELSE 'early' END AS twice FROM part",
)
def _(spark, sf):
    raw = F.concat(
        F.lit("ID=x;Name="), "p_name", F.lit(";note="), "p_brand", F.lit("="), "p_type", F.lit(";broken;twice=early"),
        F.when(F.col("p_partkey") % 2 == 0, ";twice=late").otherwise(""),
    )
    m = table(spark, sf, "part").select("p_partkey", text.parse_attributes(raw).alias("m"))
    return m.select("p_partkey", *[F.col("m")[k].alias(n) for k, n in (("Name", "name"), ("note", "note"), ("twice", "twice"))])


@query("trim_labels", "SELECT p_partkey, p_type AS label FROM part")
def _(spark, sf):
    return trim_labels(table(spark, sf, "part").select("p_partkey", F.concat(F.lit("  "), "p_type", F.lit(" \t ")).alias("label")), ["label"])


@query(
    "looks_like_accession",
    """SELECT c_custkey, c_custkey % 4 < 2 AS is_accession, CASE c_custkey % 4 WHEN 0 THEN 'AB' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') WHEN 1 THEN 'U' || lpad(CAST(c_custkey AS VARCHAR), 5, '0')
      WHEN 2 THEN 'MK' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') ELSE c_name END AS accession FROM customer""",
)
def _(spark, sf):
    c, k, key = table(spark, sf, "customer"), F.col("c_custkey") % 4, F.col("c_custkey")
    raw = (
        F.when(k == 0, accession(key, "AB")).when(k == 1, short_accession(key, "U"))
        .when(k == 2, F.concat(F.lit("strain 7 "), accession(key, "MK"), F.lit(" VP1"))).otherwise(F.concat(F.lit("  "), "c_name"))
    )
    return c.select("c_custkey", text.looks_like_accession(raw).alias("is_accession"), text.accession_in(raw).alias("accession"))


@query("derive_accession", "SELECT 'P' || p_partkey AS accession, 'P' || p_partkey || '.' || p_size AS accession_version, p_name FROM part")
def _(spark, sf):
    versioned = F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit("."), F.col("p_size").cast("string"))
    rows = table(spark, sf, "part").select(versioned.alias("accession_version"), "p_name")
    return select.derive_accession(rows)


@query("add_url", "SELECT doc_id, 'https://www.ncbi.nlm.nih.gov/nuccore/D' || doc_id AS url FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.record_url(F.concat(F.lit("D"), F.col("doc_id").cast("string"))).alias("url"))


# the first of these words, in list order, that a document holds
_WORDS = ["eaux", "tion", "ing ", "ung", "QUE", "der"]


@query(
    "substring_join",
    "SELECT doc_id, CASE " + " ".join(f"WHEN contains(lower(text), '{w.lower()}') THEN '{w}'" for w in _WORDS) + " END AS keyword FROM documents",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.first_contained(F.col("text"), _WORDS).alias("keyword"))


_BINS = [("debt", -1000.0, 0.0), ("low", 0.0, 1000.5), ("mid", 1000.5, 5000.0), ("high", 7000.0, 9000.0)]


@query(
    "range_label_join",
    "SELECT c_custkey, CASE " + " ".join(f"WHEN c_acctbal BETWEEN {a} AND {b} THEN '{n}'" for n, a, b in _BINS) + " END AS label FROM customer",
)
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", dates.range_label(F.col("c_acctbal"), _BINS).alias("label"))


_DOC_LABELS = "SELECT d.doc_id, source, lang, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _doc_labels(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", "source", "lang", "n_chars", "quality", "toxic")


@query(
    "pick_name",
    f"""WITH t AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS key, CASE doc_id % 5 WHEN 0 THEN CAST(doc_id AS VARCHAR) WHEN 1 THEN NULL ELSE source END AS x,
      CASE WHEN quality IS NULL THEN NULL WHEN doc_id % 3 = 0 THEN CAST(doc_id AS VARCHAR) ELSE lang END AS y FROM ({_DOC_LABELS}))
    SELECT doc_id, CASE WHEN x = key OR x IS NULL THEN coalesce(y, x) WHEN y = key THEN x ELSE coalesce(y, x) END AS name FROM t""",
)
def _(spark, sf):
    key = F.col("doc_id").cast("string")
    x = F.when(F.col("doc_id") % 5 == 0, key).when(F.col("doc_id") % 5 != 1, F.col("source"))
    y = F.when(F.col("quality").isNotNull(), F.when(F.col("doc_id") % 3 == 0, key).otherwise(F.col("lang")))
    return _doc_labels(spark, sf).select("doc_id", precedence.pick_name(x, y, key).alias("name"))


@query(
    "pick_date",
    """WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS x, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'XXXX-XX-XX' ELSE strftime(o_orderdate, '%Y') || '-XX-XX' END AS y,
      CASE WHEN o_orderkey % 8 = 1 THEN 'date_correction' WHEN o_orderkey % 3 = 0 THEN 'ledger' END AS origin FROM orders)
    SELECT o_orderkey, CASE WHEN origin = 'date_correction' THEN y WHEN y IS NULL OR y = 'XXXX-XX-XX' THEN x ELSE y END AS date FROM t""",
)
def _(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    y = F.when(k % 4 == 1, dates.UNKNOWN_DATE).when(k % 4 > 1, F.concat(F.date_format(d, "yyyy"), F.lit("-XX-XX")))
    origin = F.when(k % 8 == 1, "date_correction").when(k % 3 == 0, "ledger")
    return table(spark, sf, "orders").select("o_orderkey", precedence.pick_date(F.date_format(d, "yyyy-MM-dd"), y, origin).alias("date"))


@query(
    "pick_longest",
    """WITH t AS (SELECT n_nationkey, CASE WHEN n_nationkey % 3 > 0 THEN n_name END AS x, CASE WHEN n_nationkey % 5 > 0 THEN n_name || repeat('x', n_nationkey % 2) END AS y FROM nation)
    SELECT n_nationkey, CASE WHEN x IS NULL OR length(x) < length(y) THEN y ELSE x END AS region FROM t""",
)
def _(spark, sf):
    k, n = F.col("n_nationkey"), F.col("n_name")
    y = F.when(k % 5 > 0, F.concat(n, F.repeat(F.lit("x"), k % 2)))
    return table(spark, sf, "nation").select("n_nationkey", precedence.pick_longest(F.when(k % 3 > 0, n), y).alias("region"))


@query(
    "fill_from",
    f"SELECT doc_id, coalesce(CAST(toxic AS VARCHAR), lang) AS filled FROM ({_DOC_LABELS})",
)
def _(spark, sf):
    return _doc_labels(spark, sf).select("doc_id", precedence.fill_from(F.col("toxic").cast("string"), F.col("lang")).alias("filled"))


@query(
    "replace_unless",
    f"SELECT doc_id, CASE WHEN coalesce(quality = 1, false) THEN source ELSE coalesce(CASE WHEN doc_id % 2 = 0 THEN lang END, source) END AS doi FROM ({_DOC_LABELS})",
)
def _(spark, sf):
    over = F.when(F.col("doc_id") % 2 == 0, F.col("lang"))
    return _doc_labels(spark, sf).select("doc_id", precedence.replace_unless(F.col("quality") == 1, F.col("source"), over).alias("doi"))


@query("has_value", f"SELECT doc_id, quality IS NOT NULL AS has_quality FROM ({_DOC_LABELS})")
def _(spark, sf):
    return _doc_labels(spark, sf).select("doc_id", precedence.has_value(F.col("quality")).alias("has_quality"))


_ISO_SQL = """CASE o_orderkey % 10 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-XX-XX') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 3 THEN strftime(o_orderdate, '%Y-%m-XX') WHEN 4 THEN strftime(o_orderdate, '%Y-%m-XX') WHEN 6 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 8 THEN strftime(o_orderdate, '%Y-%m-XX') WHEN 9 THEN strftime(o_orderdate, '%Y-%m-%d') {failed} END"""


@query(
    "format_dates",
    f"WITH {SQL_DIRTY_DATES} SELECT o.o_orderkey, {_ISO_SQL.format(failed='ELSE ' + repr(dates.UNKNOWN_DATE))} AS date, {_ISO_SQL.format(failed='ELSE raw_date')} AS date_unmasked FROM orders o JOIN dirty USING (o_orderkey)",
)
def _(spark, sf):
    raw = F.col("raw_date")
    return dirty_dates(spark, sf).select(
        "o_orderkey", dates.format_date(raw).alias("date"), dates.format_date(raw, mask_failure=False).alias("date_unmasked")
    )


@query(
    "min_date",
    f"WITH {SQL_DIRTY_DATES}, iso AS (SELECT o_orderkey, o_orderdate, {_ISO_SQL.format(failed='')} AS date FROM orders) "
    "SELECT o_orderkey, date FROM iso WHERE date >= '1998' AND (o_orderkey % 10 <> 5 AND o_orderkey % 10 <> 7)",
)
def _(spark, sf):
    iso = dirty_dates(spark, sf).select("o_orderkey", dates.format_date(F.col("raw_date")).alias("date"))
    return iso.filter(dates.on_or_after(F.col("date"), 1998))


@query(
    "partial_date",
    f"""WITH iso AS (SELECT o_orderkey, o_orderdate, {_ISO_SQL.format(failed="ELSE 'XXXX-XX-XX'")} AS iso FROM orders)
    SELECT o_orderkey, iso, TRY_CAST(iso[1:4] AS INTEGER) AS year, TRY_CAST(iso[6:7] AS INTEGER) AS month, TRY_CAST(iso[9:10] AS INTEGER) AS day,
      CAST(CASE WHEN iso NOT LIKE 'XXXX%' THEN CAST(replace(iso, 'XX', '01') AS DATE) END AS VARCHAR) AS lo,
      CAST(CASE WHEN iso LIKE 'XXXX%' THEN NULL WHEN iso LIKE '%-XX-XX' THEN make_date(CAST(iso[1:4] AS BIGINT), 12, 31) WHEN iso LIKE '%-XX' THEN last_day(CAST(replace(iso, 'XX', '01') AS DATE)) ELSE CAST(iso AS DATE) END AS VARCHAR) AS hi FROM iso""",
)
def _(spark, sf):
    iso = dirty_dates(spark, sf).select("o_orderkey", dates.partial_date(dates.format_date(F.col("raw_date"))).alias("p"))
    out = iso.select("o_orderkey", "p.*")
    return out.withColumns({c: F.col(c).cast("string") for c in ("lo", "hi")})


@query(
    "year_of_text",
    f"WITH {SQL_DIRTY_DATES} SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 5 THEN raw_date ELSE strftime(o_orderdate, '%Y') END AS year FROM dirty JOIN orders USING (o_orderkey)",
)
def _(spark, sf):
    return dirty_dates(spark, sf).select("o_orderkey", dates.year_of_text(F.col("raw_date")).alias("year"))


@query(
    "numeric_date",
    "SELECT o_orderkey, round_even(year(o_orderdate) + (month(o_orderdate) - 1) / 12 + (day(o_orderdate) - 1) / 365.25, 2) AS date_num FROM orders",
)
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", dates.numeric_date(F.col("o_orderdate")).alias("date_num"))


@query(
    "age_range",
    """WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal / 500 END AS age FROM customer)
    SELECT c_custkey, CASE WHEN age IS NULL THEN 'nan' WHEN age >= 18 THEN '18+ y/o' WHEN age >= 11 THEN '11-17 y/o' WHEN age >= 6 THEN '6-10 y/o' WHEN age >= 1 THEN '1-5 y/o'
      WHEN age >= 0.5 THEN '7-12 m/o' WHEN age >= 0.25 THEN '4-6 m/o' ELSE '0-3 m/o' END AS age_range FROM t""",
)
def _(spark, sf):
    age = F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal") / 500)
    return table(spark, sf, "customer").select("c_custkey", dates.age_range(age).alias("age_range"))


@query(
    "to_number",
    "SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN json_extract_string(props, '$.k') WHEN event_id % 3 = 1 THEN event_type ELSE CAST(user_id AS VARCHAR) || '.5' END AS DOUBLE) AS number FROM events",
)
def _(spark, sf):
    k = F.col("event_id") % 3
    raw = F.when(k == 0, F.get_json_object("props", "$.k")).when(k == 1, F.col("event_type")).otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".5")))
    return table(spark, sf, "events").select("event_id", dates.to_number(raw).alias("number"))


@query(
    "interval_coverage",
    """WITH t AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 10.0::DOUBLE AS a, 30.0::DOUBLE AS b, l_quantity AS c, l_quantity + l_linenumber * 5.0 AS d FROM lineitem)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, c AS span_lo, round(greatest(least(d, b) - greatest(c, a), 0.0) / (b - a), 6) AS coverage FROM t""",
)
def _(spark, sf):
    lo, hi = F.col("l_quantity"), F.col("l_quantity") + F.col("l_linenumber") * 5.0
    share = dates.interval_coverage(F.lit(10.0), F.lit(30.0), lo, hi)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", lo.alias("span_lo"), F.round(share, 6).alias("coverage"))


@query(
    "read_ndjson",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", parse_json(F.col("props"), "k int").alias("j"))
    return e.select("event_id", "j.k")


@query(
    "read_node_data",
    "SELECT 'E' || event_id AS node, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events",
)
def _(spark, sf):
    doc = F.concat(F.lit('{"generated_by": "x", "nodes": {"E'), F.col("event_id").cast("string"), F.lit('": '), F.col("props"), F.lit("}}"))
    return node_rows(table(spark, sf, "events").select(doc.alias("doc")), "doc")


@query(
    "read_node_documents",
    """SELECT 'E' || event_id AS node, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events
    UNION ALL SELECT 'E' || event_id, 'said', event_type || ' }"{ \\ ' || user_id FROM events""",
)
def _(spark, sf):
    said = F.concat("event_type", F.lit(' }"{ \\ '), F.col("user_id").cast("string"))
    node = F.concat(F.lit('"E'), F.col("event_id").cast("string"), F.lit('": '), F.to_json(F.struct(F.get_json_object("props", "$.k").alias("k"), said.alias("said"))))
    # a document for each user, all below one folder; other objects and braces in strings stand around the nodes
    docs = table(spark, sf, "events").select("user_id", node.alias("node")).groupBy("user_id").agg(F.concat_ws(",\n  ", F.collect_list("node")).alias("nodes"))
    text = F.concat(F.lit('{"version": "a}{\\"", "meta": {"nodes": {"x": "1"}, "y": {"z": "2"}}, "list": [{"a": 1}],\n "nodes": {'), "nodes", F.lit('}, "after": {"E": {"k": "no"}}}'))
    path = fresh_path(spark, "node-documents")
    docs.select(text.alias("value")).write.text(path)
    return read_node_documents(spark, path)


@query(
    "rename_fields",
    "SELECT o_orderkey AS accession, o_orderstatus AS strain, o_totalprice AS length FROM orders",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    out, _missing = select.rename_fields(o, {"o_orderkey": "accession", "o_orderstatus": "strain", "o_totalprice": "length", "absent": "x"})
    return out


@query("resolve_columns", 'SELECT o_orderkey AS accession, o_orderpriority AS clade, year(o_orderdate) AS "year" FROM orders')
def _(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("accession"), F.col("o_orderpriority").alias("subgenogroup"), F.year("o_orderdate").alias("collection_yr")
    )
    out, _unknown = select.resolve_columns(o, ["accession", "clade", "year", "no such column"])
    return out


@query(
    "select_final",
    "SELECT " + ", ".join(
        {"accession": "CAST(doc_id AS VARCHAR) AS accession", "strain": "source AS strain", "country": "lang AS country", "NCBI_length_genome": 'n_chars AS "NCBI_length_genome"'}.get(c, f'CAST(NULL AS VARCHAR) AS "{c}"')
        for c in select.FINAL_COLUMNS
    ) + " FROM documents",
)
def _(spark, sf):
    d = table(spark, sf, "documents")
    return select.select_final(
        d.select("text", F.col("doc_id").cast("string").alias("accession"), F.col("source").alias("strain"), F.col("lang").alias("country"), F.col("n_chars").alias("NCBI_length_genome"))
    ).select(quoted(select.FINAL_COLUMNS))


@query("duplicate_column", "SELECT c_custkey, c_mktsegment, c_mktsegment AS segment2 FROM customer")
def _(spark, sf):
    return select.duplicate_column(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "segment2")
