"""One query for each operator over its whole table, and the SQL that checks it where SQL can say it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandtide.llm import decontaminate, fill_middle, fingerprints, languages, mixing, near_dups, quality, runs, secrets, sharding, substrings, token_files, warc
from strandtide.llm.common import WORD
from strandtide.runtime import cut_lineage, fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_sharding")
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(_table(spark, folder, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query("op2_quality")
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = quality.fit(docs, _table(spark, folder, "labels").where(~held_out))
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@_query(
    "op3_decontamination",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g'), '[\p{L}\p{N}\p{M}]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g'), '[\p{L}\p{N}\p{M}]+') AS w FROM benchmark),
    k AS (SELECT 5 AS k UNION SELECT DISTINCT len(w) FROM b WHERE len(w) BETWEEN 1 AND 4),
    ds AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, k)),
    bs AS (SELECT DISTINCT item_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS s FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 4, least(len(w), 1)))) AS i FROM b)),
    n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
    f AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN bs USING (s) GROUP BY ALL)
    SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment FROM f JOIN n USING (item_id) WHERE n_found * 5 >= n_item * 4
    """,
)
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contained(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_found", "containment")


@_query(
    "op4_warc",
    """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    o AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND top > page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND top > page_id THEN top END AS refers_to
    FROM o
    """,
)
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write(_table(spark, folder, "pages"), path)
    captures = warc.assemble(warc.read(spark, path), blocks=False)
    return captures.select(
        F.col("metadata.fields")["page-id"].cast("long").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.col("metadata.fields")["refers-to-page-id"].cast("long").alias("refers_to"),
    )


def thirds(place):
    """Weights 3, 1, 2, repeating."""
    return F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)), (F.pmod(place, F.lit(3)) + 1).cast("int"))


@_query("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, folder, "documents"))


@_query(
    "op6_mixing",
    rf"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size, md5('7|' || coalesce(doc_id::VARCHAR, 'null')) AS place,
               md5(coalesce(text, '')) AS content
        FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM d GROUP BY source),
    fill(step, source, source_size, weight, target) AS (
        SELECT 0, source, source_size, weight, NULL::DOUBLE FROM s
        UNION ALL
        (WITH r AS (SELECT *, ((SELECT sum(source_size) FROM s) * 1.5 - coalesce(sum(target) OVER (), 0))
                          / sum(CASE WHEN target IS NULL THEN weight ELSE 0 END) OVER () AS rate FROM fill)
         SELECT step + 1, source, source_size, weight,
                CASE WHEN target IS NOT NULL THEN target WHEN rate * weight > 2 * source_size THEN 2.0::DOUBLE * source_size END
         FROM r WHERE step < (SELECT count(*) FROM s))),
    t AS (SELECT source, source_size,
                 coalesce(target, ((SELECT sum(source_size) FROM s) * 1.5 - coalesce(sum(target) OVER (), 0)) / sum(CASE WHEN target IS NULL THEN weight ELSE 0 END) OVER () * weight) AS target
          FROM fill WHERE step = (SELECT count(*) FROM s)),
    q AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY place, content ROWS UNBOUNDED PRECEDING) AS through
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    e AS (SELECT doc_id, place, content, size, source, (through + source_size * p) / target AS finish FROM q, (VALUES (0), (1)) v(p) WHERE size > 0),
    u AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, place, content ROWS UNBOUNDED PRECEDING) AS used FROM e),
    c AS (SELECT doc_id, place, content, count(*) AS copies FROM u WHERE used <= (SELECT sum(target) FROM t) GROUP BY ALL)
    SELECT q.doc_id, q.size::BIGINT AS size, q.source_size, round(q.target, 3) AS target, (q.size * coalesce(copies, 0))::BIGINT AS taken
    FROM q LEFT JOIN c ON q.doc_id = c.doc_id AND q.content = c.content
    """,
)
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, folder, "documents"), thirds, budget=1.5, passes=2)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


@_query(
    "op7_substrings",
    rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
    s AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d)),
    f AS (SELECT h, min(doc_id) AS lo FROM s GROUP BY h),
    bad AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM s JOIN f USING (h) WHERE doc_id > lo),
    gone AS (SELECT doc_id, count(*) AS n_removed FROM bad GROUP BY doc_id),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN bad USING (doc_id, p) GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
)
def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = substrings.remove_repeats(_table(spark, folder, "documents"), length=50, texts=False)
    return cleaned.select("doc_id", "n_words", "n_removed", "kept_sha256")


def tokenizer_definition(name: str = "word_bpe_49k.json") -> str:
    """The JSON of a public tokenizer, read on the driver and sent along with the job."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def tokenizer_words(name: str = "word_bpe_49k.json") -> frozenset[str]:
    """Words of a public vocabulary, as dictionary."""
    return secrets.dictionary(json.loads(tokenizer_definition(name))["model"]["vocab"])


@_query("op8_secrets")
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    known = tokenizer_words()
    findings = cut_lineage(secrets.candidates(_table(spark, folder, "documents"), known))
    return secrets.scan(findings, secrets.fit(findings, known=known))


@_query("op9_token_files")
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_files.write(_table(spark, folder, "documents"), path, tokenizer_definition(), end_id=1)
    return token_files.with_starts(token_files.read(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


@_query(
    "op10_near_duplicates",
    rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS h FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, least(len(w), 1)))) AS i FROM d)),
    n AS (SELECT doc_id, count(h)::BIGINT AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (h) WHERE a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
    e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r(doc_id, here) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.here = e.x)
    SELECT doc_id, any_value(n) AS n_shingles, min(here) AS component_id, min(here) = doc_id AS kept FROM r JOIN n USING (doc_id) GROUP BY doc_id
    """,
)
def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.near_duplicates(_table(spark, folder, "documents"), words=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


@_query("op11_languages")
def op11_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    model = languages.fit(docs.where(~held_out))
    return languages.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


# crc32 of a decimal number, bit by bit: the polynomial 0xEDB88320 and the ends 0xFFFFFFFF are fixed values
_SQL_CRC = """xor(4294967295::UBIGINT, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT), lambda crc, byte:
        list_reduce(list_transform(range(8), lambda i: 0::UBIGINT), lambda x, zero: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END, xor(crc, byte)), 4294967295::UBIGINT))"""


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """`docs` in which every document whose id says so repeats a stretch of its words to the end (the contract of op12)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    planned = docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + g % 8))).cast("int")
    placed = planned.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    word = lambda i: F.when(i < F.col("a"), F.get("words", i)).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    again = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return placed.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), again).otherwise(F.col("text")).alias("text"))


@_query(
    "op12_periodic_runs",
    rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w0, {_SQL_CRC} AS h FROM documents),
    m AS (SELECT doc_id, w0, h, len(w0) AS n, CASE WHEN len(w0) > 0 THEN ((h // 10) % len(w0))::BIGINT END AS a, (h // 10) % 8 AS e FROM d),
    k AS (SELECT *, 1 + (n - a) // (3 + e)::BIGINT AS p FROM m),
    t AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w0[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w0 END AS w FROM k),
    s AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM t),
    e AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM s x JOIN s y ON x.doc_id = y.doc_id AND x.word = y.word WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    g AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
    o AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
    r AS (SELECT * FROM o x WHERE NOT EXISTS (SELECT 1 FROM o y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.start <= x.start AND y.start + y.length >= x.start + x.length)),
    b AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed FROM r GROUP BY doc_id),
    f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / q DESC, start, q) = 1),
    x AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM r),
    c AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM s ANTI JOIN x USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, q::BIGINT AS period, (1000 * length // q)::BIGINT AS exponent_milli,
           sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM t LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN c USING (doc_id)
    """,
)
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_periods(_table(spark, folder, "documents")))
    # the runs come by start and period, so the first of equals stays
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, x: F.when(x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha(listed).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


@_query(
    "op13_fill_middle",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS s FROM documents),
    h AS (SELECT doc_id, t, length(t) AS n, ('0x' || s[1:8])::UBIGINT AS h1, ('0x' || s[9:16])::UBIGINT AS h2, ('0x' || s[17:24])::UBIGINT AS h3, ('0x' || s[25:32])::UBIGINT AS h4 FROM d),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
    """,
)
def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    forms = fill_middle.restore(fill_middle.arrange(_table(spark, folder, "documents"), seed=1))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return forms.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output").alias("output_sha256"), sha("restored").alias("restored_sha256"))
