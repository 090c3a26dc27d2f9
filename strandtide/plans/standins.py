"""Sequences, metadata, trees and rules derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandtide.runtime import spread_when_few

LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "ACGTACGTACGTACGTACGTACGTAC"
# the same with unknown letters (x, z) and gaps (q)
GAPPED = "ACGTACGTACGTACGT-CGTACGNAN"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_bases(text: Column, alphabet: str = BASES) -> Column:
    return F.translate(F.regexp_replace(F.lower(text), "[^a-z]", ""), LETTERS, alphabet)


def sequences(spark: SparkSession, folder: str, alphabet: str = BASES) -> DataFrame:
    """(id, seq, ord) from all documents."""
    d = spread_when_few(table(spark, folder, "documents").select("doc_id", "text"))
    return d.select(F.col("doc_id").cast("string").alias("id"), as_bases(F.col("text"), alphabet).alias("seq"), F.col("doc_id").alias("ord"))


def references(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "benchmark")
    return b.select(F.concat(F.lit("R"), F.col("item_id").cast("string")).alias("id"), as_bases(F.col("text")).alias("seq"))


def sql_bases(text: str, alphabet: str = BASES) -> str:
    return f"translate(regexp_replace(lower({text}), '[^a-z]', '', 'g'), '{LETTERS}', '{alphabet}')"


SQL_SEQS = f"seqs AS (SELECT CAST(doc_id AS VARCHAR) AS id, {sql_bases('text')} AS seq, doc_id AS ord FROM documents)"
SQL_GAPPED = (
    f"seqs AS (SELECT CAST(doc_id AS VARCHAR) AS id, {sql_bases('text', GAPPED)} AS seq, doc_id AS ord FROM documents)"
)
SQL_REFS = f"refs AS (SELECT 'R' || CAST(item_id AS VARCHAR) AS id, {sql_bases('text')} AS seq FROM benchmark)"


def accession(k: Column, first: str = "AA") -> Column:
    """Accession-shaped and different for every number below 676 million: six digits after `first`, from each further
    million on after the next two letters."""
    n = F.floor(k / 1000000) + (ord(first[0]) - 65) * 26 + ord(first[1]) - 65
    letter = lambda c: F.chr(F.floor(c) % 26 + 65)
    return F.concat(letter(n / 26), letter(n), F.lpad((k % 1000000).cast("string"), 6, "0"))


def short_accession(k: Column, first: str) -> Column:
    """Five digits after the letter `first`; numbers that have more digits are as in `accession`, which begins with it."""
    return F.when(k < 100000, F.concat(F.lit(first), F.lpad(k.cast("string"), 5, "0"))).otherwise(accession(k, first + "A"))


def customer_names(spark: SparkSession, folder: str) -> DataFrame:
    """(id, name, nation, region, balance) of every customer."""
    c, n, r = (table(spark, folder, t) for t in ("customer", "nation", "region"))
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "n_name", "r_name")
    )


SQL_CUSTOMER_NAMES = (
    "names AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal, n_name, r_name FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)


def dirty_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as text in ten styles, some of which are no dates."""
    o = table(spark, folder, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 10
    styles = {
        0: F.date_format(d, "yyyy-MM-dd"),
        1: F.date_format(d, "yyyy"),
        2: F.date_format(d, "dd.MM.yyyy"),
        3: F.date_format(d, "MMM-yyyy"),
        4: F.date_format(d, "MM-yyyy"),
        5: F.lit("not known"),
        6: F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00Z")),
        7: F.concat(F.lit("31.02."), F.date_format(d, "yyyy")),
        8: F.concat(F.lit("XX-"), F.date_format(d, "MM-yyyy")),
        9: F.date_format(d, "dd-MMM-yyyy"),
    }
    text = F.lit(None).cast("string")
    for i, style in styles.items():
        text = F.when(k == i, style).otherwise(text)
    return o.select("o_orderkey", text.alias("raw_date"))


SQL_DIRTY_DATES = """dirty AS (SELECT o_orderkey, CASE o_orderkey % 10
  WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y')
  WHEN 2 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 3 THEN strftime(o_orderdate, '%b-%Y')
  WHEN 4 THEN strftime(o_orderdate, '%m-%Y') WHEN 5 THEN 'not known'
  WHEN 6 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') WHEN 7 THEN '31.02.' || strftime(o_orderdate, '%Y')
  WHEN 8 THEN 'XX-' || strftime(o_orderdate, '%m-%Y') ELSE strftime(o_orderdate, '%d-%b-%Y') END AS raw_date
  FROM orders)"""


def tree(spark: SparkSession, folder: str) -> DataFrame:
    """root - region - nation - customer - order as (node, parent, is_tip, branch_length, trait, date)."""
    r, n, c, o = (table(spark, folder, t) for t in ("region", "nation", "customer", "orders"))
    name = lambda letter, key: F.concat(F.lit(letter), F.col(key).cast("string"))
    none = F.lit(None).cast("string")
    cell = lambda node, parent, tip, length, trait: [
        node.alias("node"), parent.alias("parent"), F.lit(tip).alias("is_tip"), length.cast("double").alias("branch_length"), trait.alias("trait"),
    ]
    one = F.lit(1.0)
    # one root row, derived from the region table
    root = r.agg(F.min("r_regionkey").alias("k")).select(*cell(F.lit("root"), none, False, F.lit(0.0), none))
    return (
        root.unionByName(r.select(*cell(name("R", "r_regionkey"), F.lit("root"), False, one, none)))
        .unionByName(n.select(*cell(name("N", "n_nationkey"), name("R", "n_regionkey"), False, one, none)))
        .unionByName(c.select(*cell(name("C", "c_custkey"), name("N", "c_nationkey"), False, one, none)))
        .unionByName(
            o.select(*cell(name("O", "o_orderkey"), name("C", "o_custkey"), True, F.col("o_totalprice"), F.col("o_orderpriority")))
        )
    )


SQL_TREE = """tree AS (
  SELECT 'root' AS node, CAST(NULL AS VARCHAR) AS parent, false AS is_tip, 0.0::DOUBLE AS branch_length, CAST(NULL AS VARCHAR) AS trait
  UNION ALL SELECT 'R' || r_regionkey, 'root', false, 1.0, NULL FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, false, 1.0, NULL FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, false, 1.0, NULL FROM customer
  UNION ALL SELECT 'O' || o_orderkey, 'C' || o_custkey, true, o_totalprice, o_orderpriority FROM orders)"""
