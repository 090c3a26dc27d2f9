"""Delimited tables, NDJSON, id lists, rule tables and node data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandtide.functions.binding import bind
from strandtide.operators.select import select_columns
from strandtide.sources.sequences import file_order

_NEVER = "\u0000"


def separator_of(path: str) -> str:
    return "\t" if path.endswith("tsv") else ","


def read_table(
    spark: SparkSession,
    path: str | list[str],
    sep: str | None = None,
    columns: Sequence[str] | None = None,
    null_tokens: Sequence[str] = ("", "NA"),
    header: bool = True,
) -> DataFrame:
    """All-text table plus `ord`. `columns` names a headerless file; empty `null_tokens` keep empty text."""
    first = path if isinstance(path, str) else path[0]
    reader = (
        spark.read.option("sep", sep or separator_of(first))
        .option("escape", '"')
        .option("nullValue", _NEVER)
        .option("emptyValue", "")
    )
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).option("header", "false")
    else:
        reader = reader.option("header", str(header).lower())
    df = reader.csv(path)
    names = df.columns
    tokens = list(null_tokens)
    clean = lambda c: F.when(~c.isin(tokens), c) if tokens else F.coalesce(c, F.lit(""))
    return df.select(*[clean(F.col(f"`{c}`")).alias(c) for c in names], file_order().alias("ord"))


def read_ndjson(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def parse_json(col: Column, schema: str) -> Column:
    return F.from_json(col, schema)


def read_id_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Ids, one per line; `#` starts a comment, blank lines and outer white space go."""
    text = F.trim(F.regexp_replace(F.regexp_replace("value", "#.*$", ""), r"\s+$|^\s+", ""))
    return spark.read.text(path).select(text.alias("id")).filter("id <> ''").distinct()


def node_rows(df: DataFrame, col: str) -> DataFrame:
    """`{"nodes": {name: {key: value}}}` to rows (node, key, value)."""
    nodes = F.from_json(F.col(col), "nodes map<string,map<string,string>>")["nodes"]
    return df.select(F.explode(nodes).alias("node", "_v")).select("node", F.explode("_v").alias("key", "value"))


def read_node_data(spark: SparkSession, path: str) -> DataFrame:
    """Node data of one JSON document per file: a document is one row, so this is for small trees (else `read_node_documents`)."""
    return node_rows(spark.read.text(path, wholetext=True), "value")


#: Entries that are looked through in one go for the object they belong to.
ENTRIES_PER_SLICE = 1 << 16


def read_node_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Node data of JSON documents of any size as (node, key, value); one document is read by as many tasks as it has splits.

    Files are cut at closing braces. Whether a piece begins inside a string follows from the quotes before it, and its depth
    from the brackets before it, both as running sums: first over the splits of a file, one row for each, then over the pieces
    of a split. A piece that ends an entry of a top-level object closes it; the entries of `nodes` are put together
    and parsed one by one. Files are plain text; several documents may follow each other in one.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select("value", file_order().alias("ord"))
    # escaped signs neither open nor close anything, and an escape never goes on behind a brace
    text = F.regexp_replace("value", r"\\.", "")
    count = lambda t, signs: F.length(t) - F.length(F.translate(t, signs, ""))
    outside = lambda t: F.regexp_replace(t, '"[^"]*("|$)', "")
    read = pieces.select("ord.file", "ord.block", "ord.row", "value", text.alias("t")).withColumn("flips", count(F.col("t"), '"') % 2)
    # depth gained by a piece and the brace behind it, if it begins outside (0) or inside (1) a string
    for state in (0, 1):
        bare = outside(F.col("t") if state == 0 else F.concat(F.lit('"'), "t"))
        closes = F.when((F.col("flips") + state) % 2 == 0, 1).otherwise(0)
        # how far the depth falls below its start inside the piece
        signs = F.split(F.regexp_replace(bare, r"[^\[\]{]", ""), "")
        lowest = F.aggregate(
            signs,
            F.struct(F.lit(0).alias("now"), F.lit(0).alias("low")),
            lambda a, c: bind(a["now"] + F.when(c == "]", -1).when(c != "", 1).otherwise(0), lambda n: F.struct(n.alias("now"), F.least(a["low"], n).alias("low"))),
            lambda a: a["low"],
        )
        read = read.withColumn(f"gain{state}", count(bare, "{[") - count(bare, "]") - closes).withColumn(f"low{state}", lowest)
    read = read.drop("t")
    by_split = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    inner = read.withColumn("odd", before("flips", by_split) % 2)
    # the same pieces seen from a split that begins outside or inside a string
    for state in (0, 1):
        own = F.when((F.col("odd") + state) % 2 == 0, F.col("gain0")).otherwise(F.col("gain1"))
        inner = inner.withColumn(f"own{state}", own).withColumn(f"up{state}", before(f"own{state}", by_split))
    splits = inner.groupBy("file", "block").agg((F.sum("flips") % 2).alias("f"), F.sum("own0").alias("g0"), F.sum("own1").alias("g1"))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.withColumn("state", before("f", along) % 2)
    begun = begun.withColumn("g", F.when(F.col("state") == 0, F.col("g0")).otherwise(F.col("g1"))).withColumn("base", before("g", along)).select("file", "block", "state", "base")
    placed = inner.join(begun, ["file", "block"]).select(
        "file", "block", "row", "value",
        (F.col("base") + F.when(F.col("state") == 0, F.col("up0")).otherwise(F.col("up1"))).alias("depth"),
        F.when(F.col("state") == 0, F.col("own0")).otherwise(F.col("own1")).alias("gain"),
        F.when((F.col("odd") + F.col("state")) % 2 == 0, F.col("low0")).otherwise(F.col("low1")).alias("low"),
        ((F.col("odd") + F.col("state") + F.col("flips")) % 2 == 0).alias("closed"),
    )
    ends = F.when(F.col("closed") & (F.col("depth") + F.col("gain") <= 2), 1).otherwise(0)
    marked = placed.withColumn("ends", ends).withColumn("nth", before("ends", by_split))
    totals = marked.groupBy("file", "block").agg(F.sum("ends").alias("n")).withColumn("first", before("n", along)).drop("n")
    numbered = marked.join(totals, ["file", "block"]).withColumn("entry", F.col("first") + F.col("nth"))
    # the pieces of one entry, at most as many as it has braces
    parts = F.array_sort(F.collect_list(F.struct("block", "row", "value", "depth")))
    grouped = numbered.groupBy("file", "entry").agg(parts.alias("p"), F.min(F.col("depth") + F.col("low")).alias("low"))
    entries = grouped.select("file", "entry", "low", F.get("p", F.lit(0))["depth"].alias("depth"), F.concat_ws("}", F.transform("p", lambda x: x["value"])).alias("text"))
    # an entry that reaches above depth 2 may open a top-level object; what follows belongs to the object opened last
    opening = r'(?s)^(?:[^"]|"(?:[^"\\]|\\.)*"(?!\s*:\s*\{))*?"((?:[^"\\]|\\.)*)"\s*:\s*\{'
    head = F.regexp_replace(F.regexp_replace(F.regexp_extract("text", opening, 0), r"\\.", ""), '"[^"]*"', "")
    at_top = F.col("depth") + count(head, "{[") - count(head, "]}") == 2
    named = entries.withColumn("object", F.when(F.col("low") < 2, F.when(at_top, F.regexp_extract("text", opening, 1)).otherwise("")))
    # the object opened last: inside a slice of the entries, else in the slices before it
    sliced = named.withColumn("slice", F.floor(F.col("entry") / ENTRIES_PER_SLICE))
    of_slice = sliced.groupBy("file", "slice").agg(F.max_by("object", F.when(F.col("object").isNotNull(), F.col("entry"))).alias("o"))
    along = Window.partitionBy("file").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = of_slice.select("file", "slice", F.last("o", ignorenulls=True).over(along).alias("carried"))
    inside = Window.partitionBy("file", "slice").orderBy("entry").rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce("own", "carried")
    of_nodes = sliced.withColumn("own", F.last("object", ignorenulls=True).over(inside)).join(carried, ["file", "slice"]).where(last == "nodes")
    body = F.when(F.col("low") < 2, F.regexp_replace("text", opening, "")).otherwise(F.regexp_replace("text", r"^[\s,]+", ""))
    # the piece behind the last entry closes the object and holds nothing
    whole = of_nodes.select(F.concat(F.lit('{"nodes": {'), body, F.when(F.trim(body) != "", "}").otherwise(""), F.lit("}}")).alias("doc"))
    return node_rows(whole, "doc")


def read_node_lines(spark: SparkSession, path: str) -> DataFrame:
    """Node data of one `{"name": .., "values": {key: value}}` per line as (node, key, value); files are split freely."""
    line = F.from_json("value", "name string, values map<string,string>").alias("n")
    return spark.read.text(path).select(line).select(F.col("n.name").alias("node"), F.explode("n.values").alias("key", "value"))


def write_node_lines(nodes: DataFrame, path: str) -> None:
    """Rows (node, key, value) as the lines that `read_node_lines` reads; one value per node and key."""
    values = F.map_from_entries(F.collect_list(F.struct("key", "value")))
    grouped = nodes.groupBy("node").agg(values.alias("values"))
    grouped.select(F.to_json(F.struct(F.col("node").alias("name"), "values")).alias("value")).write.text(path)


def read_rule_table(spark: SparkSession, path: str) -> DataFrame:
    """Clade rules (clade, gene, site, alt, ord) without blank lines and carriage returns."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"\r$", "").alias("line"), file_order().alias("ord"))
    cells = F.split("line", "\t")
    at = lambda i, n: F.nullif(F.trim(F.get(cells, F.lit(i))), F.lit("")).alias(n)
    rows = lines.select(at(0, "clade"), at(1, "gene"), at(2, "site"), at(3, "alt"), "ord")
    return rows.filter("clade IS NOT NULL AND NOT (clade = 'clade' AND gene = 'gene')")


def read_geo_rules(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Place rules (raw, corrected, ord); comment lines and trailing comments go."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "#.*$|\r$", "").alias("line"), file_order().alias("ord"))
    cells = F.split("line", "\t")
    at = lambda i: F.trim(F.get(cells, F.lit(i)))
    return lines.select(at(0).alias("raw"), at(1).alias("corrected"), "ord").filter("raw <> '' AND corrected IS NOT NULL")


def mapping_table(spark: SparkSession, mapping: Mapping[str, str], lower_keys: bool = False) -> DataFrame:
    """A configuration dictionary as (key, value, ord)."""
    rows = [(k.lower() if lower_keys else k, v, i) for i, (k, v) in enumerate(mapping.items())]
    return spark.createDataFrame(rows, "key string, value string, ord int")


def union_files(tables: Sequence[DataFrame]) -> DataFrame:
    """Concatenate tables in order; `source_ord` keeps which one a row came from."""
    out = None
    for i, t in enumerate(tables):
        part = t.withColumn("source_ord", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def write_tsv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Fixed column order with a header; absent columns are empty, extra ones are dropped."""
    select_columns(df, columns).write.option("sep", "\t").option("header", "true").option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)
