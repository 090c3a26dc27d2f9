"""Equi joins and set operations. No side is broadcast here by hand: the planner does so from measured sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandtide.names import quoted
from strandtide.functions.text import blank_to_null, title_letters
from strandtide.operators.dedup import keep_first


COPIES_AT_ONCE = 10_000


def merge_sides(base: DataFrame, extra: DataFrame, key: str, base_order: str, extra_order: str) -> DataFrame:
    """Full outer join of two tables after keep-first per key; sides are structs `base` and `extra`.

    Rows without a key are dropped. Precedence rules then read `base.x` and `extra.x`.
    """
    left = keep_first(base.dropna(subset=[key]), [key], [base_order])
    right = keep_first(extra.dropna(subset=[key]), [key], [extra_order])
    left = left.select(key, F.struct(*[f"`{c}`" for c in left.columns if c != key]).alias("base"))
    right = right.select(key, F.struct(*[f"`{c}`" for c in right.columns if c != key]).alias("extra"))
    return left.join(right, key, "full")


def merge_many(tables: Sequence[DataFrame], key: str, order: str | None = None) -> DataFrame:
    """Outer merge of any number of tables; per column the last table with a non-empty value wins.

    Where a key is repeated inside one table, `order` (a column of every table that repeats keys) says which row is
    the last; values that are equal in it, or all without it, are ordered as text, so no result depends on
    partitions. One union and one grouping instead of a chain of full joins: a single shuffle, combined map-side.
    """
    columns = list(dict.fromkeys(c for t in tables for c in t.columns if c not in (key, order)))
    ranked = [
        t.select(
            F.col(f"`{key}`").alias(key),
            F.lit(rank).alias("_rank"),
            (F.col(f"`{order}`").cast("decimal(38,6)") if order in t.columns else F.lit(None).cast("decimal(38,6)")).alias("_order"),
            *[(F.col(f"`{c}`").cast("string") if c in t.columns else F.lit(None).cast("string")).alias(c) for c in columns],
        )
        for rank, t in enumerate(tables)
    ]
    union = reduce(DataFrame.unionByName, ranked)
    filled = lambda c: blank_to_null(F.col(f"`{c}`")).isNotNull()
    place = lambda c: F.struct("_rank", "_order", f"`{c}`")
    return union.groupBy(F.col(f"`{key}`").alias(key)).agg(
        *[F.max_by(F.when(filled(c), F.col(f"`{c}`")), F.when(filled(c), place(c))).alias(c) for c in columns]
    )


def left_enrich(df: DataFrame, dim: DataFrame, key: str, order: str) -> DataFrame:
    """Left join of a dimension made unique per key first, so that the row count stays."""
    return df.join(keep_first(dim, [key], [order]).drop(order), key, "left")


def join_qc(
    metadata: DataFrame, qc: DataFrame, key: str, qc_id: str, column_map: Mapping[str, str] | None = None, tail: int = 0
) -> DataFrame:
    """Left join of quality columns under new names; ids lose text after ` |`; the last columns stay last.

    Without a map all quality columns are joined under their own names; one that the metadata has, too, keeps the
    metadata's values.
    """
    if column_map is None:
        column_map = {c: c for c in qc.columns if c != qc_id and c not in metadata.columns}
    mapped = qc.select(
        F.regexp_replace(F.col(qc_id), r" \|.*", "").alias(key),
        *[F.col(f"`{c}`").alias(n) for c, n in column_map.items()],
    )
    names = metadata.columns
    head, end = (names[:-tail], names[-tail:]) if tail else (names, [])
    joined = metadata.join(mapped, key, "left")
    return joined.select(*[f"`{c}`" for c in [*head, *column_map.values(), *end]])


def attach_sequences(
    meta: DataFrame, seqs: DataFrame, key: str, order: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every metadata row with the first sequence of its id, ids found on one side only, repeated ids.

    Sequences are made unique first, so an id that is repeated on both sides is not multiplied out.
    """
    matched = meta.join(keep_first(seqs, [key], [order]).drop(order), key)
    only = lambda a, b, side: a.select(key).join(b.select(key), key, "left_anti").select(key, F.lit(side).alias("side"))
    unmatched = only(meta, seqs, "metadata").unionByName(only(seqs, meta, "sequences"))
    repeated = lambda t, side: duplicate_report(t, key).select(key, "n", F.lit(side).alias("side"))
    return matched, unmatched, repeated(meta, "metadata").unionByName(repeated(seqs, "sequences"))


def duplicate_report(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def semi_filter(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def anti_filter(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def lookup_override(df: DataFrame, table: DataFrame, probe: str, target: str, order: str) -> DataFrame:
    """Replace `target` by the table's value for `probe`, else keep it. The last entry per key wins."""
    entries = keep_first(table.select(F.col("key").alias(probe), F.col("value").alias("_hit"), order), [probe], [F.desc(order)])
    joined = df.join(entries.drop(order), probe, "left")
    return joined.withColumn(target, F.coalesce("_hit", F.col(target))).select(quoted(df.columns))


def replace_ids(df: DataFrame, mapping: DataFrame, key: str, order: str) -> DataFrame:
    return lookup_override(df.withColumn("_probe", F.col(key)), mapping, "_probe", key, order).drop("_probe")


def apply_annotations(df: DataFrame, edits: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Point edits (id, field, value, ord): the last edit of a field wins; other fields keep their value."""
    wanted = edits.filter(F.col("field").isin(list(fields)))
    per_id = wanted.groupBy(F.col("id").alias(key)).agg(
        *[
            F.max_by(F.when(F.col("field") == f, F.struct("value")), F.when(F.col("field") == f, F.col("ord"))).alias(f"_e_{f}")
            for f in fields
        ]
    )
    joined = df.join(per_id, key, "left")
    out = {f: F.when(F.col(f"_e_{f}").isNotNull(), F.col(f"_e_{f}")["value"]).otherwise(F.col(f)) for f in fields}
    return joined.withColumns(out).select(quoted(df.columns))


def wildcard_rules(df: DataFrame, rules: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Most specific rule whose path matches, `*` matching anything; `*` in the output keeps the input.

    Every distinct path is written once per subset of wildcard levels, so the match is an equi join
    on the masked path: no rule is compared with every row. Among equally specific rules the later wins.
    """
    n = len(levels)
    sep = "\x1f"
    path = lambda cols: F.concat_ws(sep, *cols)
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    paths = df.select(*[blank(c).alias(c) for c in levels]).distinct()
    masked = F.array(
        *[
            path([F.lit("*") if (mask >> i) & 1 else F.col(c) for i, c in enumerate(levels)])
            for mask in range(2**n)
        ]
    )
    parsed = rules.select(
        path([F.trim(F.get(F.split("raw", "/"), F.lit(i))) for i in range(n)]).alias("_probe"),
        F.transform(F.split("corrected", "/"), lambda p: F.trim(p)).alias("_to"),
        "ord",
    )
    # later rules replace earlier ones with the same left side
    parsed = parsed.groupBy("_probe").agg(F.max("ord").alias("ord"), F.max_by("_to", "ord").alias("_to"))
    stars = F.length("_probe") - F.length(F.translate("_probe", "*", ""))
    hits = (
        paths.withColumn("_probe", F.explode(F.array_distinct(masked)))
        .join(parsed.withColumn("_stars", stars), "_probe")
        .groupBy(*levels)
        .agg(F.min_by("_to", F.struct("_stars", -F.col("ord"))).alias("_to"))
    )
    keyed = df.withColumns({f"_k_{c}": blank(c) for c in levels})
    joined = keyed.join(hits.withColumnsRenamed({c: f"_k_{c}" for c in levels}), [f"_k_{c}" for c in levels], "left")
    target = lambda i: F.get(F.col("_to"), F.lit(i))
    out = {
        c: F.when(F.col("_to").isNull() | (target(i) == "*"), F.col(c)).otherwise(F.nullif(target(i), F.lit("")))
        for i, c in enumerate(levels)
    }
    return joined.withColumns(out).select(quoted(df.columns))


def country_region(df: DataFrame, country: str, dim: DataFrame, target: str = "region") -> DataFrame:
    """Region by country; spaces are tried as `_` as well; unknown gives `Na`, null gives empty text."""
    known = dim.groupBy(F.lower(F.trim("country")).alias("_c")).agg(F.max_by(F.trim("region"), "ord").alias("_r"))
    probe = F.lower(F.trim(F.col(country)))
    wide = df.withColumns({"_p1": probe, "_p2": F.replace(probe, F.lit(" "), F.lit("_"))})
    for i in (1, 2):
        wide = wide.join(known.select(F.col("_c").alias(f"_p{i}"), F.col("_r").alias(f"_r{i}")), f"_p{i}", "left")
    region = title_letters(F.replace(F.coalesce("_r1", "_r2", F.lit("NA")), F.lit("_"), F.lit(" ")))
    keep = [c for c in df.columns if c != target]
    return wide.select(*quoted(keep), F.when(F.col(country).isNull(), F.lit("")).otherwise(region).alias(target))


def dimension_attach(
    df: DataFrame, colors: DataFrame, latlongs: DataFrame, field: str, level: str
) -> DataFrame:
    """Colour by (field, value) and coordinates by (level, name), both ignoring case; no hit stays null."""
    tint = colors.filter(F.col("field") == field).groupBy(F.lower("value").alias("_v")).agg(F.min("hex").alias(f"{field}_color"))
    place = (
        latlongs.filter(F.col("level") == level)
        .groupBy(F.lower("name").alias("_v"))
        .agg(F.min(F.struct("lat", "lon")).alias("_at"))
        .select("_v", F.col("_at.lat").alias("lat"), F.col("_at.lon").alias("lon"))
    )
    keyed = df.withColumn("_v", F.lower(F.col(field)))
    return keyed.join(tint, "_v", "left").join(place, "_v", "left").drop("_v")


def find_new(new: DataFrame, known: Sequence[DataFrame | None], key: str) -> DataFrame:
    """Rows whose key is in none of the known tables; a missing table is skipped."""
    tables = [k.select(key) for k in known if k is not None]
    if not tables:
        return new
    return new.join(reduce(DataFrame.unionByName, tables), key, "left_anti")


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def row_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows present on one side only, repeated rows counted, with the side.

    One grouping over the union of both sides, combined before the shuffle.
    """
    both = old.withColumn("_d", F.lit(-1)).unionByName(new.withColumn("_d", F.lit(1)))
    surplus = both.groupBy(*[f"`{c}`" for c in old.columns]).agg(F.sum("_d").alias("_d")).filter("_d <> 0")
    # copies come in blocks: no array is longer than one, however often a row is repeated
    blocks = surplus.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.abs("_d") - 1) / COPIES_AT_ONCE))))
    inside = F.least(F.lit(COPIES_AT_ONCE), F.abs("_d") - F.col("_block") * COPIES_AT_ONCE).cast("int")
    side = F.when(F.col("_d") > 0, F.lit("added")).otherwise(F.lit("removed"))
    return blocks.select(*quoted(old.columns), F.explode(F.array_repeat(side, inside)).alias("side"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()

