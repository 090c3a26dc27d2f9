"""Ledgers, upserts and snapshot comparison."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandtide.names import quoted
from strandtide.functions.text import ACCESSION, accession_in, looks_like_accession
from strandtide.operators.dedup import assign_sequential_ids, keep_last, rmdup_sequences
from strandtide.operators.grouping import change_class, max_numeric_suffix
from strandtide.operators.joins import replace_ids
from strandtide.operators.select import drop_sparse
from strandtide.runtime import cut_lineage, drop_stored, fresh_path, stored_folders

NO_ACCESSION = "NA"


def file_date() -> Column:
    """The day on which the file that holds a row was last changed; for tables read from files."""
    return F.to_date("_metadata.file_modification_time")


def first_seen_ledger(ledger: DataFrame, ids: DataFrame, date: str | None = None) -> DataFrame:
    """Append ids that are not in the ledger; `ids` carries `date_added` (such as `file_date()`), or `date` is used for all.

    A null is no id and is never appended.
    """
    ids = ids.dropna(subset=["accession"])
    dated = ids if date is None else ids.withColumn("date_added", F.lit(date).cast("date"))
    fresh = dated.groupBy("accession").agg(F.min("date_added").alias("date_added"))
    return ledger.unionByName(fresh.join(ledger.select("accession"), "accession", "left_anti"))


def upsert_latest(history: DataFrame, batch: DataFrame, key: str, min_non_null: int = 2, order: str | None = None) -> DataFrame:
    """Append the batch, keep the last row per key, drop rows with too few values.

    `order` is a column that says which of several rows of one key in the batch (or the history) is the last; rows
    equal in it, or all without it, are ordered by their values, so the result never depends on partitions.
    """
    ranked = history.withColumn("_rank", F.lit(0)).unionByName(batch.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    row = F.struct(*[f"`{c}`" for c in ranked.columns if c not in (key, "_rank")])
    place = [F.col("_rank"), *([F.col(f"`{order}`")] if order else []), row.alias("_row")]
    last = ranked.groupBy(F.col(f"`{key}`").alias(key)).agg(F.max_by(row, F.struct(*place)).alias("_row"))
    out = last.select(f"`{key}`", "_row.*")
    return drop_sparse(out.select(quoted(c for c in ranked.columns if c != "_rank")), min_non_null)


def upsert_table(target: str | None, batch: DataFrame, key: str, order: str | None = None) -> str:
    """Upsert a batch into a stored table; the result goes to a new path, which is returned and is the caller's."""
    spark = batch.sparkSession
    history = batch.limit(0) if target is None else spark.read.parquet(target)
    merged = upsert_latest(history, batch, key, 1, order)
    path = fresh_path(spark, "upsert")
    merged.write.parquet(path)
    return path


def upsert_buckets(path: str, batch: DataFrame, key: str, order: str | None = None, buckets: int = 64) -> list[int]:
    """Upsert a batch into the table below `path` in place; only buckets that the batch changes are written again.

    The table is partitioned by a hash of the key into `buckets` folders; the first call makes it, and later ones take its own
    number. Of the stored rows only the buckets that the batch has keys for are read. Returns the buckets that were
    written: none if the batch changes nothing. A call that fails half way is repeated as it is: each bucket is
    replaced as a whole, and the same batch gives the same rows.
    """
    spark = batch.sparkSession
    known = [int(p.rsplit("-", 1)[1]) for p in stored_folders(spark, path) if re.search(r"/buckets-\d+$", p)]
    count = known[0] if known else buckets
    table = f"{path}/buckets-{count}"
    placed = batch.withColumn("_bucket", F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(count)).cast("int"))
    # at most `count` numbers
    touched = sorted(r["_bucket"] for r in placed.select("_bucket").distinct().collect())
    if not touched:
        return []
    history = spark.read.parquet(table).where(F.col("_bucket").isin(touched)) if known else placed.limit(0)
    without = lambda df: df.select(quoted(c for c in df.columns if c != "_bucket"))
    merged = cut_lineage(upsert_latest(without(history), batch, key, 1, order))
    merged_in = merged.withColumn("_bucket", F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(count)).cast("int"))
    sums = lambda df: df.groupBy("_bucket").agg(*_digest(_row_hash(without(df))))
    # with other columns than before every bucket at hand has changed
    before = sums(history if set(history.columns) == set(merged_in.columns) else merged_in.limit(0))
    same = sums(merged_in).join(before, ["_bucket", "n", "hash_sum", "hash_xor"], "left_anti")
    changed = sorted(r["_bucket"] for r in same.select("_bucket").collect())
    if changed:
        writer = merged_in.where(F.col("_bucket").isin(changed)).repartition("_bucket").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(table)
    drop_stored(merged)
    return changed


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table that `upsert_buckets` keeps below `path`; a column that only some buckets have is null in the others."""
    table = spark.read.option("mergeSchema", "true").parquet(*[p for p in stored_folders(spark, path) if re.search(r"/buckets-\d+$", p)])
    return table.select(quoted(c for c in table.columns if c != "_bucket"))


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row's values by column name; a null counts by its column, too."""
    return F.xxhash64(*[x for c in sorted(df.columns) for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def _shape(df: DataFrame) -> str:
    """Names and types of the columns, in order of the names."""
    return "; ".join(f"{f.name}: {f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name))


def _digest(h: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor")]


def snapshot_digest(df: DataFrame) -> DataFrame:
    """Order-free digest of a table: its columns, row count, sum and xor of row hashes."""
    return df.agg(*_digest(_row_hash(df))).withColumn("columns", F.lit(_shape(df)))


def snapshot_unchanged(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row, one boolean: both tables hold the same rows in columns of the same names and types, in any order."""
    sides = snapshot_digest(old).unionByName(snapshot_digest(new))
    same = [F.equal_null(F.min(c), F.max(c)) for c in ("columns", "n", "hash_sum", "hash_xor")]
    return sides.agg((same[0] & same[1] & same[2] & same[3]).alias("unchanged"))


def _range(key: Sequence[str], levels: int) -> Column:
    """The leading bits of the key's hash."""
    if not 0 <= levels <= 20:
        raise ValueError("a digest tree has 0 to 20 levels")
    return F.shiftrightunsigned(F.xxhash64(*quoted(key)), 64 - levels) if levels else F.lit(0).cast("long")


def digest_tree(df: DataFrame, key: Sequence[str], levels: int = 12) -> DataFrame:
    """(level, range, columns, n, hash_sum, hash_xor): digests of the rows by ranges of the hash of their key.

    Level l has 2 ** l ranges, each half of one on the level before; level 0 is the whole table. Rows are read once: the
    finest level is grouped, combined before its shuffle, and the coarser ones are sums of it. Store the tree with a
    snapshot, and the next one is compared without reading the old rows again.
    """
    finest = df.groupBy(_range(key, levels).alias("range")).agg(*_digest(_row_hash(df)))
    spread = finest.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    up = spread.groupBy("level", F.expr(f"shiftright(range, {levels} - level)").alias("range"))
    return up.agg(F.sum("n").alias("n"), F.sum("hash_sum").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor")).withColumn("columns", F.lit(_shape(df)))


def differing_ranges(old: DataFrame, new: DataFrame) -> DataFrame:
    """(level, range) in which two trees of the same number of levels differ; other columns make all of them differ."""
    names = ["columns", "n", "hash_sum", "hash_xor"]
    both = old.select("level", "range", F.struct(*names).alias("o")).join(new.select("level", "range", F.struct(*names).alias("w")), ["level", "range"], "full")
    return both.where(~F.equal_null("o", "w")).select("level", "range")


def snapshot_changes(old: DataFrame, new: DataFrame, key: Sequence[str], levels: int = 12, old_tree: DataFrame | None = None) -> DataFrame:
    """(*key, change): keys whose rows were `added`, `removed` or `changed` between two snapshots.

    Only rows in ranges where the digest trees differ are shuffled; `old_tree` is the stored tree of `old`, if there is one. Keys
    may be null and may have several rows, which count as a whole. A renamed column or another type changes every row.
    """
    mine, theirs = digest_tree(new, key, levels), old_tree if old_tree is not None else digest_tree(old, key, levels)
    ranges = cut_lineage(differing_ranges(theirs, mine).where(F.col("level") == levels).select("range"))

    def inside(df: DataFrame, side: int) -> DataFrame:
        hashed = df.select(*quoted(key), _range(key, levels).alias("range"), F.lit(side).alias("_side"), _row_hash(df).alias("_h"))
        # at most 2 ** 20 ranges
        return hashed.join(F.broadcast(ranges), "range", "left_semi").drop("range")

    digest = F.struct("n", "hash_sum", "hash_xor")
    sides = inside(old, 0).unionByName(inside(new, 1)).groupBy(*quoted(key), "_side").agg(*_digest(F.col("_h")))
    both = sides.groupBy(*quoted(key)).agg(F.max(F.when(F.col("_side") == 0, digest)).alias("_old"), F.max(F.when(F.col("_side") == 1, digest)).alias("_new"))
    differs = F.lit(_shape(old) != _shape(new)) | (F.col("_old") != F.col("_new"))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(differs, "changed")
    return both.select(*quoted(key), change.alias("change")).where("change is not null")


def snapshot_report(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows added and removed together with the counts and their class: one row, one grouping of both sides."""
    names = [f"`{c}`" for c in old.columns]
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    per_row = both.groupBy(*names).agg(F.sum("_new").alias("_n"), F.sum(1 - F.col("_new")).alias("_o"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    surplus = F.col("_n") - F.col("_o")
    counts = per_row.agg(
        total("_n").alias("n_new"),
        total("_o").alias("n_old"),
        total("_n").alias("delta"),
        total(F.greatest(surplus, F.lit(0))).alias("n_added"),
        total(F.greatest(-surplus, F.lit(0))).alias("n_removed"),
    )
    return counts.withColumns({"delta": F.col("n_new") - F.col("n_old"), "change": change_class(F.col("n_new") - F.col("n_old"))})


def local_id_registry(
    registry: DataFrame, names: DataFrame, accessions: DataFrame | None, date: str
) -> DataFrame:
    """Registry (internal_accession, sample_name, gb_accession, date_added, seq_accession) after new names.

    Names not shaped like an accession and not yet known get the next local id; entries without a valid
    public accession read `NA` unless the supplied table (sample_name, accession) has one by now.
    """
    known = registry.select(F.col("sample_name").alias("name")).unionByName(registry.select(F.col("seq_accession").alias("name")))
    fresh = names.select(F.col("name")).distinct().filter(~looks_like_accession(F.col("name"))).join(known, "name", "left_anti")
    numbered = assign_sequential_ids(fresh, "name", max_numeric_suffix(registry, "internal_accession"))
    added = numbered.select(
        F.col("new_id").alias("internal_accession"),
        F.col("name").alias("sample_name"),
        F.lit(NO_ACCESSION).alias("gb_accession"),
        F.lit(date).alias("date_added"),
        F.col("new_id").alias("seq_accession"),
    )
    ranked = registry.withColumn("_r", F.lit(0)).unionByName(added.withColumn("_r", F.lit(1)))
    valid = F.coalesce(F.col("gb_accession").rlike(f"^{ACCESSION}$"), F.lit(False))
    out = ranked.withColumn("gb_accession", F.when(valid, F.col("gb_accession")).otherwise(F.lit(NO_ACCESSION)))
    if accessions is not None:
        found = accessions.groupBy("sample_name").agg(F.min("accession").alias("_acc"))
        late = (F.col("gb_accession") == NO_ACCESSION) & F.col("_acc").isNotNull()
        out = out.join(found, "sample_name", "left").withColumns(
            {
                "seq_accession": F.when(late, F.col("_acc")).otherwise(F.col("seq_accession")),
                "gb_accession": F.when(late, F.col("_acc")).otherwise(F.col("gb_accession")),
            }
        )
    number = F.regexp_extract("internal_accession", r"(\d+)", 1).try_cast("decimal(38,0)")
    out = out.dropna(subset=["sample_name"]).withColumn("_number", number)
    kept = keep_last(out, ["sample_name"], ["_r", "_number", "internal_accession"])
    return kept.select(quoted(registry.columns))


def update_sequences(
    seqs: DataFrame, registry: DataFrame, ledger: DataFrame, accessions: DataFrame | None, date: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New names get local ids, ledger entries and new headers: (sequences, registry, ledger)."""
    unique = rmdup_sequences(seqs)
    heads = unique.select(accession_in(F.col("id")).alias("name")).distinct()
    unseen = heads.join(ledger.select(F.col("accession").alias("name")), "name", "left_anti")
    registered = local_id_registry(registry, unseen, accessions, date)
    mapping = registered.select(F.col("sample_name").alias("key"), F.col("seq_accession").alias("value"), F.col("internal_accession").alias("ord"))
    renamed = replace_ids(unique, mapping, "id", "ord")
    known = registry.select(F.col("sample_name").alias("name")).unionByName(registry.select(F.col("seq_accession").alias("name")))
    entries = replace_ids(unseen.join(known, "name", "left_anti"), mapping, "name", "ord").select(F.col("name").alias("accession"))
    return renamed, registered, first_seen_ledger(ledger, entries, date)
