"""Streaming curation and the streaming first-seen ledger, both run until the input is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandtide.plans.curation import CurationSettings, curate
from strandtide.runtime import drop_folder, fresh_path, stored_files, stored_folders


def ndjson_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def curate_stream(
    records: DataFrame, geo_rules: DataFrame, edits: DataFrame, out: str, checkpoint: str, settings: CurationSettings = CurationSettings()
) -> None:
    """The batch chain on every micro-batch, appended to a parquet table; rules are the static side."""

    def step(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch: a repeated batch replaces its own output
        curate(batch, geo_rules, edits, settings).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_available(records, step, checkpoint)


def first_seen_stream(
    ids: DataFrame, folder: str, checkpoint: str, key: str = "id", time: str = "ts", merge_every: int | None = None, fan: int = 8
) -> DataFrame:
    """Earliest time per id over a stream. Each micro-batch adds one small table of its own minima.

    The ledger is the minimum over these tables. As soon as `fan` tables of one tier are there they become one table of the next
    tier, so a row is written again about log(batches) / log(fan) times and never more than `fan` tables wait in a tier. With
    `merge_every` all tables become one after that many batches instead. A merged table is complete at its new path before
    the old ones go: a batch or a merge that is repeated after a failure loses nothing, as a minimum may be taken twice.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        add_to_ledger(batch, folder, batch_id, key, time, fan if merge_every is None else None)
        if merge_every is not None and (batch_id + 1) % merge_every == 0:
            _merge(batch.sparkSession, folder, batch_id, key)

    run_available(ids, step, checkpoint)
    return compact_ledger(ids.sparkSession, folder, key)


def add_to_ledger(batch: DataFrame, folder: str, batch_id: int, key: str = "id", time: str = "ts", fan: int | None = 8) -> None:
    """The minima of one batch as a table of the lowest tier, and the merges that are due."""
    part = batch.groupBy(key).agg(F.min(time).alias("first_seen"))
    part.write.mode("overwrite").parquet(f"{folder}/parts/{batch_id}")
    if fan is not None:
        _merge_tiers(batch.sparkSession, folder, key, fan)


def _tier(level: int) -> str:
    return f"tier{level}" if level else "parts"


def _merge_tiers(spark: SparkSession, folder: str, key: str, fan: int) -> None:
    """Merge the oldest `fan` tables of every tier that has so many, from the lowest tier on."""
    level = 0
    while True:
        tables = sorted(_tables(spark, folder, _tier(level)).items())
        if len(tables) < fan:
            return
        oldest = tables[:fan]
        # named after its last batch, so a repeated merge finds its own table
        target = f"{folder}/{_tier(level + 1)}/{oldest[-1][0]}"
        if f"{target}/_SUCCESS" not in stored_files(spark, target):
            _least(spark, [path for _, path in oldest], key).write.mode("overwrite").parquet(target)
        for _, path in oldest:
            drop_folder(spark, path)
        level += 1


def _least(spark: SparkSession, paths: list[str], key: str) -> DataFrame:
    return spark.read.parquet(*paths).groupBy(key).agg(F.min("first_seen").alias("first_seen"))


def _tables(spark: SparkSession, folder: str, kind: str) -> dict[int, str]:
    return {int(path.rsplit("/", 1)[1]): path for path in stored_folders(spark, f"{folder}/{kind}")}


def _merge(spark: SparkSession, folder: str, batch_id: int, key: str) -> None:
    """All tables up to a batch as one. The minimum may be taken twice, so parts that outlive a failure do no harm."""
    done = [p for i, p in _tables(spark, folder, "merged").items() if i == batch_id and f"{p}/_SUCCESS" in stored_files(spark, p)]
    if not done:
        compact_ledger(spark, folder, key, before=batch_id).write.mode("overwrite").parquet(f"{folder}/merged/{batch_id}")
    for i, path in _tables(spark, folder, "parts").items():
        if i <= batch_id:
            drop_folder(spark, path)
    for i, path in _tables(spark, folder, "merged").items():
        if i < batch_id:
            drop_folder(spark, path)


def compact_ledger(spark: SparkSession, folder: str, key: str = "id", before: int | None = None) -> DataFrame:
    """The ledger over all tables; merged ones of batch `before` and later are left out."""
    merged = [p for i, p in _tables(spark, folder, "merged").items() if before is None or i < before]
    tiers = [path.rsplit("/", 1)[1] for path in stored_folders(spark, folder)]
    stored = [p for tier in tiers if tier == "parts" or tier.startswith("tier") for p in _tables(spark, folder, tier).values()]
    return _least(spark, [*stored, *merged], key)


def run_available(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str | None = None) -> None:
    location = checkpoint or fresh_path(stream.sparkSession, "stream")
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", location).trigger(availableNow=True).start()
    query.awaitTermination()
