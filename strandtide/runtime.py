"""Session settings, checkpoint folder and size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its measured size is below this bound.
BROADCAST_BYTES = 64 * 1024 * 1024


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strandtide") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strandtide-ckpt-"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local masters."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="strandtide-ckpt-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never one that is already in use."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Folders that the innermost open `tables_for_a_while` will delete, one list for each.
_ENDING: list[list[str]] = []


@contextmanager
def tables_for_a_while(spark: SparkSession):
    """Tables that `cut_lineage` stores inside are deleted at the end: write what depends on them before that."""
    _ENDING.append([])
    try:
        yield
    finally:
        for path in _ENDING.pop():
            drop_folder(spark, path)


def cut_lineage(df: DataFrame, replaces: DataFrame | None = None, codec: str | None = None) -> DataFrame:
    """Write `df` as a table below the shared folder and read it back.

    Iterative plans stay short and survive lost executors, and the planner knows the size of the
    result, which it would not know of a checkpointed RDD. `replaces` is a result of this function that nothing
    needs once `df` is written, such as the round before; its folder is deleted then. The last table of a loop belongs to
    the caller's result and stays below the shared folder. `codec` is Parquet's compression, by default the session's.
    """
    path = fresh_path(df.sparkSession, "cut")
    if _ENDING:
        _ENDING[-1].append(path)
    df.write.parquet(path, compression=codec)
    if replaces is not None:
        drop_stored(replaces)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Delete the folder behind a result of `cut_lineage`; other tables are left alone."""
    path = getattr(df, "_stored_at", None)
    if path is not None:
        drop_folder(df.sparkSession, path)
        del df._stored_at


def _listed(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(system.listStatus(folder)) if system.exists(folder) else []


def stored_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders right below `path`; none if it does not exist."""
    return [f"{path}/{s.getPath().getName()}" for s in _listed(spark, path) if s.isDirectory()]


def stored_files(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/{s.getPath().getName()}" for s in _listed(spark, path) if s.isFile()]


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_when_small(df: DataFrame, size_expr=None, bound: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast `df` only if its measured size is within `bound`; otherwise a shuffled join.

    `size_expr` is an aggregate such as the number of letters; the default is the bytes of all rows as JSON text.
    The check is one small aggregate whose result is a single number.
    """
    text = F.to_json(F.struct(*[f"`{c}`" for c in df.columns]))
    size = df.agg((F.sum(F.octet_length(text)) if size_expr is None else size_expr).alias("n")).first()["n"] or 0
    return F.broadcast(df) if size <= bound else df.hint("merge")


def spread_when_few(df: DataFrame) -> DataFrame:
    """Spread rows over all cores when the scan has fewer splits than cores; otherwise leave them in place.

    A small file with one row group would keep heavy per-row work on one core. A large input has
    more splits than cores and is never shuffled here. For plain scans: planning only, no job.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if splits < cores else df
