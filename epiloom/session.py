"""Session settings the library relies on, and where shared scratch tables go."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Joins whose inputs are already hash-partitioned on a subset of the join keys
# keep that partitioning instead of shuffling both sides again.
RUNTIME_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # A task's hash table is bounded by these and not by the table: with Spark's 128 MB of file and 64 MB of shuffled rows
    # a task it grows to a gigabyte and more.
    "spark.sql.files.maxPartitionBytes": str(16 << 20),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 << 20),
}

INITIAL_PARTITIONS = 256  # of a shuffle, before Spark merges those with few rows

# While a table is written: the shuffle files of its query go when it ends, as nothing reads them again.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

BROADCAST_MAX_BYTES = 64 << 20  # the driver holds a broadcast table several times over while it builds it

PARTITION_BYTES = 64 << 20  # of the side of a shuffled join that a task holds as a hash table


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the operators are planned for (results do not depend on them)."""
    for key, value in RUNTIME_OPTIONS.items():
        spark.conf.set(key, value)
    initial = max(INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial))
    return spark


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and small local runs."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("epiloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/epiloom/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, *partition_by: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as a shared Parquet table and read it back.

    Used where a result feeds several later passes, so that each pass (and each
    retry after a lost executor) starts from the written table. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        writer = df.write.mode("overwrite").options(**(options or {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Tables written inside leave no shuffle files."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    try:
        spark.conf.set(FREE_SHUFFLES, "true")
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def bytes_of(df: DataFrame) -> int:
    """About how much memory the rows take, from one aggregation: lengths of strings, eight bytes for any other value."""
    width = F.lit(16)
    for field in df.schema.fields:
        text = field.dataType.typeName() in ("string", "binary")
        width = width + 8 + (F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) if text else F.lit(0))
    return df.select(F.sum(width.cast("long"))).first()[0] or 0


def partitions_for(spark: SparkSession, size: int) -> int:
    """As many partitions as a shuffle has, or more so that none holds over ``PARTITION_BYTES`` of ``size`` on average."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Hint a broadcast only after measuring at most ``max_bytes``; else a merge join.

    The hint is needed: Spark's own estimate knows neither of exploded rows nor of compression and may broadcast a large table.

    ``df`` should read a written table or a given list, as it is read once more for the measure.
    """
    if bytes_of(df) <= max_bytes:
        return F.broadcast(df), True
    return df.hint("merge"), False
