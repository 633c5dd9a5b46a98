"""The settings of ``tune`` bound what one task reads and groups, whatever the cores and the shuffle partitions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import functions as F

from epiloom.session import tune


@contextmanager
def conf(spark, **options: str) -> Iterator[None]:
    names = {k.replace("__", "."): v for k, v in options.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_task_reads_and_groups_a_bounded_part(spark, tmp_path):
    """F13 to F20: one core and two shuffle partitions, as on a cluster with far more input than tasks."""
    tune(spark)
    path = str(tmp_path / "rows")
    spark.range(6_000_000).select(F.xxhash64("id").alias("key"), F.lit(1).alias("v")).coalesce(1).write.option(
        "parquet.block.size", str(4 << 20)).parquet(path)
    few = {"spark__sql__files__minPartitionNum": "1", "spark__sql__shuffle__partitions": "2",
           "spark__sql__adaptive__coalescePartitions__minPartitionNum": "1"}
    with conf(spark, **few):
        rows = spark.read.parquet(path)
        assert rows.rdd.getNumPartitions() >= 3  # 48 MB of incompressible keys
        sums = rows.groupBy("key").agg(F.sum("v").alias("v"))
        assert sums.rdd.getNumPartitions() >= 3
        assert sums.agg(F.sum("v"), F.count("*")).first() == (6_000_000, 6_000_000)
