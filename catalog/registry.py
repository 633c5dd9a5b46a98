"""Query registry: a Spark query and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.session import scratch_path, tune

from .fixtures import FIXTURES, spark_fixture, with_clause

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Derived tables of one data directory, as attributes: ``t.fx_sites``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in FIXTURES:
            return spark_fixture(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def path(self, name: str) -> str:
        return scratch_path(self.spark, name)


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(Tables(tune(spark), str(sf_dir).rstrip("/"))))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_clause(oracle, "duckdb")
        return fn

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals and NaN to NULL at the edge, for comparison."""
    return df.select(
        *[
            F.round(F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast("double")), 6).alias(f.name)
            if f.dataType.typeName() in ("double", "float")
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c.split('.')[-1]}" for c in columns)
