"""Global ranks and quantiles without a single-task window.

Rows are range-partitioned by the order, sorted within their range and written with their place in it. The ranges' sizes
(one number a range) give every range its offset, so rank = offset + place. Nothing but those sizes reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

_PLACES = 33  # bits of monotonically_increasing_id below the partition number


def with_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Add the 0-based rank (bigint) of every row in ``order``; rows that ``order`` ties get ranks in any order.

    The result reads a written table, so every use of it sees the same ranks.
    """
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()), "ranks"
    )
    part = F.shiftright(name, _PLACES)
    sizes = placed.groupBy(part.alias("part")).count().collect()  # one row a range
    if not sizes:
        return placed
    before, total = [0] * (max(row["part"] for row in sizes) + 1), 0
    for row in sorted(sizes):
        before[row["part"]] = total
        total += row["count"]
    offsets = F.array(*[F.lit(v).cast("long") for v in before])
    return placed.withColumn(name, F.get(offsets, part.cast("int")) + F.col(name).bitwiseAND((1 << _PLACES) - 1))


def ranked_groups(df: DataFrame, value: Sequence[Column | str], *, by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Rank within each group of ``by``, and the group's size ``n``; a group may span many ranges."""
    ranked = with_rank(df, [*by, *value], name)
    sizes = ranked.groupBy(*by).agg(F.min(name).alias("first"), F.count(F.lit(1)).alias("n"))
    joined = ranked.join(sizes, list(by)) if by else ranked.withColumns({
        "first": F.lit(0), "n": sizes.select("n").scalar()})
    return joined.withColumn(name, F.col(name) - F.col("first")).drop("first")


def quantile(df: DataFrame, value: str, q: float, *, by: Sequence[str] = (), name: str = "quantile") -> DataFrame:
    """Exact linearly interpolated quantile of each group: only the one or two wanted ranks are read back.

    NULLs do not count; a group without a value has no row, nor has an empty table.
    """
    ranked = ranked_groups(df.where(F.col(value).isNotNull()).select(*by, value), [value], by=by)
    place = F.lit(q) * (F.col("n") - 1)
    low, high = F.floor(place), F.ceil(place)
    wanted = ranked.where((F.col("rank") == low) | (F.col("rank") == high)).withColumn("share", place - low)
    lower, upper, share = F.min(value), F.max(value), F.max("share")
    return wanted.groupBy(*by).agg((lower * (1 - share) + upper * share).alias(name), F.count(F.lit(1)).alias("found")).where(
        "found > 0"
    ).drop("found")
