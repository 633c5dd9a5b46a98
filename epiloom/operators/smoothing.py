"""Pseudobulk methylation and its tricube smoothing.

Every later join works on the position table made here. It has one row per
observed genome position, however many cells cover it, so its size is bounded
by the genome and not by the number of sites.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pseudobulk(encoded: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Per position: cells observed, cells methylated, methylated fraction."""
    return (
        encoded.groupBy(*by, "chrom", "pos")
        .agg(
            F.count(F.lit(1)).alias("n_obs"),
            F.sum((F.col("m") > 0).cast("long")).alias("n_meth"),
        )
        .withColumn("frac", F.col("n_meth") / F.col("n_obs"))
    )


def chrom_extents(positions: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """First and last observed position and observation count per chromosome.

    One row per contig of the reference genome, which bounds its broadcast.
    """
    return positions.groupBy(*by, "chrom").agg(
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
        F.sum("n_obs").alias("n_encoded"),
    )


def band_join(positions: DataFrame, reach: int, *, by: Sequence[str] = ()) -> DataFrame:
    """Pairs of positions on one chromosome less than ``reach`` apart, as (pos, npos).

    Positions hash to bins of width ``reach``; the neighbour side is copied into
    the (at most three) bins its band touches. A bin holds at most ``reach``
    positions, so no key grows with the data and no chromosome lands in one task.
    """
    keys = [*by, "chrom", "bin"]
    bin_of = lambda c: F.floor(c / reach)
    core = positions.withColumn("bin", bin_of(F.col("pos")))
    halo = positions.select(
        *by,
        "chrom",
        F.explode(
            F.sequence(bin_of(F.col("pos") - (reach - 1)), bin_of(F.col("pos") + (reach - 1)))
        ).alias("bin"),
        F.col("pos").alias("npos"),
        F.col("frac").alias("nfrac"),
        F.col("n_obs").alias("nobs_n"),
    )
    return core.join(halo, keys).where(F.abs(F.col("pos") - F.col("npos")) < reach)


def smooth(
    positions: DataFrame,
    bandwidth: int = 1000,
    use_weights: bool = False,
    *,
    strict_compat: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Tricube-smoothed fraction per position: ``(chrom, pos, n_obs, n_meth, smoothed)``.

    ``positions`` is the output of :func:`pseudobulk`. Neighbours closer than
    ``bandwidth // 2`` count with weight ``(1 - |d/h|^3)^3`` (times
    ``log1p(n_obs)`` with ``use_weights``). Positions whose window leaves the
    chromosome are NaN. An odd bandwidth would make every value NaN and is
    rejected; ``strict_compat=True`` returns those NaNs.
    """
    if bandwidth < 1:
        raise ValueError("bandwidth must be >= 1")
    half = bandwidth // 2
    keep = [*by, "chrom", "pos", "n_obs", "n_meth"]
    if bandwidth % 2:
        if not strict_compat:
            raise ValueError("bandwidth must be even: an odd one leaves every position undefined")
        return positions.select(*keep, F.lit(float("nan")).alias("smoothed"))

    ratio = F.abs(F.col("pos") - F.col("npos")) / F.lit(float(half))
    falloff = 1 - ratio * ratio * ratio
    weight = falloff * falloff * falloff
    if use_weights:
        weight = weight * F.log1p("nobs_n")
    sums = (
        band_join(positions, half, by=by)
        .withColumn("weight", weight)
        .groupBy(*by, "chrom", "bin", "pos")
        .agg(
            F.max("n_obs").alias("n_obs"),
            F.max("n_meth").alias("n_meth"),
            F.sum(F.col("nfrac") * F.col("weight")).alias("num"),
            F.sum("weight").alias("den"),
        )
    )
    last = chrom_extents(positions, by=by).select(*by, "chrom", "last_pos")
    inside = (F.col("pos") >= half) & (F.col("pos") + half <= F.col("last_pos") + 1)
    return sums.join(F.broadcast(last), [*by, "chrom"]).select(
        *keep,
        F.when(inside, F.col("num") / F.col("den")).otherwise(F.lit(float("nan"))).alias("smoothed"),
    )
