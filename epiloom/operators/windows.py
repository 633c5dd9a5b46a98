"""Sliding windows over positions, their variance across cells, and merged peaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .position_join import BLOCK_WIDTH, blocks, join_sites
from .ranks import quantile
from .smoothing import chrom_extents

NAN = float("nan")
COPIES_PER_SALT = 1_000_000


def residual(meth: Column | str, smooth: Column | str, n: Column | str) -> Column:
    """Mean residual shrunken towards zero by one pseudo-observation."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return (as_col(meth) - as_col(smooth)) / (as_col(n) + 1)


def _nan_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(NAN)).alias(name)


def _placed(positions: DataFrame, half: int, step: int, by: Sequence[str]) -> DataFrame:
    first, last = F.col("first_pos"), F.col("last_pos")
    n_windows = F.ceil((last - first - 2 * half - 2) / step)
    offset = F.col("pos") - first - 1
    slot = F.floor(offset / step)
    rest = offset - slot * step
    low = slot - (2 * half) // step + F.when(rest > (2 * half) % step, 1).otherwise(0)
    extents = chrom_extents(positions, by=by).drop("n_encoded")
    return (
        positions.join(F.broadcast(extents), [*by, "chrom"])
        .withColumn("k_lo", F.greatest(low, F.lit(0)).cast("int"))
        .withColumn("k_hi", F.least(slot, n_windows - 1).cast("int"))
        .where(F.col("k_hi") >= F.col("k_lo"))
        .drop("last_pos")
    )


def slide_positions(
    positions: DataFrame, half: int, step: int, *, by: Sequence[str] = ()
) -> DataFrame:
    """Add the range ``[k_lo, k_hi]`` of window numbers that contain each position.

    Windows are closed, ``[center - half, center + half]``, with centers at
    ``first + half + 1 + k * step`` while ``center < last - half - 1``. Positions
    in no window, and chromosomes too short for one, are dropped. Computed once
    per position, not once per site.
    """
    return _placed(positions, half, step, by).drop("first_pos")


def slide_blocks(
    positions: DataFrame, half: int, step: int, block_width: int = BLOCK_WIDTH, *, by: Sequence[str] = ()
) -> DataFrame:
    """As :func:`slide_positions`, one row per block that owns some of the position's windows.

    A window belongs to the block of its center, so ``[k_lo, k_hi]`` is cut to
    the centers inside ``block``, and a position meets the blocks within ``half``.
    """
    first_in = lambda b: F.ceil((b.cast("long") * block_width - F.col("first_pos") - half - 1) / step)
    tiled = _placed(positions, half, step, by).withColumn("block", F.explode(blocks(F.col("pos"), block_width, half)))
    return (
        tiled.withColumn("k_lo", F.greatest("k_lo", first_in(F.col("block"))).cast("int"))
        .withColumn("k_hi", F.least("k_hi", first_in(F.col("block") + 1) - 1).cast("int"))
        .where(F.col("k_hi") >= F.col("k_lo"))
        .drop("first_pos")
    )


def window_cell_sums(
    encoded: DataFrame, smoothed: DataFrame, half: int, step: int, *, by: Sequence[str] = (),
    block_width: int = BLOCK_WIDTH, rows_per_salt: int = COPIES_PER_SALT,
) -> DataFrame:
    """Per (window, cell): observations ``n``, methylated ``meth``, Σ smoothed ``s``.

    Sites are copied into the blocks within half a window (two for a few percent
    of them), so each sum is final inside its (block, salt): after the one
    shuffle of the sites, nothing keyed by window and cell moves again. Sites of
    a cell that share a window range are summed before they are copied into
    their windows; the salts bound the copies of a task, not its sites.
    """
    dim = slide_blocks(
        smoothed.select(*by, "chrom", "pos", "n_obs", _nan_if_null("smoothed")), half, step, block_width, by=by
    )
    copies = F.col("k_hi") - F.col("k_lo") + 1
    joined = join_sites(
        encoded, dim, by=by, halo=max(half, 1), copies=copies, block_width=block_width, rows_per_salt=rows_per_salt
    )
    place = [*by, "chrom", "block", "salt"]
    ranges = joined.groupBy(*place, "cell", "k_lo", "k_hi").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("m") > 0).cast("long")).alias("meth"),
        F.sum("smoothed").alias("s"),
    )
    return (
        ranges.withColumn("win", F.explode(F.sequence("k_lo", "k_hi")))
        .groupBy(*place, "win", "cell")
        .agg(F.sum("n").alias("n"), F.sum("meth").alias("meth"), F.sum("s").alias("s"))
        .drop("block", "salt")
    )


def window_residuals(
    encoded: DataFrame, smoothed: DataFrame, half: int, step: int, *, by: Sequence[str] = (), **join_options
) -> DataFrame:
    """Shrunken mean residual per (window, cell); NaN when a site of the cell has no smoothed value."""
    return window_cell_sums(encoded, smoothed, half, step, by=by, **join_options).select(
        *by, "chrom", "win", "cell", "n", residual("meth", "s", "n").alias("resid")
    )


def window_variance(residuals: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Population variance across the cells of a window; NaN residuals drop the cell, not the window."""
    return (
        residuals.where(~F.isnan("resid"))
        .groupBy(*by, "chrom", "win")
        .agg(F.var_pop("resid").alias("variance"))
    )


def add_centers(
    variances: DataFrame, smoothed: DataFrame, half: int, step: int, *, by: Sequence[str] = ()
) -> DataFrame:
    extents = chrom_extents(smoothed, by=by).select(*by, "chrom", "first_pos")
    return variances.join(F.broadcast(extents), [*by, "chrom"]).select(
        *by,
        "chrom",
        "win",
        (F.col("first_pos") + half + 1 + F.col("win") * step).cast("int").alias("center"),
        "variance",
    )


def variance_cutoff(
    variances: DataFrame, smoothed: DataFrame, half: int, var_threshold: float, *, by: Sequence[str] = ()
) -> DataFrame:
    """The (1 - var_threshold) quantile of the largest chromosome that has room for a window.

    Largest means most encoded sites, ties by name. The quantile is exact and
    interpolates linearly, from the ranks of range-partitioned values.
    """
    largest = (
        chrom_extents(smoothed, by=by)
        .where(F.col("last_pos") - F.col("first_pos") > 2 * half + 2)
        .groupBy(*by)
        .agg(F.min_by("chrom", F.struct(-F.col("n_encoded"), F.col("chrom"))).alias("chrom"))
    )
    of_largest = variances.join(F.broadcast(largest), [*by, "chrom"])
    return quantile(of_largest, "variance", 1 - var_threshold, by=[*by, "chrom"], name="cutoff")


def hot_windows(variances: DataFrame, cutoff: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Windows strictly above the cut-off (one value per sample)."""
    if by:
        return variances.join(
            F.broadcast(cutoff.select(*by, "cutoff")), list(by)
        ).where(F.col("variance") > F.col("cutoff")).drop("cutoff")
    return variances.where(F.col("variance") > cutoff.select("cutoff").scalar())


def merge_peaks(hot: DataFrame, half: int, bridge_gaps: int = 0, *, by: Sequence[str] = ()) -> DataFrame:
    """Gaps and islands over the windows above the cut-off: ``(chrom, VMR_start, VMR_end)``.

    Neighbouring grid windows always merge; after a gap they merge when the next
    window starts at most ``bridge_gaps`` past the end of the last. The input is
    the few percent of windows above the cut-off, at most one per grid step.
    """
    order = Window.partitionBy(*by, "chrom").orderBy("win")
    gap = F.col("win") - F.lag("win").over(order)
    distance = (F.col("center") - half - bridge_gaps) - (F.lag("center").over(order) + half)
    starts = F.when((gap == 1) | (distance <= 0), 0).otherwise(1)
    return (
        hot.withColumn("new", starts)
        .withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*by, "chrom", "island")
        .agg(
            (F.min("center") - half).cast("int").alias("VMR_start"),
            (F.max("center") + half).cast("int").alias("VMR_end"),
        )
        .drop("island")
    )
