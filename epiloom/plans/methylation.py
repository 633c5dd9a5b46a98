"""From sites to a site store, smoothing, variable regions and region matrices."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import regions as rg
from ..operators import sites as st
from ..operators import smoothing as sm
from ..operators import windows as wn
from ..session import materialize, tune


def build_site_store(
    sites: DataFrame,
    cells: DataFrame | None = None,
    *,
    context: str = "CG",
    round_sites: bool = False,
    exclude_contigs: Iterable[str] = (),
    main_only: bool = False,
    literal_prefix: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Filter, encode and (with a cell list) restrict: ``(chrom, pos, cell, m)``.

    Narrow apart from the cell list, which is a semi join on the small side.
    Write it with ``sinks.write_site_store``.
    """
    picked = st.select_sites(
        sites, context=context, exclude_contigs=exclude_contigs, main_only=main_only,
        literal_prefix=literal_prefix,
    )
    encoded = st.encode_sites(picked, round_sites=round_sites, by=by)
    return encoded if cells is None else encoded.join(cells, [*by, "cell"], "left_semi")


def smooth_store(
    encoded: DataFrame, bandwidth: int = 1000, use_weights: bool = False, *,
    strict_compat: bool = False, by: Sequence[str] = (),
) -> DataFrame:
    """Pseudobulk and tricube smoothing of a site store.

    The sites are scanned once: the pseudobulk (a row per position) is written, and the band join's
    two sides and the chromosome ends read that table.
    """
    positions = materialize(sm.pseudobulk(encoded, by=by), "pseudobulk")
    return sm.smooth(positions, bandwidth, use_weights, strict_compat=strict_compat, by=by)


def check_scan_parameters(
    bandwidth: int, stepsize: int, var_threshold: float, min_cells: int, bridge_gaps: int
) -> None:
    if bandwidth < 1:
        raise ValueError("bandwidth must be >= 1")
    if stepsize < 1:
        raise ValueError("stepsize must be >= 1")
    if not 0 <= var_threshold <= 1:
        raise ValueError("var_threshold must be between 0 and 1")
    if min_cells < 1:
        raise ValueError("min_cells must be >= 1")
    if bridge_gaps < 0:
        raise ValueError("bridge_gaps must be >= 0")


def scan_vmrs(
    encoded: DataFrame,
    smoothed: DataFrame,
    *,
    bandwidth: int = 2000,
    stepsize: int = 100,
    var_threshold: float = 0.02,
    min_cells: int = 6,
    bridge_gaps: int = 0,
    by: Sequence[str] = (),
    require: bool = True,
    **join_options,
) -> DataFrame:
    """Variably methylated regions.

    Two passes over the sites: one for the variance of every window, one over
    the sites inside the merged peaks. The window variances (one row per grid
    step) are written once between them, so the cut-off and the peaks see the
    same numbers and a lost executor does not repeat the first pass.
    """
    check_scan_parameters(bandwidth, stepsize, var_threshold, min_cells, bridge_gaps)
    tune(encoded.sparkSession)
    half = bandwidth // 2
    residuals = wn.window_residuals(encoded, smoothed, half, stepsize, by=by, **join_options)
    variances = materialize(wn.window_variance(residuals, by=by), "window-variance")
    cutoff = wn.variance_cutoff(variances, smoothed, half, var_threshold, by=by)
    hot = wn.add_centers(wn.hot_windows(variances, cutoff, by=by), smoothed, half, stepsize, by=by)
    peaks = materialize(wn.merge_peaks(hot, half, bridge_gaps, by=by), "peaks")
    stats = rg.interval_stats(encoded, smoothed, peaks, by=by, **join_options)
    if require:
        stats = materialize(stats, "vmrs")
    return rg.min_cells_filter(stats, min_cells, require=require)


def region_matrix(
    encoded: DataFrame,
    smoothed: DataFrame,
    regions: DataFrame | None,
    cells: DataFrame,
    *,
    vmrs: DataFrame | None = None,
    dense: bool = False,
    include_last_site: bool = False,
    **join_options,
) -> DataFrame | dict[str, DataFrame]:
    """Cell × region matrix: long ``(cell_idx, region_idx, residual, mfrac, coverage)`` or four tables by blocks of regions.

    ``regions`` needs ``region_ord, chrom, start, end``; without it the VMR table
    is used. ``cells`` needs ``cell_idx, cell``. A NaN residual becomes NULL.
    """
    tune(encoded.sparkSession)
    if regions is None:
        if vmrs is None:
            raise ValueError("give regions or a VMR table")
        regions = vmrs.select(
            F.struct("chromosome", "VMR_start").alias("region_ord"),
            F.col("chromosome").alias("chrom"),
            F.col("VMR_start").alias("start"),
            F.col("VMR_end").alias("end"),
        )
    indexed = rg.index_regions(regions, smoothed)
    if not indexed.limit(1).count():
        raise ValueError("no region lies on a chromosome with data")
    per_cell = rg.region_cell(
        encoded, smoothed, indexed, include_last_site=include_last_site, **join_options
    )
    if dense:
        return rg.dense_tables(per_cell, cells, indexed)
    return per_cell.join(cells.select("cell", "cell_idx"), "cell").select(
        "cell_idx",
        "region_idx",
        F.nanvl("resid", F.lit(None).cast("double")).alias("residual"),
        "mfrac",
        F.col("n_total").alias("coverage"),
    )


def missing_chromosomes(regions: DataFrame, smoothed: DataFrame) -> DataFrame:
    """Chromosomes named by the regions but absent from the data (the caller's warning)."""
    return regions.select("chrom").distinct().join(
        smoothed.select("chrom").distinct(), "chrom", "left_anti"
    )
