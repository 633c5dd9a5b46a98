"""Genomic regions: interval join, indices, per-region statistics, matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sites import region_name
from ..session import materialize
from .position_join import join_sites
from .ranks import with_rank
from .smoothing import chrom_extents
from .windows import _nan_if_null, residual

WIDTHS = tuple(4**k for k in range(16))  # bin widths of the levels


def interval_join(positions: DataFrame, regions: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Positions inside closed regions ``[start, end]``.

    Hierarchical bins: a region sits at the level whose bins are the widest that
    are at most half as long as it, in the (three to nine) bins it touches. A
    position looks at its bin of every level that occurs on its chromosome, so
    the join is an equality on (chrom, width, bin), and the bins of a region
    are at most one and a half times as long as the region itself, whether it
    has a hundred positions or a million. It runs on the position table, never
    on cell × position sites.
    """
    half = (F.col("end") - F.col("start") + 1) / 2
    width = F.lit(1)
    for w in WIDTHS:
        width = F.when(half >= w, w).otherwise(width)
    bin_of = lambda c: F.floor(F.col(c) / F.col("width"))
    levelled = regions.where(F.col("end") >= F.col("start")).withColumn("width", width)
    tiled = levelled.withColumn("bin", F.explode(F.sequence(bin_of("start"), bin_of("end"))))
    levels = levelled.select(*by, "chrom", "width").distinct()  # at most one row per contig and level
    return (
        positions.join(F.broadcast(levels), [*by, "chrom"])
        .withColumn("bin", bin_of("pos"))
        .join(tiled, [*by, "chrom", "width", "bin"])
        .where(F.col("pos").between(F.col("start"), F.col("end")))
        .drop("bin", "width")
    )


def index_cells(cells: DataFrame, order: Column | str) -> DataFrame:
    """0-based ``cell_idx`` in list order, from range-partitioned ranks."""
    return with_rank(cells, [order], "cell_idx").withColumn("cell_idx", F.col("cell_idx").cast("int"))


def index_regions(
    regions: DataFrame, positions: DataFrame, *, order: str = "region_ord"
) -> DataFrame:
    """0-based ``region_idx`` by chromosome name, then list order, from range-partitioned ranks.

    Chromosomes without data get no index.
    """
    present = positions.select("chrom").distinct()
    kept = regions.join(F.broadcast(present), "chrom", "left_semi")
    return with_rank(kept, ["chrom", order], "region_idx").withColumn(
        "region_idx", F.col("region_idx").cast("int")
    ).withColumn("region_name", region_name("chrom", "start", "end"))


def region_cell(
    encoded: DataFrame,
    smoothed: DataFrame,
    regions: DataFrame,
    keys: Sequence[str] = ("region_idx",),
    *,
    include_last_site: bool = False,
    by: Sequence[str] = (),
    **join_options,
) -> DataFrame:
    """Per (region, cell): methylated and total sites, fraction, shrunken residual (NaN kept).

    The last observed position of a chromosome is not counted unless
    ``include_last_site`` is set.
    """
    positions = smoothed.select(*by, "chrom", "pos", "n_obs", _nan_if_null("smoothed"))
    if not include_last_site:
        last = chrom_extents(positions, by=by).select(*by, "chrom", "last_pos")
        positions = (
            positions.join(F.broadcast(last), [*by, "chrom"])
            .where(F.col("pos") < F.col("last_pos"))
            .drop("last_pos")
        )
    inside = interval_join(positions, regions.select(*by, "chrom", "start", "end", *[k for k in keys if k not in ("chrom", "start", "end")]), by=by)
    inside = inside.select(*dict.fromkeys([*by, "chrom", "pos", "n_obs", "smoothed", *keys]))
    sums = (
        join_sites(encoded, inside, by=by, **join_options)
        .groupBy(*dict.fromkeys([*by, *keys, "cell"]))  # combined in the tasks of the join before they move
        .agg(
            F.sum((F.col("m") > 0).cast("long")).alias("n_meth"),
            F.count(F.lit(1)).alias("n_total"),
            F.sum("smoothed").alias("s"),
        )
    )
    return sums.withColumn("mfrac", F.col("n_meth") / F.col("n_total")).withColumn(
        "resid", residual("n_meth", "s", "n_total")
    ).drop("s")


def interval_stats(
    encoded: DataFrame, smoothed: DataFrame, peaks: DataFrame, *, by: Sequence[str] = (), **join_options
) -> DataFrame:
    """Merged peaks with variance over the whole interval, distinct sites and distinct cells.

    Sites are counted on the position table and cells as groups, so no distinct
    count runs over the site table. Cells with a NaN residual count as cells but
    not towards the variance.
    """
    key = [*by, "chrom", "start", "end"]
    regions = peaks.select(*by, "chrom", F.col("VMR_start").alias("start"), F.col("VMR_end").alias("end"))
    per_cell = region_cell(
        encoded, smoothed, regions, ("chrom", "start", "end"), include_last_site=True, by=by, **join_options
    )
    cells = per_cell.groupBy(*key).agg(
        F.var_pop(F.when(~F.isnan("resid"), F.col("resid"))).alias("variance"),
        F.count(F.lit(1)).alias("n_cells"),
    )
    sites = interval_join(smoothed.select(*by, "chrom", "pos"), regions, by=by).groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_sites")
    )
    return cells.join(sites, key).select(
        *by,
        F.col("chrom").alias("chromosome"),
        F.col("start").alias("VMR_start"),
        F.col("end").alias("VMR_end"),
        "variance",
        "n_sites",
        "n_cells",
    )


def min_cells_filter(vmrs: DataFrame, min_cells: int, *, require: bool = True) -> DataFrame:
    """Drop intervals covered by fewer than ``min_cells`` cells; error when none is left."""
    kept = vmrs.where(F.col("n_cells") >= min_cells)
    if require and not kept.limit(1).count():
        raise RuntimeError(
            f"no variable region is covered by at least {min_cells} cells; lower min_cells"
        )
    return kept


COLUMN_BLOCK = 256  # regions in one array


def dense_tables(region_cells: DataFrame, cells: DataFrame, regions: DataFrame) -> dict[str, DataFrame]:
    """Four cell × region tables (fraction, residual, total, methylated), as ``cell_idx, cell, block, values``.

    ``values`` holds the regions ``block * COLUMN_BLOCK`` and following in the
    order of ``region_idx``, for every listed cell and block: counts and
    fractions are 0 without coverage, residuals NULL. Regions are columns by
    number, not by name, so their number is free and one may be listed twice.
    """
    n_regions = regions.count()
    if not n_regions:
        raise ValueError("no regions")
    n_blocks = -(-n_regions // COLUMN_BLOCK)
    fields = ("mfrac", "resid", "n_total", "n_meth")
    at = F.col("region_idx") % COLUMN_BLOCK
    filled = region_cells.groupBy("cell", F.floor(F.col("region_idx") / COLUMN_BLOCK).cast("int").alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct(at.alias("at"), F.struct(*fields).alias("v")))).alias("found")  # at most COLUMN_BLOCK
    )
    grid = cells.select("cell_idx", "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    width = F.least(F.lit(COLUMN_BLOCK), F.lit(n_regions) - F.col("block") * COLUMN_BLOCK)
    # Written once: four tables read it.
    dense = materialize(
        grid.join(filled, ["cell", "block"], "left").select(
            "cell_idx", "cell", "block", F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.element_at("found", i)).alias("all")
        ),
        "dense",
    )
    values = {
        "methylation_fractions": lambda x: F.coalesce(x["mfrac"], F.lit(0.0)),
        "mean_shrunken_residuals": lambda x: F.nanvl(x["resid"], F.lit(None).cast("double")),
        "total_sites": lambda x: F.coalesce(x["n_total"], F.lit(0)),
        "methylated_sites": lambda x: F.coalesce(x["n_meth"], F.lit(0)),
    }
    return {name: dense.select("cell_idx", "cell", "block", F.transform("all", value).alias("values")) for name, value in values.items()}
