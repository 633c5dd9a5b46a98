"""Read counts per barcode, cell calling and cell lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import ranked_groups

# Unmapped, secondary, QC-fail and supplementary bits of the alignment flag.
NOT_PRIMARY = 0x4 | 0x100 | 0x200 | 0x800


def primary_alignments(alignments: DataFrame) -> DataFrame:
    return alignments.where(
        (F.col("flag").bitwiseAND(F.lit(NOT_PRIMARY)) == 0) & F.col("chrom").isNotNull()
    )


def reads_per_barcode(alignments: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Alignment records per barcode tag; untagged records are skipped, no flag filter."""
    return (
        alignments.where(F.col("cell").isNotNull())
        .groupBy(*by, F.col("cell").alias("barcode"))
        .agg(F.count(F.lit(1)).alias("aligned_reads"))
    )


def merge_counts(*tables: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum counts of several chunks or strands."""
    union = tables[0].select(*by, "barcode", "aligned_reads")
    for table in tables[1:]:
        union = union.unionByName(table.select(*by, "barcode", "aligned_reads"))
    return union.groupBy(*by, "barcode").agg(F.sum("aligned_reads").cast("long").alias("reads"))


def rank_index(expected: int) -> int:
    """0-based rank of the reference cell: the top percentile of ``expected``, in floats."""
    return int(expected * (1 - 99 / 100))


def call_by_rank(counts: DataFrame, expected: int = 3000) -> DataFrame:
    """Barcodes with more than a tenth of the reads at the reference rank (clamped to the last).

    The rank is small, so the value comes from a top-k and enters as a scalar
    subquery; no global ordering of the barcodes.
    """
    if expected <= 0:
        raise ValueError("expected cell number must be > 0")
    top = counts.select("reads").orderBy(F.desc("reads")).limit(rank_index(expected) + 1)
    at_rank = top.agg(F.min("reads").alias("at_rank"))
    return counts.where(F.col("reads") > at_rank.scalar() * 0.1)


def top_cells(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` barcodes with most reads; ties by barcode, empty barcodes never."""
    if n <= 0:
        raise ValueError("forced cell number must be > 0")
    return counts.where(F.col("reads") > 0).orderBy(F.desc("reads"), "barcode").limit(n)


def keep_cells(alignments: DataFrame, cells: DataFrame) -> DataFrame:
    """Alignments of listed cells. ``cells`` needs ``cell``."""
    return alignments.join(cells.select("cell").distinct(), "cell", "left_semi")


def reads_of_cells(alignments: DataFrame, cells: DataFrame) -> DataFrame:
    """Reads per listed cell; cells without reads do not appear."""
    return keep_cells(alignments, cells).groupBy("cell").agg(F.count(F.lit(1)).alias("reads_counts"))


def without_data(selected: DataFrame, available: DataFrame) -> DataFrame:
    """Selected cells that have no data."""
    return selected.select("cell").distinct().join(available.select("cell").distinct(), "cell", "left_anti")


def require_data(selected: DataFrame, available: DataFrame) -> DataFrame:
    """``selected`` unchanged, or an error naming the first five cells without data."""
    missing = [r["cell"] for r in without_data(selected, available).orderBy("cell").limit(6).collect()]
    if missing:
        more = ", ..." if len(missing) > 5 else ""
        raise ValueError(f"selected cells have no data: {', '.join(missing[:5])}{more}")
    return selected


def merge_strands(forward: DataFrame, reverse: DataFrame) -> DataFrame:
    """Full outer merge of per-strand counts; a cell on either strand alone is kept."""
    tagged = forward.select("cell", "reads_counts", F.lit(True).alias("fwd")).unionByName(
        reverse.select("cell", "reads_counts", F.lit(False).alias("fwd"))
    )
    return tagged.groupBy("cell").agg(
        F.max("fwd").alias("has_forward"),
        F.max(~F.col("fwd")).alias("has_reverse"),
        F.sum("reads_counts").cast("long").alias("reads_counts"),
    )


def union_cells(*lists: DataFrame, order: str | None = None) -> DataFrame:
    """Distinct union of cell lists: sorted by name, or in first-seen order.

    First-seen means list number, then ``order`` within the list.
    """
    tagged = None
    for number, cells in enumerate(lists):
        position: Column = F.col(order) if order else F.lit(0)
        one = cells.select("cell", F.struct(F.lit(number).alias("list"), position.alias("at")).alias("seen"))
        tagged = one if tagged is None else tagged.unionByName(one)
    merged = tagged.groupBy("cell").agg(F.min("seen").alias("seen"))
    return merged.orderBy("seen", "cell").select("cell", "seen") if order else merged.select("cell").orderBy("cell")


def intersect_cells(called: DataFrame, available: DataFrame) -> DataFrame:
    return called.select("cell").intersect(available.select("cell"))


def reject_duplicates(listing: DataFrame) -> DataFrame:
    """Error if a cell comes from more than one file. ``listing``: ``cell, path``."""
    dup = (
        listing.groupBy("cell")
        .agg(F.count_distinct("path").alias("n"), F.min("path").alias("a"), F.max("path").alias("b"))
        .where(F.col("n") > 1)
    )
    bad = dup.orderBy("cell").limit(5).collect()
    if bad:
        raise ValueError("cells with several site files: " + "; ".join(f"{r['cell']} ({r['a']}, {r['b']})" for r in bad))
    return listing


def median_cell(
    cells: DataFrame, value: str = "genome_cov", cell: str = "cell_barcode", *, by: Sequence[str] = ()
) -> DataFrame:
    """The row at index ``n // 2`` of cells sorted by ``value`` descending (an actual cell, not an average).

    Ties go to the smaller name. Ranks come from range-partitioned rows, so no
    task sees all cells; with ``by`` samples are ranked in parallel.
    """
    ranked = ranked_groups(cells.where(F.col(value).isNotNull()), [F.desc(value), cell], by=by)
    return ranked.where(F.col("rank") == F.floor(F.col("n") / 2)).drop("rank", "n")


def sample_cells(
    counts: DataFrame, available: DataFrame, *, threshold: float = 100, max_cells: int | None = None, seed: int = 42
) -> DataFrame:
    """All cells with more than ``threshold`` reads and data; ``max_cells`` draws that many in a seeded hash order."""
    good = good_cells(counts, available, threshold)
    if max_cells is None:
        return good
    if max_cells <= 0:
        raise ValueError("max_cells must be > 0")
    return good.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), "barcode"), 256), "barcode").limit(max_cells)


def good_cells(counts: DataFrame, available: DataFrame, threshold: float = 100) -> DataFrame:
    have = available.select(F.col("cell").alias("barcode")).distinct()
    return counts.where(F.col("reads") > threshold).join(have, "barcode", "left_semi")


def name_sorted(alignments: DataFrame) -> DataFrame:
    """Records of a cell adjacent and in name order, for file layouts that need it.

    Range partitioning on (cell, read_name) splits a cell with very many reads.
    """
    return alignments.repartitionByRange("cell", "read_name").sortWithinPartitions("cell", "read_name")
