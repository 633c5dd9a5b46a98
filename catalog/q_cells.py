"""Read counts, cell calling, cell lists, strand merging, set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epiloom.operators.ranks import with_rank
from epiloom.functions.seq import cell_from_read_name
from epiloom.operators import cells as cl
from epiloom.plans import cells as pc
from epiloom.sinks import tables as sk

from .fixtures import FIXTURES
from .registry import query

EXPECTED = 1200

FIXTURES.update({
    "ox_ranked": "SELECT *, row_number() OVER (ORDER BY reads DESC, barcode) - 1 AS rank FROM fx_skewed_counts",
    "ox_called": f"""
        SELECT barcode, reads FROM ox_ranked
        WHERE reads > 0.1 * (SELECT min(reads) FROM ox_ranked WHERE rank <= {cl.rank_index(EXPECTED)})""",
    "fx_even_cells": "SELECT cell, cell_idx AS ord FROM fx_all_cells WHERE cell_idx % 2 = 0",
    "fx_third_cells": "SELECT cell, 1000 - cell_idx AS ord FROM fx_all_cells WHERE cell_idx % 3 = 0",
})


def strand(t, name):
    return t.fx_barcode_counts.where(F.col("strand") == name)


@query("agg_reads_per_barcode", """
    SELECT cell AS barcode, count(*) AS aligned_reads FROM fx_alignments WHERE cell IS NOT NULL GROUP BY cell""")
def agg_reads_per_barcode(t):
    return cl.reads_per_barcode(t.fx_alignments)


@query("agg_merge_counts", "SELECT barcode, reads FROM fx_totals")
def agg_merge_counts(t):
    return cl.merge_counts(strand(t, "forward"), strand(t, "reverse"))


@query("win_rank_threshold_cells", "SELECT barcode, reads FROM ox_called")
def win_rank_threshold_cells(t):
    return cl.call_by_rank(t.fx_skewed_counts, EXPECTED)


@query("topk_force_cells", "SELECT barcode, reads FROM ox_ranked WHERE rank < 25")
def topk_force_cells(t):
    return cl.top_cells(t.fx_skewed_counts, 25)


@query("call_cells", """
    SELECT 'expected' AS how, barcode, reads FROM ox_called
    UNION ALL SELECT 'forced' AS how, barcode, reads FROM ox_ranked WHERE rank < 40""")
def call_cells(t):
    counts = t.fx_skewed_counts
    expected = pc.call_cells(counts, expected=EXPECTED).select(F.lit("expected").alias("how"), "barcode", "reads")
    return expected.unionByName(
        pc.call_cells(counts, expected=EXPECTED, force=40).select(F.lit("forced").alias("how"), "barcode", "reads")
    )


@query("resolve_cell_list", """
    SELECT 'explicit' AS how, cell FROM fx_even_cells WHERE cell IN (SELECT cell FROM fx_sites)
    UNION ALL SELECT 'called' AS how, cell FROM fx_third_cells WHERE cell IN (SELECT cell FROM fx_sites)
    UNION ALL SELECT DISTINCT 'all' AS how, cell FROM fx_sites""")
def resolve_cell_list(t):
    have = t.fx_sites.select("cell").distinct()
    even = t.fx_even_cells.join(have, "cell", "left_semi")
    third = t.fx_third_cells.join(have, "cell", "left_semi")
    parts = {
        "explicit": pc.resolve_cell_list(have, explicit=even, called=third),
        "called": pc.resolve_cell_list(have, called=third),
        "all": pc.resolve_cell_list(have),
    }
    out = None
    for how, cells in parts.items():
        part = cells.select(F.lit(how).alias("how"), "cell")
        out = part if out is None else out.unionByName(part)
    return out


@query("join_called_cells_semi", """
    SELECT cell, count(*) AS reads_counts FROM fx_alignments WHERE cell IN (SELECT cell FROM fx_even_cells) GROUP BY cell""")
def join_called_cells_semi(t):
    return cl.reads_of_cells(t.fx_alignments, t.fx_even_cells)


@query("join_exclude_anti", """
    SELECT cell FROM fx_all_cells WHERE cell NOT IN (SELECT cell FROM fx_alignments WHERE cell IS NOT NULL)""")
def join_exclude_anti(t):
    return cl.without_data(t.fx_all_cells, t.fx_alignments)


@query("set_except_missing", """
    SELECT cell FROM fx_all_cells EXCEPT SELECT cell FROM fx_sites""")
def set_except_missing(t):
    return cl.without_data(t.fx_all_cells, t.fx_sites)


# barcodes of a cell and a start, so that many occur on one strand only
FR = "SELECT concat_ws(':', cell, b_start) AS cell, count(*) AS n FROM fx_alignments WHERE cell IS NOT NULL AND strand = '{0}' GROUP BY 1"


@query("join_fr_full_outer", f"""
    SELECT coalesce(f.cell, r.cell) AS cell, f.cell IS NOT NULL AS has_forward, r.cell IS NOT NULL AS has_reverse,
           coalesce(f.n, 0) + coalesce(r.n, 0) AS reads_counts
    FROM ({FR.format('forward')}) f FULL OUTER JOIN ({FR.format('reverse')}) r ON f.cell = r.cell""")
def join_fr_full_outer(t):
    al = t.fx_alignments.where("cell IS NOT NULL").withColumn("cell", F.concat_ws(":", "cell", "b_start"))
    count = lambda df: df.groupBy("cell").agg(F.count(F.lit(1)).alias("reads_counts"))
    return cl.merge_strands(count(al.where("strand = 'forward'")), count(al.where("strand = 'reverse'")))


@query("set_union_barcodes", """
    SELECT cell, cast(row_number() OVER (ORDER BY list, seen, cell) AS int) AS nth FROM (
      SELECT cell, min(list) AS list, arg_min(seen, list) AS seen FROM (
        SELECT cell, 0 AS list, ord AS seen FROM fx_even_cells UNION ALL SELECT cell, 1 AS list, ord AS seen FROM fx_third_cells) u
      GROUP BY cell) g""")
def set_union_barcodes(t):
    merged = cl.union_cells(t.fx_even_cells, t.fx_third_cells, order="ord")
    return with_rank(merged, ["seen", "cell"], "nth").select("cell", (F.col("nth") + 1).cast("int").alias("nth"))


@query("set_intersect_cells", "SELECT cell FROM fx_even_cells INTERSECT SELECT cell FROM fx_alignments")
def set_intersect_cells(t):
    return cl.intersect_cells(t.fx_even_cells, t.fx_alignments)


@query("fx_cell_from_read_name", """
    SELECT read_name, cell, count(*) AS n FROM fx_alignments WHERE cell IS NOT NULL GROUP BY read_name, cell""")
def fx_cell_from_read_name(t):
    named = t.fx_alignments.where("cell IS NOT NULL").select(
        "read_name", F.concat_ws("_", "cell", "umi", "strand", F.lit("M"), "read_name").alias("full_name")
    )
    return named.groupBy("read_name", cell_from_read_name("full_name").alias("cell")).agg(F.count(F.lit(1)).alias("n"))


@query("srt_name_sort", """
    SELECT cell, count(*) AS n, min(read_name) AS first_name, max(read_name) AS last_name, true AS in_order
    FROM fx_alignments WHERE cell IS NOT NULL GROUP BY cell""")
def srt_name_sort(t):
    """Read by their places in the output, so that another order gives other rows."""
    placed = cl.name_sorted(t.fx_alignments.where("cell IS NOT NULL")).withColumn("place", F.monotonically_increasing_id())
    before = F.lag("read_name").over(Window.partitionBy("cell").orderBy("place"))
    return placed.withColumn("before", before).groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("read_name", "place").alias("first_name"), F.max_by("read_name", "place").alias("last_name"),
        F.bool_and(F.coalesce(F.col("before") <= F.col("read_name"), F.lit(True))).alias("in_order"),
    )


@query("win_median_cell", """
    SELECT cell, median_cov FROM (
      SELECT cell, round(cov, 6) AS median_cov, row_number() OVER (ORDER BY cov DESC, cell) AS rank, count(*) OVER () AS n
      FROM (SELECT cell, sum(cov) / 4000e0 AS cov FROM fx_sites GROUP BY cell) c) r WHERE rank = n // 2 + 1""")
def win_median_cell(t):
    cov = t.fx_sites.groupBy("cell").agg((F.sum("cov") / F.lit(4000.0)).alias("median_cov"))
    return cl.median_cell(cov, "median_cov", "cell")


@query("snk_count_tables", """
    SELECT barcode, cast(reads AS string) AS reads, cast(row_number() OVER (ORDER BY reads DESC, barcode) AS int) AS line FROM fx_skewed_counts""")
def snk_count_tables(t):
    path = t.path("counts")
    sk.write_count_table(t.fx_skewed_counts, path)

    back = t.spark.read.option("header", True).csv(path)
    placed = back.select("barcode", "reads", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line_id"))
    return with_rank(placed, ["path", "line_id"], "line").select("barcode", "reads", (F.col("line") + 1).cast("int").alias("line"))
