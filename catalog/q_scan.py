"""Smoothing, windows, variable regions, region matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from epiloom.operators import regions as rg
from epiloom.operators import smoothing as sm
from epiloom.operators import windows as wn
from epiloom.plans import methylation as me
from epiloom.session import materialize

from .fixtures import FIXTURES
from .registry import query

BANDWIDTH, SCAN, STEP, TOP = 60, 100, 10, 0.02
H, W = BANDWIDTH // 2, SCAN // 2

# Oracle views (DuckDB only), written from the definitions.
FIXTURES.update({
    "ox_pseudobulk": """
        SELECT chrom, pos, count(*) AS n_obs, cast(sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) AS bigint) AS n_meth,
               sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) / count(*) AS frac, ln(1 + count(*)) AS weight
        FROM fx_encoded GROUP BY chrom, pos""",
    "ox_extent": "SELECT chrom, min(pos) AS f, max(pos) AS l, sum(n_obs) AS n FROM ox_pseudobulk GROUP BY chrom",
    "ox_kernel": f"""
        SELECT a.chrom, a.pos, a.pos >= {H} AND a.pos + {H} <= l + 1 AS inside, b.frac, b.weight,
               pow(1 - pow(abs(a.pos - b.pos) / {H}.0, 3), 3) AS k
        FROM ox_pseudobulk a JOIN ox_pseudobulk b ON a.chrom = b.chrom AND abs(a.pos - b.pos) < {H}
        JOIN ox_extent e ON a.chrom = e.chrom""",
    "ox_smooth": """
        SELECT chrom, pos, CASE WHEN inside THEN sum(frac * k) / sum(k) END AS s,
               CASE WHEN inside THEN sum(frac * k * weight) / sum(k * weight) END AS sw
        FROM ox_kernel GROUP BY chrom, pos, inside""",
    "ox_grid": f"""
        SELECT chrom, n, cast((center - f - {W} - 1) / {STEP} AS int) AS win, cast(center AS int) AS center FROM (
          SELECT chrom, f, l, n, unnest(range(f + {W} + 1, l - {W} - 1, {STEP})) AS center FROM ox_extent) g""",
    "ox_resid": f"""
        SELECT g.chrom, win, center, cell, count(*) AS n,
               CASE WHEN count(s) = count(*) THEN (sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) - sum(s)) / (count(*) + 1) END AS resid
        FROM ox_grid g JOIN fx_encoded e ON g.chrom = e.chrom AND e.pos BETWEEN center - {W} AND center + {W}
        JOIN ox_smooth s ON e.chrom = s.chrom AND e.pos = s.pos
        GROUP BY g.chrom, win, center, cell""",
    "ox_variance": "SELECT chrom, win, center, var_pop(resid) AS variance FROM ox_resid WHERE resid IS NOT NULL GROUP BY ALL",
    "ox_cutoff": f"""
        SELECT chrom, quantile_cont(variance, {1 - TOP}) AS cutoff FROM ox_variance
        WHERE chrom = (SELECT chrom FROM ox_extent WHERE l - f > {2 * W + 2} ORDER BY n DESC, chrom LIMIT 1) GROUP BY chrom""",
})
for bridge in (0, 40):
    FIXTURES[f"ox_peaks_{bridge}"] = f"""
        SELECT chrom, cast(min(center) - {W} AS int) AS s, cast(max(center) + {W} AS int) AS e FROM (
          SELECT chrom, center, sum(CASE WHEN win = pw + 1 OR center - {W} - {bridge} <= pc + {W} THEN 0 ELSE 1 END)
                 OVER (PARTITION BY chrom ORDER BY win) AS island
          FROM (SELECT chrom, win, center, lag(win) OVER o AS pw, lag(center) OVER o AS pc
                FROM ox_variance WHERE variance > (SELECT cutoff FROM ox_cutoff)
                WINDOW o AS (PARTITION BY chrom ORDER BY win)) a) b
        GROUP BY chrom, island"""
    FIXTURES[f"ox_vmrs_{bridge}"] = f"""
        SELECT chrom AS chromosome, s AS VMR_start, e AS VMR_end, round(var_pop(resid), 6) AS variance,
               max(n_sites) AS n_sites, count(*) AS n_cells
        FROM (SELECT p.chrom, p.s, p.e, cell, CASE WHEN count(q.s) = count(*)
                       THEN (sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) - sum(q.s)) / (count(*) + 1) END AS resid
              FROM ox_peaks_{bridge} p JOIN fx_encoded x ON p.chrom = x.chrom AND x.pos BETWEEN p.s AND p.e
              JOIN ox_smooth q ON x.chrom = q.chrom AND x.pos = q.pos GROUP BY p.chrom, p.s, p.e, cell) r
        JOIN (SELECT p.chrom, p.s, p.e, count(DISTINCT x.pos) AS n_sites FROM ox_peaks_{bridge} p
              JOIN fx_encoded x ON p.chrom = x.chrom AND x.pos BETWEEN p.s AND p.e GROUP BY p.chrom, p.s, p.e) c USING (chrom, s, e)
        GROUP BY chrom, s, e"""
FIXTURES["ox_region_index"] = """
        SELECT *, cast(row_number() OVER (ORDER BY chrom, region_ord) - 1 AS int) AS region_idx
        FROM fx_regions WHERE chrom IN (SELECT chrom FROM ox_extent)"""
FIXTURES["ox_region_cell"] = """
        SELECT region_idx, cell, cast(sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) AS bigint) AS n_meth, count(*) AS n_total,
               sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) / count(*) AS mfrac,
               CASE WHEN count(s) = count(*) THEN (sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) - sum(s)) / (count(*) + 1) END AS resid
        FROM ox_region_index r JOIN fx_encoded e ON r.chrom = e.chrom AND e.pos BETWEEN start AND "end"
        JOIN ox_extent x ON e.chrom = x.chrom AND e.pos < x.l
        JOIN ox_smooth q ON e.chrom = q.chrom AND e.pos = q.pos GROUP BY region_idx, cell"""


FIXTURES["ox_vmr_index"] = """
        SELECT *, cast(row_number() OVER (ORDER BY chromosome, VMR_start) - 1 AS int) AS region_idx
        FROM ox_vmrs_0 WHERE n_cells >= 6"""


def smoothed_table(t):
    return materialize(me.smooth_store(t.fx_encoded, BANDWIDTH), "smoothed")


def scan(t, bridge=0, min_cells=6):
    return me.scan_vmrs(
        t.fx_encoded, smoothed_table(t), bandwidth=SCAN, stepsize=STEP, var_threshold=TOP,
        min_cells=min_cells, bridge_gaps=bridge,
    )


@query("agg_pseudobulk", """
    SELECT chrom, pos, n_obs, n_meth, round(frac, 6) AS frac, round(weight, 6) AS weight FROM ox_pseudobulk""")
def agg_pseudobulk(t):
    return sm.pseudobulk(t.fx_encoded).withColumn("weight", F.log1p("n_obs"))


@query("join_band_smooth", f"""
    SELECT a.chrom, a.pos, count(*) AS n_neighbours, cast(sum(abs(a.pos - b.pos)) AS bigint) AS distance
    FROM ox_pseudobulk a JOIN ox_pseudobulk b ON a.chrom = b.chrom AND abs(a.pos - b.pos) < {H}
    GROUP BY a.chrom, a.pos""")
def join_band_smooth(t):
    return sm.band_join(materialize(sm.pseudobulk(t.fx_encoded), "pseudobulk"), H).groupBy("chrom", "pos").agg(
        F.count(F.lit(1)).alias("n_neighbours"), F.sum(F.abs(F.col("pos") - F.col("npos"))).alias("distance")
    )


@query("agg_tricube_smooth", "SELECT chrom, pos, round(s, 6) AS smoothed FROM ox_smooth")
def agg_tricube_smooth(t):
    return me.smooth_store(t.fx_encoded, BANDWIDTH).select("chrom", "pos", "smoothed")


@query("smooth", "SELECT chrom, pos, round(sw, 6) AS smoothed FROM ox_smooth")
def smooth(t):
    return me.smooth_store(t.fx_encoded, BANDWIDTH, use_weights=True).select("chrom", "pos", "smoothed")


@query("win_slide_sites", f"""
    SELECT p.chrom, p.pos, min(win) AS k_lo, max(win) AS k_hi
    FROM ox_pseudobulk p JOIN ox_grid g ON p.chrom = g.chrom AND p.pos BETWEEN center - {W} AND center + {W}
    GROUP BY p.chrom, p.pos""")
def win_slide_sites(t):
    return wn.slide_positions(sm.pseudobulk(t.fx_encoded), W, STEP).select("chrom", "pos", "k_lo", "k_hi")


@query("agg_shrunken_residual", "SELECT chrom, win, cell, n, round(resid, 6) AS resid FROM ox_resid")
def agg_shrunken_residual(t):
    return wn.window_residuals(t.fx_encoded, smoothed_table(t), W, STEP)


def variances(t):
    smoothed = smoothed_table(t)
    return wn.window_variance(wn.window_residuals(t.fx_encoded, smoothed, W, STEP)), smoothed


@query("agg_window_variance", "SELECT chrom, win, center, round(variance, 6) AS variance FROM ox_variance")
def agg_window_variance(t):
    variance, smoothed = variances(t)
    return wn.add_centers(variance, smoothed, W, STEP)


@query("win_variance_cutoff", "SELECT chrom, round(cutoff, 6) AS cutoff FROM ox_cutoff")
def win_variance_cutoff(t):
    variance, smoothed = variances(t)
    return wn.variance_cutoff(variance, smoothed, W, TOP)


def peaks(t, bridge):
    variance, smoothed = variances(t)
    variance = materialize(variance, "variance")
    hot = wn.hot_windows(variance, wn.variance_cutoff(variance, smoothed, W, TOP))
    return wn.merge_peaks(wn.add_centers(hot, smoothed, W, STEP), W, bridge), smoothed


@query("win_merge_peaks", """
    SELECT 0 AS bridge, chrom, s AS VMR_start, e AS VMR_end FROM ox_peaks_0
    UNION ALL SELECT 40 AS bridge, chrom, s AS VMR_start, e AS VMR_end FROM ox_peaks_40""")
def win_merge_peaks(t):
    out = None
    for bridge in (0, 40):
        part = peaks(t, bridge)[0].select(F.lit(bridge).alias("bridge"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("agg_vmr_stats", "SELECT * FROM ox_vmrs_0")
def agg_vmr_stats(t):
    found, smoothed = peaks(t, 0)
    return rg.interval_stats(t.fx_encoded, smoothed, found)


@query("flt_min_cells", "SELECT * FROM ox_vmrs_40 WHERE n_cells >= 90")
def flt_min_cells(t):
    found, smoothed = peaks(t, 40)
    stats = materialize(rg.interval_stats(t.fx_encoded, smoothed, found), "stats")
    return rg.min_cells_filter(stats, 90, require=False)


@query("scan_vmrs", "SELECT * FROM ox_vmrs_0 WHERE n_cells >= 6")
def scan_vmrs(t):
    return scan(t)


@query("scan_vmrs_bridged", "SELECT * FROM ox_vmrs_40 WHERE n_cells >= 6")
def scan_vmrs_bridged(t):
    return scan(t, bridge=40)


@query("join_interval_sites", """
    SELECT region_ord, r.chrom, count(*) AS n_positions, min(pos) AS first_pos, max(pos) AS last_pos
    FROM fx_regions r JOIN ox_pseudobulk p ON r.chrom = p.chrom AND pos BETWEEN start AND "end"
    GROUP BY region_ord, r.chrom""")
def join_interval_sites(t):
    return rg.interval_join(sm.pseudobulk(t.fx_encoded), t.fx_regions).groupBy("region_ord", "chrom").agg(
        F.count(F.lit(1)).alias("n_positions"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
    )


@query("win_cell_and_region_index", """
    SELECT 'region' AS kind, concat(chrom, ':', start, '-', "end") AS name, region_idx AS idx FROM ox_region_index
    UNION ALL
    SELECT 'cell' AS kind, cell AS name, cast(row_number() OVER (ORDER BY cell_idx DESC) - 1 AS int) AS idx FROM fx_all_cells""")
def win_cell_and_region_index(t):
    regions = rg.index_regions(t.fx_regions, sm.pseudobulk(t.fx_encoded))
    cells = rg.index_cells(t.fx_all_cells.select("cell", F.col("cell_idx").alias("ord")), F.desc("ord"))
    return regions.select(F.lit("region").alias("kind"), F.col("region_name").alias("name"), F.col("region_idx").alias("idx")).unionByName(
        cells.select(F.lit("cell").alias("kind"), F.col("cell").alias("name"), F.col("cell_idx").alias("idx"))
    )


@query("agg_region_cell", """
    SELECT region_idx, cell, n_meth, n_total, round(mfrac, 6) AS mfrac, round(resid, 6) AS resid FROM ox_region_cell""")
def agg_region_cell(t):
    smoothed = smoothed_table(t)
    return rg.region_cell(t.fx_encoded, smoothed, rg.index_regions(t.fx_regions, smoothed))


MATRIX_SQL = """
    SELECT cell_idx, region_idx, round(resid, 6) AS residual, round(mfrac, 6) AS mfrac, n_total AS coverage
    FROM ox_region_cell r JOIN fx_all_cells c ON r.cell = c.cell"""


@query("region_matrix", MATRIX_SQL)
def region_matrix(t):
    return me.region_matrix(t.fx_encoded, smoothed_table(t), t.fx_regions, t.fx_all_cells)


@query("region_matrix_of_vmrs", """
    SELECT cell_idx, region_idx,
           round(CASE WHEN count(s) = count(*) THEN (sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) - sum(s)) / (count(*) + 1) END, 6) AS residual,
           round(sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) / count(*), 6) AS mfrac, count(*) AS coverage
    FROM ox_vmr_index v JOIN fx_encoded e ON v.chromosome = e.chrom AND e.pos BETWEEN VMR_start AND VMR_end
    JOIN ox_extent x ON e.chrom = x.chrom AND e.pos < x.l
    JOIN ox_smooth q ON e.chrom = q.chrom AND e.pos = q.pos
    JOIN fx_all_cells c ON e.cell = c.cell GROUP BY cell_idx, region_idx""")
def region_matrix_of_vmrs(t):
    return me.region_matrix(t.fx_encoded, smoothed_table(t), None, t.fx_all_cells, vmrs=scan(t))
