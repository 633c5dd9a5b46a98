"""Smoothing, scan and matrices against brute force in numpy on a small random data set."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiloom.operators import regions as rg
from epiloom.operators import sites as st
from epiloom.operators import smoothing as sm
from epiloom.operators import windows as wn
from epiloom.plans import methylation as me
from epiloom.session import materialize

H, W, STEP = 20, 30, 7


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    rows = set()
    for chrom, last in (("chr1", 900), ("chr2", 400), ("chr3", 1)):
        for pos in sorted(rng.choice(np.arange(50, 50 + last), size=max(1, last // 4), replace=False)):
            for cell in rng.choice(12, size=rng.integers(1, 8), replace=False):
                meth = rng.random() < (0.2 if (pos // 100 + cell) % 3 else 0.8)
                rows.add((chrom, int(pos), f"c{cell:02d}", 1 if meth else -1))
    df = materialize(spark.createDataFrame(sorted(rows), "chrom string, pos int, cell string, m tinyint"), "t")
    return sorted(rows), df, materialize(me.smooth_store(df, 2 * H), "s")


def brute_smooth(rows):
    out = {}
    for chrom in {r[0] for r in rows}:
        by_pos = {}
        for c, p, _, m in rows:
            if c == chrom:
                by_pos.setdefault(p, []).append(m > 0)
        top = max(by_pos)
        for p in by_pos:
            near = [(np.mean(v), (1 - (abs(q - p) / H) ** 3) ** 3) for q, v in by_pos.items() if abs(q - p) < H]
            value = sum(f * k for f, k in near) / sum(k for _, k in near)
            out[chrom, p] = value if p >= H and p + H <= top + 1 else np.nan
    return out


def brute_residuals(rows, smooth, chrom, lo, hi):
    cells = {}
    for c, p, cell, m in rows:
        if c == chrom and lo <= p <= hi:
            cells.setdefault(cell, []).append((m > 0) - smooth[c, p])
    return {cell: sum(v) / (len(v) + 1) for cell, v in cells.items()}


def test_smooth(data):
    rows, _, smoothed = data
    want = brute_smooth(rows)
    got = {(r.chrom, r.pos): r.smoothed for r in smoothed.collect()}
    assert got.keys() == want.keys()
    np.testing.assert_allclose([got[k] for k in want], [want[k] for k in want], equal_nan=True)


@pytest.mark.parametrize("options", [{}, {"block_width": 64, "rows_per_salt": 20}])
def test_window_variance_and_salting(data, options):
    """The same numbers with one block per chromosome and with many salted blocks."""
    rows, df, smoothed = data
    smooth = brute_smooth(rows)
    var = wn.window_variance(wn.window_residuals(df, smoothed, W, STEP, **options))
    got = {(r.chrom, r.win): r.variance for r in var.collect()}
    want = {}
    for chrom in ("chr1", "chr2", "chr3"):
        pos = [p for c, p, _, _ in rows if c == chrom]
        for k, center in enumerate(range(min(pos) + W + 1, max(pos) - W - 1, STEP)):
            resid = [v for v in brute_residuals(rows, smooth, chrom, center - W, center + W).values() if not np.isnan(v)]
            if resid:
                want[chrom, k] = np.var(resid)
    assert got.keys() == want.keys()
    np.testing.assert_allclose([got[k] for k in want], [want[k] for k in want])


def test_scan_finds_variable_regions_and_respects_min_cells(data):
    rows, df, smoothed = data
    smooth = brute_smooth(rows)
    vmrs = me.scan_vmrs(df, smoothed, bandwidth=2 * W, stepsize=STEP, var_threshold=0.1, min_cells=2).collect()
    assert vmrs
    for v in vmrs:
        resid = brute_residuals(rows, smooth, v.chromosome, v.VMR_start, v.VMR_end)
        assert v.n_cells == len(resid) >= 2
        assert v.variance == pytest.approx(np.var([x for x in resid.values() if not np.isnan(x)]))
        assert v.n_sites == len({p for c, p, _, _ in rows if c == v.chromosome and v.VMR_start <= p <= v.VMR_end})
    ordered = sorted((v.chromosome, v.VMR_start, v.VMR_end) for v in vmrs)
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(ordered, ordered[1:]))
    with pytest.raises(RuntimeError):
        me.scan_vmrs(df, smoothed, bandwidth=2 * W, stepsize=STEP, var_threshold=0.1, min_cells=100)


def test_tiled_regions_reproduce_cell_counts(spark, data):
    """Tiles over everything give the per-cell totals; without the last site of each chromosome by default."""
    rows, df, smoothed = data
    tiles = spark.createDataFrame(
        [(i, c, s, s + 99) for i, (c, s) in enumerate((c, s) for c in ("chr1", "chr2", "chr3", "chrZ") for s in range(0, 1100, 100))],
        "region_ord int, chrom string, start int, end int",
    )
    indexed = rg.index_regions(tiles, smoothed)
    assert {r.chrom for r in indexed.select("chrom").distinct().collect()} == {"chr1", "chr2", "chr3"}
    for last, total in ((True, len(rows)), (False, len(rows) - sum(
        p == max(q for d, q, _, _ in rows if d == c) for c, p, _, _ in rows))):
        cells = rg.region_cell(df, smoothed, indexed, include_last_site=last)
        assert cells.agg(F.sum("n_total")).first()[0] == total
    assert [r.chrom for r in me.missing_chromosomes(tiles, smoothed).collect()] == ["chrZ"]


def test_several_samples_at_once(spark, data):
    _, df, smoothed = data
    both = df.withColumn("sample_id", F.explode(F.array(F.lit("a"), F.lit("b"))))
    by = ("sample_id",)
    again = materialize(me.smooth_store(both, 2 * H, by=by), "s2")
    one = me.scan_vmrs(df, smoothed, bandwidth=2 * W, stepsize=STEP, var_threshold=0.1, min_cells=2)
    two = me.scan_vmrs(both, again, bandwidth=2 * W, stepsize=STEP, var_threshold=0.1, min_cells=2, by=by)
    key = lambda r: (r.chromosome, r.VMR_start, r.VMR_end, r.n_sites, r.n_cells)
    want = sorted(map(key, one.collect()))
    for sample in ("a", "b"):
        assert sorted(map(key, two.where(F.col("sample_id") == sample).collect())) == want


def test_parameters_are_checked(data):
    _, df, smoothed = data
    with pytest.raises(ValueError):
        me.smooth_store(df, 41)
    assert me.smooth_store(df, 41, strict_compat=True).where(~F.isnan("smoothed")).count() == 0
    for bad in ({"bandwidth": 0}, {"stepsize": 0}, {"var_threshold": 2}, {"min_cells": 0}, {"bridge_gaps": -1}):
        with pytest.raises(ValueError):
            me.scan_vmrs(df, smoothed, **bad)


def test_encoding_and_empty_cells(spark):
    sites = spark.createDataFrame(
        [("chr1", 1, "a", 3, 3), ("chr1", 2, "a", 0, 2), ("chr1", 3, "a", 1, 2), ("chr1", 4, "a", 2, 3), ("chr1", 5, "a", 0, 0)],
        "chrom string, pos int, cell string, mc long, cov long",
    )
    assert [(r.pos, r.m) for r in st.encode_sites(sites).orderBy("pos").collect()] == [(1, 1), (2, -1)]
    rounded = st.encode_sites(sites, round_sites=True).orderBy("pos").collect()
    assert [(r.pos, r.m) for r in rounded] == [(1, 1), (2, -1), (4, 1)]
    stats = st.cell_stats(st.encode_sites(sites), spark.createDataFrame([("a",), ("empty",)], "cell string"))
    assert {r.cell_name: (r.n_obs, r.n_meth, r.global_meth_frac) for r in stats.collect()} == {
        "a": (2, 1, 0.5), "empty": (0, 0, 0.0)
    }
