"""Distributed ranks, interval bins, halo blocks and the store layout: results by brute force, and the plans they promise."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiloom.operators import ranks as rk
from epiloom.operators import regions as rg
from epiloom.operators import windows as wn
from epiloom.operators.cells import median_cell
from epiloom.operators.position_join import STORE_WIDTH, join_sites
from epiloom.sinks import tables as sk


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_over_many_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.randrange(50), i) for i in range(3000)]  # a third share a key, values tie
    frame = spark.createDataFrame(rows, "g string, v int, i int").repartition(5)
    got = [tuple(r) for r in rk.with_rank(frame, ["g", F.desc("v"), "i"]).orderBy("rank").collect()]
    assert [r[:3] for r in got] == sorted(rows, key=lambda r: (r[0], -r[1], r[2]))
    assert [r[3] for r in got] == list(range(3000))
    assert "Window" not in plan_of(rk.with_rank(frame, ["v"]))
    assert rk.with_rank(frame.limit(0), ["v"]).count() == 0


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.98, 1.0])
def test_quantiles_against_numpy(spark, q):
    rng = np.random.default_rng(8)
    rows = [(g, float(v)) for g, n in (("a", 1000), ("b", 1), ("c", 17)) for v in rng.normal(size=n).round(1)]
    frame = spark.createDataFrame([*rows, ("a", None), ("none", None)], "g string, v double").repartition(3)
    got = {r.g: r["quantile"] for r in rk.quantile(frame, "v", q, by=["g"]).collect()}
    want = {g: np.quantile([v for h, v in rows if h == g], q) for g in "abc"}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-12 for g in want)
    assert abs(rk.quantile(frame, "v", q).first()[0] - np.quantile([v for _, v in rows], q)) < 1e-12
    assert rk.quantile(frame.limit(0), "v", q).count() == 0


def test_median_cell_of_each_sample(spark):
    rows = [("s1", f"c{i}", float(i % 4)) for i in range(9)] + [("s2", "x", 1.0), ("s2", "y", None)]
    frame = spark.createDataFrame(rows, "sample_id string, cell_barcode string, genome_cov double")
    got = {r.sample_id: r.cell_barcode for r in median_cell(frame, by=["sample_id"]).collect()}
    s1 = sorted((r for r in rows if r[0] == "s1"), key=lambda r: (-r[2], r[1]))
    assert got == {"s1": s1[4][1], "s2": "x"}


def test_interval_bins(spark):
    rng = random.Random(6)
    positions = sorted(rng.sample(range(1, 300_000), 30_000))
    regions = [("chr1", s, s + n - 1, n) for n in (1, 2, 3, 5, 100, 1000, 40_000) for s in rng.sample(range(1, 250_000), 60)]
    regions += [("chr1", 500, 499, 0), ("chr1", 700, 799, 100), ("chr1", 700, 799, 100), ("chr9", 1, 10, 10)]
    p = spark.createDataFrame([("chr1", x) for x in positions], "chrom string, pos int")
    r = spark.createDataFrame(regions, "chrom string, start int, end int, n int")
    joined = rg.interval_join(p, r)
    got = sorted((x.start, x.end, x.pos) for x in joined.collect())
    want = sorted((s, e, x) for c, s, e, _ in regions if c == "chr1" for x in positions if s <= x <= e)
    assert got == want
    hundred = [x for x in regions if x[3] == 100]
    width = 16  # the widest bins of at most 50
    looked_at = sum(sum(s // width <= x // width <= e // width for x in positions) for _, s, e, _ in hundred)
    assert looked_at <= 2 * sum(s <= x <= e for _, s, e, _ in hundred for x in positions)


@pytest.fixture(scope="module")
def sites(spark):
    rng = random.Random(2)
    rows = sorted({(f"chr{1 + (rng.random() < 0.2)}", rng.randrange(1, 3000) * 7, f"c{rng.randrange(9)}", rng.choice([1, -1])) for _ in range(6000)})
    rows = list({r[:3]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "chrom string, pos int, cell string, m int")
    smoothed = df.groupBy("chrom", "pos").agg(F.count("*").alias("n_obs"), F.avg((F.col("m") > 0).cast("double")).alias("smoothed"))
    return rows, df, smoothed


@pytest.mark.parametrize("width, salt_rows", [(1 << 17, 10**9), (900, 400), (64, 50)])
def test_halo_blocks_give_whole_windows(sites, width, salt_rows):
    """The same sums with one block, and with windows that reach over many borders."""
    rows, df, smoothed = sites
    half, step = 100, 30
    sums = wn.window_cell_sums(df, smoothed, half, step, block_width=width, rows_per_salt=salt_rows)
    got = {(r.chrom, r.win, r.cell): (r.n, r.meth) for r in sums.collect()}
    want = {}
    for chrom in ("chr1", "chr2"):
        own = [r for r in rows if r[0] == chrom]
        first, last = min(r[1] for r in own), max(r[1] for r in own)
        for k, center in enumerate(range(first + half + 1, last - half - 1, step)):
            for _, pos, cell, m in own:
                if center - half <= pos <= center + half:
                    n, meth = want.get((chrom, k, cell), (0, 0))
                    want[chrom, k, cell] = (n + 1, meth + (m > 0))
    assert got == want


def test_no_exchange_by_window_and_cell(sites):
    _, df, smoothed = sites
    variance = wn.window_variance(wn.window_residuals(df, smoothed, 100, 30))
    keys = [re.findall(r"(\w+)#", k) for k in re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(variance))]
    assert keys and not any({"win", "cell"} <= set(k) for k in keys)
    assert ["chrom", "block", "salt"] in keys and ["chrom", "win"] in keys


def test_sites_are_filtered_before_their_shuffle(sites):
    rows, df, smoothed = sites
    few = smoothed.where("pos BETWEEN 7000 AND 7100 OR pos = 14")
    joined = join_sites(df, few.withColumn("n_obs", F.col("n_obs").cast("long")))
    assert joined.count() == sum(7000 <= r[1] <= 7100 or r[1] == 14 for r in rows)
    plan = plan_of(joined)
    assert "bit_get" in plan.lower() or "getbit" in plan.lower()


def test_store_is_pruned_by_stretch(spark, tmp_path):
    rows = [("chr1", k * STORE_WIDTH + i, f"c{i % 3}", 1) for k in range(6) for i in (0, 5, 100, STORE_WIDTH - 3)] + [("chr2", 9, "c1", -1)]
    df = spark.createDataFrame(rows, "chrom string, pos int, cell string, m int")
    sk.write_site_store(df, str(tmp_path / "store"))
    store = spark.read.parquet(str(tmp_path / "store"))
    assert sorted(tuple(r) for r in store.select("chrom", "pos", "cell", "m").collect()) == sorted(rows)
    for path in (tmp_path / "store").glob("chrom=*/stretch=*/*.parquet"):
        stretch = int(path.parent.name.split("=")[1])
        pos = [r.pos for r in spark.read.parquet(str(path)).collect()]
        assert pos == sorted(pos) and {p // STORE_WIDTH for p in pos} == {stretch}
    wanted = spark.createDataFrame([("chr1", 2 * STORE_WIDTH + 5, 1), ("chr1", 4 * STORE_WIDTH, 1)], "chrom string, pos int, n_obs long")
    joined = join_sites(store, wanted)
    assert sorted(r.pos for r in joined.collect()) == [2 * STORE_WIDTH + 5, 4 * STORE_WIDTH]
    assert "dynamicpruning" in plan_of(joined)
    half = 200  # over the border of two directories
    dim = spark.createDataFrame([("chr1", 2 * STORE_WIDTH, 1, b) for b in (127, 128)], "chrom string, pos int, n_obs long, block int")
    assert {(r.pos, r.block) for r in join_sites(store, dim, halo=half).collect()} == {(2 * STORE_WIDTH, 127), (2 * STORE_WIDTH, 128)}


def test_dense_tables_of_many_regions_and_a_repeated_one(spark, tmp_path):
    """25,000 regions, one listed twice: every cell has every region, in order, and the files are whole."""
    n, cells = 25_000, ["c0", "c1", "empty"]
    listed = [(i, "chr1", 10 * (i % (n - 1)), 10 * (i % (n - 1)) + 9, f"chr1:{10 * (i % (n - 1))}-{10 * (i % (n - 1)) + 9}") for i in range(n)]
    regions = spark.createDataFrame(listed, "region_idx int, chrom string, start int, end int, region_name string")
    rows = [(i, c, 0.5, float("nan") if i % 1000 == 0 else 0.25, i + 1, i) for i in range(0, n, 250) for c in ("c0", "c1") if i % 500 == 0 or c == "c0"] + [(n - 1, "c1", 1.0, 0.1, 3, 3)]
    found = spark.createDataFrame(rows, "region_idx int, cell string, mfrac double, resid double, n_total long, n_meth long")
    names = spark.createDataFrame(list(enumerate(cells)), "cell_idx int, cell string")
    tables = rg.dense_tables(found, names, regions)
    want = {(c, i): (f, r, t, m) for i, c, f, r, t, m in rows}
    for number, (name, table) in enumerate(tables.items()):
        got = {}
        for r in table.collect():
            got.update({(r.cell, r.block * rg.COLUMN_BLOCK + k): v for k, v in enumerate(r["values"])})
        none = None if name == "mean_shrunken_residuals" else 0
        nan_as_null = lambda v: None if v != v else v
        assert got == {(c, i): nan_as_null(want[c, i][number]) if (c, i) in want else none for c in cells for i in range(n)}
    sk.write_dense_matrix({"total_sites": tables["total_sites"]}, regions, str(tmp_path))
    files = sorted((tmp_path / "total_sites.csv").glob("part-*"))
    lines = [line for f in files for line in __import__("gzip").open(f, "rt").read().splitlines()]
    assert lines[0].split(",") == ["cell", *[r[4] for r in listed]]
    assert [x.split(",")[0] for x in lines[1:]] == cells and all(len(x.split(",")) == n + 1 for x in lines)


def test_site_join_has_as_many_partitions_as_its_load_needs(spark):
    """A small shuffle of many copies is not joined into few tasks."""
    sites = spark.range(4000).selectExpr("if(id % 2 = 0, 'chr1', 'chr2') AS chrom", "cast(id % 40 AS int) AS pos", "concat('c', id div 40) AS cell", "1 AS m")
    positions = spark.range(40).selectExpr("if(id % 2 = 0, 'chr1', 'chr2') AS chrom", "cast(id AS int) AS pos", "100L AS n_obs", "0.5D AS smoothed")
    joined = join_sites(sites, positions, rows_per_salt=100)
    assert joined.count() == 4000
    sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 1000 and joined.rdd.getNumPartitions() == 80
