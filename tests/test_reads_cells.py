"""Barcodes, reads, cells, saturation, readers and the incremental pass."""

import gzip
import math
import random

import pytest
from pyspark.sql import functions as F

from epiloom.functions import seq as fx
from epiloom.operators import barcodes as bc
from epiloom.operators import cells as cl
from epiloom.operators import saturation as sat
from epiloom.plans import cells as pc
from epiloom.plans.demux import demux
from epiloom.sinks.tables import general_4
from epiloom.sources import text as tx
from epiloom.streaming.chunks import demux_new_chunks

WHITELIST = ["AAAAA", "AAAGG", "TTTTT", "GATGA"]


def test_barcode_rules(spark):
    observed = spark.createDataFrame(
        [("AAAAA",), ("AAAAG",), ("TTTTG",), ("TTNTT",), ("TNNTT",), ("CCCCC",)], "ocb string"
    )
    listed = spark.createDataFrame([(b,) for b in WHITELIST], "cb string")
    want = {
        "AAAAA": ("AAAAA", "M", "exact"),
        "AAAAG": (None, "", "ambiguous"),
        "TTTTG": ("TTTTT", "4G", "corrected"),
        "TTNTT": ("TTTTT", "2N", "corrected"),
        "TNNTT": (None, "", "rejected"),
        "CCCCC": (None, "", "rejected"),
    }
    for options in ({}, {"max_bytes": 0, "reads_per_salt": 1}, {"max_bytes": 0}):
        got = {r.ocb: (r.cb, r.alt, r.status) for r in bc.assign_barcodes(observed, listed, **options).collect()}
        assert got == want
    off = bc.assign_barcodes(observed, listed, distance=0).where("status = 'exact'")
    assert [r.ocb for r in off.collect()] == ["AAAAA"]
    two = bc.nearest_within(observed.where("ocb <> 'AAAAA'"), listed, 2)
    assert {(r.ocb, r.cb, r.dist) for r in two.collect()} == {
        ("AAAAG", "AAAAA", 1), ("AAAAG", "AAAGG", 1), ("TTTTG", "TTTTT", 1), ("TTNTT", "TTTTT", 1), ("TNNTT", "TTTTT", 2)
    }


def test_correction_tag_lists_every_mismatch(spark):
    row = spark.sql("SELECT 'ACGT' a, 'TCGA' b").select(fx.correction_tag("a", "b").alias("t")).first()
    assert row.t == "0A3T"


def test_rank_rule(spark):
    assert [cl.rank_index(n) for n in (10, 99, 100, 3000)] == [0, 0, 1, 30]
    counts = spark.createDataFrame([("a", 100), ("b", 11), ("c", 10), ("d", 0)], "barcode string, reads long")
    assert sorted(r.barcode for r in pc.call_cells(counts, expected=10).collect()) == ["a", "b"]
    # The rank is clamped to the last barcode.
    assert sorted(r.barcode for r in pc.call_cells(counts, expected=3000).collect()) == ["a", "b", "c"]
    assert [r.barcode for r in pc.call_cells(counts, force=9).collect()] == ["a", "b", "c"]
    for bad in ({"expected": 0}, {"force": 0}):
        with pytest.raises(ValueError):
            pc.call_cells(counts, **bad)


def test_median_is_a_cell(spark):
    for n, want in ((5, 3.0), (4, 2.0)):
        cells = spark.createDataFrame([(f"c{i}", float(i)) for i in range(1, n + 1)], "cell_barcode string, genome_cov double")
        assert cl.median_cell(cells).first().genome_cov == want


def test_seeded_sample_is_stable_and_exact(spark):
    counts = spark.createDataFrame([(f"c{i:03d}", 200) for i in range(300)], "barcode string, reads long")
    have = counts.select(F.col("barcode").alias("cell"))
    draw = lambda seed: [r.barcode for r in cl.sample_cells(counts, have, max_cells=50, seed=seed).collect()]
    assert len(set(draw(1))) == 50 and draw(1) == draw(1) and draw(1) != draw(2)


def test_missing_cells_are_an_error(spark):
    have = spark.createDataFrame([("a",)], "cell string")
    asked = spark.createDataFrame([("a", 0), ("b", 1)], "cell string, ord int")
    with pytest.raises(ValueError, match="b"):
        pc.resolve_cell_list(have, explicit=asked)
    with pytest.raises(ValueError):
        pc.resolve_mode("list", 100)


def test_fragment_depth_merges_mates_and_splits_blocks(spark):
    rows = [("c", "f1", "chr1", [(0, 10), (5, 15)]), ("c", "f2", "chr1", [(8, 12)]), ("c", "f2", "chr1", [(8, 12), (20, 21)])]
    al = spark.createDataFrame(rows, "cell string, read_name string, chrom string, blocks array<struct<start:int,end:int>>")
    depth = [0] * 21
    for name in ("f1", "f2"):
        for p in {p for r in rows if r[1] == name for s, e in r[3] for p in range(s, e)}:
            depth[p] += 1
    want = {d: depth.count(d) for d in set(depth) if d}
    for width in (1_000_000, 4):
        hist = sat.depth_histogram(sat.fragment_depth(al, block_width=width))
        assert {r.depth: r.n_positions for r in hist.collect()} == want


def test_fragment_depth_moves_alignments_once(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):  # one cell holds most, with copies and mates that overlap
        start = rng.randrange(180)
        rows.append(("hot" if i % 4 else f"c{i % 7}", f"f{i % 150}", "chrM", [(start, start + rng.randint(0, 15)), (start + 4, start + 9)]))
    al = spark.createDataFrame(rows + rows[:50], "cell string, read_name string, chrom string, blocks array<struct<start:int,end:int>>")
    covered = {}
    for cell, name, _, blocks in rows:
        for s, e in blocks:
            for p in range(s, e):
                covered.setdefault((cell, p), set()).add(name)
    for width in (1_000_000, 7):
        runs = sat.fragment_depth(al, block_width=width)
        got = {(r.cell, p): r.depth for r in runs.collect() for p in range(r.start, r.end)}
        assert got == {k: len(v) for k, v in covered.items()}
    physical = runs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert physical.count("Exchange hashpartitioning") == 2
    assert sat.fragment_depth(al.limit(0)).count() == 0


def test_saturation_fit_recovers_a_curve(spark):
    points = spark.createDataFrame(
        [("curved", f, 0.4 * (1 - math.exp(-3 * f))) for f in sat.FRACTIONS] + [("straight", f, 0.2 * f) for f in sat.FRACTIONS],
        "sample_id string, fraction double, median double",
    )
    fits = {r.sample_id: r for r in sat.saturation_fit(sat.linear_fit(points, by=("sample_id",))).collect()}
    assert fits["curved"].best.a == pytest.approx(0.4, rel=1e-2) and fits["curved"].best.b == pytest.approx(3, rel=1e-2)
    assert fits["straight"].linear_r2 == pytest.approx(1) and fits["straight"].slope == pytest.approx(0.2)
    assert fits["curved"].linear_r2 < 0.99


def test_four_digit_numbers(spark):
    values = [0.0, 0.5, -0.123456, 0.15625, 1234.5678, 12345.678, 0.00012345, 0.000012345, 1.0, float("nan"), 0.99999]
    got = [r.t for r in spark.createDataFrame([(v,) for v in values], "v double").select(general_4("v").alias("t")).collect()]
    assert got == ["" if math.isnan(v) else f"{v:.4g}" for v in values]


def test_readers_on_real_file_names(spark, tmp_path):
    for cell in ("AAT", "GGT"):
        with gzip.open(tmp_path / f"{cell}_allc.gz", "wt") as out:
            out.write("# x\nchr1\t5\t+\tCGA\t1\t2\t1\nchr1\tbad\t+\tCGA\t1\t2\t1\nshort\t1\n")
    sites = tx.read_sites(spark, str(tmp_path / "*_allc.gz"))
    assert sorted((r.cell, r.pos, r.cov) for r in sites.collect()) == [("AAT", 5, 2), ("GGT", 5, 2)]
    with pytest.raises(Exception, match="bad site row"):
        tx.read_sites(spark, str(tmp_path / "*_allc.gz"), mode="fail").collect()
    cl.reject_duplicates(tx.site_files(spark, str(tmp_path / "*_allc.gz")))
    empty = tmp_path / "empty.bed"
    empty.write_text("# nothing\n")
    with pytest.raises(ValueError):
        tx.read_bed(spark, str(empty))


def test_read_pairs_report_broken_input(spark, tmp_path):
    record = "@r{0} 1\nACGT\n+\nIIII\n"
    for name, n1, n2 in (("good", 3, 3), ("bad", 3, 2)):
        for mate, n in (("R1", n1), ("R2", n2)):
            with gzip.open(tmp_path / f"{name}.{mate}.fq.gz", "wt") as out:
                out.write("".join(record.format(i) for i in range(n)))
    pair = lambda name: tx.read_pairs(spark, str(tmp_path / f"{name}.R1.fq.gz"), str(tmp_path / f"{name}.R2.fq.gz"))
    rows = pair("good").orderBy("rid").collect()
    assert [(r.chunk_id, r.rid, r.r1_header, r.r2_header) for r in rows] == [("good", i, f"@r{i} 1", f"@r{i} 1") for i in range(3)]
    with pytest.raises(Exception, match="unequal mates"):
        pair("bad").collect()


def test_read_pairs_over_several_files_of_a_chunk(spark, tmp_path):
    """Mates cut into files at different places, also inside a record: the lines of a chunk go on over its files."""
    text = {m: "".join(f"@r{i} {m}\n{'ACGT'[i % 4]}\n+\n{i}\n" for i in range(50)).splitlines(keepends=True) for m in (1, 2)}
    for mate, cuts in ((1, (0, 30, 200)), (2, (0, 81, 82, 150, 200))):
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            with gzip.open(tmp_path / f"c_R{mate}_{n:03d}.fq.gz", "wt") as out:
                out.write("".join(text[mate][a:b]))
    rows = tx.read_pairs(spark, str(tmp_path / "c_R1*"), str(tmp_path / "c_R2*")).orderBy("rid").collect()
    assert [(r.chunk_id, r.rid, r.r1_header, r.r2_header, r.r2_qual) for r in rows] == [
        ("c", i, f"@r{i} 1", f"@r{i} 2", str(i)) for i in range(50)]


def test_new_chunks_are_processed_once(spark, tmp_path):
    from catalog.fixtures import spark_fixture

    sf = "/root/testdata/sf0.001"
    reads, listed = spark_fixture(spark, sf, "fx_reads"), spark_fixture(spark, sf, "fx_whitelist")
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run():
        stream = demux_new_chunks(spark, source, listed, out, mark, prefix_bases=2)
        stream.awaitTermination()
        return spark.read.parquet(f"{out}/funnel").select(F.sum("funnel.total")).first()[0]

    first = reads.where("chunk_id = '0001'")
    first.coalesce(1).write.parquet(source)
    assert run() == first.count()
    reads.where("chunk_id = '0002'").coalesce(1).write.mode("append").parquet(source)
    assert run() == reads.count()
    assert run() == reads.count()
    funnel = spark.read.parquet(f"{out}/funnel").select("funnel.*").collect()
    for f in funnel:
        p = f.barcode_passed
        assert f.total == f.barcode_rejected + f.barcode_ambiguous + p.total
        assert p.total == p.unknown_chain + p.too_short + p.chimeric_filtered.total + p.valid.total


def test_sidecars_by_their_own_headers(spark, tmp_path):
    from epiloom.sources.reports import read_context_counts

    (tmp_path / "AAA_allc.gz.count.csv").write_text(",mc,cov,number\nCGA,1,10,5\n")
    (tmp_path / "BBB_allc.gz.count.csv").write_text(",cov,mc,number,extra\nCGA,10,1,5,0.5\n\n")
    got = {r.cell: (r.context, r.mc, r["cov"], r.number, r.extra) for r in read_context_counts(spark, str(tmp_path)).collect()}
    assert got == {"AAA": ("CGA", 1, 10, 5, None), "BBB": ("CGA", 1, 10, 5, 0.5)}


def test_fit_without_points_is_null(spark):
    from epiloom.operators import saturation as sat
    from epiloom.plans.saturation import summarize_fit

    none = spark.createDataFrame([], "fraction double, median double")
    row = summarize_fit(sat.saturation_fit(sat.linear_fit(none))).first()
    assert row.asDict() == dict.fromkeys(row.asDict())


def test_all_good_cells_by_default(spark):
    from epiloom.operators import cells as cl

    counts = spark.createDataFrame([(f"b{i}", 200) for i in range(150)], "barcode string, reads long")
    assert cl.sample_cells(counts, counts.selectExpr("barcode AS cell")).count() == 150


def test_short_rows_do_not_count_as_mitochondrial(spark):
    from epiloom.operators.sites import mito_rate

    rows = [("a", "chrM", "CGA", 1, 2, 7), ("a", "chrM", "CGA", 5, 5, 6)]
    got = mito_rate(spark.createDataFrame(rows, "cell string, chrom string, context string, mc long, cov long, n_fields int")).first()
    assert (got.mito_mc, got.mito_cov) == (1, 2)


def test_frequent_barcodes_are_salted_whatever_their_status(spark):
    """A third of the reads each on an exact, a corrected and a rejected barcode: every read once, with several salts."""
    rows = [(i, b) for i, b in enumerate(["AAAAA", "TTTTG", "CCCCC"] * 200 + ["GGGGG"])]
    reads = spark.createDataFrame(rows, "rid int, ocb string").repartition(3)
    listed = spark.createDataFrame([("AAAAA",), ("TTTTT",), ("GGGGG",)], "cb string")
    want = {"AAAAA": ("AAAAA", "exact"), "TTTTG": ("TTTTT", "corrected"), "CCCCC": (None, "rejected"), "GGGGG": ("GGGGG", "exact")}
    joined = bc.assign_barcodes(reads, listed, max_bytes=0, reads_per_salt=20)
    assert sorted((r.rid, r.ocb, r.cb, r.status) for r in joined.collect()) == [(i, b, *want[b]) for i, b in rows]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and plan.count("LocalRelation") <= 2  # the reads once


def test_demux_scans_the_reads_twice_and_trims_once(spark, tmp_path, monkeypatch):
    source = spark.createDataFrame(
        [(f"{i % 2:04d}", i, f"@r{i} 1", "AAAAA" + "ACGT" * 30, "I" * 125, f"@r{i} 2", "TTAG" * 30, "I" * 120) for i in range(40)],
        "chunk_id string, rid bigint, r1_header string, r1_seq string, r1_qual string, r2_header string, r2_seq string, r2_qual string")
    source.write.parquet(str(tmp_path / "reads"))
    trims = []
    real = fx.trim_adapters
    monkeypatch.setattr(fx, "trim_adapters", lambda df: trims.append(1) or real(df))
    result = demux(spark.read.parquet(str(tmp_path / "reads")), spark.createDataFrame([("AAAAA",)], "cb string"), structure="B5U4")
    assert len(trims) == 1
    for table in (result.valid, result.evidence, result.funnel, result.reads):
        assert str(tmp_path / "reads") not in table._jdf.queryExecution().optimizedPlan().toString()
        assert not any("reads" in f for f in table.inputFiles() if f.startswith(f"file:{tmp_path}"))
    assert result.reads.count() == 40 and result.reads.where("fate <> 'valid' AND r1_seq IS NOT NULL").count() == 0


def test_delimited_files_are_read_in_splits_by_their_own_header(spark, tmp_path):
    from epiloom.sources import reports as rp

    keys = [(f"k{i}", f"v{i}") for i in range(3000)]
    (tmp_path / "a.csv").write_text("﻿m_cb,gex_cb\r\n" + "".join(f"{k},{v}\r\n" for k, v in keys[:2000]))
    (tmp_path / "b.csv").write_text('gex_cb,note,m_cb\n\n' + "".join(f'{v},"x,y",{k}\n' for k, v in keys[2000:]) + " v,,\n")
    (tmp_path / "c.csv").write_text("")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        read = rp.read_key_map(spark, str(tmp_path), "m_cb", "gex_cb")
        assert sorted(map(tuple, read.collect())) == sorted(keys)
        assert read.rdd.getNumPartitions() > 3  # more tasks than files
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_seeded_cells_query_returns_every_good_cell(spark):
    from catalog.all_queries import QUERIES
    from catalog.fixtures import spark_sql

    data = "/root/testdata/sf0.01"
    good = spark_sql(spark, data, "SELECT barcode FROM fx_totals WHERE reads > 100").count()
    assert QUERIES["smp_seeded_cells"](spark, data).count() == good == 100


def test_a_file_for_every_cell_is_written_by_many_tasks(spark, tmp_path):
    import re

    from catalog import q_sources
    from catalog.registry import Tables

    class Here(Tables):
        def path(self, name):
            return str(tmp_path / name)

    read = q_sources.src_cell_from_filename(Here(spark, "/root/testdata/sf0.001"))
    files = list((tmp_path / "files").glob("file=*/part-*"))
    assert read.count() == len(files) and read.where("n_rows = 1").count() == len(files)
    assert len({re.search(r"part-(\d+)", f.name)[1] for f in files}) > 1


def test_the_expanded_dictionary_is_never_broadcast(spark):
    from epiloom.session import broadcast_if_small

    observed = spark.createDataFrame([("AAAAC",), ("TTCCT",), ("CCCCC",)], "ocb string")
    listed = spark.createDataFrame([(b,) for b in WHITELIST], "cb string")
    found = bc.nearest_within(observed, listed, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {tuple(r) for r in found.collect()} == {("AAAAC", "AAAAA", 1), ("TTCCT", "TTTTT", 2)}
    large, fits = broadcast_if_small(listed, 1)
    assert not fits and "Broadcast" not in observed.join(large, F.col("ocb") == F.col("cb"))._jdf.queryExecution().executedPlan().toString()


def test_one_substitution_is_found_without_a_broadcast_or_moved_candidates(spark):
    rng = random.Random(5)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    listed = {draw("ACG", n) for n in (1, 2, 5, 5, 5, 6, 6) for _ in range(40)} | {"ANA", "acg"}
    seen = {draw("ACGTN", n) for n in (1, 2, 3, 5, 6) for _ in range(120)} - listed
    near = lambda a, b: len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
    want = {}
    for o in seen:
        hits = [w for w in listed if near(o, w) and all(y in "ACGT" for x, y in zip(o, w) if x != y) and ("N" not in o or o.index("N") == next(i for i in range(len(o)) if o[i] != w[i]))]
        if hits:
            want[o] = (len(hits), hits[0] if len(hits) == 1 else None)
    found = bc.correct_hamming1(spark.createDataFrame([(o,) for o in seen], "ocb string"), spark.createDataFrame([(w,) for w in listed], "cb string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "ShuffledHashJoin" in plan
    assert all("masked" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert {r.ocb: (r.n_hits, r.cb) for r in found.collect()} == want and len(want) >= 40


def test_demux_decides_and_counts_from_its_written_table(spark, tmp_path, monkeypatch):
    """The reads are made once: barcodes are counted in the judged table, and evidence and counters read no sequence."""
    source = spark.createDataFrame(
        [("0001", i, f"@r{i} 1", ("AAAAA" if i % 2 else "CCCCC") + "ACGT" * 30, "I" * 125, f"@r{i} 2", "TTAG" * 30, "I" * 120) for i in range(40)],
        "chunk_id string, rid bigint, r1_header string, r1_seq string, r1_qual string, r2_header string, r2_seq string, r2_qual string")
    source.write.parquet(str(tmp_path / "source"))
    plans = []
    real = bc.barcode_histogram
    monkeypatch.setattr(bc, "barcode_histogram", lambda reads, *a: plans.append(reads._jdf.queryExecution().executedPlan().toString()) or real(reads, *a))
    result = demux(spark.read.parquet(str(tmp_path / "source")), spark.createDataFrame([("AAAAA",)], "cb string"), structure="B5U4")
    assert plans and not any(str(tmp_path / "source") in p for p in plans)
    for table in (result.evidence, result.funnel):
        assert "r1_seq" not in table._jdf.queryExecution().executedPlan().toString()
    rejected = result.reads.where("fate = 'rejected'")
    assert rejected.count() == 20 and rejected.where("r1_seq IS NOT NULL OR cb IS NOT NULL").count() == 0
