"""Sources and sinks: tables are written in each format by Spark and read back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from epiloom.operators import cells as cl
from epiloom.operators import regions as rg
from epiloom.operators import smoothing as sm
from epiloom.operators.demux import pool_funnels
from epiloom.operators.ranks import with_rank
from epiloom.plans import methylation as me
from epiloom.session import freed_shuffles
from epiloom.sinks import tables as sk
from epiloom.sources import reports as rp
from epiloom.sources import text as tx

from .fixtures import FIXTURES
from .q_reads import FUNNEL_FLAT, POOL_SQL, demuxed
from .q_scan import BANDWIDTH, scan, smoothed_table
from .registry import query

FIXTURES["ox_ct_lines"] = "SELECT CR, UB, C, T FROM ox_evidence"


READS_PER_FILE = 250_000  # of one mate, so that its reader's task stays small


def lines(*columns, sep="\t"):
    return F.concat_ws(sep, *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns]).alias("value")


def dealt(df, *keys):
    """Rows by ``keys`` over as many tasks as a shuffle has: few bytes may be many files, which one task would write one after another."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def write_lines(df, path, *parts):
    (df.write.partitionBy(*parts) if parts else df.write).text(path)
    return path


@query("src_read_pairs", """
    SELECT chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY rid) - 1 AS rid, r1_header, r1_seq, r1_qual, r2_header, r2_seq, r2_qual
    FROM fx_reads""")
def src_read_pairs(t):
    """Both mates as compressed FASTQ, a chunk in several files in the order of its reads."""
    paths, first, last = {}, F.min("rid").alias("first"), F.max("rid").alias("last")
    span = t.fx_reads.agg(first, last, F.count(F.lit(1)).alias("n")).first()
    if not span.n:
        return t.fx_reads
    # places by arithmetic on the reads' numbers: a range partitioning would make every read once more for its sample
    parts = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), span.n // READS_PER_FILE + 1)
    place = F.floor((F.col("rid") - span.first) / F.lit(float(span.last - span.first + 1)) * parts)
    for mate in ("r1", "r2"):
        paths[mate] = t.path(mate)
        record = F.concat_ws("\n", f"{mate}_header", f"{mate}_seq", F.lit("+"), f"{mate}_qual").alias("value")
        dealt_out = t.fx_reads.repartitionById(parts, F.least(place, F.lit(parts - 1)).cast("int")).sortWithinPartitions("chunk_id", "rid")
        with freed_shuffles(t.spark):
            dealt_out.select("chunk_id", record).write.partitionBy("chunk_id").option("compression", "gzip").text(paths[mate])
    return tx.read_pairs(t.spark, paths["r1"], paths["r2"], chunk_pattern="chunk_id=([0-9]+)/")


@query("src_barcode_list", "SELECT 'dictionary' AS kind, cb AS name FROM fx_whitelist UNION ALL SELECT 'list' AS kind, cell AS name FROM fx_all_cells")
def src_barcode_list(t):
    messy = t.fx_whitelist.select(F.explode(F.array(
        F.concat(F.lit(" "), F.lower("cb"), F.lit("\t")), F.col("cb"), F.concat(F.lit("# "), "cb"), F.lit("")
    )).alias("value"))
    dictionary = tx.read_whitelist(t.spark, write_lines(messy, t.path("whitelist")))
    listed = tx.read_barcode_list(
        t.spark, write_lines(t.fx_all_cells.select(lines("cell", "cell_idx", sep=",")), t.path("cells"))
    )
    return dictionary.select(F.lit("dictionary").alias("kind"), F.col("cb").alias("name")).unionByName(
        listed.select(F.lit("list").alias("kind"), F.col("cell").alias("name"))
    )


def write_sites(t, table):
    good = table.select("cell", lines("chrom", "pos", "strand", "context", "mc", "cov", F.lit("1")))
    junk = table.where("pos % 500 = 0").select("cell", F.explode(F.array(
        F.lit("# comment"), lines("chrom", F.lit("x"), "strand", "context", "mc", "cov"), lines("chrom", "pos"), F.lit("")
    )).alias("value"))
    return write_lines(dealt(good.unionByName(junk), "cell"), t.path("sites"), "cell")


@query("src_allc_sites", "SELECT cell, chrom, pos, strand, context, mc, cov, cast(7 AS int) AS n_fields FROM fx_sites")
def src_allc_sites(t):
    return tx.read_sites(t.spark, write_sites(t, t.fx_sites), cell_pattern="cell=([^/]+)/")


@query("src_cell_from_filename", """
    SELECT concat(cell, suffix) AS cell, kind, 1 AS n_rows FROM fx_all_cells,
           (VALUES ('', 'sites'), ('', 'counts'), ('.x', 'sites')) AS v(suffix, kind)""")
def src_cell_from_filename(t):
    """Files of every kind, one a cell, written and read: the cell comes from the path of the file that holds the row."""
    path = t.path("files")
    names = F.explode(F.array(*[F.struct(F.concat("cell", F.lit(end)).alias("file"), F.lit(kind).alias("kind")) for end, kind in (
        ("_allc.gz", "sites"), ("_allc.gz.count.csv", "counts"), (".x_allc.gz", "sites"))]))
    files = t.fx_all_cells.select(names.alias("n")).select("n.file", F.col("n.kind").alias("value"))
    write_lines(dealt(files, "file"), path, "file")
    read = t.spark.read.option("recursiveFileLookup", True).text(path).select(
        tx.cell_from_path(F.regexp_extract(F.col("_metadata.file_path"), "^(.*/file=[^/]+)/", 1)).alias("cell"), F.col("value").alias("kind"))
    return read.groupBy(F.replace("cell", F.lit("file="), F.lit("")).alias("cell"), "kind").agg(F.count(F.lit(1)).cast("int").alias("n_rows"))


@query("src_bed_regions", """
    SELECT cast(region_ord AS int) AS nth, chrom, start, "end" FROM fx_regions""")
def src_bed_regions(t):
    rows = t.fx_regions.repartitionByRange("region_ord").sortWithinPartitions("region_ord").select(F.explode(F.array(
        lines("chrom", "start", "end", F.lit("name"), F.lit("0")), F.lit("# comment"), F.lit("")
    )).alias("value"))
    bed = tx.read_bed(t.spark, write_lines(rows, t.path("regions")))
    return with_rank(bed, ["region_ord"], "nth").select((F.col("nth") + 1).cast("int").alias("nth"), "chrom", "start", "end")


@query("src_chrom_sizes", """
    SELECT chrom, cast("end" - start AS bigint) AS size FROM fx_chrom_sizes UNION ALL
    SELECT concat(chrom, '_two') AS chrom, cast("end" AS bigint) AS size FROM fx_chrom_sizes""")
def src_chrom_sizes(t):
    rows = t.fx_chrom_sizes.select(F.explode(F.array(
        lines("chrom", "start", "end"), lines(F.concat("chrom", F.lit("_two")), "end", sep="  "),
        lines("chrom", F.lit("bad"), "end"), F.lit("# c"), F.col("chrom"),
    )).alias("value"))
    return tx.read_chrom_sizes(t.spark, write_lines(rows, t.path("sizes")))


@query("src_barcode_counts", "SELECT barcode, reads FROM fx_totals")
def src_barcode_counts(t):
    """Files of two layouts in one folder, the columns in another order: each is read by its own header."""
    path, counts = t.path("counts"), t.fx_barcode_counts
    forward = counts.where("strand = 'forward'")
    forward.where("chunk_id = '0001'").select("barcode", "aligned_reads").write.option("header", True).csv(path)
    forward.where("chunk_id <> '0001'").select("aligned_reads", F.lit('a,"b"').alias("note"), "barcode").write.mode("append").option("header", True).csv(path)
    bad = counts.where("strand = 'reverse'").select(F.lit("n/a").alias("reads_counts"), "barcode")
    counts.where("strand = 'reverse'").select(F.col("aligned_reads").cast("string").alias("reads_counts"), "barcode").unionByName(
        bad
    ).write.mode("append").option("header", True).csv(path)
    return rp.read_barcode_counts(t.spark, path)


@query("src_funnel_json", POOL_SQL.format(ctot="ctot"))
def src_funnel_json(t):
    path = t.path("funnel")
    demuxed(t).funnel.repartition("chunk_id").select("chunk_id", F.to_json(F.struct("chunk_id", "funnel", "ct")).alias("value")).write.partitionBy(
        "chunk_id"
    ).text(path)
    return pool_funnels(rp.read_funnels(t.spark, f"{path}/*")).withColumnRenamed("CtoT", "ctot")


@query("src_readqc_json", """
    SELECT chunk_id, n AS raw_reads, bases AS total_bases, CASE WHEN chunk_id = '0001' THEN 0.125 ELSE 0.0 END::double AS duplication_rate,
           round(bases / 1e9, 6) AS sequencing_gbp, n // 2 AS pair_total
    FROM (SELECT chunk_id, count(*) * 2 AS n, cast(sum(length(r1_seq) + length(r2_seq)) AS bigint) AS bases FROM fx_reads GROUP BY chunk_id) g""")
def src_readqc_json(t):
    totals = t.fx_reads.groupBy("chunk_id").agg(
        (F.count(F.lit(1)) * 2).alias("total_reads"), F.sum(F.length("r1_seq") + F.length("r2_seq")).alias("total_bases")
    )
    section = F.struct("total_reads", "total_bases")
    full = F.struct(
        F.struct(section.alias("after_filtering"), section.alias("before_filtering")).alias("summary"),
        F.struct(F.lit(0.125).alias("rate")).alias("duplication"),
        F.struct((F.col("total_reads") / 2).cast("long").alias("total_reads")).alias("read1_after_filtering"),
    )
    # The other chunk's report has no duplication, no read-1 section and only one totals section.
    bare = F.struct(F.struct(section.alias("after_filtering")).alias("summary"))
    path = t.path("readqc")
    text = F.when(F.col("chunk_id") == "0001", F.to_json(full)).otherwise(F.to_json(bare))
    totals.repartition("chunk_id").select("chunk_id", text.alias("value")).write.partitionBy("chunk_id").text(path)
    report = t.spark.read.schema(rp.READ_QC_SCHEMA).option("multiLine", True).json(f"{path}/*")
    return report.select(
        F.regexp_extract(F.col("_metadata.file_path"), "chunk_id=([0-9]+)/", 1).alias("chunk_id"), *rp.read_qc_columns()
    )


@query("src_linker_tsv", "SELECT CR AS cr, UB AS ub, C AS c, T AS t FROM ox_ct_lines")
def src_linker_tsv(t):
    path = t.path("linker")
    demuxed(t).evidence.select("CR", "UB", "C", "T").write.options(header=True, sep="\t").csv(path)
    read = rp.read_linker(t.spark, path)
    return read.select(*[F.col(c).alias(c.lower()) for c in read.columns])


@query("src_context_counts", """
    SELECT cell, context, mc, cov, number, round(genome_cov, 6) AS genome_cov FROM fx_context_counts""")
def src_context_counts(t):
    path = t.path("sidecars")
    dealt(t.fx_context_counts, "cell").select("cell", "context", "mc", "cov", "number", "genome_cov").write.partitionBy(
        "cell"
    ).option("header", True).csv(path)
    return rp.read_context_counts(t.spark, f"{path}/*", cell_pattern="cell=([^/]+)/").drop("line")


@query("src_key_maps", """
    SELECT c.cell, gex_cb, found.reads, missing.reads AS missing FROM fx_all_cells c LEFT JOIN fx_key_map k ON c.cell = k.m_cb,
      (SELECT 7 AS reads) found, (SELECT cast(NULL AS int) AS reads) missing""")
def src_key_maps(t):
    path = t.path("map")
    odd = F.crc32("m_cb") % 2 == 1
    t.fx_key_map.where(~odd).unionByName(t.fx_key_map.select(F.lit(" ").alias("m_cb"), "gex_cb")).write.option("header", True).csv(path)
    # further files of the folder have their columns in another order
    t.fx_key_map.where(odd).select("gex_cb", F.lit("x,y").alias("note"), "m_cb").write.mode("append").option("header", True).csv(path)
    keys = rp.read_key_map(t.spark, path, "m_cb", "gex_cb")
    table = t.fx_all_cells.select(F.col("cell").alias("sample_id"), F.lit(7).alias("reads"))
    found = rp.lookup_sample(table, "c000000", ["reads"])
    missing = rp.lookup_sample(table, "no such sample", ["reads"])
    return t.fx_all_cells.join(keys, F.col("cell") == F.col("m_cb"), "left").select(
        "cell", "gex_cb", found.scalar().alias("reads"), missing.scalar().alias("missing")
    )


@query("src_gather_chunks", "SELECT cell, count(*) AS n_sites FROM fx_sites GROUP BY cell")
def src_gather_chunks(t):
    even = write_sites(t, t.fx_sites.where("cast(substr(cell, 2) AS int) % 2 = 0"))
    odd = write_sites(t, t.fx_sites.where("cast(substr(cell, 2) AS int) % 2 = 1"))
    pattern = "cell=([^/]+)/"
    gathered = tx.read_sites(t.spark, [even, odd], cell_pattern=pattern)
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).load([even, odd]).select(
        F.regexp_extract("path", pattern, 1).alias("cell"), F.regexp_extract("path", "^(.*/)cell=", 1).alias("path")
    )
    cl.reject_duplicates(files)
    return gathered.groupBy("cell").agg(F.count(F.lit(1)).alias("n_sites"))


@query("src_smoothed", "SELECT chrom, pos, round(s, 6) AS smoothed FROM ox_smooth")
def src_smoothed(t):
    path = t.path("smoothed-csv")
    values = me.smooth_store(t.fx_encoded, BANDWIDTH)
    values.repartition("chrom").sortWithinPartitions("chrom", "pos").select("chrom", "pos", "smoothed").write.partitionBy("chrom").csv(path)
    return rp.read_smoothed(t.spark, path, chrom_pattern="chrom=([^/]+)/")


@query("src_alignments", """
    SELECT read_name, cell, umi, flag, chrom, b_start AS s1, b_start + 5 AS e1, b_start + 8 AS s2, b_end + 8 AS e2 FROM fx_alignments""")
def src_alignments(t):
    tagged = F.concat_ws(
        "\t", F.concat(F.lit("UR:Z:"), "umi"), F.concat(F.lit("CB:Z:"), "cell")
    )
    cigar = F.concat(F.lit("2S5M1I3D"), (F.col("b_end") - F.col("b_start")).cast("string"), F.lit("="), F.lit("4H"))
    sam = t.fx_alignments.select(F.explode(F.array(
        lines("read_name", "flag", "chrom", F.col("b_start") + 1, F.lit("60"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"), tagged),
        F.lit("@CO\tcomment"),
    )).alias("value"))
    read = tx.read_alignments(t.spark, write_lines(sam, t.path("sam")))
    one, two = F.col("blocks")[0], F.col("blocks")[1]
    return read.select(
        "read_name", "cell", "umi", "flag", "chrom", one["start"].alias("s1"), one["end"].alias("e1"), two["start"].alias("s2"), two["end"].alias("e2")
    )


@query("snk_site_store", "SELECT chrom, pos, cell, m FROM fx_encoded")
def snk_site_store(t):
    path = t.path("store")
    sk.write_site_store(t.fx_encoded, path)
    return t.spark.read.parquet(path).select("chrom", "pos", "cell", "m")


@query("snk_smoothed", "SELECT chrom, pos, n_obs, n_meth, round(s, 6) AS smoothed FROM ox_smooth JOIN ox_pseudobulk USING (chrom, pos)")
def snk_smoothed(t):
    path = t.path("smoothed")
    sk.write_smoothed(me.smooth_store(t.fx_encoded, BANDWIDTH), path)
    return t.spark.read.parquet(path).select("chrom", "pos", "n_obs", "n_meth", "smoothed")


@query("snk_vmr_bed", """
    SELECT cast(row_number() OVER (ORDER BY x.n DESC, chromosome, VMR_start) AS int) AS line, chromosome AS chrom, VMR_start AS s, VMR_end AS e, n_sites, n_cells
    FROM ox_vmrs_0 v JOIN ox_extent x ON v.chromosome = x.chrom WHERE n_cells >= 6""")
def snk_vmr_bed(t):
    path = t.path("vmrs")
    sk.write_vmr_bed(scan(t), sm.chrom_extents(sm.pseudobulk(t.fx_encoded)), path)
    schema = "chrom string, s int, e int, variance double, n_sites bigint, n_cells bigint"
    read = t.spark.read.schema(schema).option("sep", "\t").csv(path).select(
        "*", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("id")
    )
    return with_rank(read, ["path", "id"], "line").select((F.col("line") + 1).cast("int").alias("line"), "chrom", "s", "e", "n_sites", "n_cells")


@query("snk_sparse_matrix", """
    SELECT cell_idx + 1 AS row_i, region_idx + 1 AS col_i, coalesce(printf('%.4g', cast(cast(resid AS float) AS double)), '') AS residuals,
           printf('%.4g', cast(cast(mfrac AS float) AS double)) AS mfracs, n_total AS coverage
    FROM ox_region_cell r JOIN fx_all_cells c ON r.cell = c.cell""")
def snk_sparse_matrix(t):
    path = t.path("matrix")
    smoothed = smoothed_table(t)
    matrix = me.region_matrix(t.fx_encoded, smoothed, t.fx_regions, t.fx_all_cells)
    sk.write_sparse_matrix(matrix, rg.index_regions(t.fx_regions, smoothed), t.fx_all_cells, path)
    part = F.split("value", " ")
    return t.spark.read.text(f"{path}/matrix.mtx").select(
        part[0].cast("int").alias("row_i"), part[1].cast("int").alias("col_i"),
        part[2].alias("residuals"), part[3].alias("mfracs"), part[4].cast("bigint").alias("coverage"),
    )


@query("snk_dense_matrix", """
    SELECT kind, c.cell, concat(chrom, ':', start, '-', "end") AS region, round(CASE kind WHEN 'fraction' THEN coalesce(mfrac, 0) WHEN 'residual' THEN resid
               WHEN 'total' THEN coalesce(n_total, 0) ELSE coalesce(n_meth, 0) END, 6) AS value
    FROM (SELECT unnest(['fraction', 'residual', 'total', 'methylated']) AS kind) k, fx_all_cells c, ox_region_index i
    LEFT JOIN ox_region_cell r ON r.cell = c.cell AND r.region_idx = i.region_idx""")
def snk_dense_matrix(t):
    path, smoothed = t.path("dense"), smoothed_table(t)
    tables = me.region_matrix(t.fx_encoded, smoothed, t.fx_regions, t.fx_all_cells, dense=True)
    sk.write_dense_matrix(tables, rg.index_regions(t.fx_regions, smoothed), path)
    kinds = {
        "fraction": "methylation_fractions", "residual": "mean_shrunken_residuals",
        "total": "total_sites", "methylated": "methylated_sites",
    }
    out = None
    for kind, name in kinds.items():
        fields = t.spark.read.text(f"{path}/{name}.csv").select(F.split("value", ",").alias("f"))
        fields = fields.select(F.col("f")[0].alias("cell"), F.posexplode("f").alias("at", "value")).where("at > 0")
        named = fields.where("cell = 'cell'").select("at", F.col("value").alias("region"))
        long = fields.where("cell <> 'cell'").join(named, "at").select(
            F.lit(kind).alias("kind"), "cell", "region", F.nullif("value", F.lit("")).cast("double").alias("value")
        )
        out = long if out is None else out.unionByName(long)
    return out


@query("snk_run_info", """
    SELECT 'smooth' AS stage, 60 AS bandwidth, (SELECT count(*) FROM ox_pseudobulk) AS n_rows, true AS ordered""")
def snk_run_info(t):
    begun = datetime.now(timezone.utc)
    path = t.path("run-info")
    sk.write_run_info(sk.run_info("smooth", {"bandwidth": BANDWIDTH}, smoothed_table(t), begun), path)
    schema = "stage string, bandwidth int, n_rows bigint, begin_time_utc string, end_time_utc string, runtime_seconds double"
    return t.spark.read.schema(schema).json(path).select(
        "stage", "bandwidth", "n_rows", (F.col("begin_time_utc") <= F.col("end_time_utc")).alias("ordered")
    )
