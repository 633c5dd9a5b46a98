"""Line-oriented readers: read pairs, lists, site tables, regions, sizes, alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n"


def read_lines(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Lines with their file; ``ord`` sorts the lines of one file in file order.

    A split is read in order by one task, so (start of the split, id within the
    task) orders the lines of a file however it was split.
    """
    return spark.read.options(recursiveFileLookup=True, **options).text(paths).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def _stripped(column: str = "line") -> Column:
    return F.btrim(F.col(column), F.lit(WHITESPACE))


def _fail(condition: Column, message: Column | str, value: Column) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    return F.when(condition, F.raise_error(message).cast("string")).otherwise(value)


def number_lines(lines: DataFrame, stream: Column | str = "path") -> DataFrame:
    """Add the 0-based ``line_no`` of every line in its ``stream``, without moving any line.

    A stream is a file, or all files with one value of an expression of ``path``,
    one after another in the order of their paths. One pass counts the lines per
    split (a row per split, so it can be broadcast); the running total of earlier
    splits shifts the ids. The stream is named once per split, not per line.
    """
    splits = lines.groupBy("path", "split_start").agg(
        F.min("line_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    ).withColumn("stream", F.col(stream) if isinstance(stream, str) else stream)
    earlier = Window.partitionBy("stream").orderBy("path", "split_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "path", "split_start", "stream", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first_id")).alias("shift")
    )
    return lines.join(F.broadcast(offsets), ["path", "split_start"]).select(
        "path", "stream", "line", (F.col("line_id") + F.col("shift")).alias("line_no")
    )


def read_pairs(
    spark: SparkSession,
    r1_paths: str | list[str],
    r2_paths: str | list[str],
    chunk_pattern: str = r"([^/]+?)[._-]?R[12][^/]*$",
) -> DataFrame:
    """FASTQ mates paired by ordinal: ``chunk_id, rid, r{1,2}_{header,seq,qual}``.

    ``chunk_pattern`` extracts the chunk name from a path and must give the same
    name for both mates. Files of one mate and chunk follow each other in the
    order of their paths; the two mates may be cut into files at different
    places. A partial record, or a chunk with unequal mates, is an error. All
    eight lines of a pair meet in one shuffle on (chunk, record); every key is
    one pair, so none is large. Plain or compressed files; a compressed file is
    one task, so give many.
    """
    chunk = F.regexp_extract("path", chunk_pattern, 1)
    mates = None
    for mate, paths in ((0, r1_paths), (1, r2_paths)):
        numbered = number_lines(read_lines(spark, paths), chunk).select(
            F.col("stream").alias("chunk_id"),
            F.floor(F.col("line_no") / 4).alias("rid"),
            (F.col("line_no") % 4 + 4 * mate).cast("int").alias("slot"),
            "line",
        )
        mates = numbered if mates is None else mates.unionByName(numbered)
    slots = {0: "r1_header", 1: "r1_seq", 3: "r1_qual", 4: "r2_header", 5: "r2_seq", 7: "r2_qual"}
    records = mates.groupBy("chunk_id", "rid").agg(
        F.count(F.lit(1)).alias("n_lines"),
        *[F.max(F.when(F.col("slot") == slot, F.col("line"))).alias(name) for slot, name in slots.items()],
    )
    broken = F.concat(
        F.lit("incomplete FASTQ record or unequal mates in chunk "), F.col("chunk_id"),
        F.lit(" at record "), F.col("rid").cast("string"),
    )
    return records.select(
        "chunk_id",
        "rid",
        _fail(F.col("n_lines") != 8, broken, F.col("r1_header")).alias("r1_header"),
        *[name for name in slots.values() if name != "r1_header"],
    )


def read_whitelist(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Distinct upper-case barcodes ``cb``; blank and ``#`` lines skipped; an empty list is an error."""
    barcodes = (
        spark.read.text(paths)
        .select(F.upper(F.btrim(F.col("value"), F.lit(WHITESPACE))).alias("cb"))
        .where((F.col("cb") != "") & ~F.startswith("cb", F.lit("#")))
        .distinct()
    )
    if not barcodes.limit(1).count():
        raise ValueError(f"empty barcode whitelist: {paths}")
    return barcodes


def read_barcode_list(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``cell, ord``: first tab- or comma-separated field of each line, in list order."""
    return (
        read_lines(spark, paths)
        .withColumn("text", _stripped())
        .where((F.col("text") != "") & ~F.startswith("text", F.lit("#")))
        .select(
            F.substring_index(F.substring_index("text", "\t", 1), ",", 1).alias("cell"),
            F.struct("path", "split_start", "line_id").alias("ord"),
        )
    )


def cell_from_path(path: Column | str) -> Column:
    """``.../<barcode>_allc.gz`` or ``.../<barcode>_allc.gz.count.csv`` -> barcode."""
    path = F.col(path) if isinstance(path, str) else path
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(name, r"(_allc)?(\.(tsv|txt))?(\.gz)?(\.count\.csv)?$", "")


def read_sites(
    spark: SparkSession, paths: str | list[str], *, mode: str = "drop", cell_pattern: str | None = None
) -> DataFrame:
    """ALLC files -> ``cell, chrom, pos, strand, context, mc, cov, n_fields``.

    Tab-separated, no header, at least six fields. The cell comes from the file
    name, or from the first group of ``cell_pattern`` in the path. Bad rows are
    dropped, or an error with ``mode="fail"``.
    """
    if mode not in ("drop", "fail"):
        raise ValueError("mode must be 'drop' or 'fail'")
    parts = F.split(F.col("text"), "\t")
    cell = F.regexp_extract("path", cell_pattern, 1) if cell_pattern else cell_from_path("path")
    rows = (
        read_lines(spark, paths)
        .withColumn("text", _stripped())
        .where((F.col("text") != "") & ~F.startswith("text", F.lit("#")))
        .select(
            cell.alias("cell"),
            parts.getItem(0).alias("chrom"),
            F.get(parts, F.lit(1)).try_cast("int").alias("pos"),
            F.get(parts, F.lit(2)).alias("strand"),
            F.get(parts, F.lit(3)).alias("context"),
            F.get(parts, F.lit(4)).try_cast("long").alias("mc"),
            F.get(parts, F.lit(5)).try_cast("long").alias("cov"),
            F.size(parts).alias("n_fields"),
            "path",
            "text",
        )
    )
    good = F.col("pos").isNotNull() & F.col("mc").isNotNull() & F.col("cov").isNotNull() & (F.col("n_fields") >= 6)
    if mode == "fail":
        rows = rows.withColumn(
            "chrom", _fail(~good, F.concat(F.lit("bad site row: "), F.col("text")), F.col("chrom"))
        )
    else:
        rows = rows.where(good)
    return rows.drop("path", "text")


def site_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``cell, path`` of the site files, from file listing metadata only."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path")
    return listing.select(cell_from_path("path").alias("cell"), "path")


def read_bed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``region_ord, chrom, start, end`` in list order; fewer than three fields or no region is an error."""
    parts = F.split(F.col("text"), "\t")
    lines = (
        read_lines(spark, paths)
        .withColumn("text", _stripped())
        .where((F.col("text") != "") & ~F.startswith("line", F.lit("#")))
    )
    if not lines.limit(1).count():
        raise ValueError(f"no regions in {paths}")
    short = F.size(parts) < 3
    bad = F.concat(F.lit("region line needs chrom, start, end: "), F.col("text"))
    return lines.select(
        F.struct("path", "split_start", "line_id").alias("region_ord"),
        _fail(short, bad, parts.getItem(0)).alias("chrom"),
        F.get(parts, F.lit(1)).cast("int").alias("start"),
        F.get(parts, F.lit(2)).cast("int").alias("end"),
    )


def read_chrom_sizes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``chrom, size`` from two- or three-column files; bad rows skipped."""
    parts = F.split(F.col("text"), r"\s+")
    first, second = (F.get(parts, F.lit(i)).try_cast("long") for i in (1, 2))
    return (
        read_lines(spark, paths)
        .withColumn("text", _stripped())
        .where((F.col("text") != "") & ~F.startswith("text", F.lit("#")))
        .select(
            parts.getItem(0).alias("chrom"),
            F.when(F.size(parts) >= 3, second - first).when(F.size(parts) == 2, first).alias("size"),
        )
        .where(F.col("size").isNotNull())
    )


def cigar_blocks(pos: Column | str, cigar: Column | str) -> Column:
    """Aligned reference blocks (M, =, X) as 0-based half-open ``array<struct<start,end>>``."""
    pos = F.col(pos) if isinstance(pos, str) else pos
    cigar = F.col(cigar) if isinstance(cigar, str) else cigar
    steps = F.arrays_zip(
        F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1)), lambda n: n.cast("int")).alias("n"),
        F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2)).alias("op"),
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def advance(state, step):
        n, op = step["n"], step["op"]
        at = state["at"]
        aligned = op.isin("M", "=", "X")
        block = F.array(F.struct(at.alias("start"), (at + n).alias("end")))
        return F.struct(
            F.when(aligned | op.isin("D", "N"), at + n).otherwise(at).alias("at"),
            F.when(aligned, F.concat(state["blocks"], block)).otherwise(state["blocks"]).alias("blocks"),
        )

    start = F.struct((pos - 1).cast("int").alias("at"), empty.alias("blocks"))
    return F.aggregate(steps, start, advance, lambda state: state["blocks"])


def read_alignments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """SAM text -> ``read_name, cell, umi, flag, chrom, blocks`` (tags CB and UR)."""
    parts = F.split(F.col("line"), "\t")
    chrom = F.get(parts, F.lit(2))
    tag = lambda name: F.nullif(
        F.regexp_extract("line", rf"\t{name}:Z:([^\t]*)", 1), F.lit("")
    )
    return (
        read_lines(spark, paths)
        .where(~F.startswith("line", F.lit("@")) & (F.size(parts) >= 11))
        .select(
            parts.getItem(0).alias("read_name"),
            tag("CB").alias("cell"),
            tag("UR").alias("umi"),
            F.get(parts, F.lit(1)).cast("int").alias("flag"),
            F.when(chrom != "*", chrom).alias("chrom"),
            cigar_blocks(F.get(parts, F.lit(3)).cast("int"), F.get(parts, F.lit(5))).alias("blocks"),
        )
    )
