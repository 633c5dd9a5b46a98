"""Table and file layouts of the results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rates import or_na
from ..functions.sites import region_name
from ..operators.position_join import BLOCK_WIDTH, STORE_WIDTH
from ..operators.regions import COLUMN_BLOCK


def prefix_layout(valid: DataFrame, bases: int) -> DataFrame:
    """Add the shard ``prefix`` (first bases of the corrected barcode; ``all`` when 0)."""
    prefix = F.substring("cb", 1, bases) if bases > 0 else F.lit("all")
    return valid.withColumn("prefix", prefix)


def write_prefix_shards(valid: DataFrame, path: str, bases: int = 0) -> None:
    """Demultiplexed pairs by barcode prefix and chain, as Parquet.

    One shuffle by shard, in which Spark splits shards larger than its advisory
    partition size and joins small ones: the number of files follows the bytes
    and not tasks times shards, and a prefix holding most reads has many writers.
    """
    dealt = rebalanced(prefix_layout(valid, bases), "prefix", "chain")
    dealt.write.mode("overwrite").partitionBy("prefix", "chain").parquet(path)


# Of a path below write_fastq_shards: equal for both mates of the same pairs.
FASTQ_CHUNK = r"/(prefix=[^/]*/chain=[^/]*/part-[0-9]+)"


def write_fastq_shards(valid: DataFrame, path: str, bases: int = 0, compression: str = "gzip") -> None:
    """The same shards as FASTQ: ``mate=M/prefix=P/chain=C/part-N*``, four lines a record.

    A task writes both mates of its pairs, each in the order of (chunk, read), so
    files with one part number hold the same pairs line by line; read them back
    with ``read_pairs(.., chunk_pattern=FASTQ_CHUNK)``.
    """
    dealt = rebalanced(prefix_layout(valid, bases), "prefix", "chain")
    records = [
        F.struct(F.lit(m).alias("mate"), F.concat_ws("\n", f"r{m}_name", f"r{m}_seq", F.lit("+"), f"r{m}_qual").alias("value")) for m in (1, 2)
    ]
    mates = dealt.select("prefix", "chain", "chunk_id", "rid", F.inline(F.array(*records)))
    # sorted as the writer wants it, so that it does not sort again and lose the order inside a file
    placed = mates.sortWithinPartitions("mate", "prefix", "chain", "chunk_id", "rid")
    placed.select("mate", "prefix", "chain", "value").write.mode("overwrite").option("compression", compression).partitionBy(
        "mate", "prefix", "chain"
    ).text(path)


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """``prefix, stream, path`` of every file that :func:`write_fastq_shards` has written, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
    return files.select(part("prefix").alias("prefix"), F.concat_ws("_", part("chain"), part("mate")).alias("stream"), "path")


def chunk_manifest(files: DataFrame) -> DataFrame:
    """``chunk_id, prefix, stream, subshard_count, subshard_paths`` from ``prefix, stream, path``.

    One group is the file list of one shard, whose number of files follows its bytes.
    """
    return files.groupBy("prefix", "stream").agg(
        F.count(F.lit(1)).alias("subshard_count"),
        F.concat_ws(";", F.array_sort(F.collect_list("path"))).alias("subshard_paths"),
    ).select(F.col("prefix").alias("chunk_id"), "prefix", "stream", "subshard_count", "subshard_paths")


def rebalanced(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` in one shuffle, without a sampling pass: Spark joins small parts and splits large ones by their size."""
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({', '.join(keys)}) */ * FROM {{frame}}", frame=df)


def write_site_store(encoded: DataFrame, path: str) -> None:
    """Parquet by chromosome and ``stretch`` of positions, sorted by position inside each file.

    A region scan prunes the directories it does not need (see ``join_sites``) and skips row groups by position.
    """
    width = lambda n: F.floor(F.col("pos") / n).cast("int")
    placed = encoded.withColumn("stretch", width(STORE_WIDTH)).withColumn("block", width(BLOCK_WIDTH))
    dealt = rebalanced(placed, "chrom", "stretch", "block").drop("block")
    dealt.sortWithinPartitions("chrom", "stretch", "pos", "cell").write.mode("overwrite").partitionBy("chrom", "stretch").parquet(path)


def write_smoothed(smoothed: DataFrame, path: str) -> None:
    """``pos, smoothed`` (and the counts) by chromosome, each file sorted by position and of a stretch of its own."""
    placed = smoothed.withColumn("stretch", F.floor(F.col("pos") / STORE_WIDTH).cast("int"))
    dealt = rebalanced(placed, "chrom", "stretch").sortWithinPartitions("chrom", "stretch", "pos").drop("stretch")
    dealt.write.mode("overwrite").partitionBy("chrom").parquet(path)


def vmr_bed(vmrs: DataFrame, sizes: DataFrame) -> DataFrame:
    """VMR rows in file order: chromosomes by number of encoded sites, largest first, then start."""
    return (
        vmrs.join(
            F.broadcast(sizes.select(F.col("chrom").alias("chromosome"), "n_encoded")), "chromosome"
        )
        .orderBy(F.desc("n_encoded"), "chromosome", "VMR_start")
        .select("chromosome", "VMR_start", "VMR_end", "variance", "n_sites", "n_cells")
    )


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").options(sep="\t", header=header, nullValue="NA", emptyValue="").csv(path)


def write_vmr_bed(vmrs: DataFrame, sizes: DataFrame, path: str, header: bool = False) -> None:
    write_tsv(vmr_bed(vmrs, sizes), path, header)


def general_4(column: str) -> Column:
    """``%.4g`` as text: four significant digits (ties to even), exponent form outside [1e-4, 1e4), '' for NULL."""
    value = F.col(column).cast("double")
    magnitude = F.floor(F.log10(F.abs(value)))
    scale = F.pow(F.lit(10.0), 3 - magnitude)
    rounded = F.when(value == 0, F.lit(0.0)).otherwise(F.rint(value * scale) / scale)
    # Rounding may carry into the next power of ten.
    exponent = F.when(rounded == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs(rounded)) + 1e-12))
    tidy = lambda text: F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+(?=$|e)", "$1"), r"\.(?=$|e)", "")
    text = F.when((exponent < -4) | (exponent >= 4), F.format_string("%.3e", rounded)).otherwise(
        rounded.cast("decimal(24,8)").cast("string")
    )
    return F.when(value.isNull() | F.isnan(value), F.lit("")).otherwise(tidy(text))


def sparse_triplets(matrix: DataFrame) -> DataFrame:
    """``row_i col_i residuals mfracs coverage``: 1-based indices, numbers as ``%.4g`` of their float value."""
    as_float = lambda c: F.col(c).cast("float").alias(c)
    floats = matrix.select("cell_idx", "region_idx", as_float("residual"), as_float("mfrac"), "coverage")
    return floats.select(
        (F.col("cell_idx") + 1).alias("row_i"),
        (F.col("region_idx") + 1).alias("col_i"),
        general_4("residual").alias("residuals"),
        general_4("mfrac").alias("mfracs"),
        "coverage",
    )


def write_sparse_matrix(matrix: DataFrame, regions: DataFrame, cells: DataFrame, path: str) -> None:
    """Triplet text (region-major), with the region and cell name lists beside it."""
    lines = sparse_triplets(matrix).repartitionByRange("col_i", "row_i").sortWithinPartitions("col_i", "row_i")
    lines.select(F.concat_ws(" ", *lines.columns)).write.mode("overwrite").option("compression", "gzip").text(
        f"{path}/matrix.mtx"
    )
    names = regions.orderBy("region_idx").select(region_name("chrom", "start", "end"))
    names.write.mode("overwrite").option("compression", "gzip").text(f"{path}/features.tsv")
    cells.orderBy("cell_idx").select("cell").write.mode("overwrite").option("compression", "gzip").text(
        f"{path}/barcodes.tsv"
    )


def write_dense_matrix(tables: dict[str, DataFrame], regions: DataFrame, path: str) -> None:
    """One CSV per table: the first line names the regions, then a line per cell, in order over the part files.

    A line is put together from its blocks where it is written; no list of regions or cells reaches the driver.
    """
    block = F.floor(F.col("region_idx") / COLUMN_BLOCK).alias("block")

    def in_order(key: str, text: str) -> Column:
        pairs = F.array_sort(F.collect_list(F.struct(key, text)))
        return F.array_join(F.transform(pairs, lambda p: p[text]), ",").alias("text")

    names = regions.groupBy(block).agg(in_order("region_idx", "region_name"))
    head = names.groupBy().agg(in_order("block", "text"))
    head = head.select(F.lit(-1).cast("long").alias("ord"), F.concat_ws(",", F.lit("cell"), "text").alias("value"))
    for name, table in tables.items():
        text = F.array_join(F.transform("values", lambda v: v.cast("string")), ",", "")
        rows = table.select("cell_idx", "cell", "block", text.alias("text")).groupBy("cell_idx", "cell").agg(
            in_order("block", "text")
        ).select(F.col("cell_idx").cast("long").alias("ord"), F.concat_ws(",", "cell", "text").alias("value"))
        head.unionByName(rows).orderBy("ord").select("value").write.mode("overwrite").option("compression", "gzip").text(f"{path}/{name}.csv")


def summary_view(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed columns as text, ``NA`` for NULL or a missing column; extra columns are ignored."""
    return table.select(
        *[(or_na(F.col(c)) if c in table.columns else F.lit("NA")).alias(c) for c in columns]
    )


def without_commas(table: DataFrame) -> DataFrame:
    return table.select(*[F.replace(F.col(f"`{c}`").cast("string"), F.lit(","), F.lit("")).alias(c) for c in table.columns])


def count_table(counts: DataFrame, reads: str = "reads", barcode: str = "barcode") -> DataFrame:
    """Counts by reads descending, ties by barcode."""
    return counts.orderBy(F.desc(reads), barcode)


def write_count_table(counts: DataFrame, path: str) -> None:
    count_table(counts).write.mode("overwrite").option("header", True).csv(path)


def run_info(stage: str, parameters: dict[str, object], table: DataFrame, begun: datetime) -> DataFrame:
    """One row: stage, parameters, row count and timings of a run."""
    ended = datetime.now(timezone.utc)
    return table.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(stage).alias("stage"),
        *[F.lit(v).alias(k) for k, v in parameters.items()],
        "n_rows",
        F.lit(begun.isoformat()).alias("begin_time_utc"),
        F.lit(ended.isoformat()).alias("end_time_utc"),
        F.lit((ended - begun).total_seconds()).alias("runtime_seconds"),
    )


def write_run_info(info: DataFrame, path: str) -> None:
    info.write.mode("overwrite").json(path)
