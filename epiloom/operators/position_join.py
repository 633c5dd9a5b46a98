"""Joining cell × position sites with the (smaller) table of positions.

This is the one shuffle of the big table in a scan or a region matrix. Both
sides are hashed by ``(chrom, block, salt)``: a block is a stretch of positions
and a salt is a slice of the cells in it. Every block gets as many salts as its
load needs, so a hot locus (or a third of all rows on one chromosome) spreads
over many tasks, while all sites of one cell and block stay together: what is
grouped by (chrom, block, salt, cell, ...) afterwards needs no further shuffle.

With a ``halo``, a site near a border is copied into each block it can matter
to, so that windows which reach over the border are complete in their own block.
Before the shuffle, a bitmap of each block's wanted stretches (``STRETCH``
positions a bit) drops the sites that cannot match.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BLOCK_WIDTH = 131_072
ROWS_PER_SALT = 250_000
STORE_WIDTH = 64 * BLOCK_WIDTH  # positions in a directory of a site store
_WORD = 64


def blocks(pos: Column, width: int, halo: int = 0) -> Column:
    """The block of a position, or an array of those within ``halo`` of it."""
    block = lambda p: F.floor(p / width).cast("int")
    return F.sequence(block(pos - halo), block(pos + halo)) if halo else block(pos)


def block_loads(dim: DataFrame, key: Sequence[str], load: Column, width: int, rows_per_salt: int) -> DataFrame:
    """One row per block: its ``load``, ``salts``, and ``words``, the bitmap of its wanted stretches."""
    stretch = max(1, width // (32 * _WORD))
    n_words = -(-width // (stretch * _WORD))
    slot = F.floor((F.col("pos") - F.col("block").cast("long") * width) / stretch)
    # a position in the halo lies outside its block: all of them share the first and last slot
    slot = F.greatest(F.lit(0), F.least(slot, F.lit(n_words * _WORD - 1))).cast("int")
    bits = dim.groupBy(*key, F.floor(slot / _WORD).cast("int").alias("word")).agg(
        F.sum(load).alias("load"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot % _WORD)).alias("bits"))
    words = F.map_from_entries(F.collect_list(F.struct("word", "bits")))  # at most n_words entries
    return bits.groupBy(*key).agg(
        F.sum("load").cast("double").alias("load"), F.greatest(F.ceil(F.sum("load") / rows_per_salt), F.lit(1)).cast("int").alias("salts"), words.alias("m")
    ).withColumn("words", F.transform(F.sequence(F.lit(0), F.lit(n_words - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0).cast("long")))).drop("m")


def wanted(pos: Column, block: Column, words: Column, width: int) -> Column:
    """Whether the bitmap of the block has the position's stretch."""
    stretch = max(1, width // (32 * _WORD))
    n_words = -(-width // (stretch * _WORD))
    slot = F.greatest(F.lit(0), F.least(F.floor((pos - block.cast("long") * width) / stretch), F.lit(n_words * _WORD - 1))).cast("int")
    return F.getbit(F.get(words, F.floor(slot / _WORD).cast("int")), slot % _WORD) == 1


def join_sites(
    encoded: DataFrame,
    positions: DataFrame,
    *,
    by: Sequence[str] = (),
    halo: int = 0,
    copies: Column | None = None,
    block_width: int = BLOCK_WIDTH,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Inner join on ``(chrom, pos)``, with the columns ``block`` and ``salt`` of its hash partitioning.

    ``positions`` needs ``n_obs``, the number of sites it will meet, and with a
    ``halo`` its own ``block`` (several rows for a position of several blocks).
    ``copies`` is what a row becomes afterwards, so that salts bound the work.

    The per-block table has one row per block of genome; Spark broadcasts it if
    its written size allows. A store written by ``write_site_store`` is read
    only where its directories hold wanted positions.
    """
    block = [*by, "chrom", "block"]
    dim = positions if halo else positions.withColumn("block", blocks(F.col("pos"), block_width))
    load = F.col("n_obs") if copies is None else F.col("n_obs") * copies
    loads = block_loads(dim, block, load, block_width, rows_per_salt)
    stored = "stretch" in encoded.columns and STORE_WIDTH % block_width == 0 and halo <= STORE_WIDTH
    # Read three times below; one row per block, so writing it costs little.
    written = materialize(loads, "block-loads")
    # As many partitions as the load needs: if Spark chose them by shuffled bytes, a task would get more copies as the input grows.
    total = written.agg(F.sum("load")).first()[0] or 0
    parts = max(int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(2 * total / rows_per_salt))
    loads = written.drop("load").where("salts > 0")  # always; a filter lets Spark prune by the join

    placed = blocks(F.col("pos"), block_width, halo)
    big = encoded.withColumn("block", F.explode(placed) if halo else placed)
    key = block
    if stored:  # equal on the partition column too, for dynamic partition pruning
        around = lambda b: F.floor((F.col("block").cast("long") * block_width + b) / STORE_WIDTH).cast("int")
        reach = F.array_distinct(F.array(around(-halo), around(0), around(block_width - 1 + halo)))
        meets = loads.withColumn("stretch", F.explode(reach))
        key = [*block, "stretch"]
    else:
        meets = loads
    big = (
        big.join(meets, key)
        .where(wanted(F.col("pos"), F.col("block"), F.col("words"), block_width))
        .withColumn("salt", F.pmod(F.xxhash64("cell"), F.col("salts")).cast("int"))
        .drop("salts", "words", "stretch")
    )
    small = (
        dim.join(loads.drop("words"), block)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .drop("salts", "n_obs")
    )
    spread = [*block, "salt"]
    return big.repartition(parts, *spread).join(
        small.repartition(parts, *spread).hint("shuffle_hash"), [*spread, "pos"]
    )
