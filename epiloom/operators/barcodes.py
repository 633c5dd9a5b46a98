"""Matching observed barcodes against a dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.seq import correction_tag
from ..session import BROADCAST_MAX_BYTES, broadcast_if_small, bytes_of, materialize, partitions_for

READS_PER_SALT = 1_000_000  # reads of one barcode that may meet in one task


def match_exact(reads: DataFrame, whitelist: DataFrame, barcode: str = "ocb") -> DataFrame:
    """Add ``is_exact``. The dictionary is a fixed list (under a million rows), broadcast after its size is measured."""
    listed, _ = broadcast_if_small(
        whitelist.select(F.col("cb").alias(barcode), F.lit(True).alias("hit")).distinct()
    )
    return reads.join(listed, barcode, "left").withColumn("is_exact", F.coalesce("hit", F.lit(False))).drop("hit")


def substitution_neighbours(
    barcodes: DataFrame, source: str = "ocb", out: str = "cb", *, alphabet: str = "ACGT", first_n: bool = True
) -> DataFrame:
    """All single substitutions of ``source``, as column ``out``.

    With ``first_n`` a barcode with an N only has its first N replaced: any
    other change keeps the N, and dictionary entries have none.
    """
    text = F.col(source)
    positions = F.sequence(F.lit(1), F.length(text))
    if first_n:
        at_n = F.instr(text, "N")
        positions = F.when(at_n > 0, F.array(at_n)).otherwise(positions)
    return (
        barcodes.withColumn("_at", F.explode(positions))
        .withColumn("_alt", F.explode(F.array(*[F.lit(b) for b in alphabet])))
        .where(F.substr(text, F.col("_at"), F.lit(1)) != F.col("_alt"))
        .withColumn(
            out,
            F.concat(F.substr(text, F.lit(1), F.col("_at") - 1), F.col("_alt"), F.substr(text, F.col("_at") + 1)),
        )
        .drop("_at", "_alt")
    )


def _masked(barcodes: DataFrame, text: str, places: int, *, first_n: bool) -> DataFrame:
    """Every text with one base masked, as ``masked``; ``place`` is a hash of the half without the mask, ``at`` the masked base.

    Moved while it is one row a half, before the masks: the rows made afterwards stay where they are.
    """
    column = F.col(text)
    half = F.floor(F.length(column) / 2).cast("int")
    sides = F.array(*[
        F.struct(F.pmod(F.xxhash64(F.lit(n), kept), F.lit(places)).cast("int").alias("place"), low.cast("int").alias("low"), high.cast("int").alias("high"))
        for n, kept, low, high in (
            (0, F.substr(column, half + 1), F.lit(1), half), (1, F.substr(column, F.lit(1), half), half + 1, F.length(column)))])
    moved = barcodes.select(text, F.inline(sides)).where("low <= high").repartition(places, "place")
    masks = F.sequence("low", "high")
    if first_n:
        at_n = F.instr(column, "N")
        masks = F.when(at_n == 0, masks).when(at_n.between(F.col("low"), F.col("high")), F.array(at_n))
    return moved.select(text, "place", F.explode(masks).alias("spot")).select(
        text, "place", F.substr(column, F.col("spot"), F.lit(1)).alias("at"),
        F.concat(F.substr(column, F.lit(1), F.col("spot") - 1), F.lit("_"), F.substr(column, F.col("spot") + 1)).alias("masked"))


def correct_hamming1(observed: DataFrame, whitelist: DataFrame, barcode: str = "ocb") -> DataFrame:
    """Dictionary entries one substitution away from each distinct non-listed barcode.

    Returns only barcodes with a hit: ``(ocb, n_hits, cb, alt, status)``; one hit is
    ``corrected``, several are ``ambiguous`` (``cb`` NULL).

    Two texts one substitution apart are equal with that base masked, and share
    the half without it: both sides move by that half, twice a barcode, and meet
    there by hash in as many partitions as the dictionary needs. A barcode with
    an N has only its first N masked.
    """
    listed = whitelist.select("cb").distinct()
    # an entry is masked at each of its bases
    places = partitions_for(observed.sparkSession, 20 * bytes_of(listed))
    mine = _masked(observed.select(barcode), barcode, places, first_n=True).drop("at")
    theirs = _masked(listed, "cb", places, first_n=False).where(F.col("at").isin(*"ACGT")).drop("at")
    found = mine.join(theirs.hint("shuffle_hash"), ["place", "masked"]).where(F.col(barcode) != F.col("cb"))
    return _decide(found.select(barcode, "cb"), barcode)


def _decide(candidates: DataFrame, barcode: str) -> DataFrame:
    grouped = candidates.groupBy(barcode).agg(F.count(F.lit(1)).alias("n_hits"), F.min("cb").alias("first_cb"))
    single = F.col("n_hits") == 1
    return grouped.select(
        barcode,
        "n_hits",
        F.when(single, F.col("first_cb")).alias("cb"),
        F.when(single, correction_tag(F.col(barcode), F.col("first_cb"))).alias("alt"),
        F.when(single, "corrected").otherwise("ambiguous").alias("status"),
    )


def nearest_within(observed: DataFrame, whitelist: DataFrame, distance: int, barcode: str = "ocb") -> DataFrame:
    """Every dictionary entry at the smallest distance ``<= distance``: ``(ocb, cb, dist)``.

    Meets in the middle: for distance d the observed barcodes take ceil(d/2)
    substitutions and the dictionary floor(d/2), and equal strings are joined by
    hash. The expansion per barcode is fixed, so no dictionary segment is ever
    joined to all its look-alikes. Barcodes that found a match leave, so the
    wider rounds only see the rest.
    """
    mine = observed.select(barcode, F.col(barcode).alias("near"))
    theirs = whitelist.select("cb", F.col("cb").alias("near")).distinct()
    found = None
    for dist in range(1, distance + 1):
        if dist % 2:
            mine = substitution_neighbours(mine.withColumnRenamed("near", "from"), "from", "near").drop("from")
            mine = mine.distinct() if dist > 1 else mine
        else:
            # An N stands for a second unknown base of the observed barcode.
            theirs = substitution_neighbours(
                theirs.withColumnRenamed("near", "from"), "from", "near", alphabet="ACGTN", first_n=False
            ).drop("from")
            theirs = theirs.distinct() if dist > 2 else theirs
        # wider rounds: the dictionary became some seventy rows an entry, of which Spark's estimate knows nothing
        listed = broadcast_if_small(theirs)[0] if dist == 1 else theirs.hint("merge")
        hits = mine.join(listed, "near").select(barcode, "cb").distinct().withColumn("dist", F.lit(dist))
        if dist < distance:
            hits = materialize(hits, "barcode-hits")
            mine = mine.join(hits.select(barcode).distinct().hint("merge"), barcode, "left_anti")
        found = hits if found is None else found.unionByName(hits)
    return found


def barcode_histogram(reads: DataFrame, barcode: str = "ocb") -> DataFrame:
    """Reads per observed barcode; combines before the shuffle, so a hot barcode is one row per task."""
    return reads.groupBy(barcode).agg(F.count(F.lit(1)).alias("n_reads"))


def decide_barcodes(
    reads: DataFrame, whitelist: DataFrame, *, distance: int = 1, barcode: str = "ocb"
) -> tuple[DataFrame, DataFrame]:
    """``(decisions, histogram)`` of the distinct barcodes, both written.

    ``decisions``: ``(ocb, cb, alt, status)`` of every barcode that is exact,
    corrected or ambiguous; the others are rejected. The reads are scanned once,
    for the histogram; all matching runs on distinct barcodes.
    """
    histogram = materialize(barcode_histogram(reads, barcode), "barcodes")
    listed = whitelist.select(F.col("cb").alias(barcode)).distinct()
    exact = histogram.join(listed, barcode, "left_semi").select(
        barcode, F.col(barcode).alias("cb"), F.lit("M").alias("alt"), F.lit("exact").alias("status"))
    if distance <= 0:
        return materialize(exact, "decisions"), histogram
    unmatched = histogram.join(listed, barcode, "left_anti")
    if distance == 1:
        fixes = correct_hamming1(unmatched, whitelist, barcode)
    else:
        fixes = _decide(nearest_within(unmatched, whitelist, distance, barcode), barcode)
    return materialize(exact.unionByName(fixes.select(*exact.columns)), "decisions"), histogram


def assign_barcodes(
    reads: DataFrame,
    whitelist: DataFrame,
    *,
    distance: int = 1,
    barcode: str = "ocb",
    max_bytes: int = BROADCAST_MAX_BYTES,
    reads_per_salt: int = READS_PER_SALT,
    salt_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``cb``, ``alt`` and ``status`` (exact, corrected, ambiguous, rejected) to every read.

    One plan over two scans of the reads: a histogram of their barcodes, then one
    join with the decisions on the distinct ones. The join is a broadcast if the
    written decisions measure at most ``max_bytes``. Else it shuffles by
    (barcode, salt), where the histogram gives every barcode, rejected ones too,
    a salt for each ``reads_per_salt`` of its reads; the frequent ones that need
    several number at most reads / ``reads_per_salt``. A salt is a hash of the
    columns ``salt_by`` (all without any); few of them let a result that needs
    few columns read few. The decisions of a task are a bounded hash table, so
    no read is sorted.
    """
    decisions, histogram = decide_barcodes(reads, whitelist, distance=distance, barcode=barcode)
    small, fits = broadcast_if_small(decisions, max_bytes)
    if fits:
        joined = reads.join(small, barcode, "left")
    else:
        salts = F.ceil(F.col("n_reads") / reads_per_salt).cast("int")
        hot = histogram.where(salts > 1).select(barcode, salts.alias("_salts"))
        several = F.coalesce("_salts", F.lit(1))
        spread = reads.join(F.broadcast(hot), barcode, "left").withColumn(
            "_salt", F.when(several > 1, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in salt_by or reads.columns]), several)).otherwise(0).cast("int"))
        copied = decisions.join(F.broadcast(hot), barcode, "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), several - 1))).drop("_salts")
        places = partitions_for(reads.sparkSession, bytes_of(decisions))
        joined = spread.repartition(places, barcode, "_salt").join(
            copied.repartition(places, barcode, "_salt").hint("shuffle_hash"), [barcode, "_salt"], "left")
    return joined.select(
        *reads.columns, "cb", F.coalesce("alt", F.lit("")).alias("alt"), F.coalesce("status", F.lit("rejected")).alias("status"))


def prefix_chunks(whitelist: DataFrame, bases: int) -> DataFrame:
    """Sorted distinct barcode prefixes: the disjoint analysis chunks."""
    if bases <= 0:
        raise ValueError("prefix length must be > 0")
    return (
        whitelist.where(F.length("cb") >= bases)
        .select(F.substring("cb", 1, bases).alias("prefix"))
        .distinct()
        .orderBy("prefix")
    )
