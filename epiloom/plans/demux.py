"""The read-level pass: barcode, conversion evidence, chain, trim, length and chimera filters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import chemistry as chem
from ..functions import seq as fx
from ..operators import barcodes as bc
from ..operators import demux as op
from ..session import materialize


# What later results read of a judged pair; the sequences are written for pairs that any barcode would make valid.
FACTS = ("chunk_id", "rid", "ocb", "umi", "has_linker", "ct", "chain", "verdict")
RECORD = ("r1_header", "r1_seq", "r1_qual", "r2_header", "r2_seq", "r2_qual")


@dataclass(frozen=True)
class Demux:
    """Results of one demultiplexing pass; each joins the columns it needs of its one written table with the decisions."""

    reads: DataFrame      # every input pair with its fate; trimmed sequences of valid pairs
    evidence: DataFrame   # first eligible read per (chunk, cell, UMI)
    funnel: DataFrame     # nested counters per chunk

    @property
    def valid(self) -> DataFrame:
        """Pairs that passed, renamed and trimmed."""
        return self.reads.where((F.col("verdict") == "valid") & F.col("cb").isNotNull()).select(
            "chunk_id",
            "rid",
            "cb",
            "umi",
            "chain",
            fx.demux_read_name("r1_header", "cb", "umi", "chain", "alt").alias("r1_name"),
            "r1_seq",
            "r1_qual",
            fx.demux_read_name("r2_header", "cb", "umi", "chain", "alt").alias("r2_name"),
            "r2_seq",
            "r2_qual",
        )


def annotate_reads(reads: DataFrame, structure: str = chem.READ_STRUCTURE) -> DataFrame:
    """Per-read facts that need no other row: barcode and UMI slices, linker, evidence, chain.

    Stateless, so it also applies to a streaming DataFrame.
    """
    return fx.staged(
        reads,
        ocb=fx.structure_column("r1_seq", structure, "B"),
        umi=fx.structure_column("r1_seq", structure, "U"),
        has_linker=fx.has_linker("r1_seq"),
        ct=fx.ct_counts("r1_seq", "r1_qual"),
        chain=fx.chain_direction("r1_seq"),
    )


def trim_and_judge(reads: DataFrame, threshold: int = chem.CHIMERIC_THRESHOLD) -> DataFrame:
    """Trim and crop both mates, then add ``verdict``: the fate of the pair if its barcode is accepted."""
    trimmed = fx.crop_insert(fx.trim_adapters(reads))
    verdict = (
        F.when(F.col("chain") == "unknown", "unknown_chain")
        .when(~fx.long_enough_pair(), "too_short")
        .when(fx.is_chimeric("r1_seq", "r2_seq", "chain", threshold), "chimeric")
        .otherwise("valid")
    )
    return fx.staged(trimmed, verdict=verdict)


def demux(
    reads: DataFrame,
    whitelist: DataFrame,
    *,
    structure: str = chem.READ_STRUCTURE,
    distance: int = 1,
    chimeric_threshold: int = chem.CHIMERIC_THRESHOLD,
) -> Demux:
    """Demultiplex ``reads`` (``chunk_id, rid, r{1,2}_header, r{1,2}_seq, r{1,2}_qual``).

    One scan of the reads: every pair is trimmed and judged once, as if its
    barcode were accepted, and written by that verdict. The barcodes are decided
    from that table's column of them. A result joins only its own columns and
    rows with the decisions: evidence and counters, which are map-side-combined
    aggregations, move no sequence, and only valid pairs are moved with theirs.
    """
    judged = trim_and_judge(annotate_reads(reads, structure), chimeric_threshold)
    valid = F.col("verdict") == "valid"
    written = materialize(judged.select(*FACTS, *[F.when(valid, F.col(c)).alias(c) for c in RECORD]), "judged", "verdict")
    assigned = bc.assign_barcodes(written, whitelist, distance=distance, salt_by=("chunk_id", "rid"))
    accepted = F.col("cb").isNotNull()
    assigned = assigned.withColumns({
        "fate": F.when(accepted, F.col("verdict")).otherwise("rejected"), **{c: F.when(accepted, F.col(c)) for c in RECORD}})
    evidence = op.first_per_umi(assigned)
    return Demux(assigned, evidence, op.nest_funnel(op.funnel_counts(assigned, evidence)))
