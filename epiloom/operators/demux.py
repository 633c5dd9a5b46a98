"""Conversion evidence, first read per UMI, and the demultiplexing funnel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rates import safe_rate


def first_per_umi(
    reads: DataFrame, *, chunk: str = "chunk_id", order: str = "rid", evidence: str = "ct"
) -> DataFrame:
    """The first eligible read per (chunk, cell, UMI) as ``(chunk_id, CR, UB, C, T)``.

    ``min_by`` keeps one candidate per key and task, so duplicates collapse
    before the shuffle and no key is ever sorted or held whole.
    """
    return (
        reads.where(F.col("cb").isNotNull() & F.col(evidence).isNotNull())
        .groupBy(chunk, F.col("cb").alias("CR"), F.col("umi").alias("UB"))
        .agg(F.min_by(evidence, order).alias("first"))
        .select(chunk, "CR", "UB", F.col("first.c").alias("C"), F.col("first.t").alias("T"))
    )


def conversion_per_cell(evidence: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """ΣC, ΣT and T/(C+T) per barcode; barcodes without bases are dropped."""
    return (
        evidence.groupBy(*by, "CR")
        .agg(F.sum("C").cast("long").alias("C"), F.sum("T").cast("long").alias("T"))
        .where(F.col("C") + F.col("T") > 0)
        .withColumn("CtoT", F.round(F.col("T") / (F.col("C") + F.col("T")), 3))
    )


def funnel_counts(reads: DataFrame, evidence: DataFrame, *, chunk: str = "chunk_id") -> DataFrame:
    """Every counter of the funnel, one row per chunk, from one aggregation over the reads.

    ``reads``: one row per input pair with ``has_linker, status, ct, chain, fate``
    where fate is one of rejected, unknown_chain, too_short, chimeric, valid.
    """
    fate, chain = F.col("fate"), F.col("chain")
    counts = reads.groupBy(chunk).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "rejected").alias("rejected"),
        F.count_if(F.col("status") == "ambiguous").alias("ambiguous"),
        F.count_if(F.col("status") == "exact").alias("exact"),
        F.count_if(F.col("status") == "corrected").alias("corrected"),
        F.count_if(fate == "unknown_chain").alias("unknown_chain"),
        F.count_if(fate == "too_short").alias("too_short"),
        F.count_if((fate == "chimeric") & (chain == "forward")).alias("chimeric_forward"),
        F.count_if((fate == "chimeric") & (chain == "reverse")).alias("chimeric_reverse"),
        F.count_if((fate == "valid") & (chain == "forward")).alias("forward"),
        F.count_if((fate == "valid") & (chain == "reverse")).alias("reverse"),
        F.count_if("has_linker").alias("num_17lme"),
        F.count_if(F.col("ct").isNotNull() & F.col("cb").isNotNull()).alias("ct_reads"),
    )
    dedup = evidence.groupBy(chunk).agg(
        F.count(F.lit(1)).alias("ct_umi_dedup"), F.sum("C").alias("c_sum"), F.sum("T").alias("t_sum")
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    return counts.join(dedup, chunk, "left").select(
        *[c for c in counts.columns], zero("ct_umi_dedup"), zero("c_sum"), zero("t_sum")
    )


def nest_funnel(counts: DataFrame, *, chunk: str = "chunk_id") -> DataFrame:
    """The counters as the nested ``funnel`` and ``ct`` structs."""
    c = F.col
    passed = c("exact") + c("corrected")
    chimeric = c("chimeric_forward") + c("chimeric_reverse")
    valid = c("forward") + c("reverse")
    return counts.select(
        chunk,
        F.struct(
            c("total"),
            c("rejected").alias("barcode_rejected"),
            c("ambiguous").alias("barcode_ambiguous"),
            F.struct(
                passed.alias("total"),
                c("exact"),
                c("corrected"),
                F.round(safe_rate(c("corrected"), passed, 0.0), 6).alias("corrected_fraction"),
                c("unknown_chain"),
                c("too_short"),
                F.struct(
                    chimeric.alias("total"),
                    c("chimeric_forward").alias("forward"),
                    c("chimeric_reverse").alias("reverse"),
                ).alias("chimeric_filtered"),
                F.struct(
                    valid.alias("total"),
                    F.round(safe_rate(valid, c("total"), 0.0), 6).alias("fraction_of_input"),
                    c("forward"),
                    c("reverse"),
                ).alias("valid"),
            ).alias("barcode_passed"),
        ).alias("funnel"),
        F.struct(
            c("num_17lme"),
            F.round(safe_rate(c("num_17lme"), c("total"), 0.0), 6).alias("rate_17lme"),
            c("ct_reads"),
            c("ct_umi_dedup"),
            (c("c_sum") + c("t_sum")).alias("ct_convertible_bases"),
            c("t_sum").alias("ct_converted_bases"),
            F.round(safe_rate(c("t_sum"), c("c_sum") + c("t_sum"), 0.0), 3).alias("CtoT"),
        ).alias("ct"),
    )


def pool_funnels(funnels: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Sum nested funnels over chunks and derive the sample rates (NULL without input).

    The chimeric rate is taken over the passed reads that were not too short.
    """
    paths = {
        "total": "funnel.total",
        "passed": "funnel.barcode_passed.total",
        "corrected": "funnel.barcode_passed.corrected",
        "too_short": "funnel.barcode_passed.too_short",
        "chimeric": "funnel.barcode_passed.chimeric_filtered.total",
        "valid": "funnel.barcode_passed.valid.total",
        "forward_reads": "funnel.barcode_passed.valid.forward",
        "reverse_reads": "funnel.barcode_passed.valid.reverse",
        "num_17lme": "ct.num_17lme",
        "convertible": "ct.ct_convertible_bases",
        "converted": "ct.ct_converted_bases",
    }
    sums = funnels.groupBy(*by).agg(
        *[F.coalesce(F.sum(path), F.lit(0)).cast("long").alias(name) for name, path in paths.items()]
    )
    remaining = F.col("passed") - F.col("too_short")
    return sums.select(
        *by,
        safe_rate("passed", "total").alias("valid_barcode_rate"),
        safe_rate("valid", "total").alias("valid_demux_rate"),
        safe_rate("corrected", "passed").alias("barcode_corrected_fraction"),
        safe_rate("too_short", "total").alias("dropped_too_short"),
        F.when(remaining > 0, F.col("chimeric") / remaining).alias("dropped_chimeric"),
        "forward_reads",
        "reverse_reads",
        safe_rate("num_17lme", "total").alias("rate_17lme"),
        safe_rate("converted", "convertible").alias("CtoT"),
    )
