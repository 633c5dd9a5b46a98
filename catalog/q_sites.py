"""Sites: filters, encoding, per-cell statistics, pileup."""

from __future__ import annotations

from pyspark.sql import functions as F

from epiloom.functions import rates as fr
from epiloom.functions import sites as fs
from epiloom.operators import sites as st
from epiloom.plans import methylation as me

from .registry import query


@query("flt_context", """
    SELECT 'CG' AS wanted, * FROM fx_sites WHERE context IN ('CGA', 'CGT', 'CGC')
    UNION ALL SELECT 'CHG' AS wanted, * FROM fx_sites WHERE context IN ('CAG', 'CCG', 'CTG')
    UNION ALL SELECT 'CHH' AS wanted, * FROM fx_sites WHERE context IN ('CTT', 'CAA')
    UNION ALL SELECT '*' AS wanted, * FROM fx_sites""")
def flt_context(t):
    sites, out = t.fx_sites, None
    for wanted in ("CG", "CHG", "CHH", "*"):
        part = sites.where(fs.context_filter("context", wanted)).select(F.lit(wanted).alias("wanted"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("flt_contigs", """
    SELECT * FROM fx_contig_sites WHERE chrom IN ('chr1', 'chr2', 'chrX')""")
def flt_contigs(t):
    return t.fx_contig_sites.where(
        fs.contig_filter("chrom", exclude=fs.parse_contigs("chrM, chr7,"), main_only=True)
    )


@query("fx_encode_site", """
    SELECT chrom, pos, cell, cov, mc,
           cast(CASE WHEN cov <= 0 THEN NULL WHEN mc <> 0 AND mc <> cov THEN NULL WHEN mc > 0 THEN 1 ELSE -1 END AS tinyint) AS strict_code,
           cast(CASE WHEN cov <= 0 THEN NULL WHEN 2 * mc = cov THEN NULL WHEN 2 * mc > cov THEN 1 ELSE -1 END AS tinyint) AS rounded_code
    FROM fx_sites""")
def fx_encode_site(t):
    return t.fx_sites.select(
        "chrom", "pos", "cell", "cov", "mc",
        fs.encode_site("mc", "cov").alias("strict_code"),
        fs.encode_site("mc", "cov", round_sites=True).alias("rounded_code"),
    )


@query("build_site_store", """
    SELECT chrom, pos, cell, cast(CASE WHEN 2 * mc > cov THEN 1 ELSE -1 END AS tinyint) AS m
    FROM fx_contig_sites
    WHERE context IN ('CGA', 'CGT', 'CGC') AND chrom IN ('chr1', 'chr2', 'chrX', 'chrM') AND 2 * mc <> cov
      AND cell IN (SELECT cell FROM fx_all_cells WHERE cell_idx % 2 = 0)""")
def build_site_store(t):
    cells = t.fx_all_cells.where("cell_idx % 2 = 0")
    return me.build_site_store(t.fx_contig_sites, cells, context="CG", round_sites=True, main_only=True)


@query("agg_cell_stats", """
    SELECT c.cell AS cell_name, coalesce(n_obs, 0) AS n_obs, coalesce(n_meth, 0) AS n_meth,
           round(coalesce(n_meth / n_obs, 0.0), 6) AS global_meth_frac
    FROM fx_all_cells c LEFT JOIN (
      SELECT cell, count(*) AS n_obs, cast(sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) AS bigint) AS n_meth
      FROM fx_encoded GROUP BY cell) s ON c.cell = s.cell""")
def agg_cell_stats(t):
    return st.cell_stats(t.fx_encoded, t.fx_all_cells.select("cell"))


@query("agg_context_counts", """
    SELECT cell, context, cast(sum(mc) AS bigint) AS mc, cast(sum(cov) AS bigint) AS cov, count(*) AS number
    FROM fx_sites GROUP BY cell, context""")
def agg_context_counts(t):
    return st.context_counts(t.fx_sites)


RATES_SQL = """
    SELECT cell, """ + ", ".join(
    f"round(coalesce(sum(mc) FILTER (WHERE {cond}) / nullif(sum(cov) FILTER (WHERE {cond}), 0), 0.0), 6) AS {name}_mc_rate"
    for name, cond in {
        "CG": "context LIKE '_G%'", "CH": "context NOT LIKE '_G%'",
        "CHG": "context NOT LIKE '_G%' AND context LIKE '__G'", "CHH": "context NOT LIKE '_G%' AND context NOT LIKE '__G'",
        "CA": "context LIKE '_A%'", "CT": "context LIKE '_T%'", "CC": "context LIKE '_C%'",
    }.items()
) + " FROM fx_context_counts GROUP BY cell"


@query("agg_context_rates", RATES_SQL)
def agg_context_rates(t):
    return st.context_rates(t.fx_context_counts)


@query("agg_total_cpg", """
    SELECT c.cell, total_cpg_number, genome_cov, genome_cov_raw_umi, genome_cov_new_umi, cell_saturation
    FROM (SELECT cell, cast(sum(CASE WHEN context LIKE 'CG%' THEN number ELSE 0 END) AS bigint) AS total_cpg_number
          FROM fx_context_counts GROUP BY cell) c
    LEFT JOIN (SELECT * FROM fx_context_counts WHERE genome_cov IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY cell ORDER BY md5(context)) = 1) f ON c.cell = f.cell""")
def agg_total_cpg(t):
    """In an order of rows that is not that of the context names."""
    return st.total_cpg(t.fx_context_counts.withColumn("line", F.md5("context")))


@query("agg_mito_rate", """
    SELECT cell, mito_mc, mito_cov, round(mito_mc / mito_cov, 6) AS mito_cg_mc_rate FROM (
      SELECT cell, cast(sum(mc) AS bigint) AS mito_mc, cast(sum(cov) AS bigint) AS mito_cov
      FROM fx_contig_sites WHERE chrom = 'chrM' AND substr(context, 2, 1) = 'G' GROUP BY cell) g
    UNION ALL
    SELECT 'pooled', mc, cov, round(mc / cov, 6) FROM (
      SELECT cast(sum(mc) AS bigint) AS mc, cast(sum(cov) AS bigint) AS cov
      FROM fx_contig_sites WHERE chrom = 'chrM' AND substr(context, 2, 1) = 'G'
        AND cell IN (SELECT cell FROM fx_all_cells WHERE cell_idx % 2 = 0)) p""")
def agg_mito_rate(t):
    per_cell = st.mito_rate(t.fx_contig_sites)
    pool = st.mito_pool(per_cell, t.fx_all_cells.where("cell_idx % 2 = 0")).select(F.lit("pooled").alias("cell"), "*")
    return per_cell.unionByName(pool).withColumnRenamed("mito_CG_mc_rate", "mito_cg_mc_rate")


@query("agg_site_pileup", """
    SELECT cell, chrom, pos, strand, context, cast(sum(CASE WHEN vote > 0 THEN 1 ELSE 0 END) AS bigint) AS mc, count(*) AS cov
    FROM (SELECT cell, chrom, pos, strand, context, umi, sum(CASE WHEN meth = 1 THEN 1 ELSE -1 END) AS vote
          FROM fx_base_calls GROUP BY ALL) m
    WHERE vote <> 0 GROUP BY cell, chrom, pos, strand, context""")
def agg_site_pileup(t):
    return st.pileup(t.fx_base_calls)


@query("fx_region_name", """
    SELECT region_ord, concat(chrom, ':', start, '-', "end") AS region_name, 'tiles' AS label FROM fx_regions""")
def fx_region_name(t):
    return t.fx_regions.select(
        "region_ord", fs.region_name("chrom", "start", "end").alias("region_name"),
        F.lit(fs.region_label("/data/tiles.bed")).alias("label"),
    )


@query("fx_safe_rate", """
    SELECT cell, context, pos, round(mc / nullif(cov - 1, 0), 6) AS rate, round(coalesce(mc / nullif(cov - 1, 0), 0.0), 6) AS rate_or_zero
    FROM fx_sites""")
def fx_safe_rate(t):
    den = F.col("cov") - 1
    return t.fx_sites.select(
        "cell", "context", "pos", fr.safe_rate("mc", den).alias("rate"), fr.safe_rate("mc", den, 0.0).alias("rate_or_zero")
    )


@query("fx_format_rates", """
    SELECT cell, context, coalesce(printf('%.6f', genome_cov), 'NA') AS six,
           coalesce(printf('%.2f', genome_cov * 100) || '%', 'NA') AS percent,
           coalesce(printf('%.1f', cell_saturation * 100) || '%', 'NA') AS percent_1,
           round(genome_cov, 6) AS parsed
    FROM (SELECT cell, context, genome_cov + 0.0000001 AS genome_cov, cell_saturation + 0.0000001 AS cell_saturation FROM fx_context_counts) c""")
def fx_format_rates(t):
    shifted = t.fx_context_counts.select(
        "cell", "context", (F.col("genome_cov") + 0.0000001).alias("g"), (F.col("cell_saturation") + 0.0000001).alias("s")
    )
    return shifted.select(
        "cell", "context", fr.format_rate("g").alias("six"), fr.format_percent("g").alias("percent"),
        fr.format_percent_1(F.col("s") * 100).alias("percent_1"), fr.parse_rate(fr.format_rate("g")).alias("parsed"),
    )


@query("fx_json_path", """
    SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(json_extract_string(props, '$.no.such'), 'none') AS missing
    FROM events""")
def fx_json_path(t):
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    return events.select(
        "event_id", fr.json_path("props", "k").alias("k"), fr.json_path("props", "no", "such", default="none").alias("missing")
    )
