"""Domain tables derived from the given tables, in SQL both Spark and DuckDB read.

Each entry is the body of a common table expression; ``with_clause`` orders the
ones a query needs. ``{days}``, ``{div}`` and ``{read_key}`` are the only dialect differences.
"""

from __future__ import annotations

import re

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

HEX = "'0123456789abcdef'"
DNA_NO_C = "'AGTTAGTAGTTAGGTA'"
DNA_WITH_C = "'ACGTTAGTAGTTAGGT'"


def dna(text: str, alphabet: str = DNA_NO_C) -> str:
    return f"translate(md5({text}), {HEX}, {alphabet})"


FIXTURES: dict[str, str] = {
    "fx_sites": """
        SELECT cell, chrom, pos,
               CASE WHEN pos % 2 = 0 THEN '+' ELSE '-' END AS strand,
               CASE pos % 8 WHEN 0 THEN 'CGA' WHEN 1 THEN 'CGT' WHEN 2 THEN 'CAG' WHEN 3 THEN 'CTT'
                            WHEN 4 THEN 'CCG' WHEN 5 THEN 'CAA' WHEN 6 THEN 'CGC' ELSE 'CTG' END AS context,
               mc, cov
        FROM (
          SELECT concat('c', lpad(cast(l_suppkey AS string), 6, '0')) AS cell,
                 CASE l_returnflag WHEN 'R' THEN 'chr1' WHEN 'A' THEN 'chr2' ELSE 'chrX' END AS chrom,
                 {days} + 1 AS pos,
                 cast(sum(CASE WHEN l_discount < 0.05 THEN 1 ELSE 0 END) AS bigint) AS mc,
                 count(*) AS cov
          FROM lineitem GROUP BY 1, 2, 3) g""",
    "fx_contig_sites": """
        SELECT cell,
               CASE WHEN chrom = 'chrX' AND pos % 50 = 0 THEN 'chrM'
                    WHEN chrom = 'chrX' AND pos % 51 = 0 THEN 'GL001' ELSE chrom END AS chrom,
               pos, strand, context, mc, cov
        FROM fx_sites""",
    "fx_encoded": """
        SELECT chrom, pos, cell, cast(CASE WHEN mc > 0 THEN 1 ELSE -1 END AS tinyint) AS m
        FROM fx_sites WHERE cov > 0 AND (mc = 0 OR mc = cov)""",
    "fx_all_cells": """
        SELECT concat('c', lpad(cast(s_suppkey AS string), 6, '0')) AS cell,
               cast(row_number() OVER (ORDER BY s_suppkey) - 1 AS int) AS cell_idx
        FROM (SELECT s_suppkey FROM supplier UNION ALL SELECT -1 AS s_suppkey) s""",
    "fx_whitelist": f"""
        SELECT DISTINCT substr({dna("concat('c', cast(c_custkey AS string))")}, 1, 17) AS cb FROM customer""",
    "fx_reads": f"""
        SELECT rid, chunk_id, concat('@read', cast(rid AS string), ' 1:N:0') AS r1_header,
               concat('@read', cast(rid AS string), ' 2:N:0') AS r2_header,
               r1_seq, repeat(qc, length(r1_seq)) AS r1_qual, r2_seq, repeat(qc, length(r2_seq)) AS r2_qual
        FROM (
          SELECT rid, CASE WHEN rid % 2 = 0 THEN '0001' ELSE '0002' END AS chunk_id, qc,
                 substr(concat(ocb, umi, lk, ins), 1, CASE WHEN l_linenumber = 7 THEN 70 ELSE 400 END) AS r1_seq,
                 CASE WHEN l_partkey % 7 = 0 THEN concat(substr(r2, 1, 80), 'CTATCTCTTATACTCATCT', substr(r2, 81, 10))
                      WHEN l_partkey % 7 = 1 THEN concat(substr(r2, 1, 84), 'CTGTCTCTTATA')
                      WHEN l_partkey % 7 = 2 THEN concat('GAGACAG', 'AAGAGACAG', r2)
                      WHEN l_partkey % 7 = 3 THEN concat(substr(r2, 1, 40), 'CTGTCTCTTATACACATCT', r2)
                      WHEN l_partkey % 7 = 4 THEN concat(substr(r2, 1, 3), 'AGATGTGTCATAAGAGACAG', substr(r2, 4, 80), 'CTATCTCTTATACAATCT', substr(r2, 1, 9))
                      WHEN l_partkey % 7 = 5 THEN concat('GTGTATAAGGACAG', substr(r2, 1, 70), CASE WHEN l_linenumber % 2 = 0 THEN 'CTGTCTTCTTATACACATCTAC' ELSE 'CTGTCTCTATACA' END)
                      ELSE r2 END AS r2_seq
          FROM (
            SELECT rid, l_partkey, l_linenumber, umi, qc, r2,
                   CASE WHEN k <= 5 THEN bc
                        WHEN k <= 7 THEN concat(substr(bc, 1, p), translate(substr(bc, p + 1, 1), 'ACGT', 'CGTA'), substr(bc, p + 2))
                        WHEN k = 8 THEN concat(substr(bc, 1, p), 'N', substr(bc, p + 2))
                        ELSE substr({dna("concat('x', cast(rid AS string))")}, 1, 17) END AS ocb,
                   concat('TTTCTTATATGGG', i1, 'GT', b1, 'TGTTGTTG', b2, 'T', i2, 'GTAGATGTGTATAAGAGA', i3, 'AG') AS lk,
                   CASE WHEN l_linenumber % 3 = 0 THEN concat(ins, 'CTGTCTCTTATACACATCT', 'GGATTT')
                        WHEN l_linenumber % 3 = 1 THEN concat(ins, ins2, ins3) ELSE ins END AS ins
            FROM (
              SELECT ((({{read_key}} * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100
                       + cast(l_quantity AS int) AS rid, l_partkey, l_linenumber, l_partkey % 10 AS k,
                     cast((l_partkey + l_linenumber) % 17 AS int) AS p,
                     substr({dna("concat('c', cast(o_custkey AS string))")}, 1, 17) AS bc,
                     substr({dna("concat('u', cast(l_orderkey % 50 AS string))")}, 1, 12) AS umi,
                     {dna("concat('i', cast(l_orderkey * 10 + l_linenumber AS string))", DNA_WITH_C)} AS ins,
                     {dna("concat('j', cast(l_orderkey * 10 + l_linenumber AS string))")} AS ins2,
                     {dna("concat('h', cast(l_orderkey * 10 + l_linenumber AS string))")} AS ins3,
                     translate(concat({dna("concat('k', cast(l_orderkey * 10 + l_linenumber AS string))")},
                            {dna("concat('m', cast(l_orderkey * 10 + l_linenumber AS string))")},
                            {dna("concat('n', cast(l_orderkey * 10 + l_linenumber AS string))")}),
                               'G', CASE WHEN l_returnflag = 'R' THEN 'G' ELSE 'A' END) AS r2,
                     CASE WHEN l_quantity < 10 THEN '5' ELSE 'I' END AS qc,
                     CASE WHEN l_returnflag = 'R' THEN 'C' ELSE 'T' END AS i1,
                     CASE WHEN l_returnflag = 'R' THEN 'C' ELSE 'T' END AS i2,
                     CASE WHEN l_returnflag = 'A' THEN 'T' ELSE 'C' END AS i3,
                     CASE WHEN l_suppkey % 20 = 0 THEN 'C' ELSE 'T' END AS b1,
                     CASE WHEN l_suppkey % 33 = 0 THEN 'A' ELSE 'T' END AS b2
              FROM (SELECT /*+ REPARTITION(l_orderkey) */ l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, o_custkey
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) j) a) b) c""",
    "fx_alignments": f"""
        SELECT cast(l_orderkey AS string) AS read_name,
               CASE WHEN l_partkey % 29 = 0 THEN NULL
                    ELSE concat('c', lpad(cast(o_custkey % 100 AS string), 6, '0')) END AS cell,
               substr({dna("concat('u', cast(l_orderkey % 50 AS string))")}, 1, 12) AS umi,
               cast(CASE WHEN l_partkey % 31 = 0 THEN 4 WHEN l_partkey % 37 = 0 THEN 256
                    WHEN l_partkey % 41 = 0 THEN 512 WHEN l_partkey % 43 = 0 THEN 2048 ELSE 0 END AS int) AS flag,
               CASE l_returnflag WHEN 'R' THEN 'chr1' WHEN 'A' THEN 'chr2' ELSE 'chrX' END AS chrom,
               cast(l_partkey % 500 AS int) AS b_start,
               cast(l_partkey % 500 + cast(l_quantity AS int) AS int) AS b_end,
               CASE WHEN l_linestatus = 'O' THEN 'forward' ELSE 'reverse' END AS strand,
               CASE WHEN (l_orderkey * 10 + l_linenumber) % 2 = 0 THEN '0001' ELSE '0002' END AS chunk_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_barcode_counts": """
        SELECT chunk_id, strand, cell AS barcode, count(*) AS aligned_reads
        FROM fx_alignments WHERE cell IS NOT NULL GROUP BY 1, 2, 3""",
    "fx_totals": """
        SELECT barcode, cast(sum(aligned_reads) AS bigint) AS reads FROM fx_barcode_counts GROUP BY 1""",
    "fx_skewed_counts": """
        SELECT concat('z', lpad(cast(g AS string), 6, '0')) AS barcode, count(*) AS reads
        FROM (SELECT cast(floor(2000e0 / (1 + l_partkey)) AS int) AS g FROM lineitem) s GROUP BY 1""",
    "fx_base_calls": f"""
        SELECT concat('c', lpad(cast(l_suppkey AS string), 6, '0')) AS cell,
               CASE l_returnflag WHEN 'R' THEN 'chr1' WHEN 'A' THEN 'chr2' ELSE 'chrX' END AS chrom,
               {{days}} + 1 AS pos,
               CASE WHEN ({{days}} + 1) % 2 = 0 THEN '+' ELSE '-' END AS strand,
               CASE ({{days}} + 1) % 8 WHEN 0 THEN 'CGA' WHEN 1 THEN 'CGT' WHEN 2 THEN 'CAG' WHEN 3 THEN 'CTT'
                    WHEN 4 THEN 'CCG' WHEN 5 THEN 'CAA' WHEN 6 THEN 'CGC' ELSE 'CTG' END AS context,
               substr({dna("concat('u', cast(l_orderkey % 3 AS string))")}, 1, 12) AS umi,
               CASE WHEN l_discount < 0.05 THEN 1 ELSE 0 END AS meth
        FROM lineitem""",
    "fx_regions": """
        SELECT cast(row_number() OVER (ORDER BY chrom DESC, start_) AS int) AS region_ord, chrom,
               start_ AS start, end_ AS end
        FROM (
          SELECT DISTINCT chrom, cast(({div:pos - 1:250}) * 250 + 1 AS int) AS start_,
                 cast(({div:pos - 1:250}) * 250 + 250 AS int) AS end_ FROM fx_sites
          UNION ALL
          SELECT DISTINCT chrom, 5001 AS start_, 5250 AS end_ FROM fx_sites
          UNION ALL
          SELECT DISTINCT chrom, 2000 AS start_, 2600 AS end_ FROM fx_sites
          UNION ALL
          SELECT DISTINCT 'chr9' AS chrom, 1 AS start_, 250 AS end_ FROM fx_sites) t""",
    "fx_chrom_sizes": """
        SELECT DISTINCT chrom, 0 AS start, 4000 AS end FROM fx_sites""",
    "fx_context_counts": """
        SELECT cell, context, mc, cov, number,
               CASE WHEN n % 3 = 0 THEN NULL ELSE round(cov / 1000e0, 6) END AS genome_cov,
               CASE WHEN n % 3 = 0 THEN NULL ELSE round(cov / 900e0, 6) END AS genome_cov_raw_umi,
               CASE WHEN n % 3 = 0 THEN NULL ELSE round(cov / 800e0, 6) END AS genome_cov_new_umi,
               CASE WHEN n % 3 = 0 THEN NULL ELSE round(mc / cast(cov AS double), 6) END AS cell_saturation
        FROM (SELECT cell, context, cast(sum(mc) AS bigint) AS mc, cast(sum(cov) AS bigint) AS cov, count(*) AS number,
                     count(*) + ascii(substr(context, 2, 1)) AS n
              FROM fx_sites GROUP BY cell, context) g""",
    "fx_key_map": """
        SELECT cell AS m_cb, concat('g', cast(cell_idx AS string)) AS gex_cb
        FROM fx_all_cells WHERE cell_idx % 2 = 0""",
}

SPARK = {"days": "datediff(cast(l_shipdate AS date), date'1992-01-01')", "div": "(({}) div {})", "read_key": "l_orderkey"}
DIALECTS = {
    "spark": SPARK,
    "spark_wide": {**SPARK, "read_key": "cast(l_orderkey AS decimal(20, 0))"},
    "duckdb": {
        "days": "cast(cast(l_shipdate AS date) - date '1992-01-01' AS int)",
        "div": "(({}) // {})",
        "read_key": "l_orderkey",
    },
}

#: A read's number is 10^12 times its order's key and more: from here on it doesn't fit 64 bits.
WIDE_FROM = 9_200_000

_DIV = re.compile(r"\{div:([^:}]+):([^:}]+)\}")
_NAME = re.compile(r"\b[fo]x_[a-z0-9_]+\b")


def render(sql: str, dialect: str) -> str:
    words = DIALECTS[dialect]
    sql = _DIV.sub(lambda m: words["div"].format(m.group(1), m.group(2)), sql)
    return sql.replace("{days}", words["days"]).replace("{read_key}", words["read_key"])


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name in _NAME.findall(sql):
        if name in FIXTURES and name not in seen:
            _needed(FIXTURES[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def with_clause(sql: str, dialect: str, extra: list[str] | None = None) -> str:
    """``sql`` preceded by the fixtures it mentions."""
    parts = list(extra or [])
    parts += [f"{n} AS ({render(FIXTURES[n], dialect)})" for n in _needed(sql, [])]
    body = render(sql, dialect)
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


def spark_fixture(spark, sf_dir: str, name: str):
    """The fixture as a Spark DataFrame over the Parquet tables in ``sf_dir``."""
    return spark_sql(spark, sf_dir, f"SELECT * FROM {name}")


def spark_sql(spark, sf_dir: str, sql: str):
    closure = sql + " ".join(FIXTURES[n] for n in _needed(sql, []))
    base = [
        f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)"
        for t in BASE_TABLES
        if re.search(rf"\b(?:FROM|JOIN)\s+{t}\b", closure)
    ]
    return spark.sql(with_clause(sql, _spark_dialect(spark, sf_dir, closure), base))


def _spark_dialect(spark, sf_dir: str, closure: str) -> str:
    """Read numbers are exact at any size: bigint, as in SQL, and decimal for keys with which SQL's own arithmetic overflows."""
    if "{read_key}" not in closure:
        return "spark"
    largest = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg({"l_orderkey": "max"}).first()[0]
    return "spark_wide" if (largest or 0) >= WIDE_FROM else "spark"
