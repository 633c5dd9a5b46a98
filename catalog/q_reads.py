"""Read-level operators: structure, evidence, barcodes, trimming, the demultiplexing pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from epiloom.functions import chemistry as chem
from epiloom.functions import seq as fx
from epiloom.operators import barcodes as bc
from epiloom.operators import demux as dm
from epiloom.plans.demux import annotate_reads, demux as run_demux
from epiloom.sinks import tables as sk
from epiloom.sources import text as tx

from .fixtures import FIXTURES
from .registry import query


def _distance(window: str, adapter: str) -> str:
    """Edit distance to an adapter whose only codes are Y and R: the least over its plain texts."""
    distances = [f"levenshtein({window}, '{text}')" for text in _plain(adapter)]
    return f"least({', '.join(distances)})" if len(distances) > 1 else distances[0]


def _plain(piece: str) -> list[str]:
    texts = [""]
    for base in piece:
        texts = [text + b for text in texts for b in {"Y": "CT", "R": "AG"}.get(base, base)]
    return texts


def _brute_trim(source: str, mate: str, adapter: str, end: str) -> str:
    """Oracle trim of one adapter: the edit distance of every stretch of the read, then the documented rule, stretch by stretch."""
    seq, qual, m = f"{mate}_seq", f"{mate}_qual", len(adapter)
    score = "{n} - CASE WHEN {d} = 0 THEN 0 WHEN {change} < 0 THEN 3 ELSE 2 END"
    partial = []
    for n in range(9, m):
        for change in (0, 1, -1):
            piece, window = (adapter[-n:], f"left({seq}, {n + change})") if end == "5" else (adapter[:n], f"right({seq}, {n + change})")
            far = f"CASE WHEN len({seq}) >= {n + change} THEN {_distance(window, piece)} ELSE 99 END"
            partial.append(f"{{'n': {n}, 'span': {n + change}, 'd': {far}, 'score': {score.format(n=n, d='0' if change == 0 else '1', change=change)}, 'ok': {1 if n >= 10 else 0}, 'change': {change}}}")
    # of equal lengths, one error is a replaced base
    exactly = "CASE WHEN x.change = 0 AND x.d = 1 THEN x.n - 2 ELSE x.score END"
    rank = f"{{'a': -({exactly}), 'b': {'x.span' if end == '5' else '-x.n'}, 'span': x.span, 'score': {exactly}}}"
    fits = "x.d <= x.ok AND (x.change = 0 OR x.d = 1)"
    none = "{'kind': 0, 's': 0, 'e': 0, 'score': 0}"
    part = f"{{'kind': 1, 's': {'0' if end == '5' else f'len({seq}) - parts[1].span'}, 'e': {'parts[1].span' if end == '5' else f'len({seq})'}, 'score': parts[1].score}}"
    first = f"CASE WHEN len(parts) > 0 THEN {part} ELSE {none} END" if end == "5" else none
    met = "x.score > acc.score AND (acc.kind < 2 OR x.s <= acc.s + 9)"
    fold = f"list_reduce(fulls, lambda acc, x: CASE WHEN {met} THEN x ELSE acc END, {first})"
    best = "held" if end == "5" else f"""
        CASE WHEN len(parts) > 0 AND (held.kind = 0 OR (parts[1].score > held.score AND len({seq}) - parts[1].span <= held.s + 9)) THEN {part} ELSE held END"""
    cut = (
        "substr({0}, CASE WHEN best.kind > 0 THEN best.e ELSE 0 END + 1) AS {0}" if end == "5" else
        "CASE WHEN best.kind = 0 THEN {0} ELSE left({0}, best.s) END AS {0}"
    )
    flag = f"{mate}_{'left' if end == '5' else 'right'}"
    window = f"substr({seq}, cast(o AS int) + 1, cast({m} + c AS int))"
    # one error leaves one half of a whole adapter as it is; without either half no stretch can fit
    half = " OR ".join(f"contains({seq}, '{text}')" for text in _plain(adapter[:9]) + _plain(adapter[9:]))
    return f"""
      SELECT * EXCLUDE ({seq}, {qual}, fulls, parts, held, best), {cut.format(seq)}, {cut.format(qual)}, best.kind > 0 AS {flag} FROM (
        SELECT *, {best} AS best FROM (
          SELECT *, {fold} AS held FROM (
            SELECT * EXCLUDE (tried, pieces),
                   list_transform(list_sort([{{'e': x.o + {m} + x.c, 'a': -x.score, 'b': -x.o, 's': x.o, 'score': x.score}}
                     FOR x IN [{{'o': y.o, 'c': y.c, 'score': CASE WHEN y.d = 0 THEN {m} WHEN y.c < 0 THEN {m - 3} ELSE {m - 2} END}}
                               FOR y IN tried IF y.d <= 1 AND (y.c = 0 OR y.d = 1)]]),
                     lambda x: {{'kind': 2, 's': cast(x.s AS int), 'e': cast(x.e AS int), 'score': x.score}}) AS fulls,
                   list_sort([{rank} FOR x IN pieces IF {fits}]) AS parts FROM (
              SELECT *, [{', '.join(partial)}] AS pieces,
                     flatten([[{{'o': o, 'c': c, 'd': {_distance(window, adapter)}}} FOR o IN range(0, CASE WHEN {half} THEN greatest(len({seq}) - {m - 1} - c, 0) ELSE 0 END)] FOR c IN [0, 1, -1]]) AS tried
              FROM {source}) a) b) c) d"""


FIXTURES.update({
    "ox_obs": "SELECT *, substr(r1_seq, 1, 17) AS ocb, substr(r1_seq, 18, 12) AS umi FROM fx_reads",
    "ox_unmatched": "SELECT DISTINCT ocb FROM ox_obs WHERE ocb NOT IN (SELECT cb FROM fx_whitelist)",
    "ox_fix": """
        SELECT ocb, n_hits, CASE WHEN n_hits = 1 THEN one END AS cb,
               CASE WHEN n_hits = 1 THEN concat(spot - 1, substr(ocb, cast(spot AS int), 1)) END AS alt,
               CASE WHEN n_hits = 1 THEN 'corrected' ELSE 'ambiguous' END AS status
        FROM (SELECT *, list_filter(range(1, 18), lambda i: substr(ocb, cast(i AS int), 1) <> substr(one, cast(i AS int), 1))[1] AS spot
              FROM (SELECT ocb, count(*) AS n_hits, min(cb) AS one
                    FROM ox_unmatched JOIN fx_whitelist ON hamming(ocb, cb) = 1 GROUP BY ocb) g) h""",
    "ox_assigned": """
        SELECT o.* EXCLUDE (ocb), o.ocb, coalesce(w.cb, f.cb) AS cb, CASE WHEN w.cb IS NOT NULL THEN 'M' ELSE coalesce(f.alt, '') END AS alt,
               CASE WHEN w.cb IS NOT NULL THEN 'exact' ELSE coalesce(f.status, 'rejected') END AS status
        FROM ox_obs o LEFT JOIN fx_whitelist w ON o.ocb = w.cb LEFT JOIN ox_fix f ON o.ocb = f.ocb""",
    "ox_facts": """
        SELECT *, substr(r1_seq, 58, 18) = 'GTAGATGTGTATAAGAGA' AS has_linker,
               CASE WHEN len(r1_seq) <= 75 THEN 'unknown' WHEN ins3 = 'CCC' THEN 'reverse' ELSE 'forward' END AS chain,
               CASE WHEN substr(r1_seq, 58, 18) = 'GTAGATGTGTATAAGAGA' AND len(r1_seq) > 75 AND ins3 = 'TTT'
                     AND len(translate(probe, 'CT', '')) = 0 AND q / 7 >= 30 THEN len(translate(probe, 'T', '')) END AS ct_c,
               CASE WHEN substr(r1_seq, 58, 18) = 'GTAGATGTGTATAAGAGA' AND len(r1_seq) > 75 AND ins3 = 'TTT'
                     AND len(translate(probe, 'CT', '')) = 0 AND q / 7 >= 30 THEN len(translate(probe, 'C', '')) END AS ct_t
        FROM (SELECT *, concat(substr(r1_seq, 43, 1), substr(r1_seq, 57, 1), substr(r1_seq, 76, 1)) AS ins3,
                     concat(substr(r1_seq, 46, 1), substr(r1_seq, 47, 1), substr(r1_seq, 50, 1), substr(r1_seq, 55, 1)) AS probe,
                     list_sum(list_transform([43, 46, 47, 50, 55, 57, 76], lambda i: ascii(substr(r1_qual, i, 1)) - 33)) AS q
              FROM ox_assigned) p""",
    "ox_trim_a": _brute_trim("ox_facts", "r1", chem.READ1_ADAPTER_5, "5"),
    "ox_trim_b": _brute_trim("ox_trim_a", "r1", chem.READ1_ADAPTER_3, "3"),
    "ox_trim_c": _brute_trim("ox_trim_b", "r2", chem.READ2_ADAPTER_5, "5"),
    "ox_trim_d": _brute_trim("ox_trim_c", "r2", chem.READ2_ADAPTER_3, "3"),
    "ox_crop": """
        SELECT * EXCLUDE (r1_seq, r1_qual, r2_seq, r2_qual, s1, e1, e2),
               substr(r1_seq, s1 + 1, greatest(e1 - s1, 0)) AS r1_seq, substr(r1_qual, s1 + 1, greatest(e1 - s1, 0)) AS r1_qual,
               substr(r2_seq, 10, greatest(e2 - 9, 0)) AS r2_seq, substr(r2_qual, 10, greatest(e2 - 9, 0)) AS r2_qual
        FROM (SELECT *, CASE WHEN len(r1_seq) <= 18 THEN len(r1_seq)
                             ELSE least(len(r1_seq) - CASE WHEN r1_right THEN 9 ELSE 0 END, s1 + 63) END AS e1,
                     len(r2_seq) - CASE WHEN len(r2_seq) > 18 AND r2_right THEN 9 ELSE 0 END AS e2
              FROM (SELECT *, CASE WHEN len(r1_seq) <= 18 THEN 0 WHEN r1_left THEN 9 ELSE 70 END AS s1 FROM ox_trim_d) a) b""",
    "ox_fate": """
        SELECT *, CASE WHEN cb IS NULL THEN 'rejected' WHEN chain = 'unknown' THEN 'unknown_chain'
                       WHEN len(r1_seq) < 20 OR len(r2_seq) < 60 THEN 'too_short' WHEN chimera THEN 'chimeric' ELSE 'valid' END AS fate
        FROM (SELECT *, CASE chain WHEN 'forward' THEN len(regexp_extract_all(r1_seq, 'C[ATC]')) > 2 OR len(regexp_extract_all(r2_seq, '[ATG]G')) > 2
                                   WHEN 'reverse' THEN len(regexp_extract_all(r1_seq, '[ATG]G')) > 2 OR len(regexp_extract_all(r2_seq, 'C[ATC]')) > 2
                                   ELSE false END AS chimera FROM ox_crop) a""",
    "ox_evidence": """
        SELECT chunk_id, cb AS CR, umi AS UB, ct_c AS C, ct_t AS T FROM ox_facts WHERE cb IS NOT NULL AND ct_c IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY chunk_id, cb, umi ORDER BY rid) = 1""",
    "ox_funnel": """
        SELECT f.*, coalesce(ct_umi_dedup, 0) AS ct_umi_dedup, coalesce(c_sum, 0) AS c_sum, coalesce(t_sum, 0) AS t_sum FROM (
          SELECT chunk_id, count(*) AS total, count(*) FILTER (WHERE status = 'rejected') AS rejected,
                 count(*) FILTER (WHERE status = 'ambiguous') AS ambiguous, count(*) FILTER (WHERE status = 'exact') AS exact,
                 count(*) FILTER (WHERE status = 'corrected') AS corrected, count(*) FILTER (WHERE fate = 'unknown_chain') AS unknown_chain,
                 count(*) FILTER (WHERE fate = 'too_short') AS too_short,
                 count(*) FILTER (WHERE fate = 'chimeric' AND chain = 'forward') AS chimeric_forward,
                 count(*) FILTER (WHERE fate = 'chimeric' AND chain = 'reverse') AS chimeric_reverse,
                 count(*) FILTER (WHERE fate = 'valid' AND chain = 'forward') AS forward,
                 count(*) FILTER (WHERE fate = 'valid' AND chain = 'reverse') AS reverse,
                 count(*) FILTER (WHERE has_linker) AS num_17lme,
                 count(*) FILTER (WHERE ct_c IS NOT NULL AND cb IS NOT NULL) AS ct_reads
          FROM ox_fate GROUP BY chunk_id) f
        LEFT JOIN (SELECT chunk_id, count(*) AS ct_umi_dedup, cast(sum(C) AS bigint) AS c_sum, cast(sum(T) AS bigint) AS t_sum
                   FROM ox_evidence GROUP BY chunk_id) e ON f.chunk_id = e.chunk_id""",
})

FUNNEL_FLAT = {
    "total": "funnel.total", "rejected": "funnel.barcode_rejected", "ambiguous": "funnel.barcode_ambiguous",
    "passed": "funnel.barcode_passed.total", "exact": "funnel.barcode_passed.exact",
    "corrected": "funnel.barcode_passed.corrected", "corrected_fraction": "funnel.barcode_passed.corrected_fraction",
    "unknown_chain": "funnel.barcode_passed.unknown_chain", "too_short": "funnel.barcode_passed.too_short",
    "chimeric": "funnel.barcode_passed.chimeric_filtered.total",
    "chimeric_forward": "funnel.barcode_passed.chimeric_filtered.forward",
    "chimeric_reverse": "funnel.barcode_passed.chimeric_filtered.reverse",
    "valid": "funnel.barcode_passed.valid.total", "fraction_of_input": "funnel.barcode_passed.valid.fraction_of_input",
    "forward": "funnel.barcode_passed.valid.forward", "reverse": "funnel.barcode_passed.valid.reverse",
    "num_17lme": "ct.num_17lme", "rate_17lme": "ct.rate_17lme", "ct_reads": "ct.ct_reads",
    "ct_umi_dedup": "ct.ct_umi_dedup", "ct_convertible_bases": "ct.ct_convertible_bases",
    "ct_converted_bases": "ct.ct_converted_bases", "ctot": "ct.CtoT",
}
FUNNEL_SQL = """
    SELECT chunk_id, total, rejected, ambiguous, exact + corrected AS passed, exact, corrected,
           round(corrected / (exact + corrected), 6) AS corrected_fraction, unknown_chain, too_short,
           chimeric_forward + chimeric_reverse AS chimeric, chimeric_forward, chimeric_reverse,
           forward + reverse AS valid, round((forward + reverse) / total, 6) AS fraction_of_input, forward, reverse,
           num_17lme, round(num_17lme / total, 6) AS rate_17lme, ct_reads, ct_umi_dedup,
           c_sum + t_sum AS ct_convertible_bases, t_sum AS ct_converted_bases,
           round(coalesce(t_sum / nullif(c_sum + t_sum, 0), 0.0), 3) AS ctot
    FROM ox_funnel"""


def observed(t):
    return annotate_reads(t.fx_reads)


def demuxed(t):
    return run_demux(t.fx_reads, t.fx_whitelist)


@query("fx_parse_structure", "SELECT rid, ocb, umi, substr(r1_seq, 30, 13) AS extra FROM ox_obs")
def fx_parse_structure(t):
    layout = "B17U12X13"
    return t.fx_reads.select(
        "rid", fx.structure_column("r1_seq", layout, "B").alias("ocb"),
        fx.structure_column("r1_seq", layout, "U").alias("umi"), fx.structure_column("r1_seq", layout, "X").alias("extra"),
    )


@query("fx_has_linker", """
    SELECT chunk_id, count(*) AS total, count(*) FILTER (WHERE has_linker) AS with_linker FROM ox_facts GROUP BY chunk_id""")
def fx_has_linker(t):
    return t.fx_reads.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(fx.has_linker("r1_seq")).alias("with_linker")
    )


@query("fx_ct_counts", "SELECT rid, ct_c AS c, ct_t AS t FROM ox_facts")
def fx_ct_counts(t):
    return observed(t).select("rid", F.col("ct.c").alias("c"), F.col("ct.t").alias("t"))


@query("fx_chain_direction", "SELECT rid, chain FROM ox_facts")
def fx_chain_direction(t):
    return t.fx_reads.select("rid", fx.chain_direction("r1_seq").alias("chain"))


@query("fx_trim_adapter", """
    SELECT rid, r1_seq, r1_qual, r2_seq, r2_qual, r1_left, r1_right, r2_left, r2_right FROM ox_trim_d""")
def fx_trim_adapter(t):
    return fx.trim_adapters(t.fx_reads).select(
        "rid", "r1_seq", "r1_qual", "r2_seq", "r2_qual", "r1_left", "r1_right", "r2_left", "r2_right"
    )


@query("fx_crop_insert", "SELECT rid, r1_seq, r1_qual, r2_seq, r2_qual FROM ox_crop")
def fx_crop_insert(t):
    return fx.crop_insert(fx.trim_adapters(t.fx_reads)).select("rid", "r1_seq", "r1_qual", "r2_seq", "r2_qual")


@query("flt_min_length", """
    SELECT rid, len(r1_seq) AS n1, len(r2_seq) AS n2 FROM ox_crop WHERE len(r1_seq) >= 20 AND len(r2_seq) >= 60""")
def flt_min_length(t):
    return fx.crop_insert(fx.trim_adapters(t.fx_reads)).where(fx.long_enough_pair()).select(
        "rid", F.length("r1_seq").alias("n1"), F.length("r2_seq").alias("n2")
    )


@query("flt_chimeric_ch", "SELECT rid, chain, chimera FROM ox_fate")
def flt_chimeric_ch(t):
    cropped = fx.crop_insert(fx.trim_adapters(t.fx_reads.withColumn("chain", fx.chain_direction("r1_seq"))))
    return cropped.select("rid", "chain", fx.is_chimeric("r1_seq", "r2_seq", "chain").alias("chimera"))


@query("fx_read_name", """
    SELECT rid, concat('@', cb, '_', umi, '_', chain, '_', alt, '_read', rid, ':', cb, ' 1:N:0') AS r1_name,
           concat('@', cb, '_', umi, '_', chain, '_', alt, '_read', rid, ':', cb, ' 2:N:0') AS r2_name
    FROM ox_facts WHERE cb IS NOT NULL""")
def fx_read_name(t):
    named = bc.assign_barcodes(observed(t), t.fx_whitelist).where(F.col("cb").isNotNull())
    return named.select(
        "rid",
        fx.demux_read_name("r1_header", "cb", "umi", "chain", "alt").alias("r1_name"),
        fx.demux_read_name("r2_header", "cb", "umi", "chain", "alt").alias("r2_name"),
    )


@query("fx_correction_tag", "SELECT ocb, cb, alt FROM ox_fix WHERE n_hits = 1")
def fx_correction_tag(t):
    unmatched = bc.barcode_histogram(bc.match_exact(observed(t), t.fx_whitelist).where(~F.col("is_exact")))
    return bc.correct_hamming1(unmatched, t.fx_whitelist).where("n_hits = 1").select("ocb", "cb", "alt")


@query("join_barcode_exact", "SELECT rid, ocb, status = 'exact' AS is_exact FROM ox_assigned")
def join_barcode_exact(t):
    return bc.match_exact(observed(t), t.fx_whitelist).select("rid", "ocb", "is_exact")


@query("join_barcode_hamming1", "SELECT rid, ocb, cb, alt, status FROM ox_assigned")
def join_barcode_hamming1(t):
    return bc.assign_barcodes(observed(t).select("rid", "ocb"), t.fx_whitelist)


@query("join_barcode_hamming1_shuffled", "SELECT rid, ocb, cb, alt, status FROM ox_assigned")
def join_barcode_hamming1_shuffled(t):
    """The path taken when the decisions are too large to broadcast: frequent barcodes are salted."""
    return bc.assign_barcodes(observed(t).select("rid", "ocb"), t.fx_whitelist, max_bytes=0, reads_per_salt=3)


@query("join_barcode_hamming_k", """
    SELECT ocb, cb, cast(d AS int) AS dist FROM (
      SELECT ocb, cb, hamming(ocb, cb) AS d, min(hamming(ocb, cb)) OVER (PARTITION BY ocb) AS best
      FROM ox_unmatched JOIN fx_whitelist ON hamming(ocb, cb) <= 2) c WHERE d = best""")
def join_barcode_hamming_k(t):
    unmatched = bc.barcode_histogram(bc.match_exact(observed(t), t.fx_whitelist).where(~F.col("is_exact")))
    return bc.nearest_within(unmatched, t.fx_whitelist, 2)


@query("join_reads_to_whitelist_prefix", """
    SELECT p.prefix, count(cb) AS reads FROM (SELECT DISTINCT left(cb, 3) AS prefix FROM fx_whitelist) p
    LEFT JOIN ox_assigned a ON left(a.cb, 3) = p.prefix GROUP BY p.prefix""")
def join_reads_to_whitelist_prefix(t):
    assigned = bc.assign_barcodes(observed(t).select("rid", "ocb"), t.fx_whitelist)
    per_prefix = assigned.groupBy(F.substring("cb", 1, 3).alias("prefix")).agg(F.count("cb").alias("reads"))
    return bc.prefix_chunks(t.fx_whitelist, 3).join(per_prefix, "prefix", "left").select(
        "prefix", F.coalesce("reads", F.lit(0)).alias("reads")
    )


@query("win_first_per_umi", """
    SELECT chunk_id, CR AS cr, UB AS ub, C AS c, T AS t FROM ox_evidence""")
def win_first_per_umi(t):
    assigned = bc.assign_barcodes(observed(t), t.fx_whitelist)
    found = dm.first_per_umi(assigned)
    return found.select("chunk_id", F.col("CR").alias("cr"), F.col("UB").alias("ub"), F.col("C").alias("c"), F.col("T").alias("t"))


@query("agg_ctot_per_cell", """
    SELECT CR AS cr, cast(sum(C) AS bigint) AS c, cast(sum(T) AS bigint) AS t, round(sum(T) / (sum(C) + sum(T)), 3) AS ctot
    FROM ox_evidence GROUP BY CR""")
def agg_ctot_per_cell(t):
    per_cell = dm.conversion_per_cell(dm.first_per_umi(bc.assign_barcodes(observed(t), t.fx_whitelist)))
    return per_cell.select(F.col("CR").alias("cr"), F.col("C").alias("c"), F.col("T").alias("t"), F.col("CtoT").alias("ctot"))


@query("agg_demux_funnel", FUNNEL_SQL)
def agg_demux_funnel(t):
    return demuxed(t).funnel.select("chunk_id", *[F.col(path).alias(name) for name, path in FUNNEL_FLAT.items()])


POOL_SQL = """
    SELECT round((sum(exact) + sum(corrected)) / sum(total), 6) AS valid_barcode_rate,
           round((sum(forward) + sum(reverse)) / sum(total), 6) AS valid_demux_rate,
           round(sum(corrected) / (sum(exact) + sum(corrected)), 6) AS barcode_corrected_fraction,
           round(sum(too_short) / sum(total), 6) AS dropped_too_short,
           round((sum(chimeric_forward) + sum(chimeric_reverse)) / (sum(exact) + sum(corrected) - sum(too_short)), 6) AS dropped_chimeric,
           cast(sum(forward) AS bigint) AS forward_reads, cast(sum(reverse) AS bigint) AS reverse_reads,
           round(sum(num_17lme) / sum(total), 6) AS rate_17lme, round(sum(t_sum) / (sum(c_sum) + sum(t_sum)), 6) AS {ctot}
    FROM ox_funnel"""


@query("agg_funnel_pool", POOL_SQL.format(ctot="ctot"))
def agg_funnel_pool(t):
    return dm.pool_funnels(demuxed(t).funnel).withColumnRenamed("CtoT", "ctot")


VALID_SQL = """
    SELECT chunk_id, rid, cb, umi, chain,
           concat('@', cb, '_', umi, '_', chain, '_', alt, '_read', rid, ':', cb, ' 1:N:0') AS r1_name, r1_seq, r1_qual,
           concat('@', cb, '_', umi, '_', chain, '_', alt, '_read', rid, ':', cb, ' 2:N:0') AS r2_name, r2_seq, r2_qual
    FROM ox_fate WHERE fate = 'valid'"""


@query("demux", VALID_SQL)
def demux(t):
    return demuxed(t).valid


def fastq_shards(t):
    path = t.path("fastq")
    sk.write_fastq_shards(demuxed(t).valid, path, bases=2)
    return path


def shards(t):
    path = t.path("shards")
    sk.write_prefix_shards(demuxed(t).valid, path, bases=2)
    return t.spark.read.parquet(path)


@query("snk_prefix_shards", """
    SELECT left(cb, 2) AS prefix, chain, concat('@', cb, '_', umi, '_', chain, '_', alt, '_read', rid, ':', cb, ' 1:N:0') AS r1_name, r1_seq, r1_qual,
           concat('@', cb, '_', umi, '_', chain, '_', alt, '_read', rid, ':', cb, ' 2:N:0') AS r2_name, r2_seq, r2_qual
    FROM ox_fate WHERE fate = 'valid'""")
def snk_prefix_shards(t):
    """FASTQ shards read back as pairs of mates."""
    path = fastq_shards(t)
    pairs = tx.read_pairs(t.spark, f"{path}/mate=1", f"{path}/mate=2", chunk_pattern=sk.FASTQ_CHUNK)
    part = lambda name: F.regexp_extract("chunk_id", f"{name}=([^/]*)/", 1).alias(name)
    return pairs.select(
        part("prefix"), part("chain"), F.col("r1_header").alias("r1_name"), "r1_seq", "r1_qual", F.col("r2_header").alias("r2_name"), "r2_seq", "r2_qual")


@query("set_regroup_shards", """
    SELECT rid, left(cb, 2) AS prefix, chain, r1_seq FROM ox_fate WHERE fate = 'valid'""")
def set_regroup_shards(t):
    return shards(t).select("rid", "prefix", "chain", "r1_seq")


@query("snk_chunk_manifest", """
    SELECT left(cb, 2) AS chunk_id, left(cb, 2) AS prefix, concat(chain, '_', mate) AS stream, count(*) AS pairs, true AS counted
    FROM ox_fate, (SELECT unnest([1, 2]) AS mate) m WHERE fate = 'valid' GROUP BY ALL""")
def snk_chunk_manifest(t):
    """The manifest of files really written: each is opened by the name it has there."""
    path = fastq_shards(t)
    manifest = sk.chunk_manifest(sk.shard_files(t.spark, path))
    listed = manifest.select("chunk_id", "prefix", "stream", "subshard_count", F.explode(F.split("subshard_paths", ";")).alias("file"))
    lines = t.spark.read.option("recursiveFileLookup", True).text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/").alias("file")
    found = listed.withColumn("file", plain("file")).join(lines.withColumn("file", plain("file")), "file")
    return found.groupBy("chunk_id", "prefix", "stream").agg(
        (F.sum("n") / 4).cast("long").alias("pairs"), (F.count(F.lit(1)) == F.max("subshard_count")).alias("counted"))
