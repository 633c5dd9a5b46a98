"""One query for each operator of this package, over whole tables, and SQL oracles where SQL can say it.

Queries without an oracle are tested against brute force, exact round trips or held-out accuracy in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.session import materialize, scratch_path

from . import (
    boosted_trees, bpe, decontaminate, fill_middle, html_text, ngram_join, pii, plane_clusters, quality, secrets, toxicity, train_order, url_filters,
)
from .spans import listed

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
TOXIC_FROM = 0.7
GOOD_FROM = 0.3
END_ID = 65_535  # after each document; no id of the vocabulary
ORDER_KEY = 20_240_229


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = url_filters.rule_table(spark, URL_RULES)
    found = url_filters.verdicts(pages, rules, url_filters.page_links(pages), keep=["page_id"])
    return found.select("page_id", "host", "path", "rule", "verdict")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), keep=~held)
    found = toxicity.score(docs, model, keep=["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "evidence")


def _of(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", *[_of(k) for k in secrets.KINDS[:3]], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *quality.COUNTS[:5], "base_failed", "kept", "rejected_by")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode(table(spark, sf_dir, "documents"), vocabulary(), keep_ids=False, keep=["doc_id"])
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", *[_of(k) for k in pii.KINDS], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op9_train_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids (2 bytes each) of every document, an end id after each, in full sequences of 1,024."""
    docs = bpe.token_ids(table(spark, sf_dir, "documents"), vocabulary(), keep=["doc_id"])
    sequences = train_order.pack(docs, "ids", end=END_ID, item_bytes=2)
    folder = scratch_path(spark, "shards")
    return train_order.write_shards(
        sequences, folder if "://" in folder or folder.startswith("file:") else f"file://{folder}", ORDER_KEY, item_bytes=2)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.transform(table(spark, sf_dir, "documents"), keep=["doc_id"])
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(fill_middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op12_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plane_clusters.clusters(table(spark, sf_dir, "embeddings"), keep=["vec_id"])


def op13_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    found = boosted_trees.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), allowed=~held, keep=["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_filters, op2_toxicity, op3_secrets, op4_html_text, op5_quality, op6_bpe, op7_ngram_join, op8_pii, op9_train_order, op10_decontaminate,
              op11_fill_middle, op12_plane_clusters, op13_boosted_trees)
}

UP, LOW = url_filters.UPPER, url_filters.LOWER

ORACLES: dict[str, str] = {}

ORACLES["op1_url_filters"] = rf"""
WITH RECURSIVE rules(action, rule) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
parts AS (SELECT action, rule, split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp FROM rules),
urls AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest, html, url FROM pages),
placed AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UP}', '{LOW}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, html FROM urls),
hrefs AS (
  SELECT host, path, regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*?\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS t FROM placed
  UNION ALL SELECT host, path, regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*?\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) FROM placed),
targets AS (SELECT host, path, substr(t, strpos(t, '://') + 3) AS rest FROM hrefs WHERE host <> '' AND strpos(t, '://') > 0),
edges AS (SELECT host AS h1, path AS p1, translate(regexp_extract(rest, '^[^/?#]*'), '{UP}', '{LOW}') AS h2, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS p2 FROM targets),
places AS (SELECT host, path FROM placed UNION SELECT h2, p2 FROM edges),
fits AS (
  SELECT host, path, action, rule, row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, action, rule DESC) AS k
  FROM places JOIN parts ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
best AS (SELECT host, path, action, rule FROM fits WHERE k = 1),
named AS (SELECT host || rtrim(path, '/') AS node, max(action = 'allow') AS allow FROM best GROUP BY 1),
pairs AS (SELECT h1 || rtrim(p1, '/') AS a, h2 || rtrim(p2, '/') AS b FROM edges WHERE h2 <> ''),
sides AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a, a AS b FROM sides UNION SELECT r.a, e.b FROM reach r JOIN sides e ON r.b = e.a),
alias AS (SELECT a AS node, max(allow) AS allow FROM reach JOIN named ON b = node GROUP BY a)
SELECT page_id, p.host, p.path, rule, coalesce(action, CASE WHEN allow THEN 'allow' WHEN NOT allow THEN 'block' END, 'allow') AS verdict
FROM placed p LEFT JOIN best b ON p.host = b.host AND p.path = b.path LEFT JOIN alias ON node = p.host || rtrim(p.path, '/')
"""

ORACLES["op7_ngram_join"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS g FROM d),
x AS (SELECT doc_id, unnest(g) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b USING (h) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * c >= 90 * (len(sa.g) + len(sb.g) - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, len(g)::BIGINT AS n_shingles, m AS component_id FROM s JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) ON doc_id = a
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op10_decontaminate"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS t
  FROM (SELECT *, least(10, len(w)) AS k FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, unnest([{{'pos': i, 't': array_to_string(w[i:i + k - 1], ' ')}} FOR i IN range(1, len(w) - k + 2)], recursive := true)
  FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k),
hits AS (SELECT doc_id, pos, k, item_id FROM dw JOIN bw USING (k, t)),
n AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + k)) AS p FROM hits) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id
"""

_H = ", ".join(f"('0x' || substr(k, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))

ORACLES["op11_fill_middle"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, {_H} FROM d),
c AS (SELECT *, len(w)::BIGINT AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(w[1:a], '') AS x, array_to_string(w[a + 1:b], '') AS y, array_to_string(w[b + 1:], '') AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


def _clusters_sql(rounds: int = plane_clusters.ROUNDS, k: int = plane_clusters.CLUSTERS) -> str:
    """One common table for each assignment and each update; vectors and centroids as rows of (component, value)."""
    nearest = """a{i} AS MATERIALIZED (SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
  SELECT r, cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM v JOIN c{i} c USING (i) GROUP BY r, cluster) GROUP BY r)"""
    update = """c{j} AS MATERIALIZED (SELECT c.cluster, c.i, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
  SELECT cluster, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x FROM a{i} JOIN v USING (r) GROUP BY cluster, i) m USING (cluster, i))"""
    steps = [nearest.format(i=0)]
    for i in range(rounds):
        steps += [update.format(i=i, j=i + 1), nearest.format(i=i + 1)]
    last = rounds
    return f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {plane_clusters.SIZE} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x::DOUBLE)]) = {plane_clusters.SIZE}),
v AS MATERIALIZED (SELECT r, unnest(range({plane_clusters.SIZE})) AS i, unnest([floor({plane_clusters.SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding]) AS x FROM e),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('{plane_clusters.SALT}' || coalesce(vec_id::VARCHAR, ''))) - 1 AS cluster FROM e),
c0 AS MATERIALIZED (SELECT cluster, i, x FROM s JOIN v USING (r) WHERE cluster < {k}),
{", ".join(steps)},
n AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS name FROM c{last} GROUP BY cluster)
SELECT vec_id, cluster::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, name AS centroid_sha256
FROM a{last} JOIN e USING (r) JOIN n USING (cluster)
"""


ORACLES["op12_plane_clusters"] = _clusters_sql()
