"""URL rules with redirect equivalence.

A rule is a host and a path prefix with an action; it fits the host and its subdomains, and the longest fitting rule
decides. Urls that no rule fits take the verdict of their aliases: redirect and canonical-link edges join urls (without
scheme, query, fragment and trailing slash) to connected components. An explicit allow among the members allows the
component's undecided urls, otherwise a block blocks them, otherwise they are allowed.

Rules are found by equality: every host suffix and every path prefix of a length that some rule of that host has. So
the rule table may be large, and a host with many rules gives no pairs. Distinct (host, path) pairs are matched once.

Defined results: a NULL url or one without ``://`` has empty host and path, fits no rule and is allowed; repeated pages
have equal verdicts; rules that differ only in action count as allow; input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.session import materialize

from .graphs import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ("host", "path", "rule", "verdict", "decided_by")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?`` or ``#``."""
    whole = F.coalesce(url, F.lit(""))
    at = F.locate("://", whole)
    rest = F.when(at > 0, whole.substr(at + 3, F.length(whole))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*+([^?#]*+)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Of (action, rule) pairs such as ("block", "example.org/ads/")."""
    return spark.createDataFrame(rules, "action string, rule string")


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of the longest fitting rule of each distinct place that has one."""
    cut = F.locate("/", F.col("rule"))
    parts = rules.filter("rule IS NOT NULL").withColumns({
        "rule_host": F.translate(F.when(cut > 0, F.col("rule").substr(F.lit(1), cut - 1)).otherwise(F.col("rule")), UPPER, LOWER),
        "rule_path": F.when(cut > 0, F.col("rule").substr(cut, F.length("rule"))).otherwise(F.lit("")),
    }).groupBy("rule_host", "rule_path").agg(F.min(F.struct("action", "rule")).alias("r"))
    lengths = parts.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))  # bounded by the longest path
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    hosts = places.filter("host <> ''").select("host", "path", F.explode(F.array_distinct(suffixes)).alias("rule_host"))
    tries = hosts.join(lengths, "rule_host").select("host", "path", "rule_host", F.explode("lengths").alias("n"))
    tries = tries.filter(F.col("n") <= F.length("path")).withColumn("rule_path", F.expr("substring(path, 1, n)"))
    found = tries.join(parts, ["rule_host", "rule_path"])
    best = F.max(F.struct(F.length("r.rule").alias("size"), (F.col("r.action") == "allow").alias("allow"), F.col("r.rule").alias("rule"), F.col("r.action").alias("action")))
    return found.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.action")


def alias_key(host: Column, path: Column) -> Column:
    """Names a page for aliases: host and path without trailing slashes."""
    return F.xxhash64(host, F.regexp_replace(path, "/++$", ""))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target): canonical links and refresh redirects that pages declare, resolved against the page's url."""
    whole = F.col(f"`{html}`")
    tag = F.regexp_extract(whole, r"(?is)<link\b[^>]*?\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    href = F.regexp_extract(tag, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    refresh = F.regexp_extract(whole, r"(?is)<meta\b[^>]*?\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    to = F.regexp_extract(refresh, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)
    some = pages.filter(F.col(f"`{url}`").contains("://") & (F.lower(whole).contains("canonical") | F.lower(whole).contains("refresh")))
    links = some.select(F.col(f"`{url}`").alias("url"), F.explode(F.array(href, to)).alias("target")).filter("target <> ''")
    target = F.regexp_replace("target", "&amp;", "&")
    scheme, host = F.substring_index("url", "://", 1), F.regexp_extract("url", r"^[^:]*+://[^/?#]*+", 0)
    folder = F.regexp_extract("url", r"^[^:]*+://[^/?#]*+(?:[^?#]*/)?", 0)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    full = (
        F.when(target.contains("://"), target).when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(host, target)).when(target.startswith("#"), F.col("url")).otherwise(F.concat(folder, target))
    )
    return links.select("url", full.alias("target"))


def verdicts(pages: DataFrame, rules: DataFrame, links: DataFrame, url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """Adds host, path, rule, verdict and decided_by (rule, alias or default); ``links``: (url, target) edges."""
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    kept = [c for c in (keep or pages.columns) if c not in ADDED]
    base = pages.select(*[f"`{c}`" for c in kept], host.alias("host"), path.alias("path"))
    ends = [host_and_path(F.col(c)) for c in ("url", "target")]
    edges = materialize(links.select(*[x.alias(n) for (h, p), s in zip(ends, "ab") for x, n in ((h, "host_" + s), (p, "path_" + s))]).filter("host_a <> '' AND host_b <> ''"), "links")
    sides = edges.select(F.col("host_a").alias("host"), F.col("path_a").alias("path")).union(edges.select("host_b", "path_b"))
    places = base.filter("host <> ''").select("host", "path").union(sides).distinct()
    decided = materialize(match_rules(places, rules), "rules")
    groups = connected_components(edges.select(alias_key(F.col("host_a"), F.col("path_a")).alias("a"), alias_key(F.col("host_b"), F.col("path_b")).alias("b")))
    marks = decided.select(alias_key(F.col("host"), F.col("path")).alias("node"), F.col("action") == "allow")
    marks = marks.toDF("node", "allow").groupBy("node").agg(F.max("allow").alias("allow"))
    spread = groups.join(marks, "node").groupBy("component").agg(F.max("allow").alias("allow"))  # any member allowed
    aliases = groups.join(spread, "component").select("node", F.when(F.col("allow"), "allow").otherwise("block").alias("by_alias"))
    out = base.join(decided, ["host", "path"], "left").withColumn("node", alias_key(F.col("host"), F.col("path"))).join(aliases, "node", "left")
    by = F.when(F.col("action").isNotNull(), "rule").when(F.col("by_alias").isNotNull(), "alias").otherwise("default")
    return out.select(*[f"`{c}`" for c in kept], "host", "path", "rule", F.coalesce("action", "by_alias", F.lit("allow")).alias("verdict"), by.alias("decided_by"))
