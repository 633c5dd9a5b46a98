"""Secret scan with multipart credential linking, in built-in Spark expressions.

Base matches (assignments, access keys, long hex strings) always count. Weak parts (account names, loose high-entropy
strings, endpoints) count only if complementary parts stand in the same scope, ``SCOPE`` code points to either side:

* a weak secret next to an access key, or next to an account name with an endpoint;
* an account name next to a base secret, or next to a weak secret with an endpoint;
* an endpoint next to an identifier and a secret, one of them from a base match.

The link is an interval join on (text, scope bucket). Before it, the parts of a bucket are reduced to the first and
last place for each role, which decide the three touching buckets exactly, so a bucket full of parts gives no pairs.
Equal texts are joined once.

Defined results: NULL counts as the empty text, which has no spans; texts of any length are searched whole, with places from
running sums in time about linear in the matches; repeated rows have equal results; input columns
named ``base`` or ``spans`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.session import materialize

from .spans import SPAN, as_spans, found, in_order, masked, of_texts, outside, read_once, with_more

KINDS = ("assign", "access", "hex", "weak_secret", "account", "endpoint")
SCOPE = 400
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is long enough is one match from its first character; shorter ones fail as a whole.
ACCESS = rf"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}+"
HEX = rf"[0-9a-f]{{{MIN_HEX},}}+"
WEAK_SECRET = r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z0-9+/_-]{24})(?=[A-Za-z+/_-]*+[0-9])(?=[^A-Z\s]*+[A-Z])[A-Za-z0-9+/_-]{24,}+={0,2}+(?![A-Za-z0-9+/_=-])"
ACCOUNT = r"""(?<![A-Za-z0-9])(?i:access_?key_?id|client_?id|user(?:name)?|account|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,}+)"""
ENDPOINT = r"""(?<![A-Za-z0-9])(?:https?|jdbc:[a-z]{2,12}|amqp|mongodb|postgres(?:ql)?|redis|ftp)://[^\s"'<>]{4,}+"""


def base_spans(text: Column) -> Column:
    return in_order(
        as_spans(found(text, ASSIGN, 2, needs=text.rlike("[:=]")), "assign", 0, lambda m: F.length(m["value"]) >= MIN_VALUE),
        as_spans(found(text, ACCESS, needs=F.contains(text, F.lit("AKIA"))), "access", 1),
        as_spans(found(text, HEX), "hex", 2),
    )


def weak_spans(text: Column, base: Column) -> Column:
    return outside(in_order(
        as_spans(found(text, WEAK_SECRET), "weak_secret", 3),
        as_spans(found(text, ACCOUNT, 1, needs=text.rlike("[:=]")), "account", 4, whole=False),
        as_spans(found(text, ENDPOINT, needs=F.contains(text, F.lit("://"))), "endpoint", 5),
    ), base)


def _role(kind: Column) -> Column:
    return F.when(kind.isin("access", "account"), "id").when(kind == "endpoint", "place").otherwise("secret")


def link(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans that complementary parts confirm; ``parts``: h1, h2, start, end, rank, kind."""
    parts = parts.withColumn("role", _role(F.col("kind"))).withColumn("strong", F.col("rank") < 3).withColumn("bucket", F.floor(F.col("start") / scope))
    places = parts.groupBy("h1", "h2", "bucket", "role", "strong").agg(F.min("start").alias("low"), F.max("start").alias("high"))
    weak = parts.filter("NOT strong").withColumn("mine", F.col("bucket")).withColumn("bucket", F.explode(F.array(*[F.col("bucket") + i for i in (-1, 0, 1)])))
    weak = weak.withColumnRenamed("role", "own").drop("strong")
    near = (F.col("bucket") == F.col("mine")) | ((F.col("bucket") < F.col("mine")) & (F.col("high") >= F.col("start") - scope)) | ((F.col("bucket") > F.col("mine")) & (F.col("low") <= F.col("start") + scope))
    met = weak.join(places.filter(F.col("role").isNotNull()), ["h1", "h2", "bucket"]).filter(near & (F.col("role") != F.col("own")))
    has = lambda role, strong=None: F.max((F.col("role") == role) & (F.lit(True) if strong is None else F.col("strong") == strong))
    marks = met.groupBy("h1", "h2", "start", "rank", "end", "kind").agg(
        has("id").alias("id"), has("id", True).alias("strong_id"), has("secret").alias("secret"), has("secret", True).alias("strong_secret"), has("place").alias("place"))
    good = (
        F.when(F.col("kind") == "weak_secret", F.col("strong_id") | (F.col("id") & F.col("place")))
        .when(F.col("kind") == "account", F.col("strong_secret") | (F.col("secret") & F.col("place")))
        .otherwise(F.col("id") & F.col("secret") & (F.col("strong_id") | F.col("strong_secret")))
    )
    return marks.filter(good).select("h1", "h2", F.struct("start", "rank", "end", "kind").alias("span"))


def scan(docs: DataFrame, text: str = "text", scope: int = SCOPE, keep: list[str] | None = None) -> DataFrame:
    """Adds ``base`` and ``spans``: arrays of (start, rank, end, kind); ``keep`` lists the other columns to return.

    Every text is searched once; the link reads what was found.
    """
    table = read_once(docs, text, keep, base_spans, weak_spans)
    parts = materialize(of_texts(table).select("h1", "h2", F.explode(F.concat("base", "found")).alias("s")).select("h1", "h2", "s.*"), "parts")
    more = link(parts, scope).groupBy("h1", "h2").agg(F.array_sort(F.collect_set("span")).cast(SPAN).alias("extra"))  # of one text
    return with_more(table, more)


def redact(docs: DataFrame, text: str = "text", by: str = "[SECRET]") -> DataFrame:
    """The documents with every secret span replaced; columns as before, ``n_chars`` (if any) counted anew."""
    changed = scan(docs, text)
    fresh = masked(F.col(f"`{text}`"), F.col("spans"), by)
    changed = changed.withColumn(text, fresh)
    if "n_chars" in docs.columns:
        counted = F.when(F.size("spans") > 0, F.length(F.col(f"`{text}`"))).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", counted)
    return changed.select(*[f"`{c}`" for c in docs.columns])
