"""Personal data: base patterns, and contextual patterns bootstrapped from them, in built-in Spark expressions.

1. Base matches (email, ip, card, phone) are the seed entities.
2. Lexical patterns are cues: a word and a separator before a value ("mail: x", "id = x"), and in prose the one, two and
   three words before a value-like token (one with a digit or an @), or the word before and the word after it. Every cue in
   the corpus, with every value, is an occurrence; values that a base match covers are seeds of its kind.
3. Over the graph of cues and distinct values, in ``ROUNDS`` rounds: a cue's score for a kind is the mean score of its
   values, shrunk by ``SHRINK`` values of score 0; a value that is no seed takes the best score of its cues, damped.
   Copies of a text do not count twice, since a value counts once for each cue.
4. Cues with at least ``MIN_SEEDS`` distinct seeds and a score of ``MIN_SCORE`` find the identifiers that no base
   pattern knows: their values with a digit or an @ and at least five characters.

The counts cover the whole corpus. Cue occurrences are combined before the shuffle to distinct (cue, value) pairs.

Defined results: NULL counts as the empty text, which has no spans; texts of any length are searched whole, with places from
running sums in time about linear in the matches; repeated rows have equal results; input columns
named ``base`` or ``spans`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.session import materialize

from .spans import SPAN, as_spans, found, in_order, of_texts, read_once, with_more

KINDS = ("email", "ip", "card", "phone")
ROUNDS, SHRINK, DAMP = 3, 1.0, 0.8
MIN_SEEDS, MIN_SCORE = 5, 0.6

# Written so that a run of one class is searched once: a match starts at a run's first character or where the last
# match ended, and loops are possessive, so long runs need neither backtracking nor stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CUE = r"""(?<![A-Za-z_])[A-Za-z_]{2,}+["']?+\x20{0,3}+[:=#]\x20{0,3}+["']?+([^\s"',;<>|]{3,}+)"""

# One to three words, then a token with a digit or an @; a match starts at a word's first character.
PROSE = r"""(?<![^\s"'(])(?:[\p{L}'-]++[\x20\n]){1,3}["'(]?+((?=[^\s0-9@]*+[0-9@])[^\s"',;<>|()]++)"""


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Every second digit from the right counts double, minus 9 if over 9."""
    digits = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: d.cast("int"))
    weighed = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(weighed, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def _is_ip(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def base_spans(text: Column) -> Column:
    n = lambda m: F.length(_digits(m["value"]))
    return in_order(
        as_spans(found(text, EMAIL, needs=F.contains(text, F.lit("@"))), "email", 0),
        as_spans(found(text, IP, needs=text.rlike(r"[0-9]\.[0-9]")), "ip", 1, lambda m: _is_ip(m["value"])),
        as_spans(found(text, CARD, needs=text.rlike("[0-9][\\x20-]?[0-9]")), "card", 2, lambda m: F.when(n(m).between(14, 19), _luhn(m["value"])).otherwise(False)),
        as_spans(found(text, PHONE, needs=F.contains(text, F.lit("+"))), "phone", 3, lambda m: n(m).between(10, 15)),
    )


def occurrences(text: Column, base: Column) -> Column:
    """Array of (cue, value, start, end, kind): kind of the base match that the value touches, else NULL."""

    def one(m: Column) -> Column:
        start = m["end"] - F.length(m["value"])
        own = F.filter(base, lambda b: (b["start"] < m["end"]) & (start < b["end"]))
        cue = F.lower(F.regexp_replace(F.substring(text, m["start"] + 1, start - m["start"]), r"[\s\"']", ""))
        return F.struct(cue.alias("cue"), m["value"].alias("value"), start.alias("start"), m["end"].alias("end"), F.get(own, F.lit(0))["kind"].alias("kind"))

    def prose(m: Column) -> Column:
        start = m["end"] - F.length(m["value"])
        own = F.get(F.filter(base, lambda b: (b["start"] < m["end"]) & (start < b["end"])), F.lit(0))  # a phone or card number may have spaces
        end = F.greatest(m["end"], F.coalesce(own["end"], m["end"]))
        value = F.when(own.isNull(), F.regexp_replace(m["value"], r"[.!?:]+$", "")).otherwise(F.substring(text, own["start"] + 1, own["end"] - own["start"]))
        last = F.when(own.isNull(), start + F.length(value)).otherwise(end)
        words = F.filter(F.split(F.lower(F.regexp_replace(F.substring(text, m["start"] + 1, start - m["start"]), "[\"'(]", "")), r"\s"), lambda w: w != "")
        after = F.lower(F.regexp_extract(F.substring(text, last + 1, F.length(text)), r"^[\"')]?[\x20\n]([\p{L}'-]++)(?=[^\p{L}'-])", 1))
        left = [F.when(F.size(words) >= k, F.array_join(F.slice(words, -k, k), " ")) for k in (1, 2, 3)]
        cues = F.array_compact(F.array(*left, F.when(after != "", F.concat(left[0], F.lit(" _ "), after))))
        return F.transform(cues, lambda c: F.struct(c.alias("cue"), value.alias("value"), start.alias("start"), last.alias("end"), own["kind"].alias("kind")))

    return F.concat(
        F.transform(found(text, CUE, 1, needs=text.rlike("[:=#]")), one),
        F.flatten(F.transform(found(text, PROSE, 1, needs=text.rlike("[0-9@]")), prose)))


def learn(pairs: DataFrame) -> DataFrame:
    """Accepted cues: (cue, kind, score); ``pairs``: distinct (cue, value, kind or NULL)."""
    seeds = pairs.filter("kind IS NOT NULL").select("cue", F.col("kind").alias("of")).distinct()  # only these can score
    graph = materialize(pairs.join(seeds, "cue").select("cue", "value", "of", (F.coalesce("kind", F.lit("")) == F.col("of")).alias("seed"), F.col("kind").isNotNull().alias("known")), "graph")
    state = graph.withColumn("s", F.col("seed").cast("double"))
    for turn in range(ROUNDS):
        cues = state.groupBy("cue", "of").agg((F.sum("s") / (F.count("*") + SHRINK)).alias("score"), F.sum(F.col("seed").cast("long")).alias("seeds"))
        if turn == ROUNDS - 1:
            break
        best = graph.filter("NOT known").join(cues, ["cue", "of"]).groupBy("value", "of").agg((F.max("score") * DAMP).alias("best"))
        state = materialize(graph.join(best, ["value", "of"], "left").select("cue", "value", "of", "seed", "known", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("s")), "state")
    good = cues.filter((F.col("seeds") >= MIN_SEEDS) & (F.col("score") >= MIN_SCORE))
    return good.groupBy("cue").agg(F.max(F.struct("score", F.col("of").alias("kind"))).alias("m")).select("cue", "m.kind", "m.score")


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``base`` and ``spans``: arrays of (start, rank, end, kind); discovered kinds are named like ``context_email``.

    Every text is searched once; all that follows reads what was found. ``keep`` lists the other columns to return.
    """
    table = read_once(docs, text, keep, base_spans, occurrences)
    cues = materialize(of_texts(table).select("h1", "h2", F.explode("found").alias("o")).select("h1", "h2", "o.*"), "cues")
    pairs = cues.groupBy("cue", "value").agg(F.max("kind").alias("kind"))
    accepted = learn(pairs)
    looks = F.col("value").rlike("[0-9@]") & (F.length("value") >= 5)
    fresh = cues.filter(F.col("kind").isNull() & looks).join(accepted.withColumnRenamed("kind", "as"), "cue")
    span = F.struct("start", F.lit(4).alias("rank"), "end", F.concat(F.lit("context_"), "as").alias("kind"))
    more = fresh.groupBy("h1", "h2").agg(F.array_sort(F.collect_set(span)).cast(SPAN).alias("extra"))  # of one text
    return with_more(table, more)
