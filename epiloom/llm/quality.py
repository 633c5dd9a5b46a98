"""Quality rules whose cutoffs are chosen under a risk guarantee.

One pass computes counts per text. Rules compare a rate with a cutoff. For every stratum, rule and cutoff of a grid,
labelled good documents of the holdout give the number of false rejections; a cutoff is allowed if the exact binomial
(Clopper-Pearson) upper bound of its false rejection rate is at most the rule's share of ``risk``. The confidence is
corrected for all strata, rules and cutoffs tested (Bonferroni), so with probability ``1 - delta`` no stratum loses more
than ``risk`` of its good documents, all rules together. Each rule takes its strictest allowed cutoff, or is off.

Every stratum has cutoffs of its own, however many there are: the cutoff table is joined to the documents.

Defined results: NULL and empty texts have no words, fail the base rule and are in no holdout; a NULL stratum is a
stratum like others; very long texts are walked as slices of their own; a document whose stratum has no holdout meets no rule; labels with a NULL id or label count for nothing, and of several the smallest holds; repeated
rows have equal verdicts (and count as often as they occur); clashing input columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiloom.session import materialize

from . import textcore as tc

RISK, DELTA = 0.02, 0.05
MIN_WORDS, MAX_REPEAT = 50, 50  # base rule: words at least, percent of repeated words at most

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOLS = ~tc.byte_class(b"#*$%&|<>")
_LINES = tc.byte_class(b"\n")

#: rule: (rate of the counts, grid from strict to lax); a rate above the cutoff rejects
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (0.05, 0.1, 0.2, 0.3, 0.5, 0.8, 1.0, 1.5, 2.0, 3.0)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)),
    "repeats": ("n_repeat_words / n_words", (0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45)),
    "long_words": ("word_chars / n_words", (7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0)),
    "short_words": ("-word_chars / n_words", (-4.0, -3.5, -3.0, -2.5, -2.0, -1.5)),
}


def counts_of(part: tc.Slice) -> list[np.ndarray]:
    """The counts of each text of a slice, in the order of ``COUNTS``."""
    data, offsets = part.data, part.offsets
    found = tc.words(part, tc.WHITESPACE, tc.SAME)
    n = np.diff(found.bounds)
    inside = tc.WHITESPACE[data]

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    lines = tc.words(part, _LINES, tc.SAME)
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=seen[1:])
    real = seen[lines.ends] > seen[lines.starts]  # lines with a word
    of = lines.doc[real]
    kept, bounds = tc.distinct_per_row(lines.hashes[real], np.searchsorted(of, np.arange(part.n + 1)))
    n_lines = np.bincount(of, minlength=part.n)
    values, cuts = tc.shingles(found, 3)
    rows = np.repeat(np.arange(part.n), np.diff(cuts))
    order = np.lexsort((values, rows))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (values[order][1:] == values[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    again = np.zeros(len(values), bool)
    again[order] = same[:-1] | same[1:]
    at = np.flatnonzero(again)
    first = at - cuts[rows[at]] + found.bounds[rows[at]]
    covered = np.zeros(len(found.hashes) + 3, bool)
    for i in range(3):
        covered[first + i] = True
    repeated = tc.row_sums(covered[: len(found.hashes)].astype(np.int64), found.bounds)
    return [n, per_text(inside & (data & 0xC0 != 0x80)), per_text(_SYMBOLS[data]), n_lines - np.diff(bounds), repeated, n_lines]


def counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds the counts; ``keep`` lists the columns to return."""
    kept = [f for f in docs.schema.fields if f.name not in COUNTS and (keep is None or f.name in keep)]
    schema = T.StructType(kept + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tc.slices(batch.column(batch.num_columns - 1)):
                rows = batch.slice(part.first, part.n)
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *[pa.array(c.astype(np.int64)) for c in counts_of(part)]], names=schema.names)

    return docs.select(*[f"`{f.name}`" for f in kept], F.col(f"`{text}`").cast("string").alias("__text")).mapInArrow(run, schema)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial variable, by the continued fraction of the incomplete beta function."""
    if k >= n:
        return 1.0
    if p <= 0 or p >= 1:
        return float(p <= 0)
    a, b, x = n - k, k + 1, 1 - p
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta(b, a, 1 - x)
    return _beta(a, b, x)


def _beta(a: float, b: float, x: float) -> float:
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / max(abs(1 - (a + b) * x / (a + 1)), tiny)
    total = d
    for m in range(1, 100_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + step / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * total


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the rate at which k or fewer of n have probability ``delta``."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(k, n, middle) > delta else (low, middle)
    return high


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def choose_cutoffs(good: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum of the holdout: ``stratum``, its good rows ``n`` and a column per rule, the cutoff or NULL for off.

    ``good`` has ``stratum`` and the counts. The counts of false rejections are summed by Spark and the bounds are computed where
    the strata's rows lie, so the number of strata is free; only that number reaches the driver.
    """
    tests = [(rule, cutoff, F.sum((F.expr(rate) > cutoff).cast("long"))) for rule, (rate, grid) in RULES.items() for cutoff in grid]
    counted = good.filter(~base_failed()).groupBy("stratum").agg(F.count("*").alias("n"), *[e.alias(f"t{i}") for i, (_, _, e) in enumerate(tests)])
    counted = materialize(counted, "strata")
    level = delta / max(1, counted.count() * len(tests))
    schema = T.StructType([
        T.StructField("stratum", T.StringType()), T.StructField("n", T.LongType()), *[T.StructField(f"cut_{r}", T.DoubleType()) for r in RULES]])

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                chosen = {}
                for i, (rule, cutoff) in enumerate(grid_of_tests):  # from strict to lax
                    if rule not in chosen and upper_bound(row[f"t{i}"], row["n"], level) <= risk / len(RULES):
                        chosen[rule] = cutoff
                out.append({"stratum": row["stratum"], "n": row["n"], **{f"cut_{r}": chosen.get(r) for r in RULES}})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("stratum", pa.string()), ("n", pa.int64()), *[(f"cut_{r}", pa.float64()) for r in RULES]]))

    grid_of_tests = [(rule, cutoff) for rule, cutoff, _ in tests]
    return counted.mapInArrow(bounds, schema)


def verdicts(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", stratum: str = "lang", label: str = "quality",
    risk: float = RISK, delta: float = DELTA,
) -> DataFrame:
    """(id, stratum column, counts, base_failed, rejected_by, kept) of every document."""
    frame = materialize(counts(docs, text, [id, stratum]), "counts").withColumn("stratum", F.col(f"`{stratum}`").cast("string"))
    good = labels.filter(F.col(id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id)).agg(F.min(label).alias("__label")).filter("__label = 1")
    # a row per stratum: Spark broadcasts it if it is small, else AQE splits the strata that hold many documents
    chosen = materialize(choose_cutoffs(frame.join(good, id, "left_semi"), risk, delta), "cutoffs").drop("n").withColumnRenamed("stratum", "__of")
    met = frame.join(chosen, F.col("stratum").eqNullSafe(F.col("__of")), "left")
    by_rule = F.array_compact(F.array(*[F.when(F.expr(rate) > F.col(f"cut_{rule}"), F.lit(rule)) for rule, (rate, _) in RULES.items()]))
    safe = F.when(F.col("n_words") > 0, by_rule).otherwise(F.array().cast("array<string>"))
    out = met.withColumn("base_failed", base_failed()).withColumn("rejected_by", safe)
    dropped = [c for c in ("stratum", "__of", *[f"cut_{r}" for r in RULES]) if c != stratum]
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop(*dropped)
