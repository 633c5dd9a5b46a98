"""Running sums and places of many matches, in time that does not grow with their square."""

import re
import time

from pyspark.sql import functions as F

from epiloom.llm import pii
from epiloom.llm.spans import found, running


def test_running_sums(spark):
    rows = [([],), ([5],), (list(range(127)),), (list(range(128)),), (list(range(129)),), ([1] * 1000,)]
    frame = spark.createDataFrame(rows, "v array<int>")
    for r in frame.withColumn("s", running(F.col("v"))).collect():
        assert r.s == [sum(r.v[: i + 1]) for i in range(len(r.v))]


def test_places_and_groups(spark):
    texts = ["", "no", "a1b22", "é1🙂22 333", "1" * 9, "x=1;y=22;z="]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern, group in (("[0-9]+", 0), ("[a-z]=([0-9]+)", 1)):
        for r in frame.withColumn("f", found(F.col("t"), pattern, group)).collect():
            assert [tuple(x) for x in r.f] == [(m.start(), m.end(), m[group]) for m in re.finditer(pattern, r.t)]


def test_many_matches_in_one_text(spark):
    """Thousands of addresses in one document: every one found, in time that grows with their number and not its square."""

    def spent(n):
        text = " ".join(f"u{i}@x.org" for i in range(n))
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begun = time.perf_counter()
        got = frame.select(pii.base_spans(F.col("text")).alias("base")).first().base
        assert [(s.start, s.end) for s in got] == [m.span() for m in re.finditer(r"\S+", text)]
        return time.perf_counter() - begun

    spent(10)  # compiled
    few, many = spent(10_000), spent(80_000)
    assert many < 20 * max(few, 0.2)  # the square would be 64 times
