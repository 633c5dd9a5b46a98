"""Statistics against plain counts, splits against enumeration, trees against a plain walk, and held-out accuracy."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from epiloom.llm import boosted_trees as bt
from epiloom.llm import textcore as tc
from epiloom.llm.queries import table

DATA = "/root/testdata/sf0.01"


def cells(texts):
    return np.concatenate([bt.statistics(p) for p in tc.slices(pa.array(texts, pa.string()))])


def test_statistics_of_texts():
    text = "The cat sat. The cat sat!\nThe cat sat. The cat sat!\nÜber 12 $$"
    got = dict(zip(bt.NAMES, cells([text, "", None, "x"])[0]))
    rate = lambda part, whole: math.floor(part / whole * (bt.CELLS - 1))
    size = lambda n: math.floor(32 * math.log2(1 + n))
    words = text.split()
    assert got["bytes"] == size(len(text.encode())) and got["words"] == size(len(words)) and got["lines"] == size(3)
    assert got["symbol"] == rate(2, len(text)) and got["shout"] == rate(2, len(text)) and got["foreign"] == rate(1, len(text))
    assert got["distinct_words"] == rate(len({w.lower() for w in words}), len(words))
    assert got["distinct_lines"] == rate(2, 3) and got["top_word"] == rate(4, len(words))
    shingles = [tuple(w.lower() for w in words[i : i + 3]) for i in range(len(words) - 2)]
    assert got["distinct_shingles"] == rate(len(set(shingles)), len(shingles))
    assert got["stopped_lines"] == rate(2, 3) and got["longest_word"] == size(5)
    assert (cells(["", None]) == 0).all()


def test_statistics_do_not_depend_on_neighbours():
    texts = ["a b c", "", "\n\n", "x" * 3_000_000, "ß" * 10, None, "a b c", *[str(i) for i in range(5000)]]
    together = cells(texts)
    assert (together == np.concatenate([cells([t]) for t in texts])).all()


def test_best_split_against_enumeration():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, bt.BINS, (200, 4))
    g, h = np.rint(rng.normal(size=200) * bt.FIXED), np.rint(rng.uniform(0.1, 0.25, 200) * bt.FIXED)
    sums = np.zeros((3, 1, 4, bt.BINS), np.int64)
    for i in range(4):
        for j, w in enumerate((g, h, np.ones(200))):
            sums[j, 0, i] = np.bincount(bins[:, i], w, bt.BINS)
    best = None
    value = lambda a, b: (a / bt.FIXED) ** 2 / (b / bt.FIXED + 1.0)
    for f in range(4):
        for cut in range(bt.BINS):
            left = bins[:, f] <= cut
            if left.sum() >= 10 and (~left).sum() >= 10:
                gain = value(g[left].sum(), h[left].sum()) + value(g[~left].sum(), h[~left].sum()) - value(g.sum(), h.sum())
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, f, cut)
    assert bt.best_splits(*sums, 1.0, 10)[0][:2] == best[1:]
    assert bt.best_splits(*sums, 1.0, 101) == [None]


def test_flattened_trees_against_a_plain_walk():
    rng = np.random.default_rng(5)
    model = bt.Model([], 0.25, rng.integers(0, len(bt.NAMES), (6, 7)), rng.integers(0, bt.BINS + 1, (6, 7)), rng.normal(size=(6, 8)))
    bins = rng.integers(0, bt.BINS, (100, len(bt.NAMES))).astype(np.uint8)

    def walk(row):
        total = model.base
        for t in range(6):
            at = 0
            while at < 7:
                at = 2 * at + (1 if row[model.feature[t, at]] <= model.cut[t, at] else 2)
            total += model.leaf[t, at - 7]
        return total

    assert np.allclose(model.margin(bins), [walk(r) for r in bins])


def test_edges_share_the_rows():
    counts = np.zeros(bt.CELLS, np.int64)
    assert len(bt.cell_edges(counts)) == 0
    counts[5] = 100
    assert len(bt.cell_edges(counts)) == 0  # one value: nothing to cut
    counts[[1, 900]] = 50
    assert bt.cell_edges(counts).tolist() == [1, 5]
    assert len(bt.cell_edges(np.ones(bt.CELLS, np.int64))) == bt.BINS - 1


def test_held_out_accuracy_and_partitions(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    scores = {}
    for parts in (1, 7):
        scored = bt.classify(docs.repartition(parts), labels, allowed=~held, keep=["doc_id"], trees=8)
        scores[parts] = {r.doc_id: r.score for r in scored.collect()}
    assert scores[1] == scores[7] and len(scores[1]) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.filter(held).collect()}
    good, bad = ([scores[1][d] for d, q in truth.items() if q == v] for v in (1, 0))
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.97


def test_labels_and_rows_without_content(spark):
    docs = spark.createDataFrame([(1, "good text here", "a"), (2, None, "b"), (None, "no id", "c"), (1, "good text here", "a"), (3, "", "d")], "doc_id long, text string, score string")
    none = spark.createDataFrame([(None, 1), (1, None), (1, 7)], "doc_id long, quality int")
    found = bt.classify(docs, none).collect()
    assert len(found) == 5 and {r.score for r in found} == {0.5}
    one = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "doc_id long, quality int")  # of two labels the smaller holds
    rows = bt.labelled(bt.statistics_table(docs), one, "doc_id", "quality")
    assert sorted(r.y for r in rows.collect()) == [0, 0, 1]
    found = bt.classify(docs, one, trees=1, min_rows=1).collect()
    assert len({r.score for r in found if r.doc_id == 1}) == 1 and all(0 <= r.score <= 1 for r in found)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bt.classify(empty, one).count() == 0
