import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiloom.llm import toxicity as tx


def small_model(rng, n_terms=40, n=300):
    model = tx.Model(np.sort(rng.integers(1, 1 << 60, n_terms).astype(np.uint64)), rng.random(n_terms) + 0.5, base=0.1, none=0.01)
    rows = [np.sort(rng.choice(n_terms, rng.integers(1, 6), replace=False)) for _ in range(n)]
    counts = [rng.integers(1, 4, len(r)) for r in rows]
    model.bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    model.which = np.concatenate(rows)
    model.weights = np.concatenate([model.vector(r, c) for r, c in zip(rows, counts)])
    model.toxic, model.clean, model.ids = rng.integers(0, 3, n).astype(float), rng.integers(1, 3, n).astype(float), np.arange(n)
    return model.index(), rows


@pytest.mark.parametrize("seed", range(5))
def test_neighbours_are_exact(seed):
    rng = np.random.default_rng(seed)
    model, rows = small_model(rng)
    dense = np.zeros((len(rows), len(model.terms)))
    for i, r in enumerate(rows):
        dense[i, r] = model.weights[model.bounds[i] : model.bounds[i + 1]]
    for _ in range(40):
        terms = np.sort(rng.choice(len(model.terms), rng.integers(1, 8), replace=False))
        weights = model.vector(terms, rng.integers(1, 3, len(terms)))
        got, cosine = model.nearest(terms, weights, 10)
        every = dense[:, terms] @ weights
        want = np.sort(every[every > 0])[::-1][:10]
        assert np.allclose(cosine, np.minimum(want, 1)) and np.allclose(every[got], want)


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(5)
    clean, bad = [f"plain{i}" for i in range(400)], ["zorgl", "vexit", "kwamp"]
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        for _ in range(2 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(2000, None), (2001, ""), (None, "zorgl"), (0, rows[0][1]), (2002, "Zorgl, vexit! " + "x" * 200_000)]
    labels += [(None, 1), (7, None), (1, 0), (1, 0)]
    docs = spark.createDataFrame([(i, t, 9.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = tx.train(docs, table, keep=F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in tx.score(docs, model).collect()}
    held = [i for i in range(900) if i % 3 == 1]
    assert all((got[i].score >= 0.7) == (i % 6 == 0) for i in held)
    assert got[2002].score >= 0.7 and got[2000].score == got[2001].score < 0.1 and got[None].score >= 0.7
    assert len(got[2002].evidence) == len(got[2002].cosines) == tx.NEIGHBOURS or got[2002].evidence
    none = tx.train(docs, table.limit(0))
    assert {r.score for r in tx.score(docs, none).collect()} == {0.0}
    assert tx.score(docs.limit(0), model).count() == 0


def test_every_distinct_vector_is_an_example(spark):
    rng, n = random.Random(8), 21_000
    words = ["zorgl", "vexit", "kwamp", "mulfo"]
    rows = []
    for i in range(n):
        counts = [(i // 13**j) % 13 for j in range(4)]
        rows.append((i, " ".join(" ".join([w] * c) for w, c in zip(words, counts))))
    labels = spark.createDataFrame([(i, 1) for i in range(n)] + [(n + i, 0) for i in range(n)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows + [(n + i, f"plain{rng.randrange(50)}") for i in range(n)], "doc_id long, text string").repartition(4)
    model = tx.train(docs, labels)
    assert len(model.ids) == n - 1 and model.ids.max() == n - 1
    last = tx.score(docs.filter(F.col("doc_id") == n - 1), model).first()
    assert max(last.cosines) > 1 - 1e-9 and n - 1 in last.evidence


def test_every_passing_term_is_in_the_lexicon(spark):
    n = 5_000  # rare terms, each in four toxic rows and no clean one
    rare = lambda i: "q" + "".join(chr(97 + i // 26**j % 26) for j in range(3))  # noqa: E731 - no longer than a stem
    rows = [(100 * k + g, " ".join(rare(i) for i in range(g * n // 100, (g + 1) * n // 100))) for k in range(4) for g in range(100)]
    labels = [(i, 1) for i, _ in rows] + [(1_000 + i, 0) for i in range(4_000)]
    rows += [(1_000 + i, f"plain w{i % 9}") for i in range(4_000)] + [(9_000 + i, rare(i)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = tx.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(model.terms) == n
    found = tx.score(docs.filter("doc_id >= 9000"), model)
    assert found.filter("size(evidence) > 0").count() == n
