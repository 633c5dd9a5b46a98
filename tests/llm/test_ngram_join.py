import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from epiloom.llm import ngram_join as nj
from epiloom.llm.graphs import connected_components


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, k, t):
    sets = [(i, shingle_set(x, k)) for i, x in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, u) = sets[a], sets[b]
            if s and u and i is not None and j is not None and Fraction(len(s & u), len(s | u)) >= t:
                parent[find(a)] = find(b)
    least = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return sorted((str(i), len(s), str(None if i is None else (least[find(a)] if s else i))) for a, (i, s) in enumerate(sets))


def corpus(rng, n):
    vocab = [f"w{i}" for i in range(300)] + ["É", "中"]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    rows, bases = [], []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3 or not bases:
            bases.append([rng.choice(vocab) for _ in range(rng.randint(1, 120))])
            w = bases[-1]
        elif kind < 0.5:
            w = list(bases[rng.randrange(min(3, len(bases)))])
        else:
            w = list(rng.choice(bases))
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.4:
                w = w + [rng.choice(vocab)] * rng.randint(1, 5)
        text = " ".join(w)
        rows.append((i, passage + " " + text if rng.random() < 0.3 else text.upper() if rng.random() < 0.1 else text))
    return rows + [(n, ""), (n + 1, None), (None, rows[0][1]), (3, rows[3][1]), (n + 2, " \n ")]


@pytest.mark.parametrize("k,num,tile", [(3, 90, 1 << 20), (3, 90, 400), (5, 80, 1000)])
def test_against_brute_force(spark, k, num, tile):
    rows = corpus(random.Random(num + tile), 250)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = nj.components(frame, k=k, num=num, tile_shingles=tile)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got.collect()) == brute(rows, k, Fraction(num, 100))


def test_empty_and_one_per_component(spark):
    schema = "doc_id long, text string, n_shingles int"
    assert nj.components(spark.createDataFrame([], schema)).count() == 0
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(5, text, 1), (2, text + " b", 2), (2, text + " b", 2), (9, "other words here", 3), (None, text, 4), (7, "", 5)]
    kept = nj.one_per_component(spark.createDataFrame(rows, schema)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["2", "7", "9", "None"]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(100)] + [(5000, 5000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(201)}) == 1 and len({got[i] for i in range(1000, 1101)}) == 1 and got[0] != got[1000]
    assert 5000 not in got


def test_one_per_component_moves_no_texts(spark):
    """Without repeated ids the texts of the rows that stay are not shuffled."""
    rows = [(i, " ".join(f"a{i // 2}x{j}" for j in range(40))) for i in range(20)]
    kept = nj.one_per_component(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 20, 2))
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()


def test_components_write_the_labels_once(spark, monkeypatch):
    """pipeline: the driver plans no join of all labels in every round."""
    from epiloom.llm import graphs

    names = []

    def noted(df, name, *args, **more):
        names.append(name)
        return materialize(df, name, *args, **more)

    materialize = graphs.materialize
    monkeypatch.setattr(graphs, "materialize", noted)
    chain = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1100)]
    got = {r.node: r.component for r in graphs.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert len(got) == 401 and len({got[i] for i in range(301)}) == 1 and len({got[i] for i in range(1000, 1100)}) == 1
    assert got[0] != got[1000] and set(got.values()) <= set(got)
    assert names.count("parents") > 2 and names.count("labels") <= 1 + names.count("parents") // graphs.JOINS_A_PLAN


@pytest.mark.parametrize("run", [1, 2, 5])
def test_longer_runs_against_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(nj, "RUN", run)
    rows = corpus(random.Random(run), 200)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = nj.components(frame, k=5, num=80)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got.collect()) == brute(rows, 5, Fraction(4, 5))


def test_common_passages_move_no_texts(spark, monkeypatch):
    """pipeline: texts that share a passage, but aren't near, met in tiles, all texts with all others."""
    dealt = []

    def noted(df, name, *args, **more):
        out = materialize(df, name, *args, **more)
        dealt.extend(r.id for r in out.select("id").collect()) if name == "dealt" else None
        return out

    materialize = nj.materialize
    monkeypatch.setattr(nj, "materialize", noted)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([f"a{rng.random()}" for _ in range(110)] + passage + [f"b{rng.random()}" for _ in range(50)])) for i in range(100)]
    rows.append((100, rows[7][1] + " more"))
    got = {r.doc_id: r.component_id for r in nj.components(spark.createDataFrame(rows, "doc_id long, text string"), k=5, num=80).collect()}
    assert got == {i: 7 if i == 100 else i for i in range(101)}
    assert 2 <= len(dealt) < 30


def test_bitmaps_never_lose_a_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: rng.integers(20, 400)], rng.integers(0, 1 << 63, rng.integers(0, 60), dtype=np.uint64)])) for _ in range(60)]
    bounds = np.cumsum([0, *map(len, sets)])
    maps, n = nj.bitmaps(np.concatenate(sets), bounds), np.diff(bounds)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    able = nj.may_link(n[a], maps.take(pa.array(a)), n[b], maps.take(pa.array(b)).cast(pa.large_binary()), 80, 100)
    common = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)])
    near = 100 * common >= 80 * (n[a] + n[b] - common)
    assert near.sum() > 60 and able[near].all() and not able[common * 2 < (n[a] + n[b]) // 2].any()
