"""The stages of the corpus pipeline against brute force, each on its own input."""

import random
import re
from collections import Counter

import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as cp
from epiloom.session import materialize

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, items string, node long, base string"
KEY = "AKIA" + "Q7" * 8


def sentence(rng, n):
    return [rng.choice(["amber", "birch", "cedar", "dune", "ember", "fjord", "grove", "heath", "inlet", "knoll"]) + str(rng.randrange(400)) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(3)
    bench = [(f"b{i}", " ".join(sentence(rng, 25))) for i in range(4)]
    texts = {}
    for i in range(300):
        words = sentence(rng, rng.randint(20, 80))
        if i % 6 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zorgl", "vexit", "kwamp"]))
        texts[i] = " ".join(words)
    for i in range(300, 340):  # exact copies, near copies, and a shared passage in otherwise different texts
        texts[i] = texts[301 - 300 + 6 * (i % 20) + 0]
    for i in range(340, 350):
        words = texts[6 * (i - 340) + 1].split()
        words[-1] = "changed"
        texts[i] = " ".join(words)
    for i in range(350, 354):
        texts[i] = " ".join(sentence(rng, 30)) + " " + " ".join(bench[i - 350][1].split()[5:17]) + " " + " ".join(sentence(rng, 30))
    for i in range(354, 358):
        texts[i] = " ".join(sentence(rng, 30)) + f' password = "hunter2hunter2" and {KEY} ' + " ".join(sentence(rng, 20))
    texts[358], texts[359], texts[360] = "", None, "word " * 40_000
    rows = [(i, t, "en", "hot" if i % 3 else f"s{i}", None if t is None else len(t), 9.0, "x", 1, "y") for i, t in texts.items()]
    rows += [rows[2], (None, "a row without an id and with enough words", None, None, None, None, None, None, None)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*bench, ("empty", ""), ("null", None)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, int(i % 6 == 0)) for i in range(300) if i % 5] + [(None, None, None), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def one_of_each(rows):
    """Which (doc_id, text) stay: brute force over all pairs."""
    sets = [shingles(r.text, 5) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i].doc_id is not None and rows[j].doc_id is not None and sets[i] and sets[j]:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    root[top(i)] = top(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(top(i), []).append(r)
    return sorted(str(min(r.doc_id for r in g)) if g[0].doc_id is not None else "None" for g in groups.values())


def windows(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    return {tuple(words[i : i + 10]) for i in range(len(words) - 9)}


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, stages = docs.columns, dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "bpe"]
    ids = lambda frame: Counter(str(r.doc_id) for r in frame.select("doc_id").collect())

    first = materialize(stages["toxicity"](spark, docs, corpus), "first")
    assert first.columns == columns
    every, kept = ids(docs), ids(first)
    bad = {str(r.doc_id) for r in docs.collect() if re.search("zorgl|vexit|kwamp", r.text or "")}
    assert set(every) - set(kept) == bad and all(kept[i] == every[i] for i in kept)

    second = materialize(stages["near_duplicates"](spark, first, corpus), "second")
    assert second.columns == columns
    assert sorted(ids(second).elements()) == one_of_each(first.collect())

    third = materialize(stages["decontamination"](spark, second, corpus), "third")
    assert third.columns == columns
    items = set().union(*(windows(r.text) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()))
    assert sorted(ids(third).elements()) == sorted(str(r.doc_id) for r in second.collect() if not windows(r.text) & items)
    assert not {"350", "351", "352", "353"} & set(ids(third))

    fourth = materialize(stages["secrets"](spark, third, corpus), "fourth")
    assert fourth.columns == columns and ids(fourth) == ids(third)
    before = {str(r.doc_id): r for r in third.collect()}
    for r in fourth.collect():
        old = before[str(r.doc_id)]
        assert (r.lang, r.source, r.score, r.items, r.node, r.base) == (old.lang, old.source, old.score, old.items, old.node, old.base)
        if str(r.doc_id) in {"354", "355", "356", "357"}:
            assert KEY not in r.text and "hunter2" not in r.text and r.n_chars == len(r.text)
        else:
            assert (r.text, r.n_chars) == (old.text, old.n_chars)

    last = stages["bpe"](spark, fourth, corpus)
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(r.doc_id), len(tool.encode(r.text or "", add_special_tokens=False).ids)) for r in fourth.collect())
    assert sorted((str(r.doc_id), r.n_tokens) for r in last.select("doc_id", "n_tokens").collect()) == want


def test_run_equals_the_stages_in_turn(spark, corpus):
    got = sorted(str(r.doc_id) for r in cp.run(spark, corpus).select("doc_id").collect())
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, corpus), name)
    assert got == sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
    assert entry.queries()["pipeline"] is cp.run and "pipeline" not in entry.oracle_sql()


def test_stages_on_an_empty_table(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").filter(F.lit(False))
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, corpus), name)
        assert docs.count() == 0
