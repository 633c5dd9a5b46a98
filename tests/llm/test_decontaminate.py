import random
import re

import pyarrow as pa
import pytest

from epiloom.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    own, hit, found = words(text), set(), set()
    longest = 0
    for name, item in items:
        w = words(item)
        k = min(window, len(w))
        if not w or name is None:
            continue
        for j in range(len(w) - k + 1):
            for p in range(len(own) - k + 1):
                if own[p : p + k] == w[j : j + k]:
                    hit.update(range(p, p + k))
                    found.add(name)
                    n = k
                    while p + n < len(own) and j + n < len(w) and own[p + n] == w[j + n]:
                        n += 1
                    longest = max(longest, n)
    return len(own), len(hit), sorted(found), longest or None


@pytest.mark.parametrize("seed", range(25))
def test_against_brute_force(seed):
    rng = random.Random(seed)
    vocab = ["a", "Bé", "c", "d9", "中", "zz"][: rng.randint(2, 6)]
    make = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "-\n"]) for _ in range(n))
    items = [(str(i), make(rng.choice([0, 1, 3, 9, 10, 11, 25]) if seed % 3 == 0 else rng.randint(4, 25))) for i in range(6)]
    docs = ["", None] + [make(rng.randint(0, 30)) + " x " * rng.randint(0, 1) + rng.choice(items)[1] for _ in range(30)]
    docs += docs[5:9]
    got = dc.judge(pa.array(docs), dc.TestSet(items, 4 if seed % 2 else 10))
    for i, doc in enumerate(docs):
        want = brute(doc, items, 4 if seed % 2 else 10)
        spans = got["spans"][i]
        have = (got["n_words"][i], sum(spans[1::2]) - sum(spans[::2]), got["items"][i], got["longest"][i] and got["longest"][i][0])
        assert have == want, (seed, i, doc)


def test_blocks_nulls_and_clashes(spark):
    items = [("1", "one two three four five six seven eight nine ten eleven"), ("2", "seven eight nine ten alpha beta gamma delta eps zeta eta"), ("3", None), (None, "x y z")]
    docs = [(1, "p one two three four five six seven eight nine ten q", 5), (1, "p one two three four five six seven eight nine ten q", 5), (None, None, None),
            (2, "Seven eight nine TEN alpha beta gamma delta eps zeta eta. one two three four five six seven eight nine ten", 7), (3, "clean text", 0), (4, "", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id string, text string")
    one = sorted(map(str, dc.matches(frame, bench).drop("longest_at", "longest_item").collect()))
    many = sorted(map(str, dc.matches(frame, bench, block_bytes=50, shard_bytes=60).drop("longest_at", "longest_item").collect()))
    assert one == many and len(one) == 6
    rows = {r.doc_id: r for r in dc.matches(frame, bench).collect()}
    assert rows[2].n_hit == 21 and rows[2]["items"] == ["1", "2"] and rows[2].longest_words == 11
    assert rows[1].n_hit == 10 and rows[None].n_words == 0
    assert [r.doc_id for r in dc.decontaminate(frame, bench).orderBy("doc_id").collect()] == [None, 3, 4]
    assert dc.matches(frame, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert dc.matches(frame.limit(0), bench).count() == 0
