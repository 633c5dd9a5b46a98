import random
import re
from collections import Counter
from math import comb, exp, lgamma, log

import pyarrow as pa
import pytest

from epiloom.llm import quality as q
from epiloom.llm import textcore as tc


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), len(lines)]


def test_counts_against_brute_force():
    rng = random.Random(1)
    bits = ["a", "b", "Ab", "é", "中", "😀", "#", "<>", " ", "  ", "\n", "\n\n", "\t", "\r\n", "a b a b\n", "x" * 50]
    texts = ["", None, " ", "\n"] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    for part in tc.slices(pa.array(texts), 2000):
        got = q.counts_of(part)
        for i in range(part.n):
            assert [int(c[i]) for c in got] == brute(texts[part.first + i]), texts[part.first + i]


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 50, 0.1), (40, 50, 0.5), (12, 1000, 0.02), (999, 1000, 0.999)])
def test_binomial(k, n, p):
    exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert abs(q.binomial_tail(k, n, p) - exact) < 1e-9
    bound = q.upper_bound(k, n, 0.01)
    assert k / n < bound <= 1 and abs(q.binomial_tail(k, n, bound) - 0.01) < 1e-6


def test_verdicts(spark):
    rng = random.Random(2)
    plain = lambda: " ".join("w" + str(rng.randrange(10**6)) for _ in range(80))
    rows = [(i, plain(), "en") for i in range(6000)] + [(10_000 + i, plain().replace(" ", " ## "), "en") for i in range(30)]
    rows += [(20_000, plain().replace(" ", " ## "), "xx"), (20_001, None, None), (20_002, "", "en"), (None, plain(), None), (0, rows[0][1], "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, n_words string").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i in range(6000)] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in q.verdicts(docs, labels).collect()}
    assert sum(got[i].kept for i in range(6000)) >= 6000 * (1 - q.RISK)
    assert not any(got[10_000 + i].kept for i in range(30)) and got[10_000].rejected_by == ["symbols"]
    assert got[20_000].kept  # no holdout for its stratum: no rule
    assert got[20_001].base_failed and got[20_002].base_failed and got[None].kept
    assert q.verdicts(docs, labels).count() == len(rows)
    assert q.verdicts(docs, labels.limit(0)).filter("size(rejected_by) > 0").count() == 0
    assert q.verdicts(docs.limit(0), labels).count() == 0


def test_cutoffs_and_verdicts_against_brute_force(spark):
    """Many strata: bounds by exact binomial sums, cutoffs and verdicts from plain counts."""
    rng = random.Random(9)
    word = lambda: "w" + str(rng.randrange(10**6))
    rows = []
    for i in range(9000):
        lang = [None, "a", "b", *[f"x{k}" for k in range(300)]][min(rng.randrange(6), 2) if rng.random() < 0.9 else rng.randrange(303)]
        words = [word() for _ in range(rng.choice([40, 55, 60]))]
        marks = rng.choice([0, 0, 0, 0, 4, 12, 40])
        rows.append((i, " ".join(words[:marks]).replace(" ", " # ") + " " + " ".join(words[marks:]), lang))
    good = {i for i, _, _ in rows if rng.random() < 0.8}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, int(i in good)) for i, _, _ in rows], "doc_id long, quality int")
    risk = 0.4
    count = {i: dict(zip(q.COUNTS, brute(t))) for i, t, _ in rows}
    failed = {i: c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"] for i, c in count.items()}
    rate = {
        "symbols": lambda c: c["n_symbols"] / c["n_words"], "dup_lines": lambda c: c["n_dup_lines"] / max(c["n_lines"], 1),
        "repeats": lambda c: c["n_repeat_words"] / c["n_words"], "long_words": lambda c: c["word_chars"] / c["n_words"],
        "short_words": lambda c: -c["word_chars"] / c["n_words"],
    }
    holdouts = {}
    for i, _, lang in rows:
        if i in good and not failed[i]:
            holdouts.setdefault(lang, []).append(count[i])
    level = q.DELTA / (len(holdouts) * sum(len(grid) for _, grid in q.RULES.values()))

    def allowed(k, n):
        """The upper bound is at most the share: k or fewer rejections of n are too unlikely at a rate just above it."""
        p = risk / len(q.RULES)
        return k < n and sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * log(p) + (n - j) * log(1 - p)) for j in range(k + 1)) <= level

    cutoffs = {
        lang: {rule: next((c for c in grid if allowed(sum(rate[rule](x) > c for x in held), len(held))), None) for rule, (_, grid) in q.RULES.items()}
        for lang, held in holdouts.items()
    }
    assert len(holdouts) > 150 and any(c["symbols"] is not None for c in cutoffs.values())
    for r in q.verdicts(docs, labels, risk=risk).collect():
        own = cutoffs.get(r.lang, {})
        want = [rule for rule in q.RULES if own.get(rule) is not None and rate[rule](count[r.doc_id]) > own[rule]]
        assert r.rejected_by == want and r.kept == (not failed[r.doc_id] and not want), r
