"""Adapter trimming with one replaced, inserted or missing base, against edit distances computed here."""

import random

import pytest
from pyspark.sql import functions as F

from epiloom.functions import chemistry as chem
from epiloom.functions import seq as fx

ADAPTERS = [(chem.READ1_ADAPTER_5, "5"), (chem.READ1_ADAPTER_3, "3"), (chem.READ2_ADAPTER_5, "5"), (chem.READ2_ADAPTER_3, "3")]


def distance(piece, window):
    """Edit distance where an ambiguous base equals each of its bases."""
    row = list(range(len(window) + 1))
    for i, code in enumerate(piece, 1):
        last, row = row, [i]
        for j, base in enumerate(window, 1):
            row.append(min(last[j - 1] + (base not in chem.IUPAC[code]), last[j] + 1, row[j - 1] + 1))
    return row[-1]


def score(bases, change, errors):
    return bases - (0 if not errors else 3 if change < 0 else 2)


def brute(read, adapter, end):
    """(start, stop) or None, stretch by stretch."""
    m = len(adapter)
    whole = []
    for change in (0, 1, -1):
        for o in range(len(read) - m - change + 1):
            d = distance(adapter, read[o : o + m + change])
            if d <= 1 and (change == 0 or d == 1):
                whole.append((o + m + change, -score(m, change, d), -o))
    parts = []
    for n in range(9, m):
        for change in (0, 1, -1):
            span = n + change
            if span <= len(read):
                d = distance(adapter[-n:], read[:span]) if end == "5" else distance(adapter[:n], read[len(read) - span :])
                if d <= (n >= 10) and (change == 0 or d == 1):
                    parts.append((-score(n, change, d), span if end == "5" else -n, span))
    best = None
    if end == "5" and parts:
        best = ("part", 0, min(parts)[2], -min(parts)[0])
    for stop, minus, start in ((a, b, -c) for a, b, c in sorted(whole)):
        if best is None or (-minus > best[3] and (best[0] == "part" or start <= best[1] + m // 2)):
            best = ("whole", start, stop, -minus)
    if end == "3" and parts:
        minus, _, span = min(parts)
        if best is None or (-minus > best[3] and len(read) - span <= best[1] + m // 2):
            best = ("part", len(read) - span, len(read), -minus)
    return best and (best[1], best[2])


def mutants(adapter, draw):
    plain = "".join(draw.choice(chem.IUPAC[b]) for b in adapter)
    yield plain
    for i in range(len(plain)):
        for base in "ACGT":
            yield plain[:i] + base + plain[i + 1 :]
            yield plain[:i] + base + plain[i:]
        yield plain[:i] + plain[i + 1 :]
        yield plain[:i] + "N" + plain[i + 1 :]


@pytest.mark.parametrize("number", range(4))
def test_every_edit_of_an_adapter(spark, number):
    adapter, end = ADAPTERS[number]
    draw = random.Random(number)
    noise = lambda n: "".join(draw.choice("ACGT") for _ in range(n))
    reads = ["", "A", adapter[:9], adapter[-9:], noise(200)]
    for text in mutants(adapter, draw):
        reads += [noise(draw.randrange(12)) + text + noise(draw.randrange(12)), text, noise(5) + text[: draw.randrange(8, 20)], text[-draw.randrange(8, 20) :] + noise(5)]
        reads += [noise(3) + text + noise(draw.randrange(-9, 9) % 12) + draw.choice(list(mutants(adapter, draw))) + noise(2)]
    reads = [r.replace("Y", "C").replace("R", "A") for r in reads]
    frame = spark.createDataFrame(list(enumerate(reads)), "i int, seq string").repartition(4)
    found = fx.with_adapter_match(frame, "seq", adapter, end, "start", "stop").orderBy("i").collect()
    wrong = [(r.seq, (r.start, r.stop), brute(r.seq, adapter, end)) for r in found if (None if r.start is None else (r.start, r.stop)) != brute(r.seq, adapter, end)]
    assert not wrong, wrong[:5]


def test_one_inserted_and_one_missing_base_are_trimmed(spark):
    """The insert survives whole whatever the edit; without it, so do the adapters' remains."""
    insert = "TTAGTTGATTGGATTTAGTTATTGATTTGGTTTAAGTTTGATTGTTGGTAGTTGATTAGATTTGG"
    five, three = (a.replace("R", "A") for a in (chem.READ2_ADAPTER_5, chem.READ2_ADAPTER_3))
    forms = lambda a: {"exact": a, "more": a[:12] + "T" + a[12:], "less": a[:6] + a[7:]}
    rows = [(f"{i}/{j}", insert, "I" * len(insert), x + insert + y + "GGAT", "I" * (len(x + insert + y) + 4)) for i, x in forms(five).items() for j, y in forms(three).items()]
    frame = spark.createDataFrame(rows, "name string, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    for r in fx.trim_adapters(frame).withColumn("same", F.length("r2_seq") == F.length("r2_qual")).collect():
        assert r.r2_seq == insert and r.r2_left and r.r2_right and r.same, r.name
