import random
import re

from epiloom.llm import pii


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, d[::-1]))) % 10 == 0


def base(text):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def texts():
    rng = random.Random(11)
    bits = ["a", "b.c", "@", "@d", ".com", "_x", "%", "1", "23", "255", "256", "007", ".", "-", " ", "  ", "+1", "(555)", "4539 1488 0343 6467", "4539148803436467", "+44 20 7946 0958", "é", "😀", "\n", "..", "10.0.0.1"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(1200)]


def test_base_against_brute_force(spark):
    rows = texts() + ["0" * 30_000, "a" * 100_000, "a@b" + ".c" * 20_000, "1." * 20_000, "+1" + " " * 20_000, "00000000255.1.1.1 999.1.1.1"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(rows)] + [(-1, None)], "i int, text string").repartition(3)
    got = {r.i: [tuple(s) for s in r.base] for r in pii.scan(frame).collect()}
    assert got[-1] == []
    for i, t in enumerate(rows):
        assert got[i] == base(t), t[:200]


def test_contexts(spark):
    rows = [(i, f"hello contact: user{i}@mail.example.com bye member = 10.0.0.{i} thing: word{i}") for i in range(12)]
    rows += [(100, "contact: @handle_77 said"), (101, "thing: ab12345"), (102, "contact: nothing"), (103, "the contact:  zed#77x"), (104, None), (105, ""), (100, "contact: @handle_77 said")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "base")
    frame = frame.selectExpr("base AS doc_id", "text", "1 AS base", "2 AS spans")
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.scan(frame).collect()}
    assert got[100] == ["context_email"] and got[103] == ["context_email"]
    assert got[101] == got[102] == got[104] == got[105] == []
    assert got[3] == ["email", "ip"]
    assert pii.scan(frame).count() == len(rows) and pii.scan(frame.limit(0)).count() == 0
