"""Fill-in-the-middle against a plain regular-expression version, and exact round trips."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from epiloom.llm import fill_middle as fm

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain(doc_id, text):
    units = UNIT.findall(text)
    key = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(key[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_places_of_every_unit(block):
    draw = random.Random(block)
    for size in (0, 1, 2, 3, 8, 63, 64, 65, 300):
        text = "".join(draw.choice("abZ é\n<🙂") for _ in range(size))
        starts = [m.start() for m in UNIT.finditer(text)]
        tree = fm.BlockTree(text, block)
        assert tree.units == len(starts)
        assert [tree.place(i) for i in range(len(starts) + 1)] == [*starts, len(text)]


TEXTS = ["", None, "a", "word", "two words", "<", "<<", "a<P", "x<P>y", "ends <S>", "<M>", "P>S><", "é🙂 naïve Ünder", "\n\n", "tab\tnul\x00", "A" * 100_000 + "é",
         "long text, with words. " * 20_000, "🙂" * 5000 + "<" * 5000]


def test_rows_against_a_plain_version(spark):
    rows = [(i, t) for i in range(40) for t in TEXTS] + [(None, "a null id"), (3, "two words"), (3, "two words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("mine")).withColumn("extra", F.lit(1)).repartition(4)
    out = fm.transform(docs)
    assert out.columns == ["doc_id", "text", "extra", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = out.withColumn("again", fm.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text or "")
        assert r.again == (r.text or "")
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    out = fm.transform(spark.createDataFrame([], "doc_id long, text string"), keep=["doc_id"])
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and out.count() == 0
