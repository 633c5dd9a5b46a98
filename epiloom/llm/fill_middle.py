"""Fill-in-the-middle examples: every document cut at two token borders and rearranged.

Units are the matches of ``[A-Za-z]+|[^A-Za-z]`` over code points, left to right. A text is divided into blocks of
``BLOCK`` code points. A Fenwick tree over the blocks stores how many units begin in each and how many code points it
has; a binary-lifting descent finds the block in which a given unit begins, and only that block is searched for the place.

The cuts and the form come from a salted hash of the id alone, so any executor that repeats a task repeats its result.
Pieces hold no sentinel (a text with one stays plain) and a sentinel begins with the only ``<`` it has, so the first
occurrence of each sentinel in an output is the one that was put there: ``restored`` is exact.

Defined results: NULL counts as the empty text, which stays plain; a NULL id hashes as no digits; a very long text is
one task's work, in memory proportional to it; repeated rows have equal results; input columns with the names of added
ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SALT = "1:"
PLAIN_FROM, SPM_BELOW = 90, 20  # percent: the third hash from here on is plain, the fourth below this is spm
BLOCK = 2048  # code points

ADDED = [
    T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
]


class BlockTree:
    """Where units begin in a text: a Fenwick tree over blocks of code points."""

    def __init__(self, text: str, block: int = BLOCK):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        letter = ((points | 32) - np.uint32(97)) < 26
        begins = ~letter
        begins[1:] |= ~letter[:-1]
        begins[:1] = True
        self.begins, self.block, self.chars = begins, block, len(points)
        edges = np.arange(0, len(points), block)
        units = np.add.reduceat(begins, edges, dtype=np.int64) if len(edges) else np.zeros(0, np.int64)
        chars = np.diff(np.append(edges, len(points)))
        self.units = int(units.sum())
        self.size = len(edges)
        # node i sums the blocks (i - lowbit(i), i]
        i = np.arange(1, self.size + 1)
        below = i - (i & -i)
        totals = np.zeros((2, self.size + 1), np.int64)
        np.cumsum(units, out=totals[0, 1:])
        np.cumsum(chars, out=totals[1, 1:])
        self.tree_units = [0, *(totals[0, i] - totals[0, below]).tolist()]
        self.tree_chars = [0, *(totals[1, i] - totals[1, below]).tolist()]

    def place(self, unit: int) -> int:
        """The code point at which unit number ``unit`` begins; the length of the text for the number after the last."""
        if unit >= self.units:
            return self.chars
        at, left, chars = 0, unit, 0
        step = 1 << (self.size.bit_length() - 1)
        while step:
            following = at + step
            if following <= self.size and self.tree_units[following] <= left:
                at = following
                left -= self.tree_units[at]
                chars += self.tree_chars[at]
            step >>= 1
        return chars + int(np.flatnonzero(self.begins[chars : chars + self.block])[left])


def rearranged(text: str, hashes: tuple[int, int, int, int], plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> tuple:
    """(units, form, code points of prefix and middle or None, output) of one text."""
    tree = BlockTree(text)
    h1, h2, h3, h4 = hashes
    if not text or h3 % 100 >= plain_from or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return tree.units, "plain", None, None, text
    first, second = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
    a, b = tree.place(first), tree.place(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_below:
        return tree.units, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return tree.units, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, salt: str = SALT,
              plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """Adds n, form, prefix_chars, middle_chars and output; ``keep`` lists the columns to return."""
    names = {f.name for f in ADDED}
    kept = [f for f in docs.schema.fields if f.name not in names and (keep is None or f.name in keep)]
    schema = T.StructType(kept + ADDED)
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))), 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for part in tc.slices(texts):
                rows = batch.slice(part.first, part.n)
                keys = rows.column(rows.num_columns - 2).to_pylist()
                found = [
                    rearranged(t or "", tuple(int(k[i : i + 8], 16) for i in (0, 8, 16, 24)), plain_from, spm_below)
                    for t, k in zip(rows.column(rows.num_columns - 1).to_pylist(), keys)
                ]
                columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-2], *columns], names=schema.names)

    return docs.select(*[f"`{f.name}`" for f in kept], key.alias("__key"), F.col(f"`{text}`").cast("string").alias("__text")).mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""

    def cut(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, len(PREFIX) + 1, F.length(output))
        one = F.substring_index(body, first, 1)
        rest = F.substring(body, F.length(one) + len(first) + 1, F.length(output))
        two = F.substring_index(rest, second, 1)
        return one, two, F.substring(rest, F.length(two) + len(second) + 1, F.length(output))

    prefix, suffix, middle = cut(SUFFIX, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = cut(PREFIX, MIDDLE)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
