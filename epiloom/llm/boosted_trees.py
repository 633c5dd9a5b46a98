"""A quality classifier: histogram gradient-boosted trees over statistics of whole texts.

1. One narrow pass turns every text into statistics on a grid of ``CELLS`` whole numbers (rates linear, counts
   logarithmic) and writes them: two bytes each, so no text is read or moved again.
2. Labelled rows join their statistics. Counts of grid cells give at most ``BINS`` bins of about equal mass for each
   statistic; the labelled rows are written once more as one byte each.
3. Trees of fixed depth grow level by level. For a level, every task adds up gradients, curvatures and rows for (node,
   statistic, bin) and Spark sums the tasks' histograms; the driver sees histograms, whose size is fixed by depth,
   statistics and bins, and chooses the splits. All labelled rows take part, wherever they lie. Gradients are whole
   numbers of ``1 / FIXED``, so sums, splits and scores do not depend on how rows are dealt.
4. Trees are flattened into arrays (statistic, cut, leaf value; children of node i are 2i + 1 and 2i + 2), which a batch
   walks with one numpy step for each level.

Defined results: NULL counts as the empty text, whose statistics are 0, and has a score too; labels with a NULL id or
label, or of another value than 0 and 1, count for nothing, and of several for one id the smallest holds; repeated rows
count as often as they occur; no labelled rows give a score of 0.5 and no trees; equal gains go to the first statistic and the lowest
cut; very long texts are walked as slices of their own; input columns with the names of added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiloom.session import materialize

from . import textcore as tc

CELLS, BINS = 1024, 48
TREES, DEPTH, RATE, RIDGE = 24, 3, 0.3, 1.0
MIN_ROWS = 10  # labelled rows on each side of a split
FIXED = 1 << 20
ROWS_AT_ONCE = 2048  # texts for which byte counts are held

_RATE = CELLS - 1
_SCALE = 32.0  # cells for each doubling of a count

_CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": b"0123456789",
    "space": b" \t\x0b\x0c\r",
    "mark": b".,;:?'\"()-",
    "shout": b"!",
    "symbol": b"#*$%&|<>@^~=+_/\\{}[]`",
    "foreign": bytes(range(0xC0, 0x100)),  # first bytes of other characters
}
NAMES = (
    "bytes", "words", "lines", *_CLASSES, "entropy", "word_length", "longest_word", "long_words", "short_words", "distinct_words", "top_word",
    "repeated_words", "distinct_shingles", "distinct_lines", "line_length", "longest_line", "stopped_lines", "stopped_words", "capital_words",
    "plain_words",
)


def _tables() -> np.ndarray:
    return np.stack([~tc.byte_class(v) for v in _CLASSES.values()], 1).astype(np.float64)


_BYTE_CLASSES = _tables()
_STOPS = ~tc.byte_class(b".,;:?!")
_FULL_STOPS = ~tc.byte_class(b".?!")
_LETTER = ~tc.byte_class(bytes([*range(65, 91), *range(97, 123), *range(0x80, 0x100)]))
_CAPITAL = ~tc.byte_class(bytes(range(65, 91)))
_LINE = tc.byte_class(b"\n")


def _rate(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.minimum(_RATE, np.floor(part / np.maximum(whole, 1) * _RATE))


def _size(count: np.ndarray) -> np.ndarray:
    return np.minimum(_RATE, np.floor(_SCALE * np.log2(1 + count)))


def _mean(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return tc.row_sums(values.astype(np.int64), bounds) / np.maximum(np.diff(bounds), 1)


def _longest(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, np.int64)
    some = np.flatnonzero(np.diff(bounds) > 0)
    if len(some):
        out[some] = np.maximum.reduceat(values, bounds[some])
    return out


def _runs(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, most frequent value's count, values that occur more than once) of each row of a ragged array."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(v)))
    cuts = np.searchsorted(r[at], np.arange(len(bounds)))
    return np.diff(cuts), _longest(counts, cuts), tc.row_sums(np.where(counts > 1, counts, 0), cuts)


def statistics(part: tc.Slice) -> np.ndarray:
    """(texts, statistics) grid cells of a slice."""
    data, offsets, n = part.data, part.offsets, part.n
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    seen = np.bincount(doc * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float64)
    share = seen / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    points = size - seen[:, 0x80:0xC0].sum(1)

    found = tc.words(part, tc.WHITESPACE)
    bounds, lengths = found.bounds, found.ends - found.starts
    words = np.diff(bounds)
    last, head = data[found.ends - 1], data[found.starts]
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER[data], out=letters[1:])
    stop = _STOPS[last]
    plain = letters[found.ends] - letters[found.starts] >= lengths - stop
    distinct, top, repeated = _runs(found.hashes, bounds)
    shingled, cuts = tc.shingles(found, 3)
    shingles, _, _ = _runs(shingled, cuts)

    lines = tc.words(part, _LINE, tc.SAME)
    line_size, line_count = lines.ends - lines.starts, np.diff(lines.bounds)
    unique_lines, _, _ = _runs(lines.hashes, lines.bounds)
    flagged = lambda flags, at: tc.row_sums(flags.astype(np.int64), at)

    columns = [
        _size(size), _size(words), _size(line_count), *(_rate(c, points) for c in (seen @ _BYTE_CLASSES).T), np.floor(entropy / 8 * _RATE),
        _size(_mean(lengths, bounds)), _size(_longest(lengths, bounds)), _rate(flagged(lengths >= 12, bounds), words), _rate(flagged(lengths <= 3, bounds), words),
        _rate(distinct, words), _rate(top, words), _rate(repeated, words), _rate(shingles, np.diff(cuts)), _rate(unique_lines, line_count),
        _size(_mean(line_size, lines.bounds)), _size(_longest(line_size, lines.bounds)), _rate(flagged(_FULL_STOPS[data[lines.ends - 1]], lines.bounds), line_count),
        _rate(flagged(stop, bounds), words), _rate(flagged(_CAPITAL[head], bounds), words), _rate(flagged(plain, bounds), words),
    ]
    return np.stack(columns, 1).astype("<u2")


def statistics_table(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``cells``, the packed statistics, as a written table."""
    kept = [f for f in docs.schema.fields if f.name != "cells" and (f.name in keep if keep is not None else f.name != text)]
    schema = T.StructType([*kept, T.StructField("cells", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tc.slices(batch.column(batch.num_columns - 1)):
                for at in range(0, part.n, ROWS_AT_ONCE):
                    ends = part.offsets[at : at + ROWS_AT_ONCE + 1]
                    some = tc.Slice(part.first + at, len(ends) - 1, part.data[ends[0] : ends[-1]], ends - ends[0])
                    rows = batch.slice(some.first, some.n)
                    cells = [row.tobytes() for row in statistics(some)]
                    yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(cells, pa.binary())], names=schema.names)

    return materialize(docs.select(*[f"`{f.name}`" for f in kept], F.col(f"`{text}`").cast("string").alias("__text")).mapInArrow(run, schema), "statistics")


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """A binary column of equally long values as (rows, statistics)."""
    _, at, data = column.buffers()
    width = len(NAMES) * np.dtype(kind).itemsize
    start = int(np.frombuffer(at, np.int32, 1, 4 * column.offset)[0])
    return np.frombuffer(data, np.uint8)[start : start + len(column) * width].view(kind).reshape(-1, len(NAMES))


@dataclass
class Model:
    """Flattened trees: row t of each array is tree t."""

    edges: list[np.ndarray]  # of each statistic: cells up to an edge go below it
    base: float
    feature: np.ndarray  # (trees, 2 ** depth - 1)
    cut: np.ndarray  # bins up to the cut go left
    leaf: np.ndarray  # (trees, 2 ** depth)

    def bins(self, cells: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, cells[:, i], "left") for i, e in enumerate(self.edges)], 1).astype(np.uint8)

    def node(self, bins: np.ndarray, tree: int, levels: int) -> np.ndarray:
        """The node (counted within its level) that each row reaches after ``levels`` levels."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(levels):
            at = 2 * at + 1 + (bins[rows, self.feature[tree, at]] > self.cut[tree, at])
        return at - ((1 << levels) - 1)

    def margin(self, bins: np.ndarray, trees: int | None = None) -> np.ndarray:
        out = np.full(len(bins), self.base)
        depth = self.leaf.shape[1].bit_length() - 1
        for t in range(len(self.leaf) if trees is None else trees):
            out += self.leaf[t, self.node(bins, t, depth)]
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def cell_edges(counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most ``bins - 1`` cells at which about equal shares of the rows end; the last used cell is none."""
    total = counts.sum()
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    at = np.unique(np.searchsorted(ends, np.arange(1, bins) * total / bins, "left"))
    return at[ends[at] < total]


def best_splits(g: np.ndarray, h: np.ndarray, n: np.ndarray, ridge: float, min_rows: int) -> list[tuple | None]:
    """For each node: (statistic, cut, left and right sums of g and h), or None; the arrays are (nodes, statistics, bins)."""
    out: list[tuple | None] = []
    gl, hl, nl = g.cumsum(2), h.cumsum(2), n.cumsum(2)
    for i in range(len(g)):
        gt, ht, nt = gl[i, :, -1:], hl[i, :, -1:], nl[i, :, -1:]
        gr, hr, nr = gt - gl[i], ht - hl[i], nt - nl[i]
        gain = (gl[i] / FIXED) ** 2 / (hl[i] / FIXED + ridge) + (gr / FIXED) ** 2 / (hr / FIXED + ridge) - (gt / FIXED) ** 2 / (ht / FIXED + ridge)
        gain = np.where((nl[i] >= min_rows) & (nr >= min_rows), gain, -1.0)
        f, b = np.unravel_index(int(gain.argmax()), gain.shape)
        out.append((int(f), int(b), gl[i, f, b], hl[i, f, b], gr[f, b], hr[f, b]) if gain[f, b] > 1e-9 else None)
    return out


def labelled(table: DataFrame, labels: DataFrame, id: str, label: str, allowed: Column | None = None) -> DataFrame:
    """(cells, y) of the rows with a label that ``allowed``, a condition on the id, lets through."""
    known = labels.filter(F.col(f"`{id}`").isNotNull() & F.col(f"`{label}`").isin(0, 1))
    known = (known if allowed is None else known.filter(allowed)).groupBy(F.col(f"`{id}`").alias("__i")).agg(F.min(F.col(f"`{label}`").cast("int")).alias("y"))
    return table.select(F.col(f"`{id}`").alias("__i"), "cells").join(known, "__i").select("cells", "y")


def _cell_counts(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """(rows by statistic and cell, rows, rows labelled 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, good = np.zeros(len(NAMES) * CELLS, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                cells = _matrix(batch.column(0), "<u2").astype(np.int64) + np.arange(len(NAMES)) * CELLS
                counts += np.bincount(cells.ravel(), minlength=len(counts))
                good += int(batch.column(1).to_numpy().sum())
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(counts[used], good))], names=["cell", "n"])

    found = rows.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # bounded by statistics times cells
    cell, n = found["cell"].to_numpy(), found["n"].to_numpy()
    counts = np.zeros(len(NAMES) * CELLS, np.int64)
    counts[cell[cell >= 0]] = n[cell >= 0]
    counts = counts.reshape(len(NAMES), CELLS)
    return counts, int(counts[0].sum()), int(n[cell < 0].sum())


def _histograms(rows: DataFrame, model: Model, tree: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of gradients, curvatures and rows by (node of the level, statistic, bin), for the tree being grown."""
    nodes, stats = 1 << level, len(NAMES)
    shape = nodes * stats * BINS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, shape), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, y = _matrix(batch.column(0), "u1"), batch.column(1).to_numpy()
            p = sigmoid(model.margin(bins, tree))
            g, h = np.rint((y - p) * FIXED), np.rint(p * (1 - p) * FIXED)
            place = ((model.node(bins, tree, level)[:, None] * stats + np.arange(stats)) * BINS + bins).ravel()
            for i, weight in enumerate((g, h)):
                sums[i] += np.bincount(place, np.repeat(weight, stats), shape).astype(np.int64)  # exact below 2**53
            sums[2] += np.bincount(place, minlength=shape)
        used = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(s[used]) for s in sums]], names=["place", "g", "h", "n"])

    parts = rows.mapInArrow(run, "place long, g long, h long, n long").groupBy("place").agg(*[F.sum(c).alias(c) for c in "ghn"]).toArrow()
    out = np.zeros((3, shape), np.int64)
    out[:, parts["place"].to_numpy()] = [parts[c].to_numpy() for c in "ghn"]
    g, h, n = out.reshape(3, nodes, stats, BINS)
    return g, h, n


def train(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, ridge: float = RIDGE, min_rows: int = MIN_ROWS) -> Model:
    """The model of labelled rows (cells, y)."""
    rows = materialize(rows, "labelled")
    counts, n, good = _cell_counts(rows)
    base = float(np.log((good + 1) / (n - good + 1)))
    model = Model([cell_edges(c) for c in counts], base, np.zeros((trees, (1 << depth) - 1), np.int64),
                  np.full((trees, (1 << depth) - 1), BINS), np.zeros((trees, 1 << depth)))
    if good in (0, n):
        return model

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [row.tobytes() for row in model.bins(_matrix(batch.column(0), "<u2"))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()), batch.column(1)], names=["bins", "y"])

    rows = materialize(rows.mapInArrow(binned, "bins binary, y int"), "binned")
    for t in range(trees):
        for level in range(depth):
            g, h, n_ = _histograms(rows, model, t, level)
            for i, split in enumerate(best_splits(g, h, n_, ridge, min_rows)):
                at = (1 << level) - 1 + i
                whole = (0, BINS, g[i, 0].sum(), h[i, 0].sum(), 0, 0)  # no split: all rows go left
                model.feature[t, at], model.cut[t, at], *sides = split or whole
                if level == depth - 1:
                    for side in (0, 1):
                        model.leaf[t, 2 * i + side] = rate * (sides[2 * side] / FIXED) / (sides[2 * side + 1] / FIXED + ridge)
    return model


def score(table: DataFrame, model: Model) -> DataFrame:
    """The kept columns of a statistics table and ``score``."""
    kept = [f for f in table.schema.fields if f.name not in ("cells", "score")]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _matrix(batch.column(batch.num_columns - 1), "<u2") if batch.num_rows else np.zeros((0, len(NAMES)), "<u2")
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sigmoid(model.margin(model.bins(cells))))], names=schema.names)

    return table.select(*[f"`{f.name}`" for f in kept], "cells").mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", allowed: Column | None = None,
             keep: list[str] | None = None, **growth: float) -> DataFrame:
    """Every document with its ``score``; ``allowed`` is a condition on the id of a label, ``keep`` lists the columns to return."""
    carried = None if keep is None else [id, *keep]
    table = statistics_table(docs, text, carried)
    return score(table, train(labelled(table, labels, id, label, allowed), **growth))
