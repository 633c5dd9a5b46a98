"""Benchmark decontamination with suffix arrays of the training text.

Each task turns its share of the documents into one sequence of word numbers (a
shard), sorts the suffixes of that sequence, and looks up every suffix of every
test item by binary search. The lookup narrows an interval of the suffix array
word by word, so it finds all occurrences of a window and the longest verbatim
match in one walk. Words that no test item has are one separator number: a suffix
only counts up to the next separator, and suffixes too short for the shortest
window are left out of the array, since no lookup could reach them.

Nothing is shuffled. The test items travel to the tasks in blocks of bounded size;
a benchmark of several blocks takes one pass over the documents for each.

Defined results: NULL and empty texts have no words and no hits; a test item without
words or with a NULL id is no item; items with the same id count once; an empty
benchmark leaves all documents clean; repeated documents are judged alike; input
columns whose names clash with an output column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiloom.session import materialize

from . import textcore as tc

WINDOW = 10
BLOCK_BYTES = 8 << 20  # of test text per pass
SHARD_BYTES = 16 << 20  # of training text per suffix array


class Suffixes:
    """A suffix array over word numbers, where 0 separates; only suffixes of at least ``least`` words."""

    def __init__(self, ids: np.ndarray, least: int):
        self.ids = np.concatenate([ids, np.zeros(1, ids.dtype)])
        stops = np.flatnonzero(self.ids == 0)
        starts = np.flatnonzero(self.ids)
        room = stops[np.searchsorted(stops, starts)] - starts
        self.order = self._sort(starts[room >= max(least, 1)])

    def _sort(self, at: np.ndarray) -> np.ndarray:
        """Refine by three words at a time; ties that reach a separator stay."""
        ids, last = self.ids.astype(np.int64), len(self.ids) - 1
        bits = max(int(ids.max(initial=1)).bit_length(), 1)
        step = max(1, min(3, 62 // bits))

        def key(where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            value, alive = np.zeros(len(where), np.int64), np.ones(len(where), bool)
            for i in range(step):
                word = np.where(alive, ids[np.minimum(where + i, last)], 0)
                alive &= word > 0
                value = value << bits | word
            return value, alive

        value, alive = key(at)
        rank = np.argsort(value, kind="stable")
        at, value, alive = at[rank], value[rank], alive[rank]
        group = np.concatenate([[0], np.cumsum(value[1:] != value[:-1])]) if len(at) else np.empty(0, np.int64)
        depth = step
        open_ = np.arange(len(at))
        while len(open_):
            g = group[open_]
            same = np.zeros(len(open_), bool)
            same[1:] = g[1:] == g[:-1]
            tied = same.copy()
            tied[:-1] |= same[1:]
            open_ = open_[tied & alive[open_]]
            if not len(open_):
                break
            value, on = key(at[open_] + depth)
            rank = np.lexsort((value, group[open_]))
            at[open_], value, on = at[open_][rank], value[rank], on[rank]
            alive[open_] = on
            g = group[open_]  # unchanged: ranks stay inside their group
            fresh = np.ones(len(open_), bool)
            fresh[1:] = (g[1:] != g[:-1]) | (value[1:] != value[:-1])
            # a group starts at its first place, so numbers stay ordered and distinct
            group[open_] = len(at) * (depth // step) + open_[np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))]
            depth += step
        return at

    def narrow(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of each interval [low, high) whose suffixes have ``word`` at ``depth``."""
        return self._edge(low, high, depth, word), self._edge(low, high, depth, word + 1)

    def _edge(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> np.ndarray:
        low, high, last = low.copy(), high.copy(), len(self.ids) - 1
        while (open_ := low < high).any():
            middle = (low + high) // 2
            here = self.ids[np.minimum(self.order[np.minimum(middle, len(self.order) - 1)] + depth, last)]
            right = open_ & (here < word)
            low = np.where(right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low


class TestSet:
    """Test items of one block: word numbers, suffixes and windows."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.names = sorted({i for i, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        texts = pa.array([t for _, t in items], pa.large_string())
        hashes, owner, left, size = [np.empty(0, np.uint64)], [], [], []
        for part in tc.slices(texts):
            found = tc.words(part, tc.ALPHANUMERIC)
            for i in range(part.n):
                h = found.hashes[found.bounds[i] : found.bounds[i + 1]]
                if len(h):
                    hashes.append(h)
                    left.append(np.arange(len(h), 0, -1))
                    owner.append(np.full(len(h), number[items[part.first + i][0]]))
                    size.append(np.full(len(h), min(window, len(h))))
        flat = np.concatenate(hashes)
        self.vocabulary, words = np.unique(flat, return_inverse=True)
        self.words = words.astype(np.int64) + 1
        self.left = np.concatenate(left) if left else np.empty(0, np.int64)  # words up to the item's end
        self.owner = np.concatenate(owner) if owner else np.empty(0, np.int64)
        self.size = np.concatenate(size) if size else np.empty(0, np.int64)
        self.least = int(self.size.min(initial=window))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; 0 for words that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)

    def lookup(self, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
        """(window hits, longest matches), each rows of (low, high, words, test suffix)."""
        active = np.arange(len(self.words))
        low = np.zeros(len(active), np.int64)
        high = np.full(len(active), len(suffixes.order), np.int64)
        windows, longest = [np.empty((0, 4), np.int64)], [np.empty((0, 4), np.int64)]
        depth = 0
        while len(active):
            going = self.left[active] > depth
            a, b = low.copy(), low.copy()
            if going.any():
                a[going], b[going] = suffixes.narrow(low[going], high[going], depth, self.words[active[going] + depth])
            # what the next word cuts off ends here
            ends = (b - a < high - low) & (depth >= self.size[active])
            longest.append(np.stack([low[ends], high[ends], np.full(ends.sum(), depth), active[ends]], 1))
            depth += 1
            keep = b > a
            active, low, high = active[keep], a[keep], b[keep]
            full = self.size[active] == depth
            full &= self.left[active] >= 1
            windows.append(np.stack([low[full], high[full], np.full(full.sum(), depth), active[full]], 1))
        return np.concatenate(windows), np.concatenate(longest)


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(interval number, place) for every place of the intervals."""
    n = high - low
    which = np.repeat(np.arange(len(low)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def judge(texts: pa.Array, tests: TestSet) -> dict[str, list]:
    """Per text: words, words hit (as a mask of intervals), items and the longest match."""
    n = len(texts)
    parts, counts = [], []
    for part in tc.slices(texts):
        found = tc.words(part, tc.ALPHANUMERIC)
        size = np.diff(found.bounds)
        spaced = np.zeros(len(found.hashes) + part.n, np.int32)
        spaced[np.arange(len(found.hashes)) + np.repeat(np.arange(part.n), size)] = tests.numbers(found.hashes)
        parts.append(spaced)
        counts.append(size)
    ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
    size = np.concatenate(counts) if counts else np.empty(0, np.int64)
    begins = np.concatenate([[0], np.cumsum(size + 1)])
    out = {"n_words": size.tolist(), "spans": [[] for _ in range(n)], "items": [[] for _ in range(n)], "longest": [None] * n}
    suffixes = Suffixes(ids, tests.least)
    if not len(suffixes.order) or not len(tests.words):
        return out
    windows, longest = tests.lookup(suffixes)
    if not len(windows):
        return out
    # equal windows share an interval; equal sets of items are one
    shared, of = np.unique(windows[:, :3], axis=0, return_inverse=True)
    pairs = np.unique(np.stack([of.ravel(), tests.owner[windows[:, 3]]], 1), axis=0)
    cuts = np.searchsorted(pairs[:, 0], np.arange(len(shared) + 1))
    kinds: dict[bytes, int] = {}
    members: list[np.ndarray] = []
    kind = np.empty(len(shared), np.int64)
    for i in range(len(shared)):
        owners = pairs[cuts[i] : cuts[i + 1], 1]
        kind[i] = kinds.setdefault(owners.tobytes(), len(kinds))
        if kind[i] == len(members):
            members.append(owners)
    which, place = _spread(shared[:, 0], shared[:, 1])
    at, width = suffixes.order[place], shared[which, 2]
    edge = np.bincount(at, minlength=len(ids) + 1) - np.bincount(at + width, minlength=len(ids) + 1)
    covered = np.cumsum(edge)[: len(ids)] > 0
    doc = np.searchsorted(begins, at, "right") - 1
    pairs = np.unique(np.stack([doc, kind[which]], 1), axis=0)
    cuts = np.searchsorted(pairs[:, 0], np.arange(n + 1))
    which, place = _spread(longest[:, 0], longest[:, 1])
    at = suffixes.order[place]
    owner = np.searchsorted(begins, at, "right") - 1
    best = np.lexsort((longest[which, 3], at, -longest[which, 2], owner))
    first = best[np.searchsorted(owner[best], np.arange(n))[np.isin(np.arange(n), owner)]] if len(best) else best
    for i in first:
        d, q = int(owner[i]), int(longest[which[i], 3])
        out["longest"][d] = (int(longest[which[i], 2]), int(at[i] - begins[d]), tests.names[tests.owner[q]])
    for d in np.unique(pairs[:, 0]):
        own = np.unique(np.concatenate([members[k] for k in pairs[cuts[d] : cuts[d + 1], 1]]))
        out["items"][d] = [tests.names[i] for i in own]
        flags = np.diff(np.concatenate([[0], covered[begins[d] : begins[d] + size[d]].astype(np.int8), [0]]))
        out["spans"][d] = np.stack([np.flatnonzero(flags == 1), np.flatnonzero(flags == -1)], 1).ravel().tolist()
    return out


def _union(spans: list[int], more: list[int]) -> list[int]:
    """Of two lists of word intervals, each start, end, start, end, ..."""
    out: list[int] = []
    for a, b in sorted([*zip(spans[::2], spans[1::2]), *zip(more[::2], more[1::2])]):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest_words", T.IntegerType()),
    T.StructField("longest_at", T.IntegerType()),
    T.StructField("longest_item", T.StringType()),
])


def test_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> Iterator[TestSet]:
    """Blocks of about ``block_bytes`` of text; always at least one, which may be empty."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{text}`").cast("string").alias("t")).dropna()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        yield TestSet([tuple(r) for r in rows], window)


def matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Adds n_words, n_hit, items, hit_spans and the longest verbatim match (words, place, item) to each document.

    ``hit_spans`` lists word intervals start, end, start, end, ... of all words inside any occurrence of a
    window: ``window`` consecutive words of an item, or all words of a shorter one. The longest match counts
    words from a place inside such an occurrence.
    """
    names = {f.name for f in FOUND.fields} | {"n_hit"}
    kept = [f for f in docs.schema.fields if f.name not in names]
    frame = docs.select(
        *[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").cast("string").alias("__text"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in FOUND.fields],
    )
    sc = docs.sparkSession.sparkContext
    for number, tests in enumerate(test_blocks(benchmark, item_id, item_text, window, block_bytes)):
        shared = sc.broadcast(tests)  # of bounded size

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            k = len(FOUND.fields)
            for batch in batches:
                texts = batch.column(batch.num_columns - k - 1)
                for part in tc.slices(texts, shard_bytes):
                    rows = batch.slice(part.first, part.n)
                    found = judge(texts.slice(part.first, part.n), shared.value)
                    old = [c.to_pylist() for c in rows.columns[-k:]]
                    best = [max((x for x in (new, (w, a, i) if w else None) if x), key=lambda x: (x[0], -x[1]), default=(None, None, None)) for new, w, a, i in zip(found["longest"], *old[3:])]
                    columns = [
                        found["n_words"], [_union(a or [], b) for a, b in zip(old[1], found["spans"])],
                        [sorted({*(a or []), *b}) for a, b in zip(old[2], found["items"])], *zip(*best),
                    ]
                    types = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.string()]
                    yield pa.RecordBatch.from_arrays([*rows.columns[:-k], *[pa.array(c, t) for c, t in zip(columns, types)]], names=rows.schema.names)

        if number:
            frame = materialize(frame, "decontaminate")  # one block in memory at a time
        frame = frame.mapInArrow(run, frame.schema)
    hit = F.aggregate(F.col("hit_spans"), F.lit(0), lambda total, x: x - total).cast("long")
    # start, end, start, end: the alternating sum x - total gives the summed lengths
    return frame.withColumn("n_hit", hit).drop("__text")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any window of the benchmark; columns as before."""
    text = options.get("text", "text")
    del text
    return matches(docs, benchmark, **options).filter("n_hit = 0").select(*[f"`{c}`" for c in docs.columns])
