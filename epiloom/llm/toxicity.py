"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words (runs of letters and non-ASCII characters, A-Z lower-cased) and the first 4, 5 and 6 bytes of
longer words, which stand for word stems. Three passes over the corpus, none of which shuffles a text:

1. labelled rows: in how many toxic and clean ones each term stands; the lexicon is every term that several toxic rows
   have and that leans to toxic rows beyond chance (signed root of the likelihood ratio);
2. all rows: document frequencies of the lexicon over the whole corpus;
3. labelled rows: their TF-IDF vectors over the lexicon. Equal vectors are one example with counts of either label.

The index keeps, for each term, the largest weight in every block of examples. A query takes blocks in falling order of
their bound and stops when no block can reach its k-th best cosine, so its neighbours are exact. Each neighbour votes
with weight 1 / (0.05 + distance); the votes are shrunk to the base rate, which calibrates scores with few votes.
A text without lexicon terms takes the rate of the labelled texts without any.

The labelled sample is bounded (``max_labels``, by a hash of the id). The lexicon holds every term of the sample that
passes, the index every distinct vector; document frequencies count every document.

Defined results: NULL and empty texts are texts without terms; labelled rows with NULL label or id are not used, and
of several labels of one id the largest holds; without any usable label, or a document that has one, the score is 0;
repeated rows score alike; columns of the input whose names clash with an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiloom.session import materialize

from . import textcore as tc

MAX_LABELS = 200_000
MIN_TOXIC_ROWS = 4
MIN_Z = 4.2
MIN_LIFT = 1.5  # of a term's rate among toxic rows over that among the others
STEMS = (4, 5, 6)
NEIGHBOURS = 16
BLOCK = 64
SOFTEN = 0.05
PRIOR = 0.5  # votes of the base rate


def _terms(part: tc.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term) of every word and stem of a slice."""
    found = tc.words(part, tc.LETTERS)
    doc = found.doc
    rows, values = [doc], [found.hashes]
    for n in STEMS:
        which, hashes = found.prefixes(n)
        rows.append(doc[which])
        values.append(hashes ^ np.uint64(0x5DEECE66D5DEECE6))  # a stem is another term than the equal word
    return np.concatenate(rows), np.concatenate(values)


def _known(values: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of known values, their numbers in the sorted vocabulary)."""
    if not len(vocabulary):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
    place = np.flatnonzero(vocabulary[at] == values)
    return place, at[place]


@dataclass
class Labels:
    """A bounded sample of labelled ids, sorted by id."""

    ids: np.ndarray
    toxic: np.ndarray

    def of(self, ids: pa.Array) -> np.ndarray:
        """1 toxic, 0 not, -1 unknown."""
        if not len(self.ids):
            return np.full(len(ids), -1, np.int8)
        values = np.array(ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        at = np.minimum(np.searchsorted(self.ids, values), len(self.ids) - 1)
        known = (self.ids[at] == values) & ~np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool)
        return np.where(known, self.toxic[at], -1).astype(np.int8)


def label_sample(labels: DataFrame, id: str, label: str, keep: Column, max_labels: int) -> Labels:
    """At most ``max_labels`` rows in the order of a hash of the id."""
    rows = (
        labels.filter(keep & F.col(f"`{id}`").isNotNull() & F.col(f"`{label}`").isNotNull())
        .groupBy(F.col(f"`{id}`").cast("long").alias("i")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("y"))
        .orderBy(F.xxhash64("i"), "i").limit(max_labels).toPandas().sort_values("i")
    )
    return Labels(rows["i"].to_numpy(np.int64), (rows["y"].to_numpy(np.int64) > 0).astype(np.int8))


@dataclass
class Model:
    """Lexicon, weights and the block-max index over distinct example vectors."""

    terms: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    idf: np.ndarray = field(default_factory=lambda: np.empty(0))
    base: float = 0.0
    none: float = 0.0  # rate of the texts without terms
    # examples: ragged rows (term, weight) with label counts and the smallest id
    bounds: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    which: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    toxic: np.ndarray = field(default_factory=lambda: np.empty(0))
    clean: np.ndarray = field(default_factory=lambda: np.empty(0))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def index(self) -> "Model":
        n, size = len(self.toxic), len(self.terms)
        row = np.repeat(np.arange(n), np.diff(self.bounds))
        blocks = max(-(-n // BLOCK), 1)
        # the largest weight of each (term, block) that occurs, by term: its size follows the postings, not terms x blocks
        key = self.which * blocks + row // BLOCK
        order = np.argsort(key, kind="stable")
        own, first = np.unique(key[order], return_index=True)
        top = np.maximum.reduceat(self.weights[order], first) if len(own) else np.empty(0)
        self.max_block, self.block_max = own % blocks, top.astype(np.float32) * np.float32(1.000001)
        self.max_bounds = np.searchsorted(own // blocks, np.arange(size + 1))
        self.blocks = blocks
        # postings of a block lie together, by term
        order = np.lexsort((row, self.which, row // BLOCK))
        self.post_term, self.post_row, self.post_weight = self.which[order], row[order], self.weights[order]
        self.post_bounds = np.searchsorted(row[order] // BLOCK, np.arange(blocks + 1))
        return self

    def vector(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Weights of a text's terms, of length 1."""
        w = (1 + np.log(counts)) * self.idf[numbers]
        return w / np.sqrt((w * w).sum())

    def nearest(self, numbers: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a cosine over 0, ties by example number."""
        spans = [slice(self.max_bounds[t], self.max_bounds[t + 1]) for t in numbers]
        heights = np.concatenate([self.block_max[s] * w for s, w in zip(spans, weights)])
        bound = np.bincount(np.concatenate([self.max_block[s] for s in spans]), heights, minlength=self.blocks)
        queue = np.argsort(-bound, kind="stable")
        queue = queue[bound[queue] > 0]
        best_row, best = np.empty(0, np.int64), np.empty(0)
        query = np.zeros(len(self.terms))
        query[numbers] = weights
        step = 4
        for at in range(0, len(queue), step):
            if len(best) == k and bound[queue[at]] * 1.00001 < best[-1]:
                break
            chosen = queue[at : at + step]
            part = np.concatenate([np.arange(self.post_bounds[c], self.post_bounds[c + 1]) for c in chosen])
            part = part[query[self.post_term[part]] > 0]
            rows = self.post_row[part]
            own, at_own = np.unique(rows, return_inverse=True)
            scores = np.bincount(at_own, self.post_weight[part] * query[self.post_term[part]], minlength=len(own))
            best_row = np.concatenate([best_row, own])
            best = np.concatenate([best, scores])
            order = np.lexsort((best_row, -best))[:k]
            best_row, best = best_row[order], best[order]
        return best_row, np.minimum(best, 1.0)

    def score(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[float, list[int], list[float]]:
        """(score, ids of the nearest examples, their cosines)."""
        if not len(numbers) or not len(self.toxic):
            return self.none, [], []
        rows, cosine = self.nearest(numbers, self.vector(numbers, counts))
        if not len(rows):
            return self.none, [], []
        vote = 1 / (SOFTEN + 1 - cosine)
        vote = vote / vote.max()
        # an example that many labelled texts share counts more, but not without end
        mass = self.toxic[rows] + self.clean[rows]
        share = np.log1p(mass) / mass * vote
        up, all_ = (share * self.toxic[rows]).sum(), (share * mass).sum()
        return float((up + PRIOR * self.base) / (all_ + PRIOR)), self.ids[rows].tolist(), cosine.tolist()


def _batches(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{id}`").cast("long").alias("i"), F.col(f"`{text}`").cast("string").alias("t"))


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", keep: Column | None = None,
    max_labels: int = MAX_LABELS,
) -> Model:
    """The model from the labelled rows that ``keep`` allows."""
    sc = docs.sparkSession.sparkContext
    sample = label_sample(labels, id, label, F.lit(True) if keep is None else keep, max_labels)
    if not sample.toxic.any():
        return Model().index()
    known = sc.broadcast(sample)  # at most max_labels ids
    source = _batches(docs, id, text)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state = known.value.of(batch.column(0))
            # a row without a term counts the documents
            out = [np.zeros(1, np.int64), np.array([(state == 0).sum()]), np.array([(state == 1).sum()]), np.array([len(state)])]
            for kind in (0, 1):
                for part in tc.slices(batch.filter(pa.array(state == kind)).column(1)):
                    rows, values = _terms(part)
                    if not len(rows):
                        continue
                    order = np.lexsort((rows, values))
                    rows, values = rows[order], values[order]
                    fresh = np.ones(len(rows), bool)
                    fresh[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
                    values, counts = np.unique(values[fresh], return_counts=True)
                    none = np.zeros(len(counts), np.int64)
                    found = [values.view(np.int64), *((none, counts) if kind else (counts, none)), none]
                    out = [np.concatenate(both) for both in zip(out, found)]
            terms = pa.array(out[0], mask=np.arange(len(out[0])) == 0)
            yield pa.RecordBatch.from_arrays([terms, *[pa.array(c.astype(np.int64)) for c in out[1:]]], names=["term", "clean", "toxic", "n"])

    found = materialize(
        source.mapInArrow(candidates, "term long, clean long, toxic long, n long").groupBy("term").agg(*[F.sum(c).alias(c) for c in ("clean", "toxic", "n")])
        .filter(F.col("term").isNull() | (F.col("toxic") >= MIN_TOXIC_ROWS)), "terms")
    sizes = found.filter("term IS NULL").first()  # none without documents
    n, n0, n1 = (float(sizes.n), float(sizes.clean), float(sizes.toxic)) if sizes else (0.0, 0.0, 0.0)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, toxic = (batch.column(c).to_numpy().astype(float) for c in ("clean", "toxic"))
            lift = (toxic + 0.5) / (n1 + 1) * (n0 + 1) / (clean + 0.5)
            yield batch.filter(pa.array((_lean(toxic, clean, n1, n0) >= MIN_Z) & (lift >= MIN_LIFT))).select(["term"])

    chosen = found.filter("term IS NOT NULL").mapInArrow(passing, "term long").toArrow()["term"].to_numpy()  # of the sample's terms
    terms = np.sort(chosen.astype(np.int64).view(np.uint64))
    lexicon = sc.broadcast(terms)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(lexicon.value)
        df = np.zeros(size, np.int64)
        for batch in batches:
            for part in tc.slices(batch.column(1)):
                rows, values = _terms(part)
                place, number = _known(values, lexicon.value)
                df += np.bincount(np.unique(rows[place] * size + number) % max(size, 1), minlength=size)
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(df[used])], names=["number", "df"])

    counts = source.mapInArrow(frequencies, "number long, df long").groupBy("number").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(terms))
    df[counts["number"].to_numpy()] = counts["df"].to_numpy()
    model = Model(terms, 1 + np.log((1 + n) / (1 + df)), base=n1 / max(n0 + n1, 1))
    shared = sc.broadcast(model)  # terms of the label sample

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state = known.value.of(batch.column(0))
            some = batch.filter(pa.array(state >= 0))
            toxic = state[state >= 0]
            keys, ids = [], some.column(0).to_pylist()
            for part in tc.slices(some.column(1)):
                for number, count in _counts(part, shared.value.terms):
                    keys.append(np.stack([number, count], 1).ravel().tolist())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.list_(pa.int64())), pa.array(toxic.astype(np.int64)), pa.array(ids, pa.int64())], names=["vector", "toxic", "id"])

    examples = (
        source.mapInArrow(vectors, "vector array<long>, toxic long, id long")
        .groupBy("vector").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"), F.min("id").alias("id"))
    )
    # every distinct vector of the sample, as flat Arrow arrays; max_labels bounds their number
    rest = examples.toArrow().combine_chunks().sort_by("id")
    lengths = rest["vector"].combine_chunks().value_lengths().to_numpy()
    empty, full = rest.filter(pa.array(lengths == 0)), rest.filter(pa.array(lengths > 0))
    count = lambda part, column: part[column].to_numpy().astype(float)
    model.none = float((count(empty, "toxic").sum() + PRIOR * model.base) / (count(empty, "n").sum() + PRIOR)) if len(empty) else model.base
    if len(full):
        pairs = full["vector"].combine_chunks().flatten().to_numpy().reshape(-1, 2)
        model.bounds = np.concatenate([[0], np.cumsum(lengths[lengths > 0] // 2)])
        model.which = pairs[:, 0].copy()
        model.weights = np.concatenate([model.vector(pairs[i:j, 0], pairs[i:j, 1]) for i, j in zip(model.bounds, model.bounds[1:])])
        model.toxic, model.clean = count(full, "toxic"), count(full, "n") - count(full, "toxic")
        model.ids = full["id"].to_numpy().astype(np.int64)
    return model.index()


def _lean(toxic: np.ndarray, clean: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Signed root of the likelihood ratio of a term's presence; positive for toxic rows."""

    def log(k, n, p):
        return np.where(k > 0, k * np.log(np.maximum(p, 1e-12)), 0) + np.where(n - k > 0, (n - k) * np.log(np.maximum(1 - p, 1e-12)), 0)

    p1, p0, p = toxic / max(n1, 1), clean / max(n0, 1), (toxic + clean) / max(n0 + n1, 1)
    gain = 2 * (log(toxic, n1, p1) + log(clean, n0, p0) - log(toxic, n1, p) - log(clean, n0, p))
    return np.sign(p1 - p0) * np.sqrt(np.maximum(gain, 0))


def _counts(part: tc.Slice, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(term numbers, counts) of each text of a slice."""
    rows, values = _terms(part)
    place, number = _known(values, terms)
    pairs, counts = np.unique(rows[place] * max(len(terms), 1) + number, return_counts=True)
    cuts = np.searchsorted(pairs, np.arange(part.n + 1) * max(len(terms), 1))
    for i in range(part.n):
        yield pairs[cuts[i] : cuts[i + 1]] % max(len(terms), 1), counts[cuts[i] : cuts[i + 1]]


ADDED = [
    T.StructField("score", T.DoubleType()),
    T.StructField("evidence", T.ArrayType(T.LongType())),
    T.StructField("cosines", T.ArrayType(T.DoubleType())),
]


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``score``, ``evidence`` (ids of the nearest examples) and ``cosines``; ``keep`` lists the columns to return."""
    names = {f.name for f in ADDED}
    kept = [f for f in docs.schema.fields if f.name not in names and (keep is None or f.name in keep)]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # terms of the label sample and an example per sampled label
    schema = T.StructType(kept + ADDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = shared.value, {}
        for batch in batches:
            results = []
            for part in tc.slices(batch.column(batch.num_columns - 1)):
                for number, count in _counts(part, own.terms):
                    key = number.tobytes() + count.tobytes()
                    found = seen.get(key)
                    if found is None:
                        if len(seen) > 20_000:
                            seen.clear()
                        found = seen[key] = own.score(number, count)
                    results.append(found)
            columns = list(zip(*results)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(columns[0], pa.float64()), pa.array(columns[1], pa.list_(pa.int64())), pa.array(columns[2], pa.list_(pa.float64()))],
                names=[f.name for f in schema.fields])

    return docs.select(*[f"`{f.name}`" for f in kept], F.col(f"`{text}`").cast("string").alias("__text")).mapInArrow(run, schema)
