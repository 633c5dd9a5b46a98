"""N-gram Jaccard self-join of documents: size-banded tiles, bitmap signatures, exact intersections.

1. Every text becomes its set of k-word shingles. Texts with the same set are one node.
2. Candidates: sizes fall into bands, and a band cuts the hash range into more parts than two linked sets of that band
   (or of it and the one below) can have differences. So two sets that link agree in a whole part, and parts hold
   several shingles: a shared passage alone does not fill one. Parts that are empty count only for sets with unusually
   many of them, which keeps the argument exact.
3. Nodes with an equal part meet in the run of that part. In a run of at most ``RUN`` nodes each pair is judged by two odd
   bitmaps (below) that move instead of texts, and only pairs that may link get an edge. In a longer run neighbours get an
   edge, but only among the nodes whose guaranteed equal parts may all be of longer runs. Every link lies within a connected
   component ("cluster") of these edges, and passages that many texts share don't join them: else one cluster holds most of a
   large corpus, whose texts then meet pairwise.
4. Clusters are dealt to tiles of a bounded number of shingles. A cluster too large for one is split by size band
   (only equal or neighbouring bands can link) and, within a band, by a hash of the node.
5. In a tile, an odd bitmap (bit = parity of the shingles that hash to it) bounds the overlap of two sets from
   above: ``(|A| + |B| - popcount(A xor B)) / 2``. Pairs that pass and aren't yet connected get an exact
   intersection of sorted arrays. A tile returns a spanning forest of its links, never all pairs.
6. A split cluster is first compared within its blocks and with the first block of its own and the lower band. What is
   connected by then needs no comparison; only members outside the cluster's main component meet the other blocks.

Shingles and nodes are 64-bit hashes; sets with equal hashes count as equal.

Defined results: a text without words (or NULL) has an empty set and links with nothing; a row with a NULL id gets
its set size, no component, and takes part in no link; rows that repeat an id give one row each, with the component
of their own text; a component is named by its smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiloom.session import broadcast_if_small, materialize

from . import textcore as tc
from .graphs import connected_components

TILE_SHINGLES = 1 << 21
MAP_BYTES = 1 << 26  # of the bits of a tile before they are packed
RUN = 8  # nodes of a part whose pairs are judged one by one
MAP_BITS = 1 << 15  # of a node's bitmap at most: a narrower one is a weaker bound
GATHER_BYTES = 1 << 22


def node_numbers(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit number of each set of shingles."""
    return tc.mix(tc.row_sums(tc.mix(values), bounds) + np.diff(bounds).astype(np.uint64)).view(np.int64)


def _text_sets(texts: pa.Array, k: int) -> Iterator[tuple[tc.Slice, np.ndarray, np.ndarray]]:
    for part in tc.slices(texts):
        values, bounds = tc.shingles(tc.words(part, tc.WHITESPACE), k)
        yield part, *tc.distinct_per_row(values, bounds)


def size_bands(largest: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first sizes of the bands, most differences of two linked sets in a band, parts of a band).

    Sets that link are in equal or neighbouring bands.
    """
    starts = [1]
    while starts[-1] <= largest:
        s = starts[-1]
        starts.append(max(s + 1, (s - 1) * den // num + 1, int(s * (den / num) ** 1.05)))
    starts.append(max(starts[-1] + 1, int(starts[-1] * (den / num) ** 1.05)))
    starts = np.array(starts, np.int64)
    apart = 2 * (starts[1:] - 1) * (den - num) // (den + num)
    parts = apart + 1
    for _ in range(3):  # room for the parts that stay empty
        parts = apart + 3 + np.ceil(2 * parts * np.exp(-(starts[:-1] * num / den) / parts)).astype(np.int64)
    return starts, apart, parts


def _schemes(values: np.ndarray, bounds: np.ndarray, num: int, den: int) -> Iterator[tuple]:
    """The parts of every set, for its own band and the next one if a larger set can link from there.

    (rows, scheme and parts and most differences of each, places of the values, row and part where a part that isn't empty begins).
    """
    n = np.diff(bounds)
    starts, apart, parts = size_bands(int(n.max(initial=1)), num, den)
    band = np.searchsorted(starts, n, "right") - 1
    able = (n * den // num > n) | ((n - 1) * den >= num * (n + 1))  # else only an equal set links
    for up in (0, 1):
        own = np.flatnonzero(able & (n > 0) & ((up == 0) | (n * den // num >= starts[band + 1])))
        if not len(own):
            continue
        scheme, size = band[own] + up, n[own]
        at = np.repeat(bounds[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        row = np.repeat(np.arange(len(own)), size)
        k = parts[scheme].astype(np.uint64)
        part = (values[at] >> np.uint64(32)) * k[row] >> np.uint64(32)  # grows with the sorted values
        opens = np.ones(len(at), bool)
        opens[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(opens)
        yield own, scheme, parts[scheme], apart[scheme], at, row[first], part[first], first


def spare_parts(values: np.ndarray, bounds: np.ndarray, num: int, den: int) -> np.ndarray:
    """How many parts that aren't empty a set has in common with any set that it links with, at least."""
    spare = np.full(len(bounds) - 1, np.iinfo(np.int32).max, np.int64)
    for own, _, _, apart, _, row, _, _ in _schemes(values, bounds, num, den):
        spare[own] = np.minimum(spare[own], np.bincount(row, minlength=len(own)) - apart)
    return spare


def part_keys(values: np.ndarray, bounds: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the parts of every set."""
    rows, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for own, scheme, parts, apart, at, row, part, first in _schemes(values, bounds, num, den):
        sums = tc.row_sums(tc.mix(values[at]), np.append(first, len(at)))
        name = lambda r, q: tc.mix(scheme[r].astype(np.uint64) << np.uint64(32) | q)
        rows.append(own[row])
        keys.append(tc.mix(sums + name(row, part)))
        full = np.bincount(row, minlength=len(own))
        for r in np.flatnonzero(full <= apart):
            empty = np.setdiff1d(np.arange(parts[r], dtype=np.uint64), part[row == r])
            rows.append(np.full(len(empty), own[r]))
            keys.append(tc.mix(name(np.full(len(empty), r), empty) ^ np.uint64(0xE0)))
    return np.concatenate(rows), np.concatenate(keys)


def bitmaps(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The odd bitmap of each set of shingles, as bytes: a bit is the parity of the shingles with its number as low bits.

    There are about as many bits as shingles; folding a map's halves by XOR gives the one of half the width.
    """
    n = np.diff(bounds)
    width = np.clip(1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), 64, MAP_BITS)
    starts = np.concatenate([[0], np.cumsum(width)])
    bits = np.repeat(starts[:-1], n) + (values & np.repeat(width - 1, n).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(bits, minlength=starts[-1]) & 1).astype(np.uint8), bitorder="little")
    offsets = (starts // 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])


def _rows_of(maps: pa.Array, rows: np.ndarray, width: int, least: int) -> np.ndarray:
    """The maps of some rows, all of ``width`` bytes, folded to ``least`` bytes, as words."""
    starts = np.frombuffer(maps.buffers()[1], np.int32)[maps.offset : maps.offset + len(maps)]
    data = np.frombuffer(maps.buffers()[2], np.uint8)
    words = data[starts[rows][:, None] + np.arange(width, dtype=np.int32)].view(np.uint64)
    return np.bitwise_xor.reduce(words.reshape(len(rows), width // least, least // 8), axis=1)


def may_link(n_a: np.ndarray, map_a: pa.Array, n_b: np.ndarray, map_b: pa.Array, num: int, den: int) -> np.ndarray:
    """False for pairs of sets whose bitmaps leave too few shingles in common, as bits that differ are shingles that differ."""
    map_a, map_b = map_a.cast(pa.binary()), map_b.cast(pa.binary())  # a session may use large ones
    wide_a, wide_b = (np.diff(np.frombuffer(m.buffers()[1], np.int32)[m.offset : m.offset + len(m) + 1]) for m in (map_a, map_b))
    apart = np.abs(n_a - n_b)
    for x, y in np.unique(np.stack([wide_a, wide_b], 1), axis=0).tolist():
        least = min(x, y)
        same = np.flatnonzero((wide_a == x) & (wide_b == y))
        step = max(1, GATHER_BYTES // max(x, y))
        for rows in (same[i : i + step] for i in range(0, len(same), step)):
            differ = _rows_of(map_a, rows, x, least) ^ _rows_of(map_b, rows, y, least)
            apart[rows] = np.maximum(apart[rows], np.bitwise_count(differ).sum(1, dtype=np.int64))
    both = n_a + n_b
    return (both - apart) // 2 * (den + num) >= num * both


def document_sets(docs: DataFrame, id: str, text: str, k: int, num: int, den: int) -> DataFrame:
    """(id, n_shingles, node, bitmap, spare)."""
    source = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    schema = T.StructType([source.schema["id"], *T._parse_datatype_string("n_shingles long, node long, bitmap binary, spare long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values, bounds in _text_sets(batch.column(1), k):
                n = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.n), pa.array(n, pa.int64()), pa.array(node_numbers(values, bounds), pa.int64(), mask=n == 0),
                     bitmaps(values, bounds), pa.array(spare_parts(values, bounds, num, den))], names=schema.names)

    return source.mapInArrow(run, schema)


def part_rows(docs: DataFrame, id: str, text: str, k: int, num: int, den: int) -> DataFrame:
    """(key, node): one row for each part of a batch's nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for _, values, bounds in _text_sets(batch.column(0), k):
                number = node_numbers(values, bounds)
                row, key = part_keys(values, bounds, num, den)
                first = np.zeros(len(number), bool)
                first[np.unique(number, return_index=True)[1]] = True  # of equal sets
                keys.append(key[first[row]])
                nodes.append(number[row[first[row]]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))], names=["key", "node"])

    known = docs.filter(F.col(f"`{id}`").isNotNull())
    return known.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(run, "key long, node long")


def met_nodes(rows: DataFrame) -> DataFrame:
    """(a, b, key): each pair of a run of at most ``RUN`` nodes without its key; of a longer run its nodes ``b`` and key."""
    run = Window.partitionBy("key").orderBy("node")
    before, after = F.lag("node").over(run), F.lead("node").over(run)
    # most parts are of one node; the rest stays in place
    shared = rows.select("key", "node", before.alias("before"), after.alias("after")).filter("before <> node OR after <> node")
    shared = shared.select("key", "node").distinct()
    around = F.count("*").over(run.rowsBetween(-RUN, RUN))  # over RUN for each row of a longer run, and only there
    earlier = F.array_compact(F.array(*[F.lag("node", i).over(run) for i in range(1, RUN)]))
    met = shared.select("key", "node", around.alias("around"), earlier.alias("earlier"))
    none = F.lit(None).cast("long")
    return met.select(
        F.explode(F.when(F.col("around") > RUN, F.array(none)).otherwise(F.col("earlier"))).alias("a"), F.col("node").alias("b"),
        F.when(F.col("around") > RUN, F.col("key")).alias("key")).distinct()


def candidate_edges(met: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): the pairs that may link, and the neighbours of longer runs; ``known``: node, n, bitmap, spare.

    A longer run matters only to nodes with as many such parts as they have spare ones: any other node that links shares a part
    with a shorter run, too.
    """
    end = lambda side: known.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bitmap").alias(f"map_{side}"))
    judged = met.filter("key IS NULL").join(end("a"), "a").join(end("b"), "b").select("a", "b", "n_a", "map_a", "n_b", "map_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                column = batch.column
                able = may_link(column(2).to_numpy(), column(3), column(4).to_numpy(), column(5), num, den)
                yield batch.select(["a", "b"]).filter(pa.array(able))

    common = met.filter("key IS NOT NULL").select("key", F.col("b").alias("node"))
    bound = common.groupBy("node").agg(F.count("*").alias("parts")).join(known.select("node", "spare"), "node").filter("parts >= spare").select("node")
    before = F.lag("node").over(Window.partitionBy("key").orderBy("node"))
    chained = common.join(bound, "node").select(before.alias("a"), F.col("node").alias("b")).filter("a IS NOT NULL")
    return judged.mapInArrow(run, "a long, b long").unionByName(chained)


class _Forest:
    def __init__(self, labels: list):
        """Rows with the same label are connected from the start."""
        first: dict = {}
        self.root = np.array([first.setdefault(x, i) for i, x in enumerate(labels)], np.int64)

    def join(self, i: int, j: int) -> None:
        self.root[self.root == self.root[j]] = self.root[i]


def linked(sets: list[np.ndarray], components: list, x: np.ndarray, y: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of ``x`` and sets of ``y`` (boolean masks) of different components."""
    n = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(n, kind="stable")
    sizes = n[order]
    width = 1 << max(6, int(n.max(initial=1)).bit_length())
    while len(sets) * width > MAP_BYTES and width > 64:
        width //= 2  # a narrower map is a weaker bound
    bits = np.zeros((len(sets), width), np.uint8)
    for i, at in enumerate(order):
        bits[i] = np.bincount((sets[at] & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    maps = np.packbits(bits, axis=1).view(np.uint64)
    del bits
    forest, out = _Forest([components[i] for i in order]), []
    x, y = x[order], y[order]
    stops = np.searchsorted(sizes, sizes * den // num, "right")
    for i in range(len(order)):
        others = np.arange(i + 1, stops[i])
        others = others[(forest.root[others] != forest.root[i]) & ((x[i] & y[others]) | (y[i] & x[others]))]
        if not len(others):
            continue
        apart = np.bitwise_count(maps[i] ^ maps[others]).sum(1, dtype=np.int64)
        both = sizes[i] + sizes[others]
        able = (both - apart) // 2 * (den + num) >= num * both
        others, apart = others[able], apart[able]
        own = sets[order[i]]
        for j in others[np.argsort(apart, kind="stable")].tolist():
            if forest.root[j] == forest.root[i]:
                continue
            other = sets[order[j]]
            at = np.minimum(np.searchsorted(other, own), len(other) - 1)
            if int((other[at] == own).sum()) * (den + num) >= num * int(sizes[i] + sizes[j]):
                out.append((int(order[i]), int(order[j])))
                forest.join(i, j)
    return out


def tile_links(docs: DataFrame, dealt: DataFrame, text: str, id: str, k: int, num: int, den: int) -> DataFrame:
    """(a, b) links inside tiles; ``dealt``: id, node, tile, cluster, component, x, y. Only texts of its ids move, while they are few."""
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        for chunk in table.column("t").chunks:
            for part, values, bounds in _text_sets(chunk, k):
                nodes.append(node_numbers(values, bounds))
                sets += [values[bounds[i] : bounds[i + 1]] for i in range(part.n)]
        found = np.concatenate(nodes) if nodes else np.empty(0, np.int64)
        node = table.column("node").to_numpy()
        clusters = table.column("cluster").to_numpy()
        component, x, y = (table.column(c).to_numpy(zero_copy_only=False) for c in ("component", "x", "y"))
        keep = np.flatnonzero(found == node)  # rows that share an id may hold other texts
        keep = keep[np.argsort(clusters[keep], kind="stable")]
        a, b = [], []
        for own in np.split(keep, np.flatnonzero(np.diff(clusters[keep])) + 1) if len(keep) else []:
            for i, j in linked([sets[r] for r in own], component[own].tolist(), x[own], y[own], num, den):
                a.append(int(node[own[i]]))
                b.append(int(node[own[j]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = broadcast_if_small(materialize(dealt, "dealt"))[0]
    return texts.join(dealt, "id").drop("id").groupBy("tile").applyInArrow(run, "a long, b long")


def _blocks(members: DataFrame, tile_shingles: int) -> DataFrame:
    """(cluster, band, blocks): how many blocks each size band needs."""
    return members.groupBy("cluster", "band").agg(F.ceil(F.sum("n") / tile_shingles).cast("long").alias("blocks"))


def _near_bands(blocks: DataFrame, shifts: list[int], name: str) -> DataFrame:
    """For each band the blocks of its neighbouring bands: (cluster, band, other band, count)."""
    return blocks.select("cluster", F.col("band").alias("other"), F.col("blocks").alias(name), F.explode(F.array(*[F.col("band") + s for s in shifts])).alias("band"))


def components(
    docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 3, num: int = 90, den: int = 100,
    tile_shingles: int = TILE_SHINGLES,
) -> DataFrame:
    """(id, n_shingles, component_id) of every document; two link when ``den * intersection >= num * union``."""
    sets = materialize(document_sets(docs, id, text, k, num, den), "sets")
    known = sets.filter("id IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("id"), F.min("n_shingles").alias("n"), F.min("bitmap").alias("bitmap"), F.min("spare").alias("spare"))
    known = materialize(known, "nodes")
    met = materialize(met_nodes(part_rows(docs, id, text, k, num, den)), "met")
    clusters = connected_components(candidate_edges(met, known, num, den)).withColumnRenamed("component", "cluster")
    known = known.select("id", "node", "n")
    band = F.floor(F.log(F.col("n").cast("double")) / log(den / num)).cast("long")
    members = materialize(clusters.join(known, "node").withColumn("band", band), "members")
    weights = members.groupBy("cluster").agg(F.sum("n").alias("load"))
    total = weights.filter(F.col("load") <= tile_shingles).agg(F.sum("load")).first()[0] or 0
    tiles = max(1, total // tile_shingles)
    small = members.join(weights.filter(F.col("load") <= tile_shingles), "cluster").select(
        "id", "node", "cluster", F.concat(F.lit("s"), F.pmod(F.xxhash64("cluster"), F.lit(tiles))).alias("tile"))
    large = materialize(members.join(weights.filter(F.col("load") > tile_shingles), "cluster"), "large")
    blocks = _blocks(large, tile_shingles)
    placed = large.join(blocks, ["cluster", "band"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    tile = lambda band, block: F.concat_ws(":", F.col("cluster"), band, block)
    own = placed.select("id", "node", "cluster", tile(F.col("band"), F.col("block")).alias("tile"))
    leading = placed.filter("block = 0").join(_near_bands(blocks, [0, -1], "there"), ["cluster", "band"])
    leading = leading.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("there") - 1))).filter("other <> band OR to <> 0")
    leading = leading.select("id", "node", "cluster", tile(F.col("other"), F.col("to")).alias("tile"))
    both = {"component": F.col("node"), "x": F.lit(True), "y": F.lit(True)}
    dealt = small.unionByName(own).unionByName(leading).withColumns(both)
    links = materialize(tile_links(docs, dealt, text, id, k, num, den), "links")
    if large.take(1):
        links = links.unionByName(_remaining_links(docs, large, links, text, id, k, num, den, tile_shingles))
    labels = connected_components(links)
    named = known.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(names, "component").select("node", "component_id")
    # a set's copies may be a third of all rows: the lookup is split by a hash of the id
    out = sets.select("id", "n_shingles", "node").join(named, "node", "left")
    mine = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id), "n_shingles", mine.alias("component_id"))


def _remaining_links(docs, large, links, text, id, k, num, den, tile_shingles) -> DataFrame:
    """Links of split clusters between the members outside the main component and all others."""
    labels = connected_components(links)
    state = materialize(large.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "state")
    counts = state.groupBy("cluster", "component").agg(F.count("*").alias("c"))
    main = counts.groupBy("cluster").agg(F.max(F.struct("c", "component")).alias("m")).select("cluster", F.col("m.component").alias("main"))
    outer = state.join(main, "cluster").filter("component <> main").drop("main")
    blocks = _blocks(state, tile_shingles)
    place = lambda rows: rows.join(blocks, ["cluster", "band"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    around = _near_bands(blocks, [-1, 0, 1], "there")

    def deal(rows: DataFrame, is_x: bool) -> DataFrame:
        """Each row to every tile of its block with another block that the first comparison has not paired."""
        far = place(rows).join(around, ["cluster", "band"]).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("there") - 1)).alias("to"))
        band, block, other, to = (F.col(c) for c in ("band", "block", "other", "to"))
        done = ((band == other) & ((block == to) | (block == 0) | (to == 0))) | ((other == band + 1) & (block == 0)) | ((band == other + 1) & (to == 0))
        ends = (band, block, other, to) if is_x else (other, to, band, block)
        return far.filter(~done).select("id", "node", "cluster", "component", F.concat_ws(":", "cluster", *ends).alias("tile"), F.lit(is_x).alias("x"), F.lit(not is_x).alias("y"))

    xs, ys = deal(outer, True), deal(state, False)
    ys = ys.join(xs.select("tile").distinct(), "tile", "left_semi")
    return materialize(tile_links(docs, xs.unionByName(ys), text, id, k, num, den), "links")


def one_per_component(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component stays: that of its smallest id (of repeated rows with that id one).

    Rows with a NULL id and rows without words have no component and stay.
    """
    found = components(docs, id, text, k, num, den).filter(F.col(id).isNotNull() & (F.col("n_shingles") > 0))
    leads = F.bool_or(F.col(id) == F.col("component_id"))
    # only ids whose rows don't simply stay: their join needs no shuffle of the texts while they are few
    other = found.groupBy(F.col(id).alias("__id")).agg(leads.alias("__lead"), F.count("*").alias("__rows")).filter("NOT __lead OR __rows > 1")
    other = materialize(other, "copies")
    words = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = (F.col(f"`{id}`") == F.col("__id")) & words
    stay = docs.join(broadcast_if_small(other)[0], same, "left_anti")
    repeated = other.filter("__lead")
    if not repeated.take(1):
        return stay
    return stay.unionByName(docs.join(broadcast_if_small(repeated)[0], same, "left_semi").dropDuplicates([id]))
