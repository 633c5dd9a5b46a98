"""k-means on integer vectors with exact distances from bit planes.

A vector of 64 components becomes whole numbers, floor(scale * x). Bit b of all components is one 64-bit word, a plane;
the highest plane is the sign (two's complement) and weighs ``-2**b``. The dot product of a vector and a centroid is the
weighted sum of popcounts of the AND of their planes, so distances are exact integers and ties are real ties.

Vectors are packed once into a written table (8 bytes a plane: less than half of single floats for usual ranges). A round
is one pass over it; tasks give counts and component sums of at most ``k`` clusters, exact integers, so the result does
not depend on how rows are dealt. The driver holds ``k`` centroids only. Rounds end early at a fixed point, since
further ones would change nothing.

Defined results: vectors that are NULL, have another number of components, or hold a NULL, NaN or infinite one are left
out; a NULL id hashes as no digits; equal start hashes (repeated ids) are ordered by their planes; fewer vectors than
``k`` give as many clusters as vectors; a centroid without vectors stays where it is; repeated rows are vectors of their
own; an empty table gives an empty result. Components beyond ``2**28`` after scaling are an error, as a squared distance
would not fit a long; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiloom.session import materialize

SIZE = 64  # components: one bit of a word each
SCALE, CLUSTERS, ROUNDS, SALT = 1024, 8, 10, "3:"
MAX_PLANES = 29
CHUNK = 8192  # vectors at once in a task

ADDED = [
    T.StructField("cluster", T.IntegerType()),
    T.StructField("distance", T.LongType()),
    T.StructField("cluster_inertia", T.LongType()),
    T.StructField("inertia", T.LongType()),
    T.StructField("centroid_sha256", T.StringType()),
]


def plane_weights(planes: int) -> np.ndarray:
    weights = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    weights[-1] = -weights[-1]
    return weights


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes) words from (rows, 64) integers."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpack_bits(words: np.ndarray) -> np.ndarray:
    """(rows, planes * 64) bits."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")


def unpack(words: np.ndarray) -> np.ndarray:
    bits = unpack_bits(words).reshape(len(words), words.shape[1], SIZE).astype(np.int64)
    return np.einsum("rpc,p->rc", bits, plane_weights(words.shape[1]))


def dots(words: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact dot products of every packed vector with one packed centroid."""
    weights = plane_weights(words.shape[1])
    sums = np.zeros(words.shape, np.int64)
    for word, weight in zip(centroid, plane_weights(len(centroid))):
        sums += np.bitwise_count(words & word).astype(np.int64) * weight
    return sums @ weights


def nearest(words: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of every packed vector; ties go to the smaller number."""
    packed = pack(centroids, words.shape[1])
    own = (centroids.astype(np.int64) ** 2).sum(1)
    distances = np.stack([norms - 2 * dots(words, c) + n for c, n in zip(packed, own)])
    best = distances.argmin(0)
    return best, distances[best, np.arange(len(words))]


def _words(column: pa.Array, planes: int) -> np.ndarray:
    """A binary column of equally long values as (rows, planes) words."""
    width = 8 * planes
    _, at, data = column.buffers()
    start = int(np.frombuffer(at, np.int32, 1, 4 * column.offset)[0])
    return np.frombuffer(data, np.uint8)[start : start + len(column) * width].view("<u8").reshape(-1, planes)


@dataclass
class Packed:
    """A written table with ``planes`` (binary) and ``norm`` beside the kept columns."""

    table: DataFrame
    planes: int
    kept: list[T.StructField]


def pack_table(vectors: DataFrame, vector: str = "embedding", keep: list[str] | None = None, scale: int = SCALE) -> Packed:
    """Usable vectors as bit planes; ``keep`` lists the other columns to carry."""
    column = F.col(f"`{vector}`")
    names = {f.name for f in ADDED}
    kept = [f for f in vectors.schema.fields if f.name not in names and (f.name in keep if keep is not None else f.name != vector)]
    real = lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    usable = vectors.filter((F.size(column) == SIZE) & F.forall(column, real))
    whole = F.transform(column, lambda x: F.floor(x.cast("double") * scale))
    least, most = usable.select(F.min(F.array_min(whole)), F.max(F.array_max(whole))).first()
    planes = 1 + max((v if v >= 0 else ~v).bit_length() for v in (least or 0, most or 0))
    if planes > MAX_PLANES:
        raise ValueError(f"components reach {least} to {most}: squared distances would not fit a long")
    schema = T.StructType([*[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kept)], T.StructField("planes", T.BinaryType()), T.StructField("norm", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(at, CHUNK)
                values = rows.column(rows.num_columns - 1).flatten().to_numpy().reshape(-1, SIZE)
                words = pack(values, planes)
                norms = np.zeros(len(words), np.int64)
                weights = plane_weights(planes)
                for i in range(planes):  # the dot product of a vector with itself
                    norms += weights[i] * (np.bitwise_count(words & words[:, i : i + 1]).astype(np.int64) @ weights)
                data = [row.tobytes() for row in words]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(data, pa.binary()), pa.array(norms)], names=schema.names)

    frame = usable.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)], whole.alias("__whole"))
    return Packed(materialize(frame.mapInArrow(run, schema), "planes"), planes, kept)


def start(packed: Packed, id: str, k: int = CLUSTERS, salt: str = SALT) -> np.ndarray:
    """The vectors with the ``k`` smallest id hashes, in that order."""
    at = [f.name for f in packed.kept].index(id)
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(f"c{at}").cast("string"), F.lit(""))), 256)
    rows = packed.table.select(key.alias("h"), "planes").orderBy("h", "planes").limit(k).collect()  # k rows
    return np.concatenate([np.zeros((0, SIZE), np.int64), *[unpack(np.frombuffer(bytes(r.planes), "<u8")[None, :]) for r in rows]])


def _totals(packed: Packed, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, component sums, summed distances) of every cluster."""
    planes, k = packed.planes, len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, far = np.zeros(k, np.int64), np.zeros((k, planes * SIZE), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(at, CHUNK)
                words = _words(rows.column(0), planes)
                cluster, distance = nearest(words, rows.column(1).to_numpy(), centroids)
                bits = unpack_bits(words)
                for c in range(k):
                    mine = cluster == c
                    n[c] += mine.sum()
                    far[c] += distance[mine].sum()
                    sums[c] += bits[mine].sum(0, dtype=np.int64)
        used = np.flatnonzero(n)
        whole = np.einsum("kpc,p->kc", sums.reshape(k, planes, SIZE), plane_weights(planes))[used]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(used, SIZE)), pa.array(np.tile(np.arange(SIZE), len(used))), pa.array(whole.ravel()),
            pa.array(np.repeat(n[used], SIZE)), pa.array(np.repeat(far[used], SIZE))], names=["cluster", "component", "s", "n", "far"])

    parts = packed.table.select("planes", "norm").mapInArrow(run, "cluster long, component long, s long, n long, far long")
    found = parts.groupBy("cluster", "component").agg(*[F.sum(c).alias(c) for c in ("s", "n", "far")]).toArrow()  # k times 64 rows
    n, sums, far = np.zeros(k, np.int64), np.zeros((k, SIZE), np.int64), np.zeros(k, np.int64)
    c = found["cluster"].to_numpy()
    n[c], far[c] = found["n"].to_numpy(), found["far"].to_numpy()
    sums[c, found["component"].to_numpy()] = found["s"].to_numpy()
    return n, sums, far


def fit(packed: Packed, centroids: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, inertia of each cluster) after ``rounds`` rounds."""
    for _ in range(rounds):
        n, sums, far = _totals(packed, centroids)
        moved = np.where(n[:, None] > 0, sums // np.maximum(n, 1)[:, None], centroids)
        if (moved == centroids).all():
            return centroids, far
        centroids = moved
    return centroids, _totals(packed, centroids)[2]


def assign(packed: Packed, centroids: np.ndarray, inertia: np.ndarray) -> DataFrame:
    """The kept columns, cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    planes, total = packed.planes, int(inertia.sum())
    names = pa.array([hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids], pa.string())
    schema = T.StructType(packed.kept + ADDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(at, CHUNK)
                cluster, distance = nearest(_words(rows.column(rows.num_columns - 2), planes), rows.column(rows.num_columns - 1).to_numpy(), centroids)
                yield pa.RecordBatch.from_arrays([
                    *rows.columns[:-2], pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(inertia[cluster]),
                    pa.array(np.full(len(cluster), total)), names.take(pa.array(cluster))], names=schema.names)

    return packed.table.mapInArrow(run, schema)


def clusters(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", keep: list[str] | None = None, k: int = CLUSTERS,
             rounds: int = ROUNDS, scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """Every usable vector with its cluster; ``keep`` lists the columns to return (``id`` always)."""
    packed = pack_table(vectors, vector, None if keep is None else [id, *keep], scale)
    centroids, inertia = fit(packed, start(packed, id, k, salt), rounds) if k else (np.zeros((0, SIZE), np.int64), np.zeros(0, np.int64))
    return assign(packed, centroids, inertia)
