"""Training-order materialisation: every sequence gets a global slot, shards hold the slots in order.

The token ids of a partition's documents form one stream, an end id after each document, and the stream is cut into full
sequences; only the last sequence of a partition is shorter. A sequence carries the ids of its documents, where each
starts in it and which item of the document stands there. They are written once, with their partition and their number in
it, and the counts per partition number them densely. A keyed Feistel network over the next even number of bits is a
permutation of a power of two; numbers that leave the range walk on along their cycle until they are back, which makes
it a permutation of exactly the sequences. Shard ``s`` holds the slots ``s * per_shard .. (s + 1) * per_shard - 1`` as
records of a fixed stride, so the byte of any slot is known and a reader can resume anywhere.

A shard is written by one task to a name of its own and then renamed, so a repeated or lost task leaves whole shards
only; a failed task deletes its own file, one of a lost executor stays and readers pass over it. The numbering is part of
the written table, so it does not depend on how that is split when read. Tasks hold one sequence or one document's ids
at a time. The table holds the sequences as they are, in pages that zstd compresses together; for the shuffle each is
deflated by itself.

Defined results: a NULL or empty document has no items and no end id, one of any length runs over as many sequences as it
needs; repeated rows are documents of their own; a NULL document id stays NULL; an empty table writes no shard; a shorter
sequence is padded with zeros in its record; of the input only the id and the items are read, so no name clashes.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiloom.session import materialize

from .textcore import mix

MAGIC, HEADER = b"SEQSHARD", 64
LENGTH, PER_SHARD, ROUNDS = 1024, 16_384, 6


def permute(x: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The slots of the numbers ``x`` among ``0 .. n - 1``."""
    if len(x) and not 0 <= np.min(x) <= np.max(x) < n:
        raise ValueError(f"a number outside 0 .. {n - 1}")
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = mix(np.uint64(key & (2**64 - 1)) + np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.asarray(x, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):  # cycle walking
        left, right = out[todo] >> bits, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = left << bits | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


DOCUMENTS = [T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("starts", T.ArrayType(T.IntegerType())), T.StructField("froms", T.ArrayType(T.LongType()))]
PACKED = T.StructType(
    [T.StructField("part", T.IntegerType()), T.StructField("number", T.LongType()), *DOCUMENTS, T.StructField("items", T.BinaryType())])

# Many sequences share a page, so what they have in common is stored once.
TABLE_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "7", "parquet.page.size": str(4 << 20)}


def pack(docs: DataFrame, ids: str, end: int, id: str = "doc_id", item_bytes: int = 1, length: int = LENGTH) -> DataFrame:
    """The written table of sequences: part, number (dense in its part), doc_ids, starts, froms, items.

    ``ids``: a binary column of little-endian items. ``end``: the item after each document.
    """
    step, mark = length * item_bytes, int(end).to_bytes(item_bytes, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows: list[tuple] = []
        own: list[tuple] = []  # (document, start in the sequence, item of the document)
        buffer = bytearray()
        number = 0

        def close() -> None:
            nonlocal own, number
            rows.append((part, number, *(list(c) for c in zip(*own)), bytes(buffer)))
            buffer.clear()
            own, number = [], number + 1

        def ready() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=PACKED.names)

        kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            for doc, items in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = items.as_py()
                if not data:
                    continue
                if len(data) % item_bytes:
                    raise ValueError("the ids of a document are no whole number of items")
                data, at = memoryview(data + mark), 0
                while at < len(data):
                    take = min(step - len(buffer), len(data) - at)
                    own.append((doc, len(buffer) // item_bytes, at // item_bytes))
                    buffer += data[at : at + take]
                    at += take
                    if len(buffer) == step:
                        close()
                        if len(rows) == 512:
                            yield ready()
        if buffer:
            close()
        if rows:
            yield ready()

    source = docs.select(F.col(f"`{id}`").cast("long").alias("i"), F.col(f"`{ids}`").alias("d"))
    return materialize(source.mapInArrow(run, PACKED), "sequences", options=TABLE_OPTIONS)


def ordered(sequences: DataFrame, key: int) -> tuple[DataFrame, int]:
    """(the table of ``pack`` with ``slot``, the number of sequences)."""
    counts = sorted(tuple(r) for r in sequences.groupBy("part").count().collect())  # a row per partition that was packed
    total = sum(n for _, n in counts)
    firsts, at = [], 0
    for part, n in counts:
        firsts.append((part, at))
        at += n

    @F.pandas_udf("long")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, key))

    # a row per packed partition, twelve bytes each
    offsets = F.broadcast(sequences.sparkSession.createDataFrame(firsts, "part int, first long"))
    return sequences.join(offsets, "part").withColumn("slot", slot(F.col("first") + F.col("number"))).drop("first"), total


def write_shards(sequences: DataFrame, folder: str, key: int, item_bytes: int = 1, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """Writes the shards when it runs; returns slot, file, byte_offset, n_tokens, ids_sha256 and the documents per sequence.

    ``sequences``: the table of ``pack``. ``folder`` is a URI that all executors reach.
    """
    placed, total = ordered(sequences, key)
    shards = -(-total // per_shard) or 1
    stride = 4 + length * item_bytes
    schema = T.StructType(DOCUMENTS + T._parse_datatype_string("slot long, shard long, file string, byte_offset long, n_tokens int, ids_sha256 string").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out = name = None
        open_shard = expected = -1

        def shard_file(shard: int) -> str:
            return f"shard-{shard:06d}.bin"

        def finish() -> None:
            nonlocal out
            if out is not None:
                out.close()
                if expected != min(total, (open_shard + 1) * per_shard):
                    raise ValueError(f"shard {open_shard} ends before slot {expected}")
                store.move(name, posixpath.join(root, shard_file(open_shard)))
                out = None

        try:
            for batch in batches:
                slots, ids = batch.column("slot").to_numpy(), batch.column("deflated")
                offsets, sizes, hashes = [], [], []
                for i, slot in enumerate(slots.tolist()):
                    shard = slot // per_shard
                    if shard != open_shard:
                        finish()
                        open_shard, expected = shard, shard * per_shard
                        name = posixpath.join(root, f"_writing-{shard:06d}-{attempt}")
                        out = store.open_output_stream(name)
                        count = min(total, (shard + 1) * per_shard) - expected
                        out.write(struct.pack("<8sIIQQQ", MAGIC, item_bytes, length, expected, count, total).ljust(HEADER, b"\0"))
                    if slot != expected:
                        raise ValueError(f"slot {expected} is missing")
                    expected += 1
                    data = zlib.decompress(ids[i].as_py(), wbits=-zlib.MAX_WBITS)
                    out.write(struct.pack("<I", len(data) // item_bytes) + data.ljust(length * item_bytes, b"\0"))
                    offsets.append(HEADER + (slot % per_shard) * stride)
                    sizes.append(len(data) // item_bytes)
                    hashes.append(hashlib.sha256(data).hexdigest())
                shards_of = slots // per_shard
                files = [posixpath.join(folder, shard_file(n)) for n in shards_of.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(f.name) for f in DOCUMENTS], batch.column("slot"), pa.array(shards_of), pa.array(files, pa.string()), pa.array(offsets, pa.int64()),
                     pa.array(sizes, pa.int32()), pa.array(hashes, pa.string())],
                    names=schema.names)
            finish()
        finally:
            if out is not None:  # failed or stopped: the shard is another attempt's to write
                out.close()
                if store.get_file_info(name).type == fs.FileType.File:
                    store.delete_file(name)

    @F.pandas_udf("binary")
    def deflated(items: pd.Series) -> pd.Series:
        return items.map(lambda data: zlib.compress(data, 4, wbits=-zlib.MAX_WBITS))

    # the slots are dense, so the range of every shard is known without sampling
    dealt = placed.withColumn("deflated", deflated("items")).drop("part", "number", "items").withColumn("__shard", F.floor(F.col("slot") / per_shard).cast("int")).repartitionById(shards, F.col("__shard"))
    dealt = dealt.sortWithinPartitions("slot").drop("__shard")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return dealt.mapInArrow(run, schema)


def read_shards(folder: str, first: int = 0) -> Iterator[tuple[int, bytes]]:
    """(slot, ids) in training order from slot ``first``; opens one shard at a time."""
    store, root = fs.FileSystem.from_uri(folder)
    names = sorted(f.path for f in store.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("shard-"))
    for name in names:
        with store.open_input_file(name) as file:
            magic, item_bytes, length, start, count, _ = struct.unpack("<8sIIQQQ", file.read(HEADER)[:40])
            if magic != MAGIC:
                raise ValueError(f"no shard: {name}")
            skip = min(max(first - start, 0), count)
            stride = 4 + length * item_bytes
            file.seek(HEADER + skip * stride)
            for slot in range(start + skip, start + count):
                record = file.read(stride)
                yield slot, record[4 : 4 + int.from_bytes(record[:4], "little") * item_bytes]
