"""Byte-level BPE encoding and decoding of whole texts.

A piece of text is a doubly linked list of symbols; a priority queue holds the
merge ranks of adjacent pairs. The lowest rank (leftmost first) merges, its
neighbours enter the queue, and entries whose symbols have changed since are
skipped. Decoding concatenates vocabulary strings.

Pieces repeat, so each Python worker keeps the encodings of recent pieces in two
generations of bounded size; a piece that fell out is merged anew.

``token_ids`` needs no more than ids: it numbers the pieces of a batch of texts and merges those it has not met side by
side, one merge of every piece at a time and in the same order. Long pieces go to the queue.

Defined results: a NULL or empty text has no ids and decodes to the empty text;
repeated rows give repeated rows; all input columns are kept unless a name clashes
with an output column, which then replaces it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The piece pattern of the byte-level vocabularies, in general and for ASCII text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)



def _class(pattern: str) -> str:
    """The characters below U+10000 that ``pattern`` matches in ``regex``, as ranges of a class of ``re``."""
    points = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    those = np.array([ord(c) for c in regex.findall(pattern, "".join(map(chr, points)))])
    runs = np.split(those, np.flatnonzero(np.diff(those) != 1) + 1)
    return "".join(f"\\u{r[0]:04x}-\\u{r[-1]:04x}" for r in runs)


_L, _N, _S = (_class(p) for p in (r"\p{L}", r"\p{N}", r"\s"))
#: The same pieces for texts without characters from U+10000, where ``re`` takes half the time.
BASIC_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def pieces_of(text: str) -> list[str]:
    if text.isascii():
        return ASCII_PIECES.findall(text)
    return (PIECES if ASTRAL.search(text) else BASIC_PIECES).findall(text)


ID_BITS, PLACE_BITS = 24, 40
ID_MASK, PLACE_MASK = (1 << ID_BITS) - 1, (1 << PLACE_BITS) - 1

CACHE_PIECES = 350_000  # of each generation and worker
CACHED_PIECE_CHARS = 64

WIDTHS = (8, 16, 32, 64)  # bytes of the pieces that merge side by side
MERGED_ROWS = 1 << 14  # at a time
TABLE_PIECES, TABLE_BYTES = 500_000, 1 << 25  # that a table of pieces holds before it starts anew
BATCH_ROWS, BATCH_CHARS = 500, 1 << 24


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairs:
    """One vocabulary file: ``encode`` and ``decode`` of single texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        strings = {i: bytes(letters[c] for c in s) for s, i in vocabulary.items() if s not in specials}
        strings |= {i: s.encode() for s, i in specials.items()}
        self.single = [0] * 256
        for s, i in vocabulary.items():
            if len(s) == 1:
                self.single[letters[s]] = i
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocabulary[left] << ID_BITS | vocabulary[right]] = rank << ID_BITS | vocabulary[left + right]
        self.specials = specials
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")") if specials else None
        size = max(strings) + 1
        self.lengths = np.array([len(strings.get(i, b"")) for i in range(size)], np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.letters = np.frombuffer(b"".join(strings.get(i, b"") for i in range(size)), np.uint8)
        self.cache = _Recent(self)

    def merge(self, data: bytes) -> list[int]:
        """The ids of one piece. A queue entry is (rank, place of the left symbol), packed in an integer."""
        symbols = [self.single[b] for b in data]
        n = len(symbols)
        get = self.merges.get
        queue = []
        left = symbols[0]
        for i in range(1, n):
            right = symbols[i]
            found = get(left << ID_BITS | right)
            if found is not None:
                queue.append(found >> ID_BITS << PLACE_BITS | i - 1)
            left = right
        if not queue:
            return symbols
        heapify(queue)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i = entry & PLACE_MASK
            j = after[i]
            if j >= n or symbols[i] < 0:
                continue
            found = get(symbols[i] << ID_BITS | symbols[j])
            if found is None or found >> ID_BITS != entry >> PLACE_BITS:
                continue  # stale: one of the two has merged since
            merged = symbols[i] = found & ID_MASK
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = get(merged << ID_BITS | symbols[k])
                if found is not None:
                    heappush(queue, found >> ID_BITS << PLACE_BITS | i)
            h = before[i]
            if h >= 0:
                found = get(symbols[h] << ID_BITS | merged)
                if found is not None:
                    heappush(queue, found >> ID_BITS << PLACE_BITS | h)
        return [s for s in symbols if s >= 0]

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.split and any(s in text for s in self.specials):
            parts = self.split.split(text)
        else:
            parts = [text]
        out = []
        for part in parts:
            if part in self.specials and len(parts) > 1:
                out.append(self.specials[part].to_bytes(4, "little"))
                continue
            out.append(b"".join(map(self.cache.__getitem__, pieces_of(part))))
            self.cache.trim()
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return b""
        return self.letters[np.repeat(self.places[ids] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """Bytes that are not UTF-8 become replacement characters."""
        return self.decode_bytes(np.asarray(ids, np.int64)).decode("utf-8", "replace")


class _Recent(dict):
    """Piece to packed ids, in two generations of bounded size."""

    def __init__(self, codec: BytePairs):
        self.codec, self.older = codec, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = np.array(self.codec.merge(piece.encode()), "<u4").tobytes()
        if len(piece) <= CACHED_PIECE_CHARS:
            self[piece] = found
        return found

    def trim(self) -> None:
        if len(self) > CACHE_PIECES:
            self.older = dict(self)
            self.clear()


class PieceTable:
    """Ids of batches of texts. Pieces have numbers, and the ids of a number are a stretch of one array."""

    def __init__(self, codec: BytePairs):
        self.codec = codec
        self.keys = np.array(sorted(codec.merges), np.int64)
        self.found = np.array([codec.merges[k] for k in self.keys.tolist()], np.int64)  # rank and id
        self.none = np.int64(1) << 62
        self.single = np.array(codec.single, np.int64)
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.firsts, self.counts = (np.empty(0, np.int32) for _ in range(3))
        self.bytes = 0

    def _merges(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and id of the merge of each pair, or ``none``. Symbols below 0 are padding."""
        pair = left << ID_BITS | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.found[at], self.none)

    def _merge_rows(self, symbols: np.ndarray) -> np.ndarray:
        """Each row's symbols after all merges, to the left. The lowest rank merges first, the leftmost of equals."""
        out, rows = np.full_like(symbols, -1), np.arange(len(symbols))
        places = np.arange(symbols.shape[1])
        able = self._merges(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            at = able.argmin(1)
            best = able[np.arange(len(rows)), at]
            on = best < self.none
            if not on.all():
                out[rows[~on]] = symbols[~on]
                rows, symbols, able, at, best = rows[on], symbols[on], able[on], at[on], best[on]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            after = places > at[:, None]  # what lies behind the merged pair moves up
            symbols = np.where(after, np.pad(symbols[:, 1:], ((0, 0), (0, 1)), constant_values=-1), symbols)
            able = np.where(after[:, :-1], np.pad(able[:, 1:], ((0, 0), (0, 1)), constant_values=self.none), able)
            symbols[each, at] = best & ID_MASK
            able[each, at] = self._merges(symbols[each, at], symbols[each, at + 1])
            led = np.flatnonzero(at)
            before = at[led] - 1
            able[led, before] = self._merges(symbols[led, before], symbols[led, at[led]])
        return out

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all pieces in a row, how many each has), as ``BytePairs.merge`` gives them."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        data = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        counts = np.zeros(len(pieces), np.int64)
        owners, parts = [], []
        for width, above in zip(WIDTHS, (0, *WIDTHS)):
            those = np.flatnonzero((sizes > above) & (sizes <= width))
            for start in range(0, len(those), MERGED_ROWS):
                own = those[start : start + MERGED_ROWS]
                at = (ends - sizes)[own, None] + np.arange(width)
                symbols = np.where(np.arange(width) < sizes[own, None], data[np.minimum(at, len(data) - 1)], -1)
                done = self._merge_rows(symbols)
                there = done >= 0
                counts[own] = there.sum(1)
                owners.append(np.repeat(own, counts[own]))
                parts.append(done[there])
        for i in np.flatnonzero(sizes > WIDTHS[-1]).tolist():
            parts.append(np.array(self.codec.merge(pieces[i]), np.int64))
            counts[i] = len(parts[-1])
            owners.append(np.full(counts[i], i))
        if not parts:
            return np.empty(0, np.int64), counts
        return np.concatenate(parts)[np.argsort(np.concatenate(owners), kind="stable")], counts

    def _learn(self) -> None:
        """Ids for the numbers that are new."""
        fresh, specials = self.numbers.fresh, self.codec.specials
        # a special token is no piece: it has a key of its own
        ids, counts = self.merge([b"" if isinstance(p, tuple) else p.encode() for p in fresh])
        for i, p in enumerate(fresh if specials else ()):
            if isinstance(p, tuple):
                ids = np.insert(ids, counts[:i].sum(), specials[p[0]])
                counts[i] = 1
        self.firsts = np.concatenate([self.firsts, (len(self.ids) + np.cumsum(counts) - counts).astype(np.int32)])
        self.counts = np.concatenate([self.counts, counts.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.bytes += sum(map(len, fresh)) + 4 * len(ids)
        fresh.clear()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in a row, their bounds)."""
        tool, number = self.codec, self.numbers.__getitem__
        found, sizes = [], []
        for text in texts:
            text = text or ""
            parts = tool.split.split(text) if tool.split and any(s in text for s in tool.specials) else [text]
            size = 0
            for part in parts:
                if part in tool.specials and len(parts) > 1:
                    found.append(np.array([number((part,))]))
                else:
                    pieces = pieces_of(part)
                    found.append(np.fromiter(map(number, pieces), np.int64, len(pieces)))
                size += len(found[-1])
            sizes.append(size)
        if self.numbers.fresh:
            self._learn()
        of = np.concatenate(found) if found else np.empty(0, np.int64)
        counts = self.counts[of]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(self.firsts[of] - ends[:-1], counts) + np.arange(ends[-1])]
        if len(self.numbers) > TABLE_PIECES or self.bytes > TABLE_BYTES:
            self.clear()
        return ids, ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]


class _Numbers(dict):
    """Piece to number; a new piece gets the next one."""

    def __init__(self):
        self.fresh: list = []

    def __missing__(self, piece) -> int:
        self.fresh.append(piece)
        made = self[piece] = len(self)
        return made


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    """One table per worker process, kept between tasks."""
    return PieceTable(codec(path))


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairs:
    """One vocabulary per worker process, kept between tasks."""
    return BytePairs(path)


OUTPUT = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
]


def encode(df: DataFrame, vocabulary: str, text: str = "text", keep_ids: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Adds ``n_tokens``, ``ids`` (little-endian unsigned 32-bit), ``ids_sha256`` and ``decoded_sha256``.

    ``vocabulary`` is the path of the vocabulary file on the executors. One narrow pass, no shuffle.
    """
    made = [f for f in OUTPUT if keep_ids or f.name != "ids"]
    names = {f.name for f in made}
    kept = [f for f in df.schema.fields if (keep is None or f.name in keep) and f.name not in names]
    schema = T.StructType(kept + made)
    source = df.select(*[f"`{f.name}`" for f in kept], df[f"`{text}`"].cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                out = {f.name: [] for f in OUTPUT}
                for value in part.column(part.num_columns - 1):
                    packed = tool.encode_bytes(value.as_py() or "")
                    back = tool.decode_bytes(np.frombuffer(packed, "<u4"))
                    try:
                        back.decode("utf-8")
                    except UnicodeDecodeError:
                        back = back.decode("utf-8", "replace").encode()
                    out["n_tokens"].append(len(packed) // 4)
                    out["ids"].append(packed)
                    out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(out["n_tokens"], pa.int64()), *([pa.array(out["ids"], pa.binary())] if keep_ids else []), pa.array(out["ids_sha256"], pa.string()), pa.array(out["decoded_sha256"], pa.string())],
                    names=[f.name for f in schema.fields],
                )

    return source.mapInArrow(run, schema)


def token_ids(df: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None, item_bytes: int = 2) -> DataFrame:
    """``ids`` alone, as little-endian unsigned integers of 2 or 4 bytes; a vocabulary that does not fit in 2 bytes raises."""
    kept = [f for f in df.schema.fields if (keep is None or f.name in keep) and f.name != "ids"]
    schema = T.StructType([*kept, T.StructField("ids", T.BinaryType())])
    source = df.select(*[f"`{f.name}`" for f in kept], df[f"`{text}`"].cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = piece_table(vocabulary)
        if len(tool.codec.lengths) > 1 << 8 * item_bytes:
            raise ValueError(f"{len(tool.codec.lengths)} ids do not fit in {item_bytes} bytes")
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            start = 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and stop - start < BATCH_ROWS and chars <= BATCH_CHARS:
                    chars += len(texts[stop] or "")
                    stop += 1
                ids, bounds = tool.encode(texts[start:stop])
                if bounds[-1] * item_bytes >= 1 << 31:
                    raise ValueError("the ids of a document do not fit in a binary value")
                buffers = [None, pa.py_buffer((bounds * item_bytes).astype(np.int32)), pa.py_buffer(ids.astype(f"<u{item_bytes}"))]
                packed = pa.Array.from_buffers(pa.binary(), stop - start, buffers)
                yield pa.RecordBatch.from_arrays([*batch.slice(start, stop - start).columns[:-1], packed], names=schema.names)
                start = stop

    return source.mapInArrow(run, schema)
