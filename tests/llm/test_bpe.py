import hashlib
import json
import random

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from epiloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  \n\t ", "a", "don't we'll", "été  naïve Straße", "日本語のテキスト 123", "🙂🙂 x", " x y\u0085", "\r\n\r\nz", "é ‍", "\x00\x1f\x7f", "<|endoftext|> x<|endoftext|>", "١٢٣ ²³ Ⅷ", "a" * 70, "ab" * 20_000, " " * 5_000 + "x"]


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_padding()
    made.no_truncation()
    return made


def texts(seed, n):
    rng = random.Random(seed)
    letters = "aeiou bcdrst  ABC019'.,-\n\téßжя中文🙂́ "
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_against_the_library(library, seed):
    tool = bpe.codec(PATH)
    for text in [*ODD, *texts(seed, 300)]:
        ids = tool.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text[:80])
        assert tool.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_special_tokens_inside_texts(library):
    named = [t["content"] for t in json.load(open(PATH, encoding="utf-8")).get("added_tokens", [])]
    tool = bpe.codec(PATH)
    for name in named:
        for text in (name, f"a {name} b", name * 3, name[:-1], f" {name}\n{name}"):
            ids = tool.encode(text)
            assert ids == library.encode(text, add_special_tokens=False).ids
            assert tool.decode(ids) == library.decode(ids, skip_special_tokens=False)


def naive_merge(tool, data):
    """The lowest rank anywhere merges first, the leftmost of equals: no queue, no links."""
    symbols = [tool.single[b] for b in data]
    while True:
        ranked = [(tool.merges[p] >> bpe.ID_BITS, i) for i in range(len(symbols) - 1) if (p := symbols[i] << bpe.ID_BITS | symbols[i + 1]) in tool.merges]
        if not ranked:
            return symbols
        _, i = min(ranked)
        symbols[i : i + 2] = [tool.merges[symbols[i] << bpe.ID_BITS | symbols[i + 1]] & bpe.ID_MASK]


def test_queue_against_naive_merges():
    tool, rng = bpe.codec(PATH), random.Random(7)
    for _ in range(400):
        data = "".join(rng.choice("aaabbcdeinorst") for _ in range(rng.randint(1, 40))).encode()
        assert tool.merge(data) == naive_merge(tool, data)


def test_broken_utf8_decodes_to_replacements(library):
    tool = bpe.codec(PATH)
    for ids in ([tool.single[0xE6]], [tool.single[0xE6], tool.single[0x97], tool.single[65]], [tool.single[0xFF]] * 3, tool.encode("🙂")[:1]):
        assert tool.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_pieces_that_fell_out_of_the_cache_merge_alike(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    tool = bpe.BytePairs(PATH)
    for text in texts(11, 40):
        assert tool.encode(text) == bpe.codec(PATH).encode(text)
        assert len(tool.cache) <= 5 or len(tool.cache) <= len(text)


def test_frame(spark, library):
    rows = [(1, None, 5, "x"), (2, "", None, "x"), (3, "one two", 7, None), (3, "one two", 7, None), (None, "naïve 🙂", 1, "y"), (4, "word " * 60_000, 2, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, ids string").repartition(3)
    got = bpe.encode(docs, PATH)
    assert got.columns == ["doc_id", "text", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    found = got.collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    for r in found:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, bytes(r.ids), r.ids_sha256) == (len(ids), packed, hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    assert bpe.encode(docs, PATH, keep_ids=False, keep=["doc_id"]).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("limit", [20, 500_000])
def test_batches_against_the_library(library, monkeypatch, limit):
    """op9's CPU: pieces merge side by side, with a table that starts anew or not."""
    monkeypatch.setattr(bpe, "TABLE_PIECES", limit)
    table, rng = bpe.PieceTable(bpe.codec(PATH)), random.Random(5)
    letters = "".join(chr(rng.randrange(c, c + 500)) for c in range(0, 0x3000, 500) for _ in range(9)) + "aaeiinnnrstt  \u3000\x1c\x85\u200b"
    many = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(200)]
    for batch in ([], [None, ""], ODD, texts(21, 200), many, [*ODD, None, *texts(22, 50)]):
        ids, bounds = table.encode(batch)
        got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in batch]


def test_short_pieces_of_a_batch_need_no_queue(monkeypatch):
    tool, rng = bpe.BytePairs(PATH), random.Random(6)
    words = [" ".join("".join(rng.choice("abcdeinorst\u00e9") for _ in range(rng.randint(1, 25))) for _ in range(50)) for _ in range(40)]
    want = [tool.encode(t) for t in words]
    monkeypatch.setattr(tool, "merge", lambda data: pytest.fail("a queue"))
    ids, bounds = bpe.PieceTable(tool).encode(words)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_pieces_without_astral_characters():
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    random.Random(8).shuffle(every)
    text = "".join(a + b for a, b in zip(every, ("", " ", "a", "1", "'s", "\n ", "\u00e9", "\u2028") * 8_000))
    assert bpe.BASIC_PIECES.findall(text) == bpe.PIECES.findall(text)
    for c in every:
        assert bpe.pieces_of(f"x {c}{c} y\u00e9") == bpe.PIECES.findall(f"x {c}{c} y\u00e9")
