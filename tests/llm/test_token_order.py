import numpy as np
from pyspark.sql import functions as F

from epiloom.llm import bpe, queries
from epiloom.llm import train_order as to


def test_shards_hold_token_ids(spark, tmp_path, monkeypatch):
    texts = {1: "Hello world, " * 700, 2: "caf\u00e9 na\u00efve", 3: "", 4: None, 5: "one"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    got = queries.op9_train_order(spark, str(tmp_path)).collect()
    read, tool = dict(to.read_shards(f"file://{tmp_path}/shards")), bpe.codec(queries.vocabulary())
    assert sorted(read) == sorted(r.slot for r in got)
    found = {}
    for r in got:
        items = np.frombuffer(read[r.slot], "<u2").tolist()
        assert len(items) == r.n_tokens <= to.LENGTH and r.file.endswith(f"/shard-{r.shard:06d}.bin")
        for doc, start, end, at in zip(r.doc_ids, r.starts, [*r.starts[1:], r.n_tokens], r.froms):
            found.setdefault(doc, {})[at] = items[start:end]
    assert sorted(found) == sorted(i for i, t in texts.items() if t)
    for i in found:
        ids = [v for _, part in sorted(found[i].items()) for v in part]
        assert ids[-1] == queries.END_ID and ids[:-1] == tool.encode(texts[i]) and tool.decode(ids[:-1]) == texts[i]
    assert queries.END_ID >= len(tool.lengths)


def test_the_table_holds_what_sequences_share_once(spark, tmp_path):
    """Random texts in many copies: a sequence by itself does not compress, the table of all does."""
    text = np.random.default_rng(3).bytes(40_000)
    frame = spark.createDataFrame([(i, text) for i in range(50)], "doc_id long, data binary").coalesce(1)
    packed = to.pack(frame, "data", end=10)
    written = sum(int(r.size) for r in packed.select("_metadata.file_path", F.col("_metadata.file_size").alias("size")).distinct().collect())
    assert written < 50 * len(text) / 4
    got = to.write_shards(packed, f"file://{tmp_path}/shards", key=5).collect()
    assert sum(r.n_tokens for r in got) == 50 * (len(text) + 1)
