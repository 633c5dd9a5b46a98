"""A corpus pipeline: toxic documents go, near duplicates go, benchmark leaks go, secrets are masked, the rest becomes token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. Stages before the last return the columns of ``documents``. Documents without text pass the filters
(they are neither toxic nor a copy nor contaminated); rows that repeat a doc_id and its component count as one document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.llm import bpe, decontaminate, ngram_join, queries, secrets, toxicity
from epiloom.session import materialize


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score from the nearest labelled examples is below the limit."""
    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"))
    added = [f.name for f in toxicity.ADDED]
    aside = {c: f"__own_{c}" for c in docs.columns if c in added}
    scored = toxicity.score(docs.withColumnsRenamed(aside), model).filter(F.col("score") < queries.TOXIC_FROM).drop(*added)
    return scored.withColumnsRenamed({v: k for k, v in aside.items()}).select(*[f"`{c}`" for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.8 or more."""
    return ngram_join.one_per_component(docs, k=5, num=80, den=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of the benchmark."""
    added = [*decontaminate.FOUND.names, "n_hit"]
    aside = {c: f"__own_{c}" for c in docs.columns if c in added}
    kept = decontaminate.decontaminate(docs.withColumnsRenamed(aside), queries.table(spark, sf_dir, "benchmark"))
    return kept.withColumnsRenamed({v: k for k, v in aside.items()})


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets masked."""
    aside = {c: f"__own_{c}" for c in docs.columns if c in ("base", "spans")}
    return secrets.redact(docs.withColumnsRenamed(aside)).withColumnsRenamed({v: k for k, v in aside.items()})


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids of every document."""
    return bpe.encode(docs, queries.vocabulary(), keep=["doc_id", "lang", "source"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("bpe", encoding_stage),
]

#: Scores, components and merges are beyond SQL: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage starts from the written result of the one before."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, name)
    return docs
