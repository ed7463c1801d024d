"""Training-text pipeline over ``documents``: five stages, each written and read again by the next.

quality classifier -> line dedup -> near-dedup by fingerprints and 5-word shingles -> benchmark decontamination -> byte-level BPE
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm import bpe, decontam, jaccard, lines, quality
from snapflow.session import cut, drop_folders, made_folders

RANKS = "byte_bpe_multi_50k.tiktoken"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_last: list[str] = []  # tables that the stage called last has written for itself


def staged(stage: Stage) -> Stage:
    """A stage that first drops the tables of the stage before, whose result has been written by then."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_folders(spark, _last)
        before = set(made_folders())
        out = stage(spark, docs, sf_dir)
        _last[:] = [path for path in made_folders() if path not in before]
        return out

    return run_stage


@staged
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more; the model learns from the labelled ones outside the held-out fold."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality.score(docs, model) >= 0.5)


@staged
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; those that keep no word are dropped."""
    return lines.dedupe_lines(docs)


@staged
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies (0.8 of their 5-word shingles shared), that of the smallest id; repeated rows of it once.

    Operator 6's fingerprint shards link first, and each link is verified; signatures find the copies they leave apart.
    """
    return jaccard.one_of_each(docs)


@staged
def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = found.select(F.struct("doc_id").alias("_key")).distinct()  # a struct compares null ids as equal
    rows = docs.select(F.struct("*").alias("_row"), F.struct("doc_id").alias("_key")).join(leaks, "_key", "left_anti")
    return rows.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


@staged
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with the digests of ids and of the decoded bytes."""
    return bpe.tokenize(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", token_stage),
]

#: SQL cannot express the classifier, the fingerprints and the tokens; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table of the shared folder that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
