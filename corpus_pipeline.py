"""Corpus pipeline: stages of ``livemart.llm`` applied to ``documents`` one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``.  All stages but the last
return the columns of ``documents``; the last adds each remaining row's
shard and slot.  What a stage drops is gone for those after it:

1. toxicity: toxic documents go (the model is fitted on the stage's input);
2. ngram_jaccard_join: one document of each group of copies and links stays;
3. decontaminate: documents that hold a benchmark item go;
4. domain_mixing: each document is taken as often as its rate says;
5. shard_shuffle: a uniform shuffle into shards of equal row counts.

Nulls, repeated rows, empty tables and clashing column names are handled as
the operators' docstrings say.  SQL cannot express the fitted models and the
shuffle, so ``ORACLE_SQL`` is None; tests compare with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from livemart.llm import decontaminate, domain_mixing, ngram_jaccard_join, shard_shuffle, toxicity
from livemart.llm._shared import ship, written

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_jaccard_join.one_of_each_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return domain_mixing.mixed(docs, _table(spark, sf_dir, "labels"))


def shuffle_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_shuffle.shuffle(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("domain_mixing", mix_domains),
    ("shard_shuffle", shuffle_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each result is written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
