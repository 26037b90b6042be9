"""A training corpus from raw documents, stage by stage.

Each stage reads what the one before it wrote: toxic documents go, one of each group of
near duplicates stays, documents with benchmark passages go, sources are mixed to their
target weights, and the copies are dealt into shards of near equal size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.mixing import poisson_mix
from tidemark.llm.sharding import balanced_shards
from tidemark.llm.similar import one_of_each
from tidemark.llm.store import stored
from tidemark.llm.toxicity import toxicity_scores
from tidemark.llm.winnowing import find_passages

SHARDS = 40


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not call toxic."""
    scored = toxicity_scores(docs, read(spark, sf_dir, "labels"), F.lit(True))
    return scored.filter("toxic = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return one_of_each(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word passage of the benchmark."""
    marked = find_passages(docs, read(spark, sf_dir, "benchmark"), window=10)
    return marked.filter(~F.col("contaminated")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that a source weighs as the square root of its bytes, shuffled."""
    return poisson_mix(docs, exponent=0.5, seed=17).select(*docs.columns)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with shard and slot; equal texts share a shard."""
    return balanced_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: A trained classifier decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
