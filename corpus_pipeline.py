"""The corpus pipeline: documents go through five stages, each written as Parquet and reread.

Every stage works on all rows its predecessor kept; all but the last return the columns of
``documents``. The last returns the sampled segmentations of each remaining document.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from plateau.llm import exact_dedup, mixing, order_minhash, piece_sampling, toxicity  # noqa: E402
from plateau.llm.common import prepare, table  # noqa: E402
from plateau.session import checkpoint_dir  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject as toxic."""
    prepare(spark)
    chain = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, chain)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact_dedup.dedup_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    prepare(spark)
    return order_minhash.dedup_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights; a document can appear up to three times."""
    prepare(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of every document."""
    prepare(spark)
    # The executors also hold what four earlier stages left: a smaller cache, the same samples.
    return piece_sampling.sample_segmentations(docs, cache=2_000_000)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix),
          ("encoding", encode)]

# A trained classifier, sketches and sampling are not expressible in SQL; tests/llm compares
# the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
