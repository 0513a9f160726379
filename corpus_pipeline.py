"""From raw documents to packed sequences, each stage one operator of ``sensorflow.llm``.

Every stage gets what its predecessor kept, as a table read back from Parquet.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sensorflow.llm.common import table  # noqa: E402
from sensorflow.llm.decontam import drop_contaminated  # noqa: E402
from sensorflow.llm.near_dup import drop_near_duplicates  # noqa: E402
from sensorflow.llm.packing import added_tokens, digest_pieces, pack, tokenizer_path, whole_path  # noqa: E402
from sensorflow.llm.pii import redact  # noqa: E402
from sensorflow.llm.toxicity import drop_toxic, labelled_rows, train  # noqa: E402


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores below 0.5; labels are read to learn it only."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return drop_toxic(docs, train(labelled_rows(docs, labels)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least doc_id) of each group linked by 5-word shingles at a Jaccard similarity of 0.8 or more."""
    return drop_near_duplicates(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in full sequences."""
    return digest_pieces(pack(docs, tokenizer_path(), added=added_tokens(), whole=whole_path()))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]

#: SQL cannot express the stages; they are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
