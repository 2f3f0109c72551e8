"""The corpus pipeline: ``documents`` through five operators of ``wayfare.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``. ``run`` writes each
result as Parquet in the shared folder and reads it back for the next stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.jaccard import keep_one_of_each
from wayfare.llm.kernels import masked, shared_folder, unmasked
from wayfare.llm.packing import pack
from wayfare.llm.quality import keep_good
from wayfare.llm.queries import table, tokenizer_file
from wayfare.llm.suffix import remove_repeats
from wayfare.llm.toxicity import keep_clean


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rule and the risk-controlled rules keep."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    return keep_one_of_each(docs, width=5, threshold=0.8)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that 100-byte strings of earlier text cover."""
    own, safe = masked(docs, "doc_id", "text", "n_chars")
    kept = remove_repeats(own, length=100).withColumn("text", F.col("kept_text")) \
        .withColumn("n_chars", F.length("kept_text").cast("long"))
    return unmasked(kept, safe, docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(docs, tokenizer_file(), capacity=2048, end_id=0)


STAGES = [("quality rules", quality_rules), ("toxicity", drop_toxic), ("n-gram Jaccard join", drop_near_duplicates),
          ("suffix-array dedup", drop_repeats), ("best-fit packing", packing)]
#: Training, similarity and packing have no SQL form; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/llm-pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
