"""A corpus pipeline in five stages; each stage's rows are written as Parquet and read again by the next.

Toxic documents go, then all but one document of each near-duplicate group, then passages that an
earlier document has already; the rest is mixed to the source weights and packed into batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import common, mixing, near_dedup, packing, substring_dedup, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    common.job(spark)
    model = toxicity.fit(toxicity.labelled_documents(spark, docs, sf_dir))
    return toxicity.drop_toxic(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    common.job(spark)
    return near_dedup.drop_near_duplicates(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are cut out of the text."""
    common.job(spark)
    return substring_dedup.remove_passages(docs, substring_dedup.repeated_passages(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as the mix takes."""
    common.job(spark)
    return mixing.mix_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of documents of like length: boundary, shard, batch, doc_ids, n_docs, tokens, padded."""
    common.job(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Learned models and searches have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to documents; what lies between two stages goes to the shared checkpoint folder, until it is used."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{common.checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    common.remove_at_exit(spark, folder)  # the last stage's input is read when the result is
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                common.remove_folder(spark, f"{folder}/{k - 1}")
    return docs
