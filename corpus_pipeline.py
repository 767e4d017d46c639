"""A cleaning run over ``documents``: each stage works on all that the one before it kept.

Low-quality documents go, then exact copies, then near copies; sources are mixed to their target weights, which
takes some documents twice and others not at all; what is left is encoded.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.bpe import encode_documents
from tallyframe.llm.exact_dedup import drop_exact_duplicates
from tallyframe.llm.jaccard_join import drop_similar
from tallyframe.llm.mixing import take_mix
from tallyframe.llm.quality import keep_good
from tallyframe.sources.folders import delete
from tallyframe.sources.staging import staging_root

#: the tokenizer file, at the same place on every machine
TOKENIZER = os.environ.get("CORPUS_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_similar(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = encode_documents(docs, TOKENIZER)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("encode", encode),
]

#: nearest neighbours in a latent space are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again by the next.

    A stage's result is deleted when the next one is written; the last one's stays for the rows that are returned.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root, before = f"{staging_root(spark)}/corpus-{uuid.uuid4().hex}", None
    for place, (name, stage) in enumerate(STAGES):
        path = f"{root}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
