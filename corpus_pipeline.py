"""Training-corpus pipeline: each stage calls one operator of ``strata.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and rereads as the next
stage's docs. All stages but the last return the columns of ``documents``.

Defined results: nulls, empty texts, repeated rows and empty tables follow the
operators' own definitions; extra columns of ``documents`` pass through; the
order of rows carries no meaning.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from strata.llm.common import ROW, ship_library, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    ship_library(spark)
    model = toxicity.Model(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).filter("predicted = 0").select(f"{ROW}.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the smallest doc_id stays."""
    ship_library(spark)
    return simhash.drop_near_duplicates(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut; documents that are mostly such passages go."""
    ship_library(spark)
    length = "n_chars" if "n_chars" in docs.columns else None
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), length_col=length)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of the decoded bytes."""
    ship_library(spark)
    out = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                     public_tokenizers.PATTERN, carry=["doc_id"])
    return out.select(F.col(ROW)["doc_id"].alias("doc_id"), "n_tokens",
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies),
          ("simhash_near_dedup", drop_near_copies), ("decontamination", cut_benchmark),
          ("byte_bpe", tokenize)]

#: SQL cannot express the trained classifier; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
