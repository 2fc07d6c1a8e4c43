"""A corpus pipeline of four operators: toxicity, SimHash near-duplicates,
surrogates for personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is
written as Parquet and read again as the next stage's docs.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundlake.llm import common, packing, pii, simhash, toxicity

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 8, trained on the labels that are not held out, scores below 0.5."""
    common.make_importable(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model).select(*DOCUMENTS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (operator 7): that of the smallest id."""
    common.make_importable(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=2).select(*DOCUMENTS)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data (operator 3) and their new length."""
    common.make_importable(spark)
    return pii.with_surrogates(docs).select(*DOCUMENTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens (operator 9)."""
    common.make_importable(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("pii_surrogates", replace_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express the trained scores, the surrogates and the token ids;
#: tests/llm/test_pipeline.py compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; the result is the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
