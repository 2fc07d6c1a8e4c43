"""Registered queries of the operators, and their DuckDB SQL where SQL can
express them.  Each query applies its operator to the whole table and derives
the digest columns from the operator's rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm import (ann, common, conversations, licenses, line_dedup, packing, pii, runs, simhash, sketches, spm_sample, token_counts, token_files,
                          toxicity)
from fundlake.llm import oracle_sql as oracle

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.make_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_sentencepiece_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = spm_sample.sample(table(spark, sf_dir, "documents"), k=2)
    return samples.select("doc_id", "sample", "n_pieces", F.crc32("ids").alias("ids_crc32"), "logp", "perturbed",
                          "log_inclusion")


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.select("doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars",
                         F.crc32("deltas").alias("prefix_counts_crc32"))


def op6_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(table(spark, sf_dir, "documents"))


def op7_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "bin_class")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.scratch_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder)
    docs = token_files.read_token_files(spark, folder)
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(conversations.damaged(rows))
    key = [F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("conv_id").isNull().alias("unknown")]
    every = rows.select("conv_id").distinct().select("conv_id", *key)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = (every.join(repaired.summary, conversations.KEY, "left")
           .join(conversations.hashes(repaired.rows), conversations.KEY, "left"))
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find(runs.planted(table(spark, sf_dir, "documents")))
    better = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.withColumn("best", F.when(F.size("runs") > 0, F.try_element_at("runs", F.lit(1))))
    best = F.reduce("runs", F.col("best"), lambda best, r: F.when(better(r, best), r).otherwise(best))
    found = found.withColumn("best", best)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_sentencepiece_samples": op2_sentencepiece_samples,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_token_counts": op5_token_counts,
    "op6_bottom_k_fingerprints": op6_bottom_k_fingerprints,
    "op7_simhash_near_duplicates": op7_simhash_near_duplicates,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_token_files": op10_token_files,
    "op11_line_dedup": op11_line_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE_SQL: dict[str, str] = {
    "op11_line_dedup": oracle.OP11,
    "op12_conversation_repair": oracle.OP12,
}
