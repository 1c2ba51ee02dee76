"""The registered queries of the corpus operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import (
    alignment, collocations, exact_copies, hilbert, html_sites, line_rules, mixing, neighbours, packing, repeats, secrets, shingle_join, toxicity,
)
from emberlog.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score_documents(_read(spark, folder, "documents"), _read(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages"))


def op2_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.remove_repeats(_read(spark, folder, "documents"), with_text=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_certified_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(_read(spark, folder, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_read(spark, folder, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"),
                        live.alias("n_live"), (F.size("spans") - live).cast("long").alias("n_copied"))


def op5_site_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    return html_sites.extract(_read(spark, folder, "pages"))


def op6_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.similar_groups(_read(spark, folder, "documents"), null_least=False)


def op7_raked_mixture(spark: SparkSession, folder: str) -> DataFrame:
    drawn = mixing.mixed(_read(spark, folder, "documents"))
    return drawn.select("doc_id", "_cell.source", "_cell.lang", "_cell.topic", "_cell.tokens",
                        F.col("_weight").alias("weight"), F.col("_probability").alias("probability"),
                        F.col("_kept").alias("kept"))


def op8_block_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_read(spark, folder, "embeddings"))


def op9_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert.shard_by_curve(_read(spark, folder, "documents"))


def op10_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.clean_lines(_read(spark, folder, "documents"), with_text=False)


def op11_exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    grouped = exact_copies.groups(_read(spark, folder, "documents"))
    return grouped.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_read(spark, folder, "documents"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(_read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxic_segments": op1_toxic_segments,
    "op2_repeated_strings": op2_repeated_strings,
    "op3_certified_packing": op3_certified_packing,
    "op4_secret_ownership": op4_secret_ownership,
    "op5_site_style_tree": op5_site_style_tree,
    "op6_shingle_join": op6_shingle_join,
    "op7_raked_mixture": op7_raked_mixture,
    "op8_block_neighbours": op8_block_neighbours,
    "op9_hilbert_shards": op9_hilbert_shards,
    "op10_line_rules": op10_line_rules,
    "op11_exact_copies": op11_exact_copies,
    "op12_collocations": op12_collocations,
    "op13_token_alignment": op13_token_alignment,
}
