"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import best_fit_packing, chunk_dedup, graph_search, licenses, line_crf, merkle_manifest, mixing, periodic_runs, pieces, quality_qda, secrets, sharding, simhash
from martloom.llm.common import table
from martloom.llm.oracle import ORACLE_SQL  # noqa: F401  (part of the driver contract)
from martloom.session import stage

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeat_report(table(spark, sf_dir, "documents"))


def op3_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.search_table(table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sizes = stage(mixing.measured(docs).drop("text"), "mix-sizes")
    mixed = mixing.mix(sizes, mixing.source_targets(sizes))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", F.array_join("shard_words", ",").alias("shard_words"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_report(table(spark, sf_dir, "documents"), pieces.read_pieces(pieces.default_model()))


def op7_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    none = F.lit(None).cast("int")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none.alias("grown_shard"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


def op9_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.rule_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = licenses.license_report(table(spark, sf_dir, "documents"))
    return report.withColumn("method_labels", F.array_join("method_labels", ","))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest_report(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.packing_report(table(spark, sf_dir, "documents"), best_fit_packing.default_tokenizer())


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secrets, op2_chunk_dedup, op3_graph_search, op4_mixing, op5_simhash, op6_pieces, op7_feistel, op8_quality, op9_line_crf, op10_licenses,
        op11_merkle, op12_packing, op13_periodic_runs,
    )
}
