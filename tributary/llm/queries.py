"""The operators for training data over their whole tables, as thin queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    chat,
    decontamination,
    filter_audit,
    fixity,
    near_dup,
    packing,
    quality,
    repeats,
    secrets,
    sentence_pieces,
    sharding,
    sql,
    token_rows,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark")
    return decontamination.digest(decontamination.find(_table(spark, sf_dir, "documents"), items))


def op2_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(chat.marked_conversation(spark))
    turns = chat.paths(chat.chain(rows, "conv_id", ["turn"], "role", "text"))
    return chat.digest(chat.read_back(chat.render(turns)))


def op3_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "linked",
    )


def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = token_rows.pack(_table(spark, sf_dir, "documents"))
    return packed.withColumnRenamed("keys", "doc_ids")


def op6_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = near_dup.link(_table(spark, sf_dir, "documents"), words=2)
    return linked.select("doc_id", "n_shingles", "component_id", "kept")


def op7_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(_table(spark, sf_dir, "documents"), with_kept=False)


#: Characters at which the copy in the audit cuts off a page, as a broken transfer would.
CUT = 32_768


def op8_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages against a copy that lost the ends of long pages and all empty ones."""
    pages = _table(spark, sf_dir, "pages")
    copy = pages.filter("html <> ''").withColumn("html", F.substring("html", 1, CUT))
    return fixity.audit(pages, copy)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(_table(spark, sf_dir, "documents"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentence_pieces.encode(_table(spark, sf_dir, "documents"))
    return sentence_pieces.digest(sentence_pieces.decode(encoded))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_reply_trees": op2_reply_trees,
    "op3_label_propagation": op3_label_propagation,
    "op4_length_buckets": op4_length_buckets,
    "op5_token_rows": op5_token_rows,
    "op6_minhash_components": op6_minhash_components,
    "op7_prefix_free_parsing": op7_prefix_free_parsing,
    "op8_merkle_fixity": op8_merkle_fixity,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_filter_interactions": op12_filter_interactions,
    "op13_sentence_pieces": op13_sentence_pieces,
}

ORACLE_SQL = sql.STATEMENTS
