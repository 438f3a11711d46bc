"""The operators as registered queries, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobmill.llm import (
    apportion,
    exact_dedup,
    fill_in_middle,
    near_dedup,
    packing,
    sharding,
    token_files,
    tool_calls,
    toxicity,
    vector_search,
    warc,
    weak_quality,
    whitening,
)
from jobmill.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        return f

    return register


@query("op1_source_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return apportion.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_near_dedup")
def near(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents"))


@query("op4_slot_sharding")
def slot_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents")).drop("virtual_slot")


@query("op8_exact_dedup")
def exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@query("op9_vector_search")
def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.top_k(table(spark, folder, "embeddings"))


@query("op6_warc_captures")
def captures(spark: SparkSession, folder: str) -> DataFrame:
    return warc.page_captures(table(spark, folder, "pages"))


@query("op5_genetic_packing")
def packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op10_weak_label_quality")
def quality(spark: SparkSession, folder: str) -> DataFrame:
    return weak_quality.score(table(spark, folder, "documents"))


@query("op2_deobfuscated_toxicity")
def toxic(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_tool_calls")
def tool_links(spark: SparkSession, folder: str) -> DataFrame:
    return tool_calls.link(*tool_calls.turn_calls(table(spark, folder, "conversations")))


@query("op11_whitened_embeddings")
def whitened(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@query("op12_token_files")
def token_listing(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"))


@query("op13_fill_in_middle")
def middle_filled(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, folder, "documents"))
