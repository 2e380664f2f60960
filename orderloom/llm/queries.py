"""The operators as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    class_lm,
    feast_whitening,
    fm_index,
    norm_topk,
    packing,
    periodic_runs,
    pii_crf,
    setsketch,
    site_bayes,
    slots,
    suffix_levels,
    swap_packing,
    tag_paths,
)
from orderloom.llm.common import ship
from orderloom.llm.sql import SQL
from orderloom.session import apply_engine_conf

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}


def query(plan: Plan) -> Plan:
    QUERIES[plan.__name__] = lambda spark, sf_dir: plan(ship(apply_engine_conf(spark)), sf_dir)
    return plan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.main_text(table(spark, sf_dir, "pages"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.digest(pii_crf.find(table(spark, sf_dir, "documents")))


@query
def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(table(spark, sf_dir, "documents"))


@query
def op4_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.shard(table(spark, sf_dir, "documents"))


@query
def op5_norm_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_topk.top_k(table(spark, sf_dir, "embeddings"))


@query
def op6_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_bayes.digest(site_bayes.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query
def op7_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_levels.digest(suffix_levels.without_repeats(table(spark, sf_dir, "documents")))


@query
def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.digest(fm_index.locate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query
def op9_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op10_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_feast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feast_whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_swap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = swap_packing.pieces(table(spark, sf_dir, "documents"))
    checked = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return swap_packing.packed(checked)


@query
def op13_synchronised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = periodic_runs.with_repeats(table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.collapse(texts))


def registered() -> dict[str, Plan]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: SQL[name] for name in QUERIES if name in SQL}
