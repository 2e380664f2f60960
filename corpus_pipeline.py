"""From raw documents to packed sequences: five stages, each stored before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import fm_index, packing, pii_crf, setsketch, site_bayes
from orderloom.llm.common import ship, stored
from orderloom.session import apply_engine_conf


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good and not toxic by their own evidence and their site's."""
    return site_bayes.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return setsketch.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that they share with the benchmark."""
    return fm_index.clean(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii_crf.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of near-equal token windows, with their ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

# Trained models, component closure and tokens: not SQL. tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each is written as Parquet and read again."""
    docs = _table(ship(apply_engine_conf(spark)), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
