"""The training-data pipeline: good documents, one of each near-duplicate group, without personal data, in the target
mix, packed into sequences. It belongs to the subpackage ``shelfcast.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import prepared
from shelfcast.llm.jaccard_join import jaccard_join
from shelfcast.llm.mixing import sample_mix
from shelfcast.llm.packing import best_fit_pack, vocabulary
from shelfcast.llm.pii import sanitise
from shelfcast.llm.quality import keep_good
from shelfcast.session import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    prepared(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id, null last.

    Rows are told apart by a number written with them, so neither repeated nor missing ids add or lose a row.
    """
    prepared(spark)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = settle(docs.select(F.monotonically_increasing_id().alias("row"), whole))
    groups = jaccard_join(rows.select(F.col("row").alias("doc_id"), "doc.text"))
    ids = rows.select("row", F.col("doc.doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    kept = (
        groups.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row")
        .groupBy("component_id").agg(first.alias("first")).select("first.row")
    )
    return rows.join(kept, "row", "left_semi").select("doc.*")


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced or removed."""
    prepared(spark)
    return sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn in the target mix of sources, languages and topics."""
    prepared(spark)
    return sample_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids, and their places in sequences of 1024 tokens."""
    prepared(spark)
    return best_fit_pack(docs, *vocabulary(), payload="ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("personal data", personal_data_stage),
    ("mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

# Tokenising is not SQL; tests/llm compares each stage with a plain version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
