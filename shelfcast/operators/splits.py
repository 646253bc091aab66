"""Train / validation / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.config import MONTH
from shelfcast.operators.layout import number_rows
from shelfcast.session import settle

_BUCKET_DIGITS = 4


def time_split(df: DataFrame, validation: int, test: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Months before ``validation``, that month, and the month to predict. Prunes a month-partitioned stage."""
    month = F.col(MONTH)
    return df.filter(month < validation), df.filter(month == validation), df.filter(month == test)


def segment(df: DataFrame, value: int, col: str = "item_seniority") -> DataFrame:
    return df.filter(F.col(col) == value)


def key_score(keys: Sequence[str], seed: int = 0) -> Column:
    """48-bit text score of a key: depends on the key and seed only, never on the layout of the data."""
    return F.substr(F.md5(F.concat_ws("-", F.lit(str(seed)), *keys)), F.lit(1), F.lit(12))


def random_split(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 0, out: str = "is_val") -> DataFrame:
    """Flag exactly int(fraction · n) rows: those with the smallest (score, keys). ``keys`` must be unique.

    A histogram over the leading score digits (at most 16^4 rows) finds the bucket with the cut; only that bucket is
    ranked, range by range, so the table itself is neither sorted nor shuffled. It is read three times: settle it first
    unless it is cheap to read.
    """
    scored = df.withColumn("_score", key_score(keys, seed))
    bucket = F.substr("_score", F.lit(1), F.lit(_BUCKET_DIGITS))
    histogram = settle(scored.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n")))
    total = histogram.agg(F.sum("_n")).first()[0] or 0
    wanted = int(fraction * total)
    if not wanted:
        return df.withColumn(out, F.lit(False))
    upto = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    cut = histogram.withColumn("_upto", upto).filter(F.col("_upto") >= wanted).orderBy("_bucket").first()
    left = wanted - (cut["_upto"] - cut["_n"])
    order = ["_score", *keys]
    ranked = number_rows(scored.filter(bucket == cut["_bucket"]).select(*order), order, "_rank")
    last = ranked.filter(F.col("_rank") == left - 1).first()
    kinds = scored.schema
    limit = F.struct(*[F.lit(last[c]).cast(kinds[c].dataType).alias(c) for c in order])
    return scored.withColumn(out, F.struct(*order) <= limit).drop("_score")


def remainder(df: DataFrame, sample: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the sample."""
    return df.join(sample.select(*keys), list(keys), "left_anti")
