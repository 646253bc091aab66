"""Mean target encodings and their lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfcast.config import ITEM, MONTH
from shelfcast.functions.numeric import mean
from shelfcast.operators.lags import calendar_lags
from shelfcast.operators.layout import join_small
from shelfcast.session import settle


def mean_encode(panel: DataFrame, keys: Sequence[str], out: str, value: str = "item_quantity") -> DataFrame:
    """Mean of the zero-filled target per (month, *keys). Partial sums keep a hot group to one row per task."""
    return panel.groupBy(MONTH, *keys).agg(mean(value).alias(out))


def attach_mean(panel: DataFrame, keys: Sequence[str], out: str, value: str = "item_quantity") -> DataFrame:
    """Put the group mean on every panel row.

    Item-keyed means are built and joined where the item-hashed panel already lies. Others are small beside the panel:
    they are written once, measured, and broadcast if they fit.
    """
    means = mean_encode(panel, keys, out, value)
    if ITEM in keys:
        return panel.join(means.hint("shuffle_hash"), [MONTH, *keys], "left")
    return join_small(panel, settle(means), [MONTH, *keys])


def lagged_encoding(
    panel: DataFrame, keys: Sequence[str], lags: Sequence[int], out: str, value: str = "item_quantity"
) -> DataFrame:
    """Lags of a group mean. NULL when the pair's own row is absent k months earlier, even if the group has a mean."""
    return calendar_lags(attach_mean(panel, keys, out, value), [out], lags).drop(out)


def ensemble_mean(predictions: Sequence[DataFrame]) -> DataFrame:
    """Average of several (ID, item_cnt_month) predictions."""
    stacked = union_all(predictions)
    return stacked.groupBy("ID").agg(mean("item_cnt_month").alias("item_cnt_month"))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack predictions of separate segments or models."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
