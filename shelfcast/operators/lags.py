"""Calendar lags: the value of the same pair exactly k months earlier, NULL when that row is absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.config import ITEM, KEYS, MONTH, SHOP


def calendar_lags(panel: DataFrame, cols: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """One-month range frames. All lags of all columns share one partitioning and one sort; keys must be unique.

    The item leads the partition keys: it has many values, so the sort seldom compares beyond it.
    """
    by_pair = Window.partitionBy(ITEM, SHOP).orderBy(MONTH)
    made = {
        f"{c}_lag_{k}": F.max(c).over(by_pair.rangeBetween(-k, -k)) for c in cols for k in lags
    }
    return panel.withColumns(made)


def calendar_lags_by_join(panel: DataFrame, cols: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """Same result by shifting the months of a copy and joining it back, one join per lag."""
    out = panel
    for k in lags:
        shifted = panel.select(
            (F.col(MONTH) + k).alias(MONTH), SHOP, ITEM, *[F.col(c).alias(f"{c}_lag_{k}") for c in cols]
        )
        out = out.join(shifted, list(KEYS), "left")
    return out
