"""Monthly totals, the dense (month × shop × item) panel, and its dimension joins."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.config import ITEM, KEYS, MONTH, SHOP
from shelfcast.functions.numeric import mean
from shelfcast.operators.cleaning import with_period
from shelfcast.operators.layout import expand, join_small
from shelfcast.session import parallelism, settle

ROWS_PER_TASK = 4_000_000


def monthly_sales(sales: DataFrame) -> DataFrame:
    """Units per (month, shop, item)."""
    return sales.groupBy(*KEYS).agg(F.sum("item_quantity").alias("item_quantity"))


def active_keys(sales: DataFrame, key: str) -> DataFrame:
    """Distinct (month, key)."""
    return sales.select(MONTH, key).distinct()


class GridSize(NamedTuple):
    """Tasks for a grid's rows, shops of its largest month, and its last month (None: no rows)."""

    partitions: int
    shops: int
    last: int | None


def grid_size(keys: DataFrame) -> GridSize:
    """Size of the grid of these keys, from its estimated row count Σ (items × shops) per month.

    Only the layout depends on the counts, so sketches merged in one small aggregate are enough; the month is exact.
    """
    per_month = keys.groupBy(MONTH).agg(
        F.approx_count_distinct(ITEM).alias("_i"), F.approx_count_distinct(SHOP).alias("_s")
    )
    rows, shops, last = per_month.agg(F.sum(F.col("_i") * F.col("_s")), F.max("_s"), F.max(MONTH)).first()
    return GridSize(max(parallelism(keys.sparkSession), math.ceil((rows or 0) / ROWS_PER_TASK)), shops or 0, last)


def grid_partitions(keys: DataFrame) -> int:
    """Tasks for the grid of these keys."""
    return grid_size(keys).partitions


def grid_of(keys: DataFrame, partitions: int | None = None) -> DataFrame:
    """Active grid from a compact table of (month, shop, item) keys that is cheap to read more than once."""
    partitions = partitions or grid_partitions(keys)
    return expand(active_keys(keys, ITEM), active_keys(keys, SHOP), MONTH, [ITEM], partitions).select(*KEYS)


def active_grid(sales: DataFrame) -> DataFrame:
    """For each month, every shop active that month with every item active that month; hashed on the item.

    No item can be hot afterwards: it has at most months × shops rows, however many sales it had.
    """
    return grid_of(settle(sales.select(*KEYS).distinct()))


def fill_panel(grid: DataFrame, monthly: DataFrame) -> DataFrame:
    """Attach the monthly units to the grid; a pair without sales has NULL.

    The sparse side is the hash-join build side, one bounded part per item hash, so the dense side is never sorted.
    """
    return grid.join(monthly.hint("shuffle_hash"), list(KEYS), "left")


def dense_panel(monthly: DataFrame, partitions: int | None = None) -> DataFrame:
    """Grid with monthly units, 0 where nothing was sold. ``monthly`` is read several times: settle it first."""
    return fill_panel(grid_of(monthly, partitions), monthly).fillna(0, subset=["item_quantity"])


def union_test_keys(panel: DataFrame, test: DataFrame, month: int, partitions: int | None = None) -> DataFrame:
    """Append the keys to predict; their target counts as 0.

    The keys take the item hash of the dense rows (pass the panel's ``partitions``), so that the union keeps it and
    later steps need no new shuffle.
    """
    partitions = partitions or parallelism(test.sparkSession)
    keys = with_period(test.select(SHOP, ITEM), month).repartition(partitions, ITEM)
    keys = keys.withColumn("item_quantity", F.lit(0.0))
    others = [c for c in panel.columns if c not in (*KEYS, "item_quantity")]
    return panel.unionByName(keys, allowMissingColumns=bool(others))


def attach_dims(panel: DataFrame, shops: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    """Left-join shop, item and category attributes. Category is resolved on the item table, before the panel."""
    enriched = join_small(items, categories, "item_category_id")
    return join_small(join_small(panel, shops, SHOP), enriched, ITEM)


def denormalise(sales: DataFrame, shops: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    """Sales with the names of shop, item and category."""
    return attach_dims(sales, shops, items, categories)


def localise(dim: DataFrame, translations: DataFrame, key: str, col: str, translated: str) -> DataFrame:
    """Replace a name by its translation where one is known."""
    table = translations.select(key, F.col(translated).alias("_new"))
    return join_small(dim, table, key).withColumn(col, F.coalesce("_new", col)).drop("_new")


def lookup(df: DataFrame, key: str, dim: DataFrame, cols: list[str]) -> DataFrame:
    """Attributes of a key; unknown keys get NULL."""
    return join_small(df, dim.select(key, *cols), key)


def monthly_price_units(sales: DataFrame, months: Column | None = None) -> DataFrame:
    """Mean price and summed units per (month, category, shop, item), for the months that satisfy the predicate."""
    rows = sales if months is None else sales.filter(months)
    return rows.groupBy(MONTH, "item_category_id", SHOP, ITEM).agg(
        mean("item_price").alias("item_price"), F.sum("item_quantity").alias("item_cnt_month")
    )


def pair_means(sales: DataFrame) -> DataFrame:
    """Mean over months of the monthly mean price and of the monthly units, per (shop, item)."""
    return (
        monthly_price_units(sales)
        .groupBy(SHOP, ITEM)
        .agg(mean("item_price").alias("item_price_mean"), mean("item_cnt_month").alias("item_cnt_month"))
    )


def category_price(sales: DataFrame) -> DataFrame:
    """Unweighted mean over a category's items of each item's mean price."""
    per_item = sales.groupBy("item_category_id", ITEM).agg(mean("item_price").alias("_price"))
    return per_item.groupBy("item_category_id").agg(mean("_price").alias("item_cat_price_mean"))


def price_context(test: DataFrame, sales: DataFrame, items: DataFrame) -> DataFrame:
    """Pair mean price, category and category mean price for the keys to predict."""
    with_pair = test.join(pair_means(sales).select(SHOP, ITEM, "item_price_mean"), [SHOP, ITEM], "left")
    with_category = with_pair.join(items.select(ITEM, "item_category_id"), ITEM, "left")
    return join_small(with_category, category_price(sales), "item_category_id")


def submission_join(test: DataFrame, predictions: DataFrame) -> DataFrame:
    """ID with its prediction, matched on (shop, item); never by row order."""
    values = predictions.select(SHOP, ITEM, F.col("item_quantity").alias("item_cnt_month"))
    return test.join(values, [SHOP, ITEM], "left").select("ID", "item_cnt_month")
