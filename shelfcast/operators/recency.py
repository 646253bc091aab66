"""First and last sale months, and item seniority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.config import ITEM, MONTH, SHOP
from shelfcast.operators.grid import ActiveMonths, last_before, month_sets, month_span, words_of
from shelfcast.operators.layout import join_small
from shelfcast.session import settle


def first_month(df: DataFrame, keys: Sequence[str], out: str = "first_month") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(MONTH).alias(out))


def last_sale(panel: DataFrame, monthly: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Latest month strictly before the row's month with a sale row of ``keys`` (a zero sum counts).

    The sale months of a key are one bit set, so the panel needs one hash join and no sort, and any panel will do: one
    after a burn-in, or only the keys to predict.
    """
    span = month_span(monthly)
    sold = month_sets(monthly, keys, span, "_m")
    joined = panel.join(sold.hint("shuffle_hash"), list(keys), "left") if ITEM in keys else join_small(panel, settle(sold), list(keys))
    found = last_before(words_of("_m", span), F.col(MONTH), span)
    return joined.withColumn(out, found).drop(*[f"_m{w}" for w in range(span[1])])


def first_seen(panel: DataFrame, months: ActiveMonths, pair: str, item: str) -> DataFrame:
    """Months since the pair's and since the item's first row in a panel of the active grid, as ``since_first`` counts."""
    made = {pair: F.col(MONTH) - months.first_pair_month(), item: F.col(MONTH) - months.first_item_month()}
    return months.attach(panel).withColumns(made).drop(*months.added)


def since_first(panel: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Months since the first panel row of ``keys``; zero rows and the month to predict count."""
    firsts = first_month(panel, keys, "_first")
    joined = panel.join(firsts.hint("shuffle_hash"), list(keys), "left")
    return joined.withColumn(out, F.col(MONTH) - F.col("_first")).drop("_first")


def since_first_sale(panel: DataFrame, monthly: DataFrame) -> DataFrame:
    """First actual sale month of the pair and the months since; −1 in both when it was never sold before."""
    firsts = first_month(monthly, [SHOP, ITEM], "_first")
    joined = panel.join(firsts.hint("shuffle_hash"), [SHOP, ITEM], "left")
    before = F.col(MONTH) > F.col("_first")
    return joined.withColumns(
        {
            "first_sale_in_shop": F.when(before, F.col("_first")).otherwise(F.lit(-1)),
            "months_since_first_sale_in_shop": F.when(before, F.col(MONTH) - F.col("_first")).otherwise(F.lit(-1)),
        }
    ).drop("_first")


def seniority_code(month, first_panel_month, first_sale_in_shop):
    """0 = new item, 1 = known item not sold in this shop before, 2 = sold here before."""
    is_new = (month == first_panel_month).cast("int")
    never_here = (~F.coalesce(month > first_sale_in_shop, F.lit(False))).cast("int")
    return 2 - is_new - never_here


def seniority(panel: DataFrame, monthly: DataFrame) -> DataFrame:
    """Seniority of the item at each panel row. An item is new in its first month on sale, or if it never was before."""
    by_item = first_month(monthly, [ITEM], "_item_first")
    by_pair = first_month(monthly, [SHOP, ITEM], "_pair_first")
    joined = panel.join(by_item.hint("shuffle_hash"), ITEM, "left").join(
        by_pair.hint("shuffle_hash"), [SHOP, ITEM], "left"
    )
    code = seniority_code(F.col(MONTH), F.least(F.col(MONTH), "_item_first"), F.col("_pair_first"))
    return joined.withColumn("item_seniority", code).drop("_item_first", "_pair_first")
