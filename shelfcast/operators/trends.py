"""Price and revenue trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.config import ITEM, MONTH, SHOP
from shelfcast.functions.numeric import mean, relative_delta, select_trend
from shelfcast.operators.grid import ActiveMonths, lag_table
from shelfcast.operators.lags import calendar_lags
from shelfcast.operators.layout import join_small
from shelfcast.session import settle


def _until(sales: DataFrame, as_of: int | None) -> DataFrame:
    return sales if as_of is None else sales.filter(F.col(MONTH) <= as_of)


def price_means(sales: DataFrame, keys: Sequence[str], out: str, as_of: int | None = None) -> DataFrame:
    """Mean price of daily rows per key. Over all months by default; ``as_of`` stops the look-ahead."""
    return _until(sales, as_of).groupBy(*keys).agg(mean("item_price").alias(out))


def shop_revenue(sales: DataFrame) -> DataFrame:
    """Σ price × quantity per (month, shop); exact when prices are decimals."""
    revenue = F.col("item_price") * F.col("item_quantity")
    if sales.schema["item_price"].dataType.typeName() == "decimal":
        revenue = F.col("item_price") * F.col("item_quantity").cast("decimal(12,0)")
    return sales.groupBy(MONTH, SHOP).agg(F.sum(revenue).alias("shop_monthly_revenue"))


def shop_avg_revenue(revenue: DataFrame, as_of: int | None = None) -> DataFrame:
    """Mean of a shop's monthly revenue over the months it has sales in."""
    return _until(revenue, as_of).groupBy(SHOP).agg(mean("shop_monthly_revenue").alias("shop_avg_revenue"))


def price_sums(sales: DataFrame) -> DataFrame:
    """Sum and number of daily prices per (month, item): all price means come from this narrow table."""
    return sales.groupBy(MONTH, ITEM).agg(F.sum("item_price").alias("_sum"), F.count("item_price").alias("_n"))


def running_price_means(sales: DataFrame) -> DataFrame:
    """The item's mean daily price up to and including each month it has sales in: every ``as_of`` in one pass."""
    upto = Window.partitionBy(ITEM).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, 0)
    so_far = F.try_divide(F.sum("_sum").over(upto).cast("double"), F.sum("_n").over(upto))
    return price_sums(sales).select(MONTH, ITEM, so_far.alias("item_avg_item_price"))


def running_shop_revenue(sales: DataFrame) -> DataFrame:
    """The shop's mean monthly revenue up to and including each month it has sales in."""
    upto = Window.partitionBy(SHOP).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, 0)
    so_far = F.try_divide(F.sum("shop_monthly_revenue").over(upto).cast("double"), F.count("shop_monthly_revenue").over(upto))
    return shop_revenue(sales).select(MONTH, SHOP, so_far.alias("shop_avg_revenue"))


def lagged_price_deltas(sales: DataFrame, lags: Sequence[int], as_of: int | None = None) -> DataFrame:
    """(month, item) with delta_price_lag_k wherever one of them is known: one pass over the sales."""
    sums = settle(price_sums(sales))
    overall = _until(sums, as_of).groupBy(ITEM).agg(
        F.try_divide(F.sum("_sum").cast("double"), F.sum("_n")).alias("_overall")
    )
    price = F.try_divide(F.col("_sum").cast("double"), F.col("_n"))
    deltas = sums.join(overall, ITEM, "left").select(MONTH, ITEM, relative_delta(price, "_overall").alias("delta_price"))
    return lag_table(deltas, [ITEM], ["delta_price"], lags)


def grid_price_deltas(
    panel: DataFrame, sales: DataFrame, months: ActiveMonths, lags: Sequence[int], as_of: int | None = None
) -> DataFrame:
    """``price_deltas`` of a panel of the active grid: one pass over the sales, no sort of the panel."""
    lagged = lagged_price_deltas(sales, lags, as_of)
    joined = months.attach(panel.join(lagged.hint("shuffle_hash"), [MONTH, ITEM], "left"))
    names = {f"delta_price_lag_{k}": F.when(months.present(k), F.col(f"delta_price_lag_{k}")) for k in lags}
    return joined.withColumns(names).drop(*months.added)


def grid_price_trend(
    panel: DataFrame, sales: DataFrame, months: ActiveMonths, lags: Sequence[int], as_of: int | None = None
) -> DataFrame:
    """``price_trend`` of a panel of the active grid."""
    names = [f"delta_price_lag_{k}" for k in lags]
    walked = grid_price_deltas(panel, sales, months, lags, as_of).withColumn("delta_price_lag", select_trend(names))
    return walked.drop(*names)


def grid_revenue_trend(
    panel: DataFrame, sales: DataFrame, months: ActiveMonths, fill: bool = True, as_of: int | None = None
) -> DataFrame:
    """``revenue_trend`` of a panel of the active grid."""
    revenue = settle(shop_revenue(sales))
    delta = join_small(revenue, shop_avg_revenue(revenue, as_of), SHOP).select(
        (F.col(MONTH) + 1).alias(MONTH), SHOP,
        relative_delta(F.col("shop_monthly_revenue").cast("double"), "shop_avg_revenue").alias("delta_revenue_lag_1"),
    )
    joined = months.attach(join_small(panel, settle(delta), [MONTH, SHOP]))
    lagged = joined.withColumn("delta_revenue_lag_1", F.when(months.present(1), F.col("delta_revenue_lag_1")))
    lagged = lagged.drop(*months.added)
    return lagged.fillna(0, subset=["delta_revenue_lag_1"]) if fill else lagged


def price_deltas(panel: DataFrame, sales: DataFrame, lags: Sequence[int], as_of: int | None = None) -> DataFrame:
    """For each lag, (the item's mean price in that month − its overall mean) / overall mean, as delta_price_lag_k."""
    overall = price_means(sales, [ITEM], "_overall", as_of)
    monthly = price_means(sales, [MONTH, ITEM], "_price")
    priced = panel.join(monthly.hint("shuffle_hash"), [MONTH, ITEM], "left")
    lagged = calendar_lags(priced, ["_price"], lags).join(overall.hint("shuffle_hash"), ITEM, "left")
    deltas = {f"delta_price_lag_{k}": relative_delta(f"_price_lag_{k}", "_overall") for k in lags}
    return lagged.withColumns(deltas).drop("_price", "_overall", *[f"_price_lag_{k}" for k in lags])


def price_trend(panel: DataFrame, sales: DataFrame, lags: Sequence[int], as_of: int | None = None) -> DataFrame:
    """The selected price delta, as delta_price_lag."""
    names = [f"delta_price_lag_{k}" for k in lags]
    walked = price_deltas(panel, sales, lags, as_of).withColumn("delta_price_lag", select_trend(names))
    return walked.drop(*names)


def revenue_trend(panel: DataFrame, sales: DataFrame, fill: bool = True, as_of: int | None = None) -> DataFrame:
    """Last month's (shop revenue − shop average) / shop average; NULL becomes 0 unless ``fill`` is off."""
    revenue = shop_revenue(sales)
    delta = (
        revenue.join(shop_avg_revenue(revenue, as_of), SHOP)
        .select(MONTH, SHOP, relative_delta(F.col("shop_monthly_revenue").cast("double"), "shop_avg_revenue").alias("delta_revenue"))
    )
    lagged = calendar_lags(join_small(panel, settle(delta), [MONTH, SHOP]), ["delta_revenue"], [1]).drop("delta_revenue")
    return lagged.fillna(0, subset=["delta_revenue_lag_1"]) if fill else lagged
