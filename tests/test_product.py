"""Panels made from two narrow sides against the operators on the dense rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfcast.config import ITEM, KEYS, MONTH, SHOP
from shelfcast.operators import grid, lags, panel, product, recency, trends
from shelfcast.plans.catalog import QUERIES
from shelfcast.session import settle

SALES = "month_id INT, shop_id INT, item_id INT, item_price DOUBLE, item_quantity DOUBLE"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.fixture(scope="module", params=[product.FLAT_KEYS, 2], ids=["one level", "two levels"])
def world(request, spark):
    """Sales with missing months, shops, items and quantities, their panel with keys to predict, and its product."""
    rng = random.Random(5)

    def some(value):
        return None if rng.random() < 0.06 else value

    daily = [
        (some(3 + rng.randrange(14)), some(rng.randrange(6)), some(rng.randrange(7)), some(float(rng.randrange(4))), some(float(rng.randrange(-1, 4))))
        for _ in range(150)
    ]
    sales = spark.createDataFrame(daily, SALES)
    monthly = settle(panel.monthly_sales(sales))
    keys = [(s, i) for s in (0, 1, 5, 8, None) for i in (0, 3, 6, 9, None)]
    asked = spark.createDataFrame(keys, "shop_id INT, item_id INT")
    dense = settle(panel.union_test_keys(panel.dense_panel(monthly), asked, 17))

    def made():
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(product, "FLAT_KEYS", request.param)
            return product.Product(monthly, asked, 17)

    assert made().levels == (1 if request.param > 6 else 3)
    return sales, monthly, dense, made


def test_calendar_lags(world):
    _, monthly, dense, made = world
    names = [*KEYS, "item_quantity", *[f"item_quantity_lag_{k}" for k in (1, 3)]]
    assert rows(made().calendar_lags([1, 3]).rows(), *names) == rows(lags.calendar_lags(dense, ["item_quantity"], [1, 3]), *names)
    got = product.Product(monthly).calendar_lags_by_join([1, 3]).rows()
    want = lags.calendar_lags_by_join(panel.dense_panel(monthly), ["item_quantity"], [1, 3])
    assert rows(got, *names) == rows(want, *names)


def test_trend_and_seniority(world):
    sales, monthly, dense, made = world
    months = grid.ActiveMonths(monthly)
    want = trends.grid_price_trend(dense, sales, months, [1, 2])
    assert rows(made().price_trend(sales, [1, 2]).rows(), *KEYS, "delta_price_lag") == rows(want, *KEYS, "delta_price_lag")
    want = recency.seniority(dense, monthly)
    assert rows(made().seniority().rows(), *KEYS, "item_seniority") == rows(want, *KEYS, "item_seniority")


@pytest.mark.parametrize("keys", [[], [ITEM], [SHOP], ["city"], ["kind"], [SHOP, "kind"], [ITEM, "city"], ["city", "kind"], [SHOP, ITEM]])
def test_lagged_means(spark, world, keys):
    _, monthly, dense, made = world
    # One shop and one item have no attribute, and one of each has two rows.
    shops = spark.createDataFrame([(s, s % 2 if s != 4 else None) for s in (*range(6), 5)], "shop_id INT, city INT")
    items = spark.createDataFrame([(i, "ab"[i % 2] if i != 6 else None) for i in (*range(7), 3)], "item_id INT, kind STRING")
    dims = (shops if "city" in keys else None, items if "kind" in keys else None)
    keyed = dense
    for dim, id_ in zip(dims, (SHOP, ITEM), strict=True):
        keyed = keyed.join(dim, id_, "left") if dim is not None else keyed
    want = grid.lagged_means(keyed, grid.ActiveMonths(monthly), keys, [1, 3], "v", *dims)
    got = made().lagged_means(keys, [1, 3], "v", *dims).rows()
    assert rows(got, *KEYS, "v_lag_1", "v_lag_3") == rows(want, *KEYS, "v_lag_1", "v_lag_3")


def test_months_to_predict_with_sales_keep_their_repeated_keys(spark):
    monthly = settle(spark.createDataFrame([(4, 1, 1, 2.0), (5, 1, 1, 3.0)], "month_id INT, shop_id INT, item_id INT, item_quantity DOUBLE"))
    made = product.Product(monthly, spark.createDataFrame([(1, 1)], "shop_id INT, item_id INT"), 5)
    assert made.last == 5
    assert rows(made.seniority().rows(), MONTH, "item_quantity", "item_seniority") == [(4, 2.0, 0), (5, 0.0, 2), (5, 3.0, 2)]


@pytest.mark.parametrize("name", ["lag_range", "lag_selfjoin", "burn_in", "mean_encode_shop_item", "item_seniority", "lagged_mean_item_city", "price_trend"])
def test_dense_rows_meet_no_sort_and_no_table_of_pairs(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan and "HashAggregate" not in plan
    assert plan.count("ShuffledHashJoin") <= 1  # only the keys to predict meet their items


def test_rows_without_units_make_no_maps_of_them(world):
    *_, made = world
    with_units, without = (made().seniority().rows(units) for units in (True, False))
    names = [c for c in with_units.columns if c != "item_quantity"]
    assert without.columns == names and rows(without, *names) == rows(with_units, *names)
    lean, settled = made().lagged_means([ITEM], [1], "mean"), []
    with pytest.MonkeyPatch.context() as patch:
        keep = product.settle_all
        patch.setattr(product, "settle_all", lambda *tables: settled.extend(tables) or keep(*tables))
        lean.rows(units=False)
    plans = [t._jdf.queryExecution().optimizedPlan().toString() for t in settled]
    assert plans and not any("collect_list" in p for p in plans)


def test_single_lag_is_a_shift(spark):
    table = spark.createDataFrame([(1, 4, 2.5), (2, 4, None), (None, 4, 1.0), (1, None, 3.0)], "month_id INT, item_id INT, v DOUBLE")
    got = grid.lag_table(table, [ITEM], ["v"], [2])
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got, MONTH, ITEM, "v_lag_2") == sorted([(3, 4, 2.5), (4, 4, None), (None, 4, 1.0), (3, None, 3.0)], key=str)
