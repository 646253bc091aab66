"""Month sets and factored means against the same operators on the dense rows."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.config import ITEM, KEYS, MONTH, SHOP
from shelfcast.operators import encodings, grid, lags, panel, recency, trends
from shelfcast.session import settle

SALES = "month_id INT, shop_id INT, item_id INT, item_price DOUBLE, item_quantity DOUBLE"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def made(spark, seed=1, first=3, months=70):
    rng = random.Random(seed)
    daily = [
        (first + int(rng.random() ** 2 * months), rng.randrange(5), rng.randrange(8), float(rng.randrange(4)), float(rng.randrange(-1, 4)))
        for _ in range(160)
    ]
    sales = spark.createDataFrame(daily, SALES)
    monthly = settle(panel.monthly_sales(sales))
    asked = spark.createDataFrame([(s, i) for s in range(6) for i in (0, 3, 7, 9)], "shop_id INT, item_id INT")
    dense = settle(panel.union_test_keys(panel.dense_panel(monthly), asked, first + months))
    return sales, monthly, dense


def dims(spark):
    shops = spark.createDataFrame([(s, s % 2 if s != 4 else None) for s in range(6)], "shop_id INT, city INT")
    items = spark.createDataFrame([(i, "ab"[i % 2] if i != 7 else None) for i in range(9)], "item_id INT, kind STRING")
    return shops, items


def test_sets_hold_first_last_and_presence_over_several_words(spark):
    sales, monthly, _ = made(spark, months=200)
    span = grid.month_span(monthly)
    assert span[1] == 4
    sold = {}
    for m, i in rows(monthly, MONTH, ITEM):
        sold.setdefault(i, set()).add(m)
    ask = monthly.select(ITEM).distinct().withColumn(MONTH, F.explode(F.sequence(F.lit(0), F.lit(210))))
    sets = grid.month_sets(monthly, [ITEM], span, "_m")
    words = grid.words_of("_m", span)
    got = ask.join(sets, ITEM).select(
        MONTH, ITEM, grid.has_month(words, F.col(MONTH), span).alias("has"), grid.first_of(words, span).alias("first"),
        grid.last_before(words, F.col(MONTH), span).alias("last"),
    )
    for m, i, has, first, last in rows(got, MONTH, ITEM, "has", "first", "last"):
        assert (has, first, last) == (m in sold[i], min(sold[i]), max((x for x in sold[i] if x < m), default=None))


def test_recency_equals_the_dense_passes(spark):
    _, monthly, dense = made(spark)
    months = grid.ActiveMonths(monthly)
    both = recency.since_first(recency.since_first(dense, [SHOP, ITEM], "pair"), [ITEM], "item")
    assert rows(recency.first_seen(dense, months, "pair", "item"), *KEYS, "pair", "item") == rows(both, *KEYS, "pair", "item")
    by_item = recency.first_month(dense, [ITEM], "f")
    code = recency.seniority_code(F.col(MONTH), F.col("f"), F.col("p"))
    firsts = dense.join(by_item, ITEM).join(recency.first_month(monthly, [SHOP, ITEM], "p"), [SHOP, ITEM], "left")
    want = firsts.withColumn("item_seniority", code)
    assert rows(recency.seniority(dense, monthly), *KEYS, "item_seniority") == rows(want, *KEYS, "item_seniority")
    for keys in ([SHOP, ITEM], [ITEM], [SHOP]):
        sold = {}
        for *k, m in rows(monthly, *keys, MONTH):
            sold.setdefault(tuple(k), set()).add(m)
        for m, last, *k in rows(recency.last_sale(dense, monthly, keys, "last"), MONTH, "last", *keys):
            assert last == max((x for x in sold.get(tuple(k), ()) if x < m), default=None)


def test_trends_equal_the_sorted_ones(spark):
    sales, monthly, dense = made(spark)
    months = grid.ActiveMonths(monthly)
    names = [f"delta_price_lag_{k}" for k in (1, 2, 5)]
    for as_of in (None, 20):
        got = trends.grid_price_deltas(dense, sales, months, [1, 2, 5], as_of)
        assert rows(got, *KEYS, *names) == rows(trends.price_deltas(dense, sales, [1, 2, 5], as_of), *KEYS, *names)
        got = trends.grid_price_trend(dense, sales, months, [1, 2], as_of)
        assert rows(got, *KEYS, "delta_price_lag") == rows(trends.price_trend(dense, sales, [1, 2], as_of), *KEYS, "delta_price_lag")
        for fill in (True, False):
            got = trends.grid_revenue_trend(dense, sales, months, fill, as_of)
            want = trends.revenue_trend(dense, sales, fill, as_of)
            assert rows(got, *KEYS, "delta_revenue_lag_1") == rows(want, *KEYS, "delta_revenue_lag_1")
    assert set(got.columns) == set(want.columns)


def test_running_means_equal_as_of(spark):
    sales, _, _ = made(spark)
    price = {(m, i): v for m, i, v in rows(trends.running_price_means(sales), MONTH, ITEM, "item_avg_item_price")}
    revenue = {(m, s): v for m, s, v in rows(trends.running_shop_revenue(sales), MONTH, SHOP, "shop_avg_revenue")}
    for at in (5, 12, 40):
        for i, v in rows(trends.price_means(sales, [ITEM], "v", as_of=at), ITEM, "v"):
            assert price[max(m for m, j in price if j == i and m <= at), i] == pytest.approx(v)
        for s, v in rows(trends.shop_avg_revenue(trends.shop_revenue(sales), as_of=at), SHOP, "shop_avg_revenue"):
            assert revenue[max(m for m, t in revenue if t == s and m <= at), s] == pytest.approx(v)


@pytest.mark.parametrize("keys", [[], [ITEM], [SHOP], ["city"], ["kind"], [SHOP, "kind"], [ITEM, "city"], ["city", "kind"], [SHOP, ITEM]])
def test_group_means_equal_means_of_the_rows(spark, keys):
    _, monthly, dense = made(spark, 2, months=12)
    shops, items = dims(spark)
    keyed = dense.join(shops, SHOP, "left").join(items, ITEM, "left")
    want = rows(encodings.lagged_encoding(keyed, keys, [1, 3], "v"), *KEYS, "v_lag_1", "v_lag_3")
    got = grid.lagged_means(keyed, grid.ActiveMonths(monthly), keys, [1, 3], "v", shops, items)
    assert rows(got, *KEYS, "v_lag_1", "v_lag_3") == want
    if set(keys) != {SHOP, ITEM}:
        known = keyed.filter(F.col(MONTH) < 15)
        assert rows(grid.group_means(monthly, keys, "v", shops, items, empty=True), MONTH, *keys, "v") == rows(
            encodings.mean_encode(known, keys, "v"), MONTH, *keys, "v"
        )


def test_dense_panel_is_not_sorted(spark):
    sales, monthly, _ = made(spark)
    rows_ = panel.dense_panel(monthly)
    months = grid.ActiveMonths(monthly)
    for df in (
        recency.last_sale(rows_, monthly, [SHOP, ITEM], "l"), recency.first_seen(rows_, months, "p", "i"),
        trends.grid_price_trend(rows_, sales, months, [1, 2]), grid.lagged_means(rows_, months, [ITEM], [1], "v"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "SortMergeJoin" not in plan and "Sort [" not in plan


def test_an_empty_grid(spark):
    monthly = settle(spark.createDataFrame([], "month_id INT, shop_id INT, item_id INT, item_quantity DOUBLE"))
    asked = spark.createDataFrame([(4, 1, 1, 0.0)], "month_id INT, shop_id INT, item_id INT, item_quantity DOUBLE")
    got = recency.first_seen(asked, grid.ActiveMonths(monthly), "p", "i")
    assert rows(got, "p", "i") == [(0, 0)]
    assert rows(recency.last_sale(asked, monthly, [ITEM], "l"), "l") == [(None,)]
    assert rows(grid.lagged_means(asked, grid.ActiveMonths(monthly), [SHOP], [1], "v"), "v_lag_1") == [(None,)]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 130), st.integers(0, 2)), min_size=1, max_size=12))
def test_lag_table_holds_every_shift(spark, cells):
    cells = sorted(set(cells))
    table = spark.createDataFrame([(m, i, float(m)) for m, i in cells], "month_id INT, item_id INT, v DOUBLE")
    got = {(m, i): (a, b) for m, i, a, b in rows(grid.lag_table(table, [ITEM], ["v"], [1, 6]), MONTH, ITEM, "v_lag_1", "v_lag_6")}
    for m, i in {(m + k, i) for m, i in cells for k in (1, 6)}:
        assert got.pop((m, i)) == tuple(float(m - k) if (m - k, i) in cells else None for k in (1, 6))
    assert not got and lags
