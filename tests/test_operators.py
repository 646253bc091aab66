"""Operators on small literal tables, and their large-data routes against the small ones."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import cleaning, encode, encodings, lags, layout, linear, panel, recency, splits, summary, trees
from shelfcast.operators import trends

SALES = "month_id INT, shop_id INT, item_id BIGINT, item_price DOUBLE, item_quantity DOUBLE"
PANEL = "month_id INT, shop_id INT, item_id BIGINT, item_quantity DOUBLE"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_null_rows_survive_delete_above_but_not_keep_positive(spark):
    df = spark.createDataFrame([(1.0,), (None,), (200000.0,), (0.0,), (-1.0,)], "p DOUBLE")
    assert rows(cleaning.drop_above(df, "p", 100000), "p") == [(-1.0,), (0.0,), (1.0,), (None,)]
    assert rows(cleaning.drop_below(df, "p", 0), "p") == [(0.0,), (1.0,), (200000.0,), (None,)]
    assert rows(cleaning.keep_positive(df, "p"), "p") == [(1.0,), (200000.0,)]


def test_returns_policies(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (3.0,), (None,)], "item_quantity DOUBLE")
    assert rows(cleaning.returns_to_zero(df), "item_quantity") == [(0.0,), (0.0,), (3.0,), (None,)]
    assert rows(cleaning.returns_drop(df), "item_quantity") == [(0.0,), (3.0,), (None,)]


def test_remap_keys_by_mapping_and_by_table(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 11, 40, 7)], "shop_id INT")
    want = [(7,), (10,), (39,), (57,), (58,)]
    assert rows(cleaning.remap_keys(df, "shop_id", {0: 57, 1: 58, 11: 10, 40: 39}), "shop_id") == want
    table = spark.createDataFrame([(0, 57), (1, 58), (11, 10), (40, 39)], "old INT, new INT")
    assert rows(cleaning.remap_keys(df, "shop_id", table), "shop_id") == want


def test_drop_keys_keeps_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    assert rows(cleaning.drop_keys(df, "k", [1]), "k") == [(2,), (None,)]
    gone = spark.createDataFrame([(1,)], "k INT")
    assert rows(cleaning.drop_keys(df, "k", gone), "k") == [(2,), (None,)]


def test_drop_where_keeps_unknown(spark):
    df = spark.createDataFrame([(34, 18), (34, None), (1, 18)], "s INT, m INT")
    assert rows(cleaning.drop_where(df, (F.col("s") == 34) & (F.col("m") == 18)), "s", "m") == [(1, 18), (34, None)]


def test_drop_argmin_removes_one_row_even_among_copies(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (1.0, "b"), (2.0, "a"), (None, "c")], "p DOUBLE, k STRING")
    assert rows(cleaning.drop_argmin(df.repartition(3), "p"), "p", "k") == [(1.0, "a"), (1.0, "b"), (2.0, "a"), (None, "c")]


def test_consolidate_leaves_out_missing_keys(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0), (None, 4.0)], "k INT, item_quantity DOUBLE")
    assert rows(cleaning.consolidate(df), "k", "item_quantity") == [(1, 5.0)]


def test_narrow_schema_fits_the_values(spark):
    df = spark.createDataFrame([(1, 40000, 2**40, 0.5, 0.1), (-128, 5, 0, 1.5, 0.2)], "a INT, b INT, c BIGINT, d DOUBLE, e DOUBLE")
    narrow = cleaning.narrow_schema(df)
    assert [f.dataType.simpleString() for f in narrow.schema] == ["tinyint", "int", "bigint", "float", "double"]
    assert rows(narrow, "a", "b", "c") == rows(df, "a", "b", "c")


def test_fill_lags_only_touches_named_lags(spark):
    df = spark.createDataFrame([(None, None, None)], "item_quantity_lag_1 DOUBLE, price_lag_1 DOUBLE, item_quantity DOUBLE")
    assert tuple(cleaning.fill_lags(df).first()) == (0.0, None, None)


def test_gap_gives_null_lag(spark):
    p = spark.createDataFrame([(0, 1, 1, 5.0), (2, 1, 1, 7.0), (3, 1, 1, 9.0)], PANEL)
    for made in (lags.calendar_lags(p, ["item_quantity"], [1, 2]), lags.calendar_lags_by_join(p, ["item_quantity"], [1, 2])):
        got = rows(made, "month_id", "item_quantity_lag_1", "item_quantity_lag_2")
        assert got == [(0, None, None), (2, None, 5.0), (3, 7.0, None)]


def test_lagged_encoding_needs_the_pairs_own_row(spark):
    p = spark.createDataFrame([(0, 1, 1, 4.0), (1, 1, 1, 0.0), (1, 1, 2, 6.0)], PANEL)
    got = rows(encodings.lagged_encoding(p, ["shop_id"], [1], "m"), "month_id", "item_id", "m_lag_1")
    assert got == [(0, 1, None), (1, 1, 4.0), (1, 2, None)]


def test_grid_size_is_the_product_per_month(spark):
    sales = spark.createDataFrame(
        [(0, 1, 10, 1.0, 1.0), (0, 2, 11, 1.0, 1.0), (0, 2, 12, 1.0, 1.0), (1, 1, 10, 1.0, 2.0)], SALES
    )
    grid = panel.active_grid(sales)
    assert grid.count() == 2 * 3 + 1
    filled = panel.dense_panel(panel.monthly_sales(sales))
    assert filled.agg(F.sum("item_quantity")).first()[0] == 5.0
    assert filled.filter("item_quantity IS NULL").count() == 0


def test_expand_without_broadcast_gives_the_same_rows(spark):
    many = spark.createDataFrame([(m, i) for m in range(3) for i in range(40)], "month_id INT, item_id INT")
    few = spark.createDataFrame([(m, s) for m in range(3) for s in range(m + 1)], "month_id INT, shop_id INT")
    cols = ("month_id", "item_id", "shop_id")
    direct = rows(layout.expand(many, few, "month_id", ["item_id"]), *cols)
    salted = rows(layout.expand(many, few, "month_id", ["item_id"], max_bytes=0), *cols)
    assert direct == salted and len(direct) == 40 * 6


def test_number_rows_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"))
    got = layout.number_rows(df, ["k"]).collect()
    assert [r["ID"] for r in sorted(got, key=lambda r: r["k"])] == list(range(1000))


@pytest.mark.parametrize("small", [True, False, None])
def test_codes(spark, small):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, None), (4, "ё"), (5, "z")], "pos INT, v STRING")
    labels = encode.label_encode(df, "v", "code", small)
    assert rows(labels, "pos", "code") == [(0, 1), (1, 0), (2, 1), (3, None), (4, 3), (5, 2)]
    first = encode.factorise(df, "v", "pos", "code", small)
    assert rows(first, "pos", "code") == [(0, 0), (1, 1), (2, 0), (3, -1), (4, 2), (5, 3)]


def test_rare_buckets(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4, "v STRING")
    assert encode.rare_bucket(df, "v", 4).groupBy("v").count().orderBy("v").collect() == [("a", 5), ("etc", 4)]
    cross = spark.createDataFrame([("ps3", "ps3"), ("xbox360", "xbox 360")], "t STRING, n STRING")
    assert rows(encode.rare_bucket_cross(cross, "t", "n", 40), "t", "n") == [("ps3", "etc"), ("xbox360", "xbox 360")]


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "x DOUBLE, c DOUBLE")
    scaled = encode.min_max_scale(df, encode.fit_min_max(df, ["x", "c"]))
    assert rows(scaled, "x", "c") == [(0.0, 0.0), (0.5, 0.0), (1.0, 0.0)]
    other = spark.createDataFrame([(5.0, 6.0)], "x DOUBLE, c DOUBLE")
    assert rows(encode.min_max_scale(other, encode.fit_min_max(df, ["x"])), "x") == [(2.0,)]
    std = encode.standardise(df, encode.fit_standard(df, ["x", "c"])).agg(F.avg("x"), F.stddev_pop("x"), F.max("c")).first()
    assert std[0] == pytest.approx(0) and std[1] == pytest.approx(1) and std[2] == 0


def test_one_hot_covers_all_listed_columns(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "x STRING, y INT")
    wide = encode.one_hot(df, {"x": ["a", "b"], "y": [1]})
    assert rows(wide, "x", "x_a", "x_b", "y_1") == [("a", 1, 0, 1), ("b", 0, 1, 0)]


def test_one_hot_index_takes_any_number_of_values(spark):
    df = spark.range(1500).select(F.format_string("%05d", "id").alias("v"), "id")
    got = encode.one_hot_index(df, "v", "place")
    assert got.schema["place"].dataType.typeName() == "long" and got.where("place = id").count() == 1500


def test_last_sale_is_strictly_before_and_counts_zero_sums(spark):
    p = spark.createDataFrame([(m, 1, 1, 0.0) for m in range(4)] + [(3, 2, 1, 0.0)], PANEL)
    monthly = spark.createDataFrame([(1, 1, 1, 0.0), (2, 1, 1, 3.0)], PANEL)
    pair = recency.last_sale(p, monthly, ["shop_id", "item_id"], "last")
    assert rows(pair, "shop_id", "month_id", "last") == [(1, 0, None), (1, 1, None), (1, 2, 1), (1, 3, 2), (2, 3, None)]
    item = recency.last_sale(p, monthly, ["item_id"], "last")
    assert rows(item, "shop_id", "month_id", "last")[-1] == (2, 3, 2)


@pytest.mark.parametrize("keys", [["shop_id", "item_id"], ["item_id"]])
def test_last_sale_needs_no_sale_months_in_the_panel(spark, keys):
    asked = spark.createDataFrame([(9, 1, 1, 0.0), (9, 2, 1, 0.0), (5, 1, 1, 0.0)], PANEL)
    monthly = spark.createDataFrame([(1, 1, 1, 2.0), (6, 1, 1, 3.0), (9, 1, 1, 4.0)], PANEL)
    other = None if len(keys) == 2 else 6
    got = recency.last_sale(asked, monthly, keys, "last")
    assert got.columns == [*asked.columns, "last"] or set(got.columns) == {*asked.columns, "last"}
    assert rows(got, "shop_id", "month_id", "last") == [(1, 5, 1), (1, 9, 6), (2, 9, other)]


def test_collinear_columns_have_a_solution(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 6.0), (3.0, 6.0, 9.0)], "a DOUBLE, b DOUBLE, y DOUBLE")
    weights = linear.ols(df, ["a", "b"], "y")
    assert weights[0] + 2 * weights[1] == pytest.approx(3)


def test_seniority_has_all_three_classes(spark):
    p = spark.createDataFrame([(0, 1, 1, 2.0), (0, 2, 1, 0.0), (1, 1, 1, 0.0), (1, 2, 1, 0.0)], PANEL)
    monthly = spark.createDataFrame([(0, 1, 1, 2.0)], PANEL)
    got = rows(recency.seniority(p, monthly), "month_id", "shop_id", "item_seniority")
    assert got == [(0, 1, 0), (0, 2, 0), (1, 1, 2), (1, 2, 1)]
    since = rows(recency.since_first_sale(p, monthly), "month_id", "shop_id", "months_since_first_sale_in_shop")
    assert since == [(0, 1, -1), (0, 2, -1), (1, 1, 1), (1, 2, -1)]


def test_since_first_counts_panel_rows(spark):
    p = spark.createDataFrame([(2, 1, 1, 0.0), (5, 1, 1, 0.0), (1, 2, 1, 0.0)], PANEL)
    both = recency.since_first(recency.since_first(p, ["shop_id", "item_id"], "pair"), ["item_id"], "item")
    assert rows(both, "month_id", "pair", "item") == [(1, 0, 0), (2, 0, 1), (5, 3, 4)]


def test_zero_mean_price_gives_null_delta(spark):
    sales = spark.createDataFrame([(0, 1, 1, 0.0, 1.0), (1, 1, 1, 0.0, 1.0)], SALES)
    p = spark.createDataFrame([(0, 1, 1, 1.0), (1, 1, 1, 1.0)], PANEL)
    assert rows(trends.price_deltas(p, sales, [1]), "month_id", "delta_price_lag_1") == [(0, None), (1, None)]
    assert rows(trends.price_trend(p, sales, [1]), "delta_price_lag") == [(0.0,), (0.0,)]


def test_as_of_removes_the_look_ahead(spark):
    sales = spark.createDataFrame([(0, 1, 1, 2.0, 1.0), (1, 1, 1, 6.0, 1.0)], SALES)
    assert rows(trends.price_means(sales, ["item_id"], "p"), "p") == [(4.0,)]
    assert rows(trends.price_means(sales, ["item_id"], "p", as_of=0), "p") == [(2.0,)]


def test_revenue_trend_fill_option(spark):
    sales = spark.createDataFrame([(0, 1, 1, 2.0, 1.0), (1, 1, 1, 6.0, 1.0)], SALES)
    p = spark.createDataFrame([(0, 1, 1, 1.0), (1, 1, 1, 1.0)], PANEL)
    assert rows(trends.revenue_trend(p, sales), "month_id", "delta_revenue_lag_1") == [(0, 0.0), (1, -0.5)]
    assert rows(trends.revenue_trend(p, sales, fill=False), "month_id", "delta_revenue_lag_1") == [(0, None), (1, -0.5)]


def test_quantiles_match_numpy_with_a_hot_value(spark):
    data = [0.0] * 500 + [float(x) for x in np.random.default_rng(3).normal(5, 2, 301)]
    df = spark.createDataFrame([(x,) for x in data], "x DOUBLE")
    assert summary.exact_quantiles(df, "x") == pytest.approx(list(np.quantile(data, [0.25, 0.5, 0.75])))
    one = spark.createDataFrame([(4.0,)], "x DOUBLE")
    assert summary.exact_quantiles(one, "x") == [4.0, 4.0, 4.0]


def test_random_split_is_exact_disjoint_and_layout_free(spark):
    df = spark.range(1234).withColumn("y", F.col("id") * 2)
    a = splits.random_split(df.repartition(7), 0.2, ["id"])
    b = splits.random_split(df.coalesce(1), 0.2, ["id"])
    chosen = rows(a.filter("is_val"), "id")
    assert len(chosen) == int(0.2 * 1234) and chosen == rows(b.filter("is_val"), "id")
    assert chosen != rows(splits.random_split(df, 0.2, ["id"], seed=1).filter("is_val"), "id")
    rest = splits.remainder(df, a.filter("is_val"), ["id"])
    assert rest.count() == 1234 - len(chosen)


def test_top_k(spark):
    df = spark.createDataFrame([(g, v) for g in "ab" for v in range(5)], "g STRING, v INT")
    assert rows(summary.top_k(df, [F.desc("v")], 2, ["g"]), "g", "v") == [("a", 3), ("a", 4), ("b", 3), ("b", 4)]
    assert summary.top_k(df, [F.asc("v"), F.asc("g")], 1).collect() == [("a", 0)]


def test_sort_within_is_globally_ordered(spark):
    df = spark.range(500).select((F.col("id") * 31 % 503).alias("k"))
    assert [r[0] for r in summary.sort_within(df, ["k"], 4).collect()] == sorted(i * 31 % 503 for i in range(500))


def linear_data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 3.0] + rng.normal(size=200) * 0.1
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")
    return x, y, df


def test_least_squares_and_ridge_match_direct_solutions(spark):
    x, y, df = linear_data(spark)
    f = ["a", "b", "c"]
    assert linear.ols(df, f, "y") == pytest.approx(np.linalg.lstsq(x, y, rcond=None)[0])
    assert linear.ridge(df, f, "y", 5.0) == pytest.approx(np.linalg.solve(x.T @ x + 5 * np.eye(3), x.T @ y))
    w = linear.ols(df, f, "y")
    err = df.select(F.avg(F.pow(linear.predict(f, w) - F.col("y"), 2))).first()[0]
    assert linear.collect_gram(df, f, "y").mse(w) == pytest.approx(err)


def test_tuner_reports_validation_error(spark):
    x, y, df = linear_data(spark)
    tried = linear.tune_lambda(df, df, ["a", "b", "c"], "y", [0.0, 1.0, 100.0])
    assert min(tried, key=lambda t: t[1])[0] == 0.0 and [t[0] for t in tried] == [0.0, 1.0, 100.0]


def test_drawn_parameters_are_seeded_and_in_range():
    a, b = trees.draw_params(20, 1), trees.draw_params(20, 1)
    assert a == b and a != trees.draw_params(20, 2)
    assert all(5 <= p.depth <= 15 and 0.05 <= p.eta <= 0.3 and 0.8 <= p.subsample <= 1 for p in a)


def test_ensemble_and_submission(spark):
    test = spark.createDataFrame([(0, 1, 1), (1, 1, 2)], "ID INT, shop_id INT, item_id BIGINT")
    preds = spark.createDataFrame([(1, 2, 4.0)], "shop_id INT, item_id BIGINT, item_quantity DOUBLE")
    sub = panel.submission_join(test, preds)
    assert rows(sub, "ID", "item_cnt_month") == [(0, None), (1, 4.0)]
    a = spark.createDataFrame([(0, 1.0)], "ID INT, item_cnt_month DOUBLE")
    b = spark.createDataFrame([(0, 3.0)], "ID INT, item_cnt_month DOUBLE")
    assert rows(encodings.ensemble_mean([a, b]), "ID", "item_cnt_month") == [(0, 2.0)]
