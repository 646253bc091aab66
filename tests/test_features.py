"""Whole feature tables row by row against plain SQL over the dense panel."""

from __future__ import annotations

import re

import pytest
from compare import digest, oracle_frame

from pyspark.sql import functions as F

from shelfcast.config import KEYS, Encoding
from shelfcast.operators import grid
from shelfcast.plans import catalog, oracle
from shelfcast.plans.features import feature_table
from shelfcast.sources import binding as b


@pytest.mark.parametrize("variant", [b.LATE, b.EARLY, b.SEGMENT, b.LONG], ids=lambda v: v.name)
def test_rows_equal_the_dense_sql(spark, sf_dir, variant):
    table = catalog.features(spark, sf_dir, variant)
    assert len(table.columns) == len(set(table.columns))
    if variant is b.LONG:
        assert len(table.columns) == 32 + 1  # features and target
    # Above the product the dense rows flow through hash joins only: no sort, no window.
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan
    assert digest(table.toPandas()) == digest(oracle_frame(sf_dir, oracle.feature_rows_sql(variant)))


def test_product_beyond_the_broadcast_bound_gives_the_same_rows(spark, sf_dir):
    shops, items = catalog.shop_dim(spark, sf_dir), catalog.full_items(spark, sf_dir)
    keys = b.test_keys_view(spark, sf_dir, b.SEGMENT)
    spread = feature_table(b.sales_view(spark, sf_dir), shops, items, keys, b.SEGMENT, max_bytes=0)
    want = oracle_frame(sf_dir, oracle.feature_rows_sql(b.SEGMENT))
    assert digest(spread.toPandas()) == digest(want)


@pytest.mark.parametrize("variant", [b.SEGMENT, b.LONG], ids=lambda v: v.name)
def test_dense_rows_meet_no_join_by_pair(spark, sf_dir, variant):
    plan = catalog.features(spark, sf_dir, variant)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan
    assert not re.search(r"ShuffledHashJoin \[[^]]*shop_id[^]]*item_id", plan)
    assert not re.search(r"HashAggregate\(keys=\[shop_id#\d+, item_id#\d+L?\], functions=\[min", plan)  # a second product


def test_first_month_of_every_bit_without_a_checked_negation(spark):
    sets = spark.range(grid.WORD).select("id", F.expr("shiftleft(5L, cast(id AS int)) & ((1L << 62) - 1)").alias("_x"))
    first = grid.first_of([F.lit(0).cast("bigint"), F.col("_x")], (7, 2))
    found = sets.select("id", first.alias("m"))
    assert all(r.m == 7 + grid.WORD + r.id for r in found.collect())
    assert spark.range(1).select(grid.first_of([F.lit(0).cast("bigint")], (7, 1)).alias("m")).first().m is None
    assert "-_x" not in found._jdf.queryExecution().optimizedPlan().toString().replace("#", "").replace("- _x", "-_x")


def test_methods_beyond_what_the_jvm_compiles_run_by_operators(spark):
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def small(spark):
    """Month 82 and 83 hold what 84 is predicted from; ids may be missing, one pair is asked that never was on sale."""
    rows = [(80, 1, 1, 2.0), (81, 1, 2, 3.0), (82, 2, 1, 4.0), (82, 1, 2, 1.0), (82, None, 1, 9.0), (83, 2, None, 5.0), (83, 2, 2, 6.0)]
    sales = spark.createDataFrame([(*r[:3], 1.5, r[3]) for r in rows], "month_id INT, shop_id INT, item_id INT, item_price DOUBLE, item_quantity DOUBLE")
    shops = spark.createDataFrame([(1, 7), (2, None)], "shop_id INT, city_code INT")
    items = spark.createDataFrame([(1, 5), (2, None)], "item_id INT, kind INT")
    return sales, shops, items, spark.createDataFrame([(1, 1), (2, 2), (1, 3)], "shop_id INT, item_id INT")


@pytest.mark.parametrize("lags", [(1,), (1, 2)])
def test_pair_means_as_maps_equal_those_by_joins(spark, monkeypatch, lags):
    from shelfcast.plans import features

    variant = b.LATE.but(
        target_month=84, burn_in=79, target_lags=(1, 2), price_trend=False, revenue_trend=False, seniority=True,
        encodings=(Encoding("item_city", ("item_id", "city_code"), lags), Encoding("by_kind", ("kind",)), Encoding("mix", ("shop_id", "kind"))),
    )
    def table():
        rows = features.FactoredPanel(*small(spark), variant).build().collect()
        return sorted((r.asDict() for r in rows), key=lambda r: str([r[k] for k in KEYS]))

    made = table()
    monkeypatch.setattr(features.FactoredPanel, "_mapped", lambda self, encoding: False)
    assert made == table()
    by = {tuple(r[k] for k in KEYS): r for r in made}
    row = by[82, 1, 2]
    assert (row["item_quantity"], row["item_quantity_lag_1"], row["item_city_lag_1"], row["item_seniority"]) == (1.0, 3.0, 3.0, 2)
    assert (by[82, 1, 1]["item_shop_first_sale"], by[84, 2, 2]["item_shop_first_sale"]) == (2, 2)


def test_item_side_is_hashed_on_the_item_alone(spark, sf_dir):
    """F6 to F9: what the (month, item) rows meet is hashed on the item too, so no join or window shuffles them again."""
    from shelfcast.operators.cleaning import clean_sales
    from shelfcast.plans.features import FactoredPanel

    items = catalog.full_items(spark, sf_dir)
    sales = clean_sales(b.sales_view(spark, sf_dir), b.SEGMENT, items)
    keys = b.test_keys_view(spark, sf_dir, b.SEGMENT)
    side = FactoredPanel(sales, catalog.shop_dim(spark, sf_dir), items, keys, b.SEGMENT).item_side()
    plan = side._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(item_id#\d+L?, \d+\)", plan)
    assert not re.search(r"Exchange hashpartitioning\([^)]*month_id#\d+, item_id#", plan)


def test_dense_rows_are_made_where_the_side_is_read(spark, sf_dir):
    """F7, F8: the product moves no (month, item) row, and the shuffle files of the narrow sides are gone before it."""
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    plan = catalog.features(spark, sf_dir, b.LATE)._jdf.queryExecution().executedPlan().toString()
    dense = plan[: plan.index("REPARTITION_BY_NUM")] if "REPARTITION_BY_NUM" in plan else plan
    assert "Coalesce" in dense and plan.count("REPARTITION_BY_NUM") <= 1  # the keys to predict
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == kept


def test_shuffle_files_of_the_narrow_sides_are_dropped(spark, sf_dir, monkeypatch):
    from shelfcast.plans import features

    seen = []
    whole = features.settle_all
    monkeypatch.setattr(
        features, "settle_all",
        lambda *t: seen.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")) or whole(*t),
    )
    catalog.features(spark, sf_dir, b.LATE)
    assert len(seen) == 3 and set(seen) == {"true"}
