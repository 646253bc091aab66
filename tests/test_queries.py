"""Every registered query that SQL can express, against its SQL, on the smallest data."""

from __future__ import annotations

import os

import pytest
from compare import compare

from shelfcast.operators import boosting, trees
from shelfcast.plans import catalog
from shelfcast.plans.catalog import QUERIES
from shelfcast.plans.oracle import ORACLES

import __spark_entry__ as entry

WHOLE_TABLES = {n for n in QUERIES if n.startswith("features_")}  # row by row in test_features
# One member per family keeps the default run short; SHELFCAST_ALL_QUERIES=1 runs every query.
FAMILIES = ("mean_encode_", "lagged_mean_")
SHOWN = ("mean_encode_shop_subtype", "lagged_mean_city", "lagged_mean_item_city", "lagged_mean_shop_supercategory")


def chosen() -> list[str]:
    names = [n for n in QUERIES if n in ORACLES and n not in WHOLE_TABLES]
    if os.environ.get("SHELFCAST_ALL_QUERIES"):
        return names
    return [n for n in names if not n.startswith(FAMILIES) or n in SHOWN]


@pytest.mark.parametrize("name", chosen())
def test_query_equals_sql(spark, sf_dir, name):
    ok, note = compare(spark, sf_dir, name, QUERIES, ORACLES)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert {n for n in QUERIES if n not in ORACLES} == {
        "tune_lambda", "linear_forecast", "gbt_forecast", "gbt_segments", "param_search",
    }


def test_entry_lists_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:4] == ["month_id", "shop_id", "item_id", "item_quantity"]


@pytest.mark.parametrize("name", ["tune_lambda", "linear_forecast", "gbt_forecast"])
def test_models_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_tree_queries_use_the_real_parameters(spark, sf_dir, monkeypatch):
    given, averaged = [], []

    def fit(self, models, ended, instead=False):
        given.extend((m.params, m.segment) for _, m in models)
        predictions = spark.createDataFrame([(1, 1, 1.0)], "shop_id long, item_id long, item_quantity double")
        for i, _ in models:
            ended(i, boosting.Fit(1, float(i), [1.0]), predictions)

    best = trees.Ledger.best
    monkeypatch.setattr(catalog, "tree_table", lambda *_: spark.createDataFrame([(1,)], "shop_id int"))
    monkeypatch.setattr(catalog, "tree_inputs", lambda *_: boosting.Packed(spark.range(1), 1, 1, {}, 1))
    monkeypatch.setattr(boosting.Boosting, "fit", fit)
    monkeypatch.setattr(trees.Ledger, "best", lambda self, k: averaged.append(k) or best(self, k))
    found, drawn = entry.queries(), trees.draw_params()
    found["gbt_forecast"](spark, sf_dir)
    found["gbt_segments"](spark, sf_dir)
    assert given == [(trees.TreeParams(), None), *[(p, i) for i, p in enumerate(trees.SEGMENT_PARAMS)]]
    assert all(p.rounds == 1000 for p, _ in given)
    given.clear()
    assert found["param_search"](spark, sf_dir).count() == len(drawn) == 100 and given == [(p, None) for p in drawn]
    found["search_and_fit"](spark, sf_dir)
    found["ensemble_trials"](spark, sf_dir)
    assert len(given) == 100 and averaged == [1, 10]  # the ledger of the search is found again
