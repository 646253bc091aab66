"""From raw CSV files to a submission, and on from the last whole stage after a loss."""

from __future__ import annotations

import random

import pytest

from shelfcast.config import LATE_CLIP, SEGMENTED
from shelfcast.operators import trees
from shelfcast.plans import run

SMALL = trees.TreeParams(depth=3, min_child_weight=1, rounds=2, subsample=1.0, column_sample=1.0)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """A small competition folder: 12 months, 6 shops, 20 items, keys to predict for month 12."""
    at, rng = tmp_path_factory.mktemp("csv"), random.Random(3)
    (at / "shops.csv").write_text("shop_name,shop_id\n" + "".join(f'"Город{i % 3} ТЦ ""Ш{i}""",{i + 2}\n' for i in range(6)))
    (at / "item_categories.csv").write_text(
        "item_category_name,item_category_id\n" + "".join(f"Игры - PS{i},{i + 40}\n" for i in range(4))
    )
    (at / "items.csv").write_text(
        "item_name,item_id,item_category_id\n" + "".join(f"Name {i} (kind {i % 2}) [PC],{i},{40 + i % 4}\n" for i in range(20))
    )
    daily = [
        f"{rng.randrange(1, 28):02d}.{m + 1:02d}.2013,{m},{rng.randrange(2, 8)},{rng.randrange(20)},{rng.randrange(1, 9)}.5,{rng.randrange(-1, 4)}.0\n"
        for m in range(12) for _ in range(60)
    ]
    (at / "sales_train.csv").write_text("date,date_block_num,shop_id,item_id,item_price,item_cnt_day\n" + "".join(daily))
    keys = [(s, i) for s in range(2, 8) for i in range(0, 22, 2)]
    (at / "test.csv").write_text("ID,shop_id,item_id\n" + "".join(f"{n},{s},{i}\n" for n, (s, i) in enumerate(keys)))
    return at


def submitted(spark, path):
    return sorted((int(r.ID), float(r.item_cnt_month)) for r in spark.read.option("header", True).csv(str(path)).collect())


def test_a_lost_run_goes_on_to_the_same_submission(spark, folder, tmp_path, monkeypatch):
    variant = LATE_CLIP.but(target_month=12)
    run.run_variant(spark, str(folder), variant, str(tmp_path / "w1"), str(tmp_path / "s1"), SMALL)
    want = submitted(spark, tmp_path / "s1")
    assert [i for i, _ in want] == list(range(66)) and all(0 <= v <= 20 for _, v in want) and len({v for _, v in want}) > 1

    made = []
    for name in ("read_sales", "feature_table", "forecast"):
        whole = getattr(run, name)
        monkeypatch.setattr(run, name, lambda *a, f=whole, n=name, **k: made.append(n) or f(*a, **k))
    fit = trees.fit_trees
    monkeypatch.setattr(trees, "fit_trees", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    again = str(tmp_path / "w2"), str(tmp_path / "s2"), SMALL
    with pytest.raises(KeyboardInterrupt):
        run.run_variant(spark, str(folder), variant, *again)
    assert made == ["read_sales", "feature_table", "forecast"]
    made.clear()
    monkeypatch.setattr(trees, "fit_trees", fit)
    run.run_variant(spark, str(folder), variant, *again)
    assert made == ["forecast"] and submitted(spark, tmp_path / "s2") == want
    made.clear()
    run.run_variant(spark, str(folder), variant, *again)
    assert made == []

    # A damaged table, and another recipe, are made anew.
    spark.range(1).write.mode("overwrite").parquet(str(tmp_path / "w2" / "features"))
    run.run_variant(spark, str(folder), variant, *again)
    assert made[0] == "feature_table" and submitted(spark, tmp_path / "s2") == want
    made.clear()
    run.run_variant(spark, str(folder), variant.but(clip_range=(0, 1)), *again)
    assert made == ["read_sales", "feature_table", "forecast"] and max(v for _, v in submitted(spark, tmp_path / "s2")) <= 20


def test_a_segmented_run(spark, folder, tmp_path):
    made = run.run_variant(
        spark, str(folder), SEGMENTED.but(target_month=12), str(tmp_path / "w"), str(tmp_path / "s"), SMALL
    )
    assert made.count() == 66 and len(submitted(spark, tmp_path / "s")) == 66
