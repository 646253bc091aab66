"""CSV dialect, stages and the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast import session
from shelfcast.sources import tables


def test_quotes_and_commas_survive_a_round_trip(spark, tmp_path):
    path = tmp_path / "shops.csv"
    path.write_text('shop_name,shop_id\n"!Якутск ТЦ ""Центральный"", фран",1\nПлощадь,2\n', encoding="utf-8")
    got = tables.read_table(spark, str(path), tables.SCHEMAS["shops"]).orderBy("shop_id").collect()
    assert [tuple(r) for r in got] == [('!Якутск ТЦ "Центральный", фран', 1), ("Площадь", 2)]


def test_nan_is_read_as_null(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("date,date_block_num,shop_id,item_id,item_price,item_cnt_day\n02.01.2013,0,1,2,NaN,1\n")
    row = tables.read_table(spark, str(path), tables.SCHEMAS["sales"]).first()
    assert row["item_price"] is None and row["item_cnt_day"] == 1.0


def test_month_stage_prunes_partitions(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 5).cast("int").alias("month_id"), "id")
    tables.write_stage(df, str(tmp_path / "panel"))
    back = tables.read_stage(spark, str(tmp_path / "panel"))
    assert back.filter("month_id = 3").count() == 20
    plan = back.filter("month_id = 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month_id" in plan


def test_submission_is_a_header_csv(spark, tmp_path):
    out = str(tmp_path / "sub")
    tables.write_submission(spark.createDataFrame([(0, 1.5, "x")], "ID INT, item_cnt_month DOUBLE, extra STRING"), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["ID", "item_cnt_month"] and back.first()["item_cnt_month"] == "1.5"


def test_settled_tables_end_with_their_scratch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "storage_root", lambda _: str(tmp_path))
    with session.scratch(spark):
        one, two = session.settle_all(spark.range(5), spark.range(7))
        assert (one.count(), two.count()) == (5, 7) and any(tmp_path.rglob("*.parquet"))
    assert not any(f.suffix == ".parquet" for f in tmp_path.rglob("*"))
    assert session.settle(spark.range(3)).count() == 3 and len(list(tmp_path.glob("settled-*"))) == 1
