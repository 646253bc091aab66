"""CSV tables, durable stages and the forecast sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.config import MONTH

# Input schemas by table.
SCHEMAS: dict[str, str] = {
    "sales": "date STRING, date_block_num INT, shop_id INT, item_id INT, item_price DOUBLE, item_cnt_day DOUBLE",
    "items": "item_name STRING, item_id INT, item_category_id INT",
    "item_categories": "item_category_name STRING, item_category_id INT",
    "shops": "shop_name STRING, shop_id INT",
    "test": "ID INT, shop_id INT, item_id INT",
}


def read_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Header CSV with quoted commas and doubled quotes, under an explicit schema; NaN becomes NULL."""
    df = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats})


def write_stage(df: DataFrame, path: str, by_month: bool | None = None) -> None:
    """Persist a step's table as Parquet; panels are partitioned by month so that splits prune files.

    Rows of one month are spread over the tasks that hold them, so a large month is written by many tasks.
    """
    by_month = MONTH in df.columns if by_month is None else by_month
    writer = df.write.mode("overwrite")
    (writer.partitionBy(MONTH) if by_month else writer).parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_submission(df: DataFrame, path: str) -> None:
    """ID, item_cnt_month as header CSV, one file per task."""
    df.select("ID", "item_cnt_month").write.mode("overwrite").option("header", True).csv(path)
