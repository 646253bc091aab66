"""Binds the generic star-schema tables to the sales model: nation is the shop, part the item, brand the category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.config import EARLY_CLIP, LATE_CLIP, LONG_LAG, SEGMENTED, Variant

FIRST_YEAR = 1995
TARGET_MONTH = 83
# Duplicate shops of this data, and what the long-lag recipe leaves out.
SHOP_REMAP = {0: 20, 1: 21, 11: 10}
DROP_SHOPS = (9, 20)
DROP_CATEGORIES = (8, 18)
DROP_SHOP_MONTH = (14, 18)
NOUNS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
GROUP_CODES = {"ECONOMY": 0, "LARGE": 1, "MEDIUM": 2, "PROMO": 3, "SMALL": 4}
DIGITAL_MARKER = "small"
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def bind(variant: Variant) -> Variant:
    """A recipe with the ids of this data in place of the defaults."""
    return variant.but(
        target_month=TARGET_MONTH,
        shop_remap=dict(SHOP_REMAP),
        drop_shops=DROP_SHOPS if variant.drop_shops else (),
        drop_categories=DROP_CATEGORIES if variant.drop_categories else (),
        drop_shop_month=DROP_SHOP_MONTH if variant.drop_shop_month else None,
    )


LATE = bind(LATE_CLIP)
EARLY = bind(EARLY_CLIP)
LONG = bind(LONG_LAG)
SEGMENT = bind(SEGMENTED)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales fact: date, month_id, shop_id, item_id, item_price, item_quantity (negative = return)."""
    ship = F.col("l_shipdate")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.to_date(ship).alias("date"),
            ((F.year(ship) - FIRST_YEAR) * 12 + F.month(ship) - 1).alias("month_id"),
            F.col("s_nationkey").alias("shop_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("item_price"),
            F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("item_quantity"),
        )
    )


def raw_sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fact under the names and text date of a raw sales file."""
    return sales_view(spark, sf_dir).select(
        F.date_format("date", "dd.MM.yyyy").alias("date"),
        F.col("month_id").alias("date_block_num"),
        "shop_id",
        "item_id",
        "item_price",
        F.col("item_quantity").alias("item_cnt_day"),
    )


def shops_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """shop_id, shop_name: region name as city word, then the nation name."""
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("shop_id"), F.concat_ws(" ", "r_name", "n_name").alias("shop_name"))
    )


def items_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, item_name ('noun [TYPE] (brand)', the bracket only for large sizes), item_category_id."""
    bracket = F.when(F.col("p_size") > 10, F.concat(F.lit(" ["), "p_type", F.lit("]"))).otherwise(F.lit(""))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.concat("p_name", bracket, F.lit(" ("), "p_brand", F.lit(")")).alias("item_name"),
        F.substring("p_brand", 7, 10).cast("int").alias("item_category_id"),
    )


def categories_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_category_id, item_category_name ('TYPE - noun' of the brand's first part)."""
    first = table(spark, sf_dir, "part").groupBy(F.substring("p_brand", 7, 10).cast("int").alias("item_category_id"))
    return first.agg(
        F.concat(F.min_by("p_type", "p_partkey"), F.lit(" - "), F.min_by("p_name", "p_partkey")).alias("item_category_name")
    )


def translations_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translated shop names, known for the nations of the first three regions only."""
    return (
        table(spark, sf_dir, "nation")
        .filter(F.col("n_regionkey") < 3)
        .select(F.col("n_nationkey").alias("shop_id"), F.lower("n_name").alias("shop_name_en"))
    )


def test_keys_view(spark: SparkSession, sf_dir: str, variant: Variant = LATE) -> DataFrame:
    """Pairs to predict: every (customer nation, part) that was ever ordered. ID, shop_id, item_id."""
    from shelfcast.operators.cleaning import drop_keys, remap_keys

    pairs = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_nationkey").alias("shop_id"), F.col("l_partkey").alias("item_id"))
    )
    pairs = remap_keys(pairs, "shop_id", variant.shop_remap).distinct()
    pairs = drop_keys(pairs, "shop_id", variant.drop_shops)
    if variant.drop_categories:
        dropped = items_view(spark, sf_dir).filter(F.col("item_category_id").isin(*variant.drop_categories))
        pairs = drop_keys(pairs, "item_id", dropped.select("item_id"))
    return pairs.select((F.col("shop_id").cast("long") * 1_000_000_000 + F.col("item_id")).alias("ID"), "shop_id", "item_id")
