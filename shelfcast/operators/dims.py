"""Shop, category and item attributes, per recipe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.config import (
    CATEGORY_NAME_PATCHES,
    CITY_PATCHES,
    CONSOLES,
    DIGITAL_MARKER,
    SHOP_NAME_PATCHES,
    SUPERCATEGORY_CODES,
    Variant,
)
from shelfcast.functions import text
from shelfcast.operators.cleaning import drop_keys, patch_values
from shelfcast.operators.encode import dict_code, factorise, label_encode, rare_bucket, rare_bucket_cross
from shelfcast.operators.layout import fits_broadcast
from shelfcast.session import settle


def _words(table: DataFrame) -> tuple[DataFrame, bool]:
    """A dimension's words, written once, and whether they are small: then so are all their distinct values."""
    table = settle(table)
    return table, fits_broadcast(table)


def shop_attributes(shops: DataFrame, more_than: int = 4) -> DataFrame:
    """shop_id, shop_type_code, city_code from the words of the shop name."""
    named = patch_values(shops, "shop_name", SHOP_NAME_PATCHES, "shop_name")
    words = named.select("shop_id", text.token("shop_name", 1).alias("city"), text.token("shop_name", 2).alias("kind"))
    words, small = _words(patch_values(words, "city", CITY_PATCHES, "city"))
    coded = label_encode(rare_bucket(words, "kind", more_than, small=small), "kind", "shop_type_code", small)
    return label_encode(coded, "city", "city_code", small).select("shop_id", "shop_type_code", "city_code")


def category_attributes(categories: DataFrame, more_than: int = 4) -> DataFrame:
    """item_category_id, category_subtype_code, category_type_code from the category name."""
    words, small = _words(
        categories.select(
            "item_category_id",
            text.token("item_category_name", 1).alias("kind"),
            text.subtype("item_category_name").alias("sub"),
        )
    )
    coded = label_encode(rare_bucket(words, "kind", more_than, small=small), "kind", "category_type_code", small)
    return label_encode(coded, "sub", "category_subtype_code", small).select(
        "item_category_id", "category_subtype_code", "category_type_code"
    )


def item_name_parts(items: DataFrame, fewer_than: int = 40) -> tuple[DataFrame, bool]:
    """item_id, item_category_id, name2, name3 as text with rare types folded, and whether the table is small."""
    parts, small = _words(
        items.select(
            "item_id",
            "item_category_id",
            text.bracket_part("item_name").alias("name2"),
            text.parenthesis_part("item_name").alias("name3"),
        )
    )
    typed = parts.withColumn("type", text.item_type("name2"))
    return rare_bucket_cross(typed, "type", "name2", fewer_than, small=small).drop("type"), small


def item_attributes(items: DataFrame, fewer_than: int = 40) -> DataFrame:
    """item_id, item_category_id and label codes of the two name parts."""
    parts, small = item_name_parts(items, fewer_than)
    coded = label_encode(label_encode(parts, "name2", "c2", small), "name3", "c3", small)
    return coded.select("item_id", "item_category_id", F.col("c2").alias("name2"), F.col("c3").alias("name3"))


def long_shop_attributes(shops: DataFrame, variant: Variant) -> DataFrame:
    """shop_id, city_id: cities numbered by first appearance; merged ids go before, dropped shops after."""
    named = drop_keys(shops, "shop_id", variant.shop_remap.keys())
    cities, small = _words(named.select("shop_id", text.first_word("shop_name").alias("city")))
    coded = factorise(cities, "city", "shop_id", "city_id", small)
    return drop_keys(coded, "shop_id", variant.drop_shops).select("shop_id", "city_id")


def long_category_attributes(
    categories: DataFrame,
    variant: Variant,
    patches: Mapping[int, str] = CATEGORY_NAME_PATCHES,
    consoles: Sequence[str] = CONSOLES,
    groups: Mapping[str, int] = SUPERCATEGORY_CODES,
    marker: str = DIGITAL_MARKER,
) -> DataFrame:
    """item_category_id with digital flag, group code and console code."""
    named = patch_values(categories, "item_category_id", patches, "item_category_name")
    named = drop_keys(named, "item_category_id", variant.drop_categories)
    words = named.select(
        "item_category_id",
        text.contains_flag("item_category_name", marker).alias("item_category_is_digital"),
        text.greedy_prefix("item_category_name").alias("group"),
        text.multi_match("item_category_name", consoles).alias("console"),
    )
    coded = dict_code(words, "group", groups, "item_supercategory_id")
    numbers = {name: i for i, name in enumerate([*consoles, "None"])}
    return dict_code(coded, "console", numbers, "item_category_console_id").drop("group", "console")
