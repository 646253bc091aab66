"""A whole run of a variant, from raw CSV files to one submission, that goes on after a lost driver.

Each stage is written once and then entered in a manifest with its schema, its number of rows and a checksum of their
content. A run over the same files with the same recipe starts after the last stage whose table still agrees with its
entry; a stage built anew makes all later ones new.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.config import KEYS, MONTH, Variant
from shelfcast.functions.numeric import parse_date
from shelfcast.operators import cleaning, dims, panel, splits, trees
from shelfcast.operators.boosting import pack
from shelfcast.plans.features import feature_table
from shelfcast.session import tune
from shelfcast.sources.tables import SCHEMAS, read_stage, read_table, write_stage, write_submission

_ENTRY = "told STRING, schema STRING, n_rows BIGINT, checksum STRING"
FILES = {"sales": "sales_train.csv", "items": "items.csv", "item_categories": "item_categories.csv", "shops": "shops.csv", "test": "test.csv"}


def content(table: DataFrame) -> tuple[int, str]:
    """Rows, and the sum of their hashes: independent of order and layout."""
    n, total = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)"))).first()
    return n, str(total or 0)


class Stages:
    """Written tables of one run in a folder, each with its entry in the manifest."""

    def __init__(self, spark: SparkSession, folder: str, told: str):
        """``told`` names what the run depends on: its files and its recipe."""
        self.spark, self.folder, self.told = spark, folder.rstrip("/"), told

    def _has(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def whole(self, name: str) -> DataFrame | None:
        """The stage's table if its entry belongs to this run and the table agrees with it."""
        entry, path = f"{self.folder}/manifest/{name}", f"{self.folder}/{name}"
        if not (self._has(entry) and self._has(path)):
            return None
        held = self.spark.read.schema(_ENTRY).json(entry).first()
        if held is None or held.told != self.told:
            return None
        table = self.spark.read.schema(T.StructType.fromJson(json.loads(held.schema))).parquet(path)
        return table if content(table) == (held.n_rows, held.checksum) else None

    def run(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table, made and entered unless it is whole; what follows depends on its content."""
        table = self.whole(name)
        if table is None:
            path = f"{self.folder}/{name}"
            write_stage(make(), path, by_month=False)
            table = read_stage(self.spark, path)
            entry = (self.told, table.schema.json(), *content(table))
            self.spark.createDataFrame([entry], _ENTRY).coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest/{name}")
        self.told = hashlib.sha256(repr((self.told, name, content(table))).encode()).hexdigest()
        return table


def files_told(spark: SparkSession, paths: list[str]) -> str:
    """Names, lengths and times of files, without their content."""
    found = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    return repr(sorted(tuple(r) for r in found.collect()))  # one row per input file


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """The raw daily fact under the library's names."""
    raw = read_table(spark, path, SCHEMAS["sales"])
    named = cleaning.conform(raw, {"date_block_num": MONTH, "item_cnt_day": "item_quantity"}, None)
    return named.select(parse_date("date").alias("date"), *KEYS, "item_price", "item_quantity")


def attribute_tables(shops: DataFrame, items: DataFrame, categories: DataFrame, variant: Variant) -> tuple[DataFrame, DataFrame]:
    """Shop and item tables with the attributes that the variant's recipe reads."""
    if variant.name == "long_lag":
        coded = dims.long_category_attributes(categories, variant)
        named = items.select("item_id", "item_category_id").join(coded, "item_category_id", "left")
        return dims.long_shop_attributes(shops, variant), named
    coded = dims.item_attributes(items).join(dims.category_attributes(categories), "item_category_id", "left")
    return dims.shop_attributes(shops), coded


def forecast(table: DataFrame, variant: Variant, params: trees.TreeParams | None = None) -> DataFrame:
    """Clipped predictions by (shop, item): one model, or one per seniority segment if the variant has them."""
    inputs = [c for c in table.columns if c not in ("item_quantity", "item_seniority")]
    parts = splits.time_split(table, variant.target_month - 1, variant.target_month)
    packed = pack(*parts, inputs, segment="item_seniority" if variant.seniority else None)
    if variant.seniority:
        return trees.fit_segments(packed, trees.SEGMENT_PARAMS if params is None else (params,) * 3, instead=True)
    return trees.fit_trees(packed, params or trees.TreeParams())[1]


def run_variant(
    spark: SparkSession, csv_folder: str, variant: Variant, work: str, out: str, params: trees.TreeParams | None = None
) -> DataFrame:
    """CSV files of a competition folder to the submission in ``out`` (ID, item_cnt_month); returns its rows.

    Stages in ``work``: sales, features, forecast, submission. A key to predict without a prediction gets 0. ``params``
    replace the trees' defaults.
    """
    tune(spark)
    paths = {name: f"{csv_folder.rstrip('/')}/{file}" for name, file in FILES.items()}
    stages = Stages(spark, work, hashlib.sha256(repr((files_told(spark, list(paths.values())), variant, params)).encode()).hexdigest())
    raw = {name: read_table(spark, path, SCHEMAS[name]) for name, path in paths.items() if name != "sales"}
    sales = stages.run("sales", lambda: read_sales(spark, paths["sales"]))

    def features() -> DataFrame:
        shops, items = attribute_tables(raw["shops"], raw["items"], raw["item_categories"], variant)
        test = cleaning.remap_keys(raw["test"], "shop_id", variant.shop_remap)
        return feature_table(sales, shops, items, test, variant)

    table = stages.run("features", features)
    found = stages.run("forecast", lambda: forecast(table, variant, params))
    asked = cleaning.remap_keys(raw["test"], "shop_id", variant.shop_remap)
    made = stages.run("submission", lambda: panel.submission_join(asked, found).fillna(0, subset=["item_cnt_month"]))
    write_submission(made, out)
    return made
