"""Registered queries: every operator on the whole test tables. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.config import CONSOLES, ITEM, KEYS, MONTH, SHOP, SHOP_REMAP, Encoding, Variant
from shelfcast.functions import numeric, text
from shelfcast.operators import (
    cleaning,
    dims,
    encode,
    encodings,
    lags,
    linear,
    panel,
    recency,
    splits,
    summary,
    trees,
    trends,
)
from shelfcast.operators.boosting import Packed, pack
from shelfcast.operators.grid import ActiveMonths, group_means
from shelfcast.operators.layout import number_rows
from shelfcast.operators.product import Product
from shelfcast.plans.features import feature_table
from shelfcast.session import in_parallel, settle, settle_all, tune
from shelfcast.sources import binding as b

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        return fn

    return register


# -- shared inputs ---------------------------------------------------------------------------------------------


def clean(spark: SparkSession, d: str, variant: Variant = b.LATE) -> DataFrame:
    return cleaning.clean_sales(b.sales_view(spark, d), variant, b.items_view(spark, d))


def totals(spark: SparkSession, d: str) -> DataFrame:
    """Monthly units, written once: the only pass over the daily fact."""
    return settle(panel.monthly_sales(clean(spark, d)))


def dense(spark: SparkSession, d: str, monthly: DataFrame | None = None) -> DataFrame:
    return panel.dense_panel(totals(spark, d) if monthly is None else monthly)


def with_keys(spark: SparkSession, d: str, monthly: DataFrame | None = None) -> DataFrame:
    monthly = totals(spark, d) if monthly is None else monthly
    parts = panel.grid_partitions(monthly)
    rows = panel.dense_panel(monthly, parts)
    return panel.union_test_keys(rows, b.test_keys_view(spark, d), b.TARGET_MONTH, parts)


def product(spark: SparkSession, d: str, monthly: DataFrame | None = None) -> Product:
    """The panel of ``dense``, before its rows are made."""
    return Product(totals(spark, d) if monthly is None else monthly)


def product_with_keys(spark: SparkSession, d: str, monthly: DataFrame | None = None) -> Product:
    """The panel of ``with_keys``, before its rows are made."""
    known = (lambda: totals(spark, d)) if monthly is None else (lambda: monthly)
    monthly, asked = in_parallel(known, lambda: settle(b.test_keys_view(spark, d).select(SHOP, ITEM)))
    return Product(monthly, asked, b.TARGET_MONTH)


def overlaps(made: Product) -> bool:
    """Whether the month to predict has sales too, so that keys repeat and later rows would see them."""
    return made.last is not None and made.last >= b.TARGET_MONTH


def shop_dim(spark: SparkSession, d: str) -> DataFrame:
    return dims.shop_attributes(b.shops_view(spark, d))


def category_dim(spark: SparkSession, d: str) -> DataFrame:
    return dims.category_attributes(b.categories_view(spark, d))


def item_dim(spark: SparkSession, d: str) -> DataFrame:
    return dims.item_attributes(b.items_view(spark, d))


def long_category_dim(spark: SparkSession, d: str) -> DataFrame:
    return dims.long_category_attributes(
        b.categories_view(spark, d), b.LONG, {}, b.NOUNS, b.GROUP_CODES, b.DIGITAL_MARKER
    )


def full_items(spark: SparkSession, d: str) -> DataFrame:
    items, categories = in_parallel(lambda: item_dim(spark, d), lambda: category_dim(spark, d))
    return items.join(categories, "item_category_id", "left")


def long_items(spark: SparkSession, d: str) -> DataFrame:
    items = b.items_view(spark, d).select(ITEM, "item_category_id")
    return items.join(long_category_dim(spark, d), "item_category_id", "left")


def features(spark: SparkSession, d: str, variant: Variant) -> DataFrame:
    keys = b.test_keys_view(spark, d, variant)
    if variant.name == "long_lag":
        shops, items = dims.long_shop_attributes(b.shops_view(spark, d), variant), long_items(spark, d)
    else:
        shops, items = in_parallel(lambda: shop_dim(spark, d), lambda: full_items(spark, d))
    return feature_table(b.sales_view(spark, d), shops, items, keys, variant)


def digest(table: DataFrame) -> DataFrame:
    """Per (month, shop): rows, and for every other column its filled rows and its sum in whole millionths."""
    parts = [F.count(F.lit(1)).alias("n_rows")]
    for c in [c for c in table.columns if c not in (MONTH, SHOP)]:
        millionths = F.floor(F.col(c).cast("double") * 1_000_000)
        parts += [F.count(c).alias(f"n_{c}"), F.sum(millionths).alias(f"s_{c}")]
    return table.groupBy(MONTH, SHOP).agg(*parts)


# -- cleaning --------------------------------------------------------------------------------------------------


@query("conform_sales")
def conform_sales(spark, d):
    names = {"date_block_num": "month_id", "item_cnt_day": "item_quantity"}
    raw = b.raw_sales_view(spark, d).withColumn("item_price", F.col("item_price").cast("double"))
    return cleaning.conform(raw, names, ["date", *KEYS, "item_price", "item_quantity"])


def _priced(df: DataFrame) -> DataFrame:
    return df.withColumn("item_price", F.col("item_price").cast("double"))


@query("drop_outliers")
def drop_outliers(spark, d):
    kept = cleaning.drop_above(b.sales_view(spark, d), "item_quantity", 1000)
    return _priced(cleaning.drop_above(kept, "item_price", 100000))


@query("drop_negative_price")
def drop_negative_price(spark, d):
    return _priced(cleaning.drop_below(b.sales_view(spark, d), "item_price", 0))


@query("keep_positive_price")
def keep_positive_price(spark, d):
    return _priced(cleaning.keep_positive(b.sales_view(spark, d), "item_price"))


@query("returns_to_zero")
def returns_to_zero(spark, d):
    return _priced(cleaning.returns_to_zero(b.sales_view(spark, d)))


@query("returns_drop")
def returns_drop(spark, d):
    return _priced(cleaning.returns_drop(b.sales_view(spark, d)))


@query("drop_keys")
def drop_keys(spark, d):
    kept = cleaning.drop_keys(b.sales_view(spark, d), SHOP, b.DROP_SHOPS)
    gone = b.items_view(spark, d).filter(F.col("item_category_id").isin(*b.DROP_CATEGORIES)).select(ITEM)
    return _priced(cleaning.drop_keys(kept, ITEM, gone))


@query("drop_composite")
def drop_composite(spark, d):
    shop, month = b.DROP_SHOP_MONTH
    return _priced(cleaning.drop_where(b.sales_view(spark, d), (F.col(SHOP) == shop) & (F.col(MONTH) == month)))


@query("drop_argmin")
def drop_argmin(spark, d):
    return _priced(cleaning.drop_argmin(b.sales_view(spark, d), "item_price"))


@query("remap_keys")
def remap_keys(spark, d):
    return _priced(cleaning.remap_keys(b.sales_view(spark, d), SHOP, SHOP_REMAP))


@query("patch_names")
def patch_names(spark, d):
    patches = {1: "Misc - one", 8: "Misc - eight", 20: "Misc - twenty"}
    return cleaning.patch_values(b.categories_view(spark, d), "item_category_id", patches, "item_category_name")


@query("consolidate_duplicates")
def consolidate_duplicates(spark, d):
    return _priced(cleaning.consolidate(b.sales_view(spark, d)))


@query("parse_date")
def parse_date(spark, d):
    raw = b.raw_sales_view(spark, d)
    return raw.groupBy(numeric.parse_date("date").alias("date")).agg(F.count(F.lit(1)).alias("n"))


@query("day_id")
def day_id(spark, d):
    sales = b.sales_view(spark, d)
    days = sales.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    first = sales.agg(F.min("date")).first()[0]
    return days.withColumn("day_id", F.datediff("date", F.lit(first)))


@query("narrow_schema")
def narrow_schema(spark, d):
    return cleaning.narrow_schema(_priced(b.sales_view(spark, d)))


# -- panel -----------------------------------------------------------------------------------------------------


@query("panel_monthly_sales")
def panel_monthly_sales(spark, d):
    """Flagship: clean, total, densify, fill and lag."""
    return product(spark, d).calendar_lags([1, 2, 3]).rows()


@query("monthly_sales")
def monthly_sales(spark, d):
    return panel.monthly_sales(clean(spark, d))


@query("active_grid")
def active_grid(spark, d):
    return panel.active_grid(clean(spark, d))


@query("grid_fill_zero")
def grid_fill_zero(spark, d):
    monthly = totals(spark, d)
    filled = panel.fill_panel(panel.grid_of(monthly), monthly)
    return cleaning.fill_constant(filled, ["item_quantity"])


@query("union_test_keys")
def union_test_keys(spark, d):
    return with_keys(spark, d)


@query("lag_selfjoin")
def lag_selfjoin(spark, d):
    return product(spark, d).calendar_lags_by_join([1, 2, 3]).rows()


@query("lag_range")
def lag_range(spark, d):
    made = product_with_keys(spark, d)
    if overlaps(made):
        return lags.calendar_lags(with_keys(spark, d, made.monthly), ["item_quantity"], [1, 2, 3, 6, 12])
    return made.calendar_lags([1, 2, 3, 6, 12]).rows()


@query("burn_in")
def burn_in(spark, d):
    return cleaning.burn_in(product(spark, d).calendar_lags([1]).rows(), 2)


@query("fill_lags")
def fill_lags(spark, d):
    rows = dense(spark, d).withColumn("presence", F.lit(1.0))
    return cleaning.fill_lags(lags.calendar_lags(rows, ["item_quantity", "presence"], [1]))


@query("clip_target")
def clip_target(spark, d):
    return cleaning.clip_columns(product(spark, d).calendar_lags([1]).rows())


@query("attach_dims")
def attach_dims(spark, d):
    tables = settle_all(shop_dim(spark, d), item_dim(spark, d), category_dim(spark, d))
    return panel.attach_dims(with_keys(spark, d), *tables)


@query("denormalise")
def denormalise(spark, d):
    shops, items = b.shops_view(spark, d), b.items_view(spark, d)
    return _priced(panel.denormalise(b.sales_view(spark, d), shops, items, b.categories_view(spark, d)))


@query("localise_names")
def localise_names(spark, d):
    return panel.localise(b.shops_view(spark, d), b.translations_view(spark, d), SHOP, "shop_name", "shop_name_en")


@query("lookup_category")
def lookup_category(spark, d):
    sales = panel.lookup(b.sales_view(spark, d), ITEM, b.items_view(spark, d), ["item_category_id"])
    named = panel.lookup(sales, "item_category_id", b.categories_view(spark, d), ["item_category_name"])
    return named.groupBy("item_category_id", "item_category_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("item_quantity").alias("units")
    )


# -- price tables for the linear recipe --------------------------------------------------------------------------


def categorised(spark: SparkSession, d: str) -> DataFrame:
    sales = cleaning.keep_positive(b.sales_view(spark, d), "item_price")
    return panel.lookup(sales, ITEM, b.items_view(spark, d), ["item_category_id"])


@query("monthly_price_units")
def monthly_price_units(spark, d):
    return panel.monthly_price_units(categorised(spark, d), F.col(MONTH) <= 60)


@query("monthly_price_units_test")
def monthly_price_units_test(spark, d):
    return panel.monthly_price_units(categorised(spark, d), F.col(MONTH) == 61)


@query("pair_means")
def pair_means(spark, d):
    return panel.pair_means(categorised(spark, d)).select(
        SHOP, ITEM, F.round("item_price_mean", 6).alias("item_price_mean"), F.col("item_cnt_month")
    )


@query("category_mean_of_means")
def category_mean_of_means(spark, d):
    return panel.category_price(categorised(spark, d)).select(
        "item_category_id", F.round("item_cat_price_mean", 6).alias("item_cat_price_mean")
    )


def _price_context(spark: SparkSession, d: str) -> DataFrame:
    return panel.price_context(b.test_keys_view(spark, d), categorised(spark, d), b.items_view(spark, d))


@query("price_context")
def price_context(spark, d):
    return _price_context(spark, d).select(
        "ID",
        SHOP,
        ITEM,
        "item_category_id",
        F.round("item_price_mean", 6).alias("item_price_mean"),
        F.round("item_cat_price_mean", 6).alias("item_cat_price_mean"),
    )


@query("price_fallback")
def price_fallback(spark, d):
    price = numeric.first_known("item_price_mean", "item_cat_price_mean")
    return _price_context(spark, d).select("ID", F.round(price, 6).alias("item_price"))


# -- encodings -------------------------------------------------------------------------------------------------

ENCODED: dict[str, Encoding] = {
    "month": Encoding("mean_q", (), (1,)),
    "item": Encoding("mean_q", (ITEM,), (1, 2, 3)),
    "shop": Encoding("mean_q", (SHOP,), (1, 2, 3)),
    "shop_item": Encoding("mean_q", (SHOP, ITEM), (1, 2, 3)),
    "category": Encoding("mean_q", ("item_category_id",), (1,)),
    "shop_category": Encoding("mean_q", (SHOP, "item_category_id"), (1,)),
    "shop_console": Encoding("mean_q", (SHOP, "item_category_console_id"), (1,)),
    "shop_supercategory": Encoding("mean_q", (SHOP, "item_supercategory_id"), (1,)),
    "shop_subtype": Encoding("mean_q", (SHOP, "category_subtype_code"), (1,)),
    "city": Encoding("mean_q", ("city_code",), (1,)),
    "item_city": Encoding("mean_q", (ITEM, "city_code"), (1,)),
    "console": Encoding("mean_q", ("item_category_console_id",), (1,)),
    "supercategory": Encoding("mean_q", ("item_supercategory_id",), (1,)),
}


def key_dims(spark: SparkSession, d: str, keys: tuple[str, ...]) -> tuple[DataFrame | None, DataFrame | None]:
    """Shop and item tables with the attributes among the keys; None where there are none."""
    shops = settle(shop_dim(spark, d)).select(SHOP, "city_code") if "city_code" in keys else None
    wanted = [k for k in keys if k not in (SHOP, ITEM, "city_code")]
    if not wanted:
        return shops, None
    items = b.items_view(spark, d).select(ITEM, "item_category_id")
    if "category_subtype_code" in wanted:
        items = items.join(category_dim(spark, d), "item_category_id", "left")
    elif wanted != ["item_category_id"]:
        items = long_items(spark, d)
    return shops, settle(items.select(ITEM, *wanted))


def _keyed(rows: DataFrame, dims_: tuple[DataFrame | None, DataFrame | None]) -> DataFrame:
    for key, dim in zip((SHOP, ITEM), dims_, strict=True):
        rows = panel.lookup(rows, key, dim, [c for c in dim.columns if c != key]) if dim is not None else rows
    return rows


def _mean_query(e: Encoding) -> Query:
    """The panel with the rows to predict, whose target counts as 0: they are groups of their own month."""

    def run(spark, d):
        dims_, monthly = key_dims(spark, d, e.keys), totals(spark, d)
        if set(e.keys) == {SHOP, ITEM}:
            made = product_with_keys(spark, d, monthly)
            if overlaps(made):
                return encodings.mean_encode(with_keys(spark, d, monthly), e.keys, e.name)
            # Every group is one row of the product: its mean is the row's own value.
            return made.rows().withColumnRenamed("item_quantity", e.name)
        means = group_means(monthly, e.keys, e.name, *dims_, empty=True)
        asked = _keyed(b.test_keys_view(spark, d).select(SHOP, ITEM), dims_).select(*e.keys).distinct()
        asked = cleaning.with_period(asked, b.TARGET_MONTH) if e.keys else cleaning.with_period(
            b.test_keys_view(spark, d).limit(1).select(), b.TARGET_MONTH
        )
        return means.unionByName(asked.select(MONTH, *e.keys, F.lit(0.0).alias(e.name)))

    return run


def _lag_query(e: Encoding) -> Query:
    def run(spark, d):
        dims_, monthly = key_dims(spark, d, e.keys), totals(spark, d)
        lagged = product_with_keys(spark, d, monthly).lagged_means(e.keys, e.lags, e.name, *dims_).rows(units=False)
        return lagged.select(*KEYS, *[f"{e.name}_lag_{k}" for k in e.lags])

    return run


for _name, _encoding in ENCODED.items():
    query(f"mean_encode_{_name}")(_mean_query(_encoding))
    query(f"lagged_mean_{_name}")(_lag_query(_encoding))


# -- trends ----------------------------------------------------------------------------------------------------


@query("price_item")
def price_item(spark, d):
    return trends.price_means(clean(spark, d), [ITEM], "item_avg_item_price")


@query("price_month_item")
def price_month_item(spark, d):
    return trends.price_means(clean(spark, d), [MONTH, ITEM], "item_monthly_avg_item_price")


@query("shop_revenue")
def shop_revenue(spark, d):
    revenue = trends.shop_revenue(clean(spark, d))
    return revenue.withColumn("shop_monthly_revenue", F.col("shop_monthly_revenue").cast("double"))


@query("shop_avg_revenue")
def shop_avg_revenue(spark, d):
    return trends.shop_avg_revenue(trends.shop_revenue(clean(spark, d)))


def _trend_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, ActiveMonths]:
    monthly = totals(spark, d)
    return with_keys(spark, d, monthly), clean(spark, d), ActiveMonths(monthly)


@query("price_delta_lags")
def price_delta_lags(spark, d):
    return trends.grid_price_deltas(*_trend_inputs(spark, d), [1, 2, 3]).drop("item_quantity")


@query("price_trend")
def price_trend(spark, d):
    rows = product_with_keys(spark, d).price_trend(clean(spark, d), [1, 2, 3]).rows(units=False)
    return rows.select(ITEM, SHOP, MONTH, "delta_price_lag")


@query("price_trend_long")
def price_trend_long(spark, d):
    rows = product_with_keys(spark, d).price_trend(clean(spark, d), [1, 2, 3, 4, 5, 6]).rows(units=False)
    return rows.select(ITEM, SHOP, MONTH, "delta_price_lag")


@query("revenue_trend")
def revenue_trend(spark, d):
    return trends.grid_revenue_trend(*_trend_inputs(spark, d)).drop("item_quantity")


@query("price_as_of")
def price_as_of(spark, d):
    """Mean price of an item as known at the end of each of its months."""
    return trends.running_price_means(clean(spark, d))


@query("revenue_as_of")
def revenue_as_of(spark, d):
    return trends.running_shop_revenue(clean(spark, d))


@query("month_features")
def month_features(spark, d):
    return clean(spark, d).groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).select(
        MONTH, "n", numeric.month_of_year(MONTH).alias("month"), numeric.days_in_month(MONTH).alias("days")
    )


# -- recency ---------------------------------------------------------------------------------------------------


@query("first_month")
def first_month(spark, d):
    monthly = totals(spark, d)
    pairs = recency.first_month(monthly, [SHOP, ITEM], "pair_first_month")
    asked = cleaning.with_period(b.test_keys_view(spark, d).select(ITEM), b.TARGET_MONTH)
    items = recency.first_month(monthly.select(MONTH, ITEM).unionByName(asked.select(MONTH, ITEM)), [ITEM], "item_first_month")
    return pairs.join(items, ITEM, "left")


@query("last_sale_shop_item")
def last_sale_shop_item(spark, d):
    monthly = totals(spark, d)
    return recency.last_sale(with_keys(spark, d, monthly), monthly, [SHOP, ITEM], "last_sale_month").drop("item_quantity")


@query("last_sale_item")
def last_sale_item(spark, d):
    monthly = totals(spark, d)
    return recency.last_sale(with_keys(spark, d, monthly), monthly, [ITEM], "last_sale_month").drop("item_quantity")


@query("since_first")
def since_first(spark, d):
    monthly = totals(spark, d)
    rows = recency.first_seen(with_keys(spark, d, monthly), ActiveMonths(monthly), "item_shop_first_sale", "item_first_sale")
    return rows.drop("item_quantity")


@query("since_first_sale")
def since_first_sale(spark, d):
    monthly = totals(spark, d)
    return recency.since_first_sale(with_keys(spark, d, monthly), monthly).drop("item_quantity")


def senior_panel(spark: SparkSession, d: str, units: bool = True) -> DataFrame:
    rows = product_with_keys(spark, d).seniority().rows(units)
    return rows.select(SHOP, ITEM, MONTH, *(["item_quantity"] if units else []), "item_seniority")


@query("item_seniority")
def item_seniority(spark, d):
    return senior_panel(spark, d, units=False)


# -- names and codes -------------------------------------------------------------------------------------------


@query("token_first")
def token_first(spark, d):
    shops = b.shops_view(spark, d).select(
        F.lit("shop").alias("kind"),
        F.col(SHOP).cast("long").alias("id"),
        text.token("shop_name", 1).alias("word"),
        text.first_word("shop_name").alias("first_run"),
    )
    items = b.items_view(spark, d).select(
        F.lit("item").alias("kind"),
        F.col(ITEM).alias("id"),
        text.token("item_name", 1).alias("word"),
        text.first_word("item_name").alias("first_run"),
    )
    return shops.unionByName(items)


@query("token_second")
def token_second(spark, d):
    return b.shops_view(spark, d).select(SHOP, text.token("shop_name", 2).alias("word"))


@query("subtype_split")
def subtype_split(spark, d):
    orders = b.table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    named = orders.select(F.col("o_orderpriority").alias("name"), "n")
    cats = b.categories_view(spark, d).groupBy(F.col("item_category_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return named.unionByName(cats).select("name", "n", text.subtype("name").alias("subtype"))


@query("greedy_prefix")
def greedy_prefix(spark, d):
    return b.categories_view(spark, d).withColumn("prefix", text.greedy_prefix("item_category_name"))


@query("multi_match")
def multi_match(spark, d):
    return b.items_view(spark, d).select(ITEM, text.multi_match("item_name", [*b.NOUNS, *CONSOLES]).alias("console"))


@query("contains_flag")
def contains_flag(spark, d):
    return b.items_view(spark, d).select(ITEM, text.contains_flag("item_name", "[").cast("int").alias("flag"))


@query("bracket_parts")
def bracket_parts(spark, d):
    return b.items_view(spark, d).select(
        ITEM, text.bracket_part("item_name").alias("name2"), text.parenthesis_part("item_name").alias("name3")
    )


@query("normalise_name")
def normalise_name(spark, d):
    docs = b.table(spark, d, "documents")
    return docs.select("doc_id", text.normalise_name("text").alias("name"))


@query("unify_tokens")
def unify_tokens(spark, d):
    return b.items_view(spark, d).select(ITEM, text.item_type(text.bracket_part("item_name")).alias("type"))


@query("value_counts")
def value_counts(spark, d):
    counts = encode.value_counts(dims.item_name_parts(b.items_view(spark, d))[0], "name2")
    return counts.withColumn("frequent", (F.col("n") > 4).cast("int"))


@query("label_encode")
def label_encode(spark, d):
    return encode.label_encode(b.items_view(spark, d).select(ITEM, "item_name"), "item_name", "code")


@query("factorise")
def factorise(spark, d):
    return encode.factorise(b.items_view(spark, d).select(ITEM, "item_name"), "item_name", ITEM, "code")


@query("dict_code")
def dict_code(spark, d):
    named = b.categories_view(spark, d).withColumn("group", text.greedy_prefix("item_category_name"))
    return encode.dict_code(named, "group", b.GROUP_CODES, "code").drop("item_category_name")


@query("rare_bucket")
def rare_bucket(spark, d):
    words = b.shops_view(spark, d).select(SHOP, text.token("shop_name", 2).alias("kind"))
    return encode.rare_bucket(words, "kind", 4)


@query("rare_bucket_cross")
def rare_bucket_cross(spark, d):
    return dims.item_name_parts(b.items_view(spark, d))[0]


@query("one_hot")
def one_hot(spark, d):
    parts = b.table(spark, d, "part").select("p_partkey", "p_type", "p_size")
    return encode.one_hot(parts, {"p_type": b.PART_TYPES, "p_size": range(1, 51)})


@query("min_max_scale")
def min_max_scale(spark, d):
    cols = ["item_price", "item_quantity"]
    monthly = settle(panel.monthly_price_units(categorised(spark, d)).withColumnRenamed("item_cnt_month", "item_quantity"))
    train, _, _ = splits.time_split(monthly, 70, 71)
    return encode.min_max_scale(monthly, encode.fit_min_max(train, cols))


@query("standardise")
def standardise(spark, d):
    cols = ["item_price", "item_quantity"]
    monthly = settle(panel.monthly_price_units(categorised(spark, d)).withColumnRenamed("item_cnt_month", "item_quantity"))
    train, _, _ = splits.time_split(monthly, 70, 71)
    scaled = encode.standardise(monthly, encode.fit_standard(train, cols))
    return scaled.withColumns({c: F.round(c, 6) for c in cols})


# -- order, top-k, sets ----------------------------------------------------------------------------------------


@query("sorted_head")
def sorted_head(spark, d):
    return summary.preview(dense(spark, d), KEYS, 100)


@query("top_k")
def top_k(spark, d):
    units = panel.monthly_sales(clean(spark, d)).groupBy(SHOP, ITEM).agg(F.sum("item_quantity").alias("units"))
    return summary.top_k(units, [F.desc("units"), F.asc(ITEM)], 5, [SHOP])


@query("union_segments")
def union_segments(spark, d):
    rows = settle(senior_panel(spark, d))
    return encodings.union_all([splits.segment(rows, s) for s in (0, 1, 2)])


@query("number_rows")
def number_rows_query(spark, d):
    return number_rows(b.test_keys_view(spark, d).select(SHOP, ITEM), [SHOP, ITEM])


# -- summaries -------------------------------------------------------------------------------------------------


@query("extremes")
def extremes(spark, d):
    return summary.extremes(b.sales_view(spark, d), b.items_view(spark, d))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query("describe")
def describe(spark, d):
    return _rounded(summary.describe(_priced(b.sales_view(spark, d)), ["item_price", "item_quantity"]))


@query("null_profile")
def null_profile(spark, d):
    return summary.null_profile(product(spark, d).calendar_lags([1, 2, 3]).rows())


@query("rmse_baseline")
def rmse_baseline(spark, d):
    naive = product(spark, d).calendar_lags([1]).rows()
    return summary.rmse(naive, "item_quantity", "item_quantity_lag_1")


# -- splits ----------------------------------------------------------------------------------------------------


@query("time_split")
def time_split(spark, d):
    parts = splits.time_split(with_keys(spark, d), b.TARGET_MONTH - 1, b.TARGET_MONTH)
    named = [
        p.agg(F.lit(n).alias("split"), F.count(F.lit(1)).alias("n"), F.sum("item_quantity").alias("units"))
        for n, p in zip(("train", "validation", "test"), parts)
    ]
    return encodings.union_all(named)


@query("segment_split")
def segment_split(spark, d):
    rows = settle(senior_panel(spark, d))
    _, val, test = splits.time_split(rows, b.TARGET_MONTH - 1, b.TARGET_MONTH)
    named = [
        splits.segment(p, s).agg(
            F.lit(n).alias("split"), F.lit(s).alias("seniority"), F.count(F.lit(1)).alias("n"),
            F.sum(F.col(SHOP) * F.col(ITEM)).alias("key_sum"),
        )
        for n, p in (("validation", val), ("test", test))
        for s in (0, 1, 2)
    ]
    return encodings.union_all(named)


def linear_rows(spark: SparkSession, d: str) -> DataFrame:
    return settle(panel.monthly_price_units(categorised(spark, d), F.col(MONTH) <= 60))


LINEAR_KEYS = (MONTH, "item_category_id", SHOP, ITEM)
LINEAR_FEATURES = (MONTH, "item_category_id", SHOP, ITEM, "item_price")


@query("random_split")
def random_split(spark, d):
    return splits.random_split(linear_rows(spark, d), 0.2, LINEAR_KEYS).select(*LINEAR_KEYS, F.col("is_val").cast("int").alias("is_val"))


# -- linear models ---------------------------------------------------------------------------------------------


def whole_price(df: DataFrame) -> DataFrame:
    """Prices as whole units, as the linear recipe reads them."""
    return df.withColumn("item_price", F.col("item_price").cast("long"))


@query("gram_matrix")
def gram_matrix(spark, d):
    return linear.gram_matrix(whole_price(linear_rows(spark, d)), LINEAR_FEATURES, "item_cnt_month")


def _weights(spark: SparkSession, weights) -> DataFrame:
    rows = [(f, round(float(w), 6)) for f, w in zip(LINEAR_FEATURES, weights)]
    return spark.createDataFrame(rows, "feature STRING, weight DOUBLE")


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = settle(splits.random_split(whole_price(linear_rows(spark, d)), 0.2, LINEAR_KEYS))
    return rows.filter(~F.col("is_val")), rows.filter("is_val")


@query("ols_fit")
def ols_fit(spark, d):
    train, _ = _split(spark, d)
    return _weights(spark, linear.ols(train, LINEAR_FEATURES, "item_cnt_month"))


@query("ridge_fit")
def ridge_fit(spark, d):
    train, _ = _split(spark, d)
    return _weights(spark, linear.ridge(train, LINEAR_FEATURES, "item_cnt_month", 5.0))


@query("tune_lambda")
def tune_lambda(spark, d):
    train, val = _split(spark, d)
    tried = linear.tune_lambda(train, val, LINEAR_FEATURES, "item_cnt_month")
    return spark.createDataFrame(tried, "lambda DOUBLE, mse DOUBLE").orderBy("mse", "lambda")


@query("linear_forecast")
def linear_forecast(spark, d):
    """Tuned ridge applied to the keys to predict, with fallback prices."""
    train, val = _split(spark, d)
    tried = linear.tune_lambda(train, val, LINEAR_FEATURES, "item_cnt_month")
    best = min(tried, key=lambda t: t[1])[0]
    weights = linear.ridge(train, LINEAR_FEATURES, "item_cnt_month", best)
    rows = cleaning.with_period(_price_context(spark, d), b.TARGET_MONTH).withColumn(
        "item_price", numeric.first_known("item_price_mean", "item_cat_price_mean")
    )
    return rows.select("ID", linear.predict(LINEAR_FEATURES, weights).alias("item_cnt_month"))


# -- forecasts without a model, used by the output operators -----------------------------------------------------


def recent_mean(spark: SparkSession, d: str, months: int) -> DataFrame:
    """Mean units of the last ``months`` months per pair, clipped; a plain forecast to submit and compare."""
    monthly = panel.monthly_sales(clean(spark, d)).filter(F.col(MONTH) >= b.TARGET_MONTH - months)
    mean = monthly.groupBy(SHOP, ITEM).agg(numeric.clip(F.sum("item_quantity") / months, 0, 20).alias("item_quantity"))
    return mean


@query("submission_join")
def submission_join(spark, d):
    return panel.submission_join(b.test_keys_view(spark, d), recent_mean(spark, d, 12))


def _forecast(spark: SparkSession, d: str, months: int) -> DataFrame:
    return panel.submission_join(b.test_keys_view(spark, d), recent_mean(spark, d, months)).fillna(0)


@query("ensemble_mean")
def ensemble_mean(spark, d):
    return encodings.ensemble_mean([_forecast(spark, d, 12), _forecast(spark, d, 24)])


@query("compare_forecasts")
def compare_forecasts(spark, d):
    return _rounded(summary.compare_forecasts(*settle_all(_forecast(spark, d, 12), _forecast(spark, d, 24))))


# -- whole feature tables --------------------------------------------------------------------------------------


@query("features_full")
def features_full(spark, d):
    return digest(features(spark, d, b.LATE))


@query("features_early_clip")
def features_early_clip(spark, d):
    return digest(features(spark, d, b.EARLY))


@query("features_segmented")
def features_segmented(spark, d):
    return digest(features(spark, d, b.SEGMENT))


@query("features_long_lags")
def features_long_lags(spark, d):
    return digest(features(spark, d, b.LONG))


# -- boosted trees ---------------------------------------------------------------------------------------------

def tree_table(spark: SparkSession, d: str, variant: Variant) -> DataFrame:
    return settle(features(spark, d, variant))


def tree_inputs(table: DataFrame, variant: Variant) -> Packed:
    """Training, validation and test rows of a variant's feature table as blocks of bins."""
    inputs = [c for c in table.columns if c not in ("item_quantity", "item_seniority")]
    parts = splits.time_split(table, b.TARGET_MONTH - 1, b.TARGET_MONTH)
    return pack(*parts, inputs, segment="item_seniority" if variant.seniority else None)


@query("gbt_forecast")
def gbt_forecast(spark, d):
    _, found = trees.fit_trees(tree_inputs(tree_table(spark, d, b.LATE), b.LATE), trees.TreeParams())
    return panel.submission_join(b.test_keys_view(spark, d), found)


@query("gbt_segments")
def gbt_segments(spark, d):
    """One model per seniority. A segment that no row of the validation month has is stopped by all of its rows."""
    packed = tree_inputs(tree_table(spark, d, b.SEGMENT), b.SEGMENT)
    return panel.submission_join(b.test_keys_view(spark, d), trees.fit_segments(packed, instead=True))


def _search(spark: SparkSession, d: str) -> tuple[Packed, list[trees.TreeParams], trees.Ledger]:
    table, trials = tree_table(spark, d, b.LATE), trees.draw_params()
    return tree_inputs(table, b.LATE), trials, trees.ledger_for(table, trials)


@query("param_search")
def param_search(spark, d):
    tried = trees.param_search(*_search(spark, d))
    return summary.top_k(tried, [F.asc("loss"), F.asc("trial")], trees.SEARCH_TRIALS)


def search_and_fit(spark, d):
    """Forecast of the best trial of the search."""
    return panel.submission_join(b.test_keys_view(spark, d), trees.ensemble_trials(*_search(tune(spark), d), best=1))


def ensemble_trials(spark, d):
    """Mean forecast of the ten best trials of the search."""
    return panel.submission_join(b.test_keys_view(spark, d), trees.ensemble_trials(*_search(tune(spark), d), best=10))


# Listed by the entry beside QUERIES: forecasts after a search, which no SQL can express.
SEARCHES: dict[str, Query] = {"search_and_fit": search_and_fit, "ensemble_trials": ensemble_trials}
