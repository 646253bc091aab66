"""Whole feature tables, planned so that the dense panel is never shuffled or sorted.

The panel of a month is the product of its active shops and active items. So every feature that depends on the shop
only, or on the item only, is computed on the narrow side before the product; group means come from the sparse monthly
totals divided by counts of the two sides; and what depends on the pair itself is a map by shop on the (month, item) row,
or follows from the month sets of the two sides. The dense rows look it up: they meet no join, sort or shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.config import ITEM, MONTH, SHOP, Encoding, Variant
from shelfcast.functions.numeric import clip, days_in_month, mean, month_of_year, relative_delta, select_trend
from shelfcast.operators.cleaning import clean_sales, clip_columns, fill_lags
from shelfcast.operators.grid import first_of, month_sets, month_span, month_words, words_of
from shelfcast.operators.layout import BROADCAST_BYTES, expand, fits_broadcast, join_small
from shelfcast.operators.panel import grid_size
from shelfcast.operators.product import lag_columns, look_up, map_levels, maps_by
from shelfcast.operators.recency import first_month, seniority_code
from shelfcast.session import dropped_shuffles, in_parallel, settle, settle_all, tune

#: Facts that a task of the (month, item) side has, about.
SIDE_ROWS = 200_000


def monthly_facts(sales: DataFrame, variant: Variant) -> DataFrame:
    """One row per (month, shop, item): target, revenue, price sum and row count. The only pass over the daily fact."""
    exact = sales.schema["item_price"].dataType.typeName() == "decimal"
    quantity = F.col("item_quantity").cast("decimal(12,0)") if exact else F.col("item_quantity")
    facts = sales.groupBy(MONTH, SHOP, ITEM).agg(
        F.sum("item_quantity").alias("q"),
        F.sum(F.col("item_price") * quantity).alias("revenue"),
        F.sum("item_price").alias("price_sum"),
        F.count("item_price").alias("price_n"),
    )
    return facts.withColumn("q", clip("q", *variant.clip_range)) if variant.clip_at != "end" else facts


def _shift(df: DataFrame, k: int) -> DataFrame:
    return df.withColumn(MONTH, F.col(MONTH) + k)


def _lag_set(variant: Variant) -> list[int]:
    used = set(variant.target_lags) | {k for e in variant.encodings for k in e.lags}
    if variant.price_trend:
        used |= set(variant.price_lags)
    if variant.revenue_trend:
        used.add(1)
    return sorted(used)


class FactoredPanel:
    """The narrow tables of one variant, and the product built from them."""

    def __init__(
        self,
        sales: DataFrame,
        shops: DataFrame,
        items: DataFrame,
        test: DataFrame,
        variant: Variant,
        max_bytes: int = BROADCAST_BYTES,
    ):
        """``shops`` and ``items`` hold one row per id with its attributes; ``test`` the (shop, item) keys to predict."""
        spark = tune(sales.sparkSession)
        self.variant, self.max_bytes = variant, max_bytes
        self.shop_attrs = [c for c in shops.columns if c != SHOP]
        self.item_attrs = [c for c in items.columns if c != ITEM]
        self.lags = _lag_set(variant)
        with dropped_shuffles(spark):
            self.facts, self.test, self.shop_dim, self.item_dim = settle_all(
                monthly_facts(sales, variant), test.select(SHOP, ITEM).distinct(), shops, items
            )
            self.active_shops, self.active_items = settle_all(
                self.facts.groupBy(MONTH, SHOP).agg(F.sum("q").alias("q"), F.sum("revenue").alias("revenue")),
                self.facts.groupBy(MONTH, ITEM).agg(
                    F.sum("q").alias("q"), F.sum("price_sum").alias("price_sum"), F.sum("price_n").alias("price_n")
                ),
            )
        size = grid_size(self.facts)
        # As many for every core: the dense rows are made where the side's files are read, each split as large.
        cores = spark.sparkContext.defaultParallelism
        self.side_parts = cores * max(1, math.ceil(self.facts.count() / SIDE_ROWS / cores))
        self.parts, self.levels, self.span = size.partitions, map_levels(size.shops), month_span(self.facts)
        # Measured once: tables with at most one row per shop or (month, shop) are broadcast only if these two may be.
        self.few_shops = all(in_parallel(*[lambda t=t: fits_broadcast(t, max_bytes) for t in (self.active_shops, self.shop_dim)]))

    def _of_shops(self, table: DataFrame) -> DataFrame:
        """Hint for a table no larger than the (month, shop) table or the shop table."""
        return F.broadcast(table) if self.few_shops else table

    def _sides(self, encoding: Encoding) -> tuple[list[str], list[str]]:
        on_shop = [k for k in encoding.keys if k == SHOP or k in self.shop_attrs]
        return on_shop, [k for k in encoding.keys if k not in on_shop]

    def _encodings(self, kind: str) -> list[Encoding]:
        """Encodings by where they attach: 'shop', 'item', 'mixed' (shop × item attribute) or 'pair' (shop × item)."""
        chosen = []
        for e in self.variant.encodings:
            shop_keys, item_keys = self._sides(e)
            found = "shop" if not item_keys else "item" if not shop_keys else "pair" if ITEM in item_keys else "mixed"
            if found == kind:
                chosen.append(e)
        return chosen

    # -- group means -------------------------------------------------------------------------------------------

    def _shops_with(self, table: DataFrame, keys: Sequence[str]) -> DataFrame:
        attrs = [k for k in keys if k != SHOP]
        return table.join(self._of_shops(self.shop_dim.select(SHOP, *attrs)), SHOP, "left") if attrs else table

    def _items_with(self, table: DataFrame, keys: Sequence[str]) -> DataFrame:
        attrs = [k for k in keys if k != ITEM]
        return table.join(self.item_dim.select(ITEM, *attrs), ITEM, "left") if attrs else table

    def group_mean(self, encoding: Encoding) -> DataFrame:
        """Mean of the zero-filled target per (month, keys), without the dense panel. A group without sales is absent.

        The panel of a month is a product, so a group has (its active shops) × (its active items) rows.
        """
        shop_keys, item_keys = self._sides(encoding)
        shops = self._shops_with(self.active_shops, shop_keys)
        items = self._items_with(self.active_items, item_keys)
        n_shops = shops.groupBy(MONTH, *shop_keys).agg(F.count(F.lit(1)).alias("_ns"))
        n_items = items.groupBy(MONTH, *item_keys).agg(F.count(F.lit(1)).alias("_ni"))
        rows = shops if not item_keys else items if not shop_keys else None
        if rows is None:
            rows = self._items_with(self._shops_with(self.facts, shop_keys), item_keys)
        sums = rows.groupBy(MONTH, *encoding.keys).agg(F.sum("q").alias("_q"))
        size = F.col("_ns").cast("double") * F.col("_ni").cast("double")
        joined = sums.join(self._of_shops(n_shops), [MONTH, *shop_keys]).join(n_items, [MONTH, *item_keys])
        return joined.select(MONTH, *encoding.keys, (F.col("_q") / size).alias(encoding.name))

    # -- narrow sides ------------------------------------------------------------------------------------------

    def shop_side(self) -> DataFrame:
        """(month, shop) rows, also for the month to predict: attributes, presence per lag, shop-level features."""
        v = self.variant
        here = self.active_shops.select(MONTH, SHOP, F.lit(True).alias("_here"), "revenue")
        asked = self.test.select(F.lit(v.target_month).alias(MONTH), SHOP).distinct()
        side = self._shops_with(here.unionByName(asked, allowMissingColumns=True), [SHOP, *self.shop_attrs])
        wanted = {f"_s{k}": ("_here", k) for k in self.lags}
        for e in self._encodings("shop"):
            side = side.join(self._of_shops(self.group_mean(e)), [MONTH, *e.keys], "left")
            wanted |= {f"{e.name}_lag_{k}": (e.name, k) for k in e.lags}
        if v.revenue_trend:
            average = self.active_shops.groupBy(SHOP).agg(mean("revenue").alias("_average"))
            side = side.join(self._of_shops(average), SHOP, "left").withColumn(
                "_delta", relative_delta(F.col("revenue").cast("double"), "_average")
            )
            wanted["delta_revenue_lag_1"] = ("_delta", 1)
        lagged = lag_columns(side, [SHOP], wanted)
        if v.revenue_trend:
            lagged = lagged.withColumn("delta_revenue_lag_1", F.when(F.col("_s1"), F.col("delta_revenue_lag_1")))
        lagged = lagged.withColumns(self._where_present("_s", self._encodings("shop")))
        months = month_sets(self.active_shops, [SHOP], self.span, "_sm")
        return lagged.join(self._of_shops(months), SHOP, "left").select(
            MONTH, SHOP, *self.shop_attrs, *wanted, *self._words("_sm")
        )

    def _words(self, prefix: str) -> list[Column]:
        return [c.alias(f"{prefix}{w}") for w, c in enumerate(words_of(prefix, self.span))]

    @staticmethod
    def _where_present(prefix: str, encodings: Sequence[Encoding]) -> dict[str, Column]:
        """Lagged means as far as one side knows them: NULL where that side or a key was missing, 0 without sales."""
        made = {}
        for e in encodings:
            for k in e.lags:
                there = F.col(f"{prefix}{k}")
                for key in e.keys:
                    there = there & F.col(key).isNotNull()
                made[f"{e.name}_lag_{k}"] = F.when(there, F.coalesce(F.col(f"{e.name}_lag_{k}"), F.lit(0.0)))
        return made

    def item_side(self) -> DataFrame:
        """(month, item) rows, also for the month to predict: attributes, presence per lag, item-level features."""
        v = self.variant
        price = F.try_divide(F.col("price_sum").cast("double"), F.col("price_n"))
        here = self.active_items.withColumns({"_here": F.lit(True), "_price": price})
        asked = self.test.select(F.lit(v.target_month).alias(MONTH), ITEM).distinct()
        # Hashed on the item once: windows, sums and joins by the item, with or without the month, stay where rows are.
        side = self._by_item(here.unionByName(asked, allowMissingColumns=True))
        of_item = Window.partitionBy(ITEM)
        side = side.withColumn("_item_first", F.min(MONTH).over(of_item))
        words = {f"_im{w}": c for w, c in enumerate(month_words(F.when(F.col("_here") & F.col(ITEM).isNotNull(), F.col(MONTH)), self.span))}
        side = side.withColumns({name: F.bit_or(c).over(of_item) for name, c in words.items()})
        wanted = {f"_i{k}": ("_here", k) for k in self.lags}
        if v.price_trend:
            overall = F.try_divide(F.sum("price_sum").over(of_item).cast("double"), F.sum("price_n").over(of_item))
            base = F.when(F.col(ITEM).isNotNull(), overall)
            side = side.withColumn("_overall", base).withColumn("_delta", relative_delta("_price", "_overall"))
            wanted |= {f"_d{k}": ("_delta", k) for k in v.price_lags}
        for e in self._encodings("item"):
            wanted |= {f"{e.name}_lag_{k}": (e.name, k) for k in e.lags}
            if e.keys == (ITEM,):
                shops = self._of_shops(self._shops_a_month())
                side = side.join(shops, MONTH, "left").withColumn(e.name, F.col("q") / F.col("_ns").cast("double")).drop("_ns")
        side = side.drop("q", "price_sum", "price_n")
        for table, on in self._pair_maps():
            side = side.join(table, on, "left")
        wanted |= {f"_q{k}": ("_q0", k) for k in self._unit_lags()}
        wanted |= {f"{e.name}_lag_{k}": (e.name, k) for e in self._pair_means() if self._mapped(e) for k in e.lags}
        side = self._items_with(side, [ITEM, *self.item_attrs])
        for e in self._encodings("item"):
            if e.keys != (ITEM,):
                side = join_small(side, settle(self.group_mean(e)), [MONTH, *e.keys], "left", self.max_bytes)
        lagged = lag_columns(side, [ITEM], wanted).withColumns(self._where_present("_i", self._encodings("item")))
        if v.price_trend:
            lagged = lagged.withColumns({f"_d{k}": F.when(F.col(f"_i{k}"), F.col(f"_d{k}")) for k in v.price_lags})
        made = {
            "month": month_of_year(F.col(MONTH)).cast("int"),
            v.days_name: days_in_month(F.col(MONTH)),
            "item_first_sale": F.col(MONTH) - F.col("_item_first"),
        }
        sold = ["_sold_first"] if v.seniority else []
        made_columns = [c.alias(n) for n, c in made.items()]
        return lagged.select(MONTH, ITEM, *self.item_attrs, "_item_first", "_q0", *sold, *wanted, *made_columns, *self._words("_im"))

    def _by_item(self, table: DataFrame) -> DataFrame:
        return table.repartition(self.side_parts, ITEM)

    def _shops_a_month(self) -> DataFrame:
        return self.active_shops.groupBy(MONTH).agg(F.count(F.lit(1)).alias("_ns"))

    def _unit_lags(self) -> list[int]:
        return sorted({*self.variant.target_lags, *[k for e in self._pair_equal() for k in e.lags]})

    def _mapped(self, encoding: Encoding) -> bool:
        """Whether a pair mean is a map by one key of the shop on the (month, item) rows."""
        shop_keys, item_keys = self._sides(encoding)
        return item_keys == [ITEM] and len(shop_keys) == 1

    def _pair_maps(self) -> list[tuple[DataFrame, list[str]]]:
        """What depends on the pair, as maps to be joined to the (month, item) rows; all tables are hashed on the item."""
        facts = self._by_item(self.facts.select(MONTH, SHOP, ITEM, "q"))
        tables = [(maps_by(facts, [MONTH, ITEM], SHOP, F.col("q"), "_q0", self.levels), [ITEM, MONTH])]
        for e in self._pair_means():
            if self._mapped(e):
                (by,) = self._sides(e)[0]
                shops = self._shops_with(self.active_shops.select(MONTH, SHOP), [by]).groupBy(MONTH, by)
                sums = self._by_item(self._shops_with(self.facts.select(MONTH, SHOP, ITEM, "q"), [by]).select(MONTH, ITEM, by, "q"))
                sums = sums.groupBy(MONTH, ITEM, by).agg(F.sum("q").alias("_q"))
                # A group has its active shops' rows of the one item.
                joined = sums.join(self._of_shops(shops.agg(F.count(F.lit(1)).alias("_ns"))), [MONTH, by])
                value = F.col("_q") / F.col("_ns").cast("double")
                tables.append((maps_by(joined, [MONTH, ITEM], by, value, e.name, self.levels), [ITEM, MONTH]))
        if self.variant.seniority:
            sold = first_month(self._by_item(self.facts.select(MONTH, SHOP, ITEM)), [SHOP, ITEM], "_sold")
            tables.append((maps_by(sold, [ITEM], SHOP, F.col("_sold"), "_sold_first", self.levels), [ITEM]))
        return tables

    def _by_attribute(self, shop_side: DataFrame, item_side: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Shop side once per item-attribute combination of its month, with the means that mix both sides."""
        combos = item_side.select(MONTH, *keys).distinct()
        side = expand(combos, shop_side, MONTH, keys, max_bytes=self.max_bytes, settled=True)
        wanted = {}
        for e in self._encodings("mixed"):
            side = side.join(self.group_mean(e), [MONTH, *e.keys], "left")
            wanted |= {f"{e.name}_lag_{k}": (e.name, k) for k in e.lags}
        lagged = lag_columns(side, [SHOP, *keys], wanted).withColumns(self._where_present("_s", self._encodings("mixed")))
        return lagged.select(*shop_side.columns, *keys, *wanted)

    # -- pairs ---------------------------------------------------------------------------------------------------

    def _pair_equal(self) -> list[Encoding]:
        """Encodings whose group is the pair itself: their mean is the target."""
        return [e for e in self.variant.encodings if set(e.keys) == {SHOP, ITEM}]

    def _pair_means(self) -> list[Encoding]:
        return [e for e in self._encodings("pair") if set(e.keys) != {SHOP, ITEM}]

    # -- the product -------------------------------------------------------------------------------------------

    def build(self) -> DataFrame:
        """Dense feature table after burn-in, plus the rows to predict."""
        v = self.variant
        keys = sorted({k for e in self._encodings("mixed") for k in self._sides(e)[1]})
        with dropped_shuffles(self.facts.sparkSession):
            shop_side, item_side = settle_all(*in_parallel(self.shop_side, self.item_side))
            if keys:
                shop_side = settle(self._by_attribute(shop_side, item_side, keys))
        # NULL attributes must still meet their own rows, so the product runs on NULL-free copies of the keys.
        coded = [F.coalesce(F.col(k), F.lit(-1)).alias(f"_on_{k}") for k in keys]
        few = shop_side.select("*", *coded).drop(*keys)
        many = item_side.select("*", *coded)
        join_on = [MONTH, *[f"_on_{k}" for k in keys]]

        known = F.col(MONTH) < v.target_month
        later = known & (F.col(MONTH) > v.burn_in)
        joins = any(not self._mapped(e) for e in self._pair_means())  # those need the item hash on the dense rows
        dense = expand(
            many.filter(later), few.filter(later), join_on, [ITEM], self.parts, self.max_bytes, settled=True, hashed=joins
        )
        asked = (
            self.test.withColumn(MONTH, F.lit(v.target_month))
            .repartition(self.parts, ITEM)
            .join(many.filter(~known).hint("shuffle_hash"), [MONTH, ITEM])
        )
        asked = join_small(asked, few.filter(~known), [*join_on, SHOP], "inner", self.max_bytes)
        return self._finish(dense).unionByName(self._finish(asked))

    def _finish(self, rows: DataFrame) -> DataFrame:
        v = self.variant
        for e in self._pair_means():
            if not self._mapped(e):
                means = self.group_mean(e)
                for k in e.lags:
                    shifted = _shift(means, k).withColumnRenamed(e.name, f"{e.name}_lag_{k}").repartition(self.parts, ITEM)
                    rows = rows.join(shifted.hint("shuffle_hash"), [MONTH, *e.keys], "left")

        def present(k: int) -> Column:
            return F.col(f"_s{k}") & F.col(f"_i{k}")

        target = F.coalesce(look_up("_q0", SHOP, self.levels), F.lit(0.0)).alias("item_quantity")
        made = [F.col(MONTH), F.col(SHOP), F.col(ITEM), target]
        made += [F.col(c) for c in self.shop_attrs + self.item_attrs]
        made += [self._lagged_target(f"item_quantity_lag_{k}", k, present(k)) for k in v.target_lags]
        for e in v.encodings:
            shop_keys, item_keys = self._sides(e)
            for k in e.lags:
                name = f"{e.name}_lag_{k}"
                if set(e.keys) == {SHOP, ITEM}:
                    made.append(self._lagged_target(name, k, present(k)))
                elif not item_keys:
                    made.append(F.when(F.col(f"_i{k}"), F.col(name)).alias(name))
                elif not shop_keys:
                    made.append(F.when(F.col(f"_s{k}"), F.col(name)).alias(name))
                elif ITEM not in item_keys:
                    there = F.col(f"_i{k}")
                    for key in item_keys:
                        there = there & F.col(key).isNotNull()
                    made.append(F.when(there, F.col(name)).alias(name))
                else:
                    there = present(k)
                    for key in e.keys:
                        there = there & F.col(key).isNotNull()
                    value = look_up(name, shop_keys[0], self.levels) if self._mapped(e) else F.col(name)
                    made.append(F.when(there, F.coalesce(value, F.lit(0.0))).alias(name))
        if v.price_trend:
            deltas = [F.when(F.col(f"_s{k}"), F.col(f"_d{k}")) for k in v.price_lags]
            made.append(select_trend(deltas).alias("delta_price_lag"))
        if v.revenue_trend:
            made.append(F.when(F.col("_i1"), F.col("delta_revenue_lag_1")).alias("delta_revenue_lag_1"))
        month = F.col(MONTH)
        both = [F.col(f"_sm{w}").bitwiseAND(F.col(f"_im{w}")) for w in range(self.span[1])]
        made += [
            F.col("month"),
            F.col(v.days_name),
            (month - F.least(month, first_of(both, self.span))).alias("item_shop_first_sale"),
            F.col("item_first_sale"),
        ]
        if v.seniority:
            sold_first = look_up("_sold_first", SHOP, self.levels)
            made.append(seniority_code(month, F.col("_item_first"), sold_first).alias("item_seniority"))
        out = fill_lags(rows.select(*made), v.fill_patterns)
        return clip_columns(out, *v.clip_range) if v.clip_at == "end" else out

    def _lagged_target(self, name: str, k: int, present: Column) -> Column:
        return F.when(present, F.coalesce(look_up(f"_q{k}", SHOP, self.levels), F.lit(0.0))).alias(name)


def feature_table(
    sales: DataFrame,
    shops: DataFrame,
    items: DataFrame,
    test: DataFrame,
    variant: Variant,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Clean the daily fact and build all features of a variant. ``items`` carries category attributes already."""
    cleaned = clean_sales(sales, variant, items)
    return FactoredPanel(cleaned, shops, items, test, variant, max_bytes).build()
