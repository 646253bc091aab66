"""Dense panels as the product of two narrow sides, with everything per pair carried by the (month, item) rows.

A month's panel is its active shops times its active items. What depends on the pair, as its units or first sale, is a
map by shop on the item's row: the dense rows look it up and meet no hash join, sort or shuffle. Maps are searched from
their start, so with many shops they have two levels and a look-up costs about the root of the number of shops.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.config import ITEM, KEYS, MONTH, SHOP
from shelfcast.functions.numeric import select_trend
from shelfcast.operators.grid import group_means, lag_table
from shelfcast.operators.layout import expand
from shelfcast.operators.panel import grid_size
from shelfcast.operators.recency import first_month, seniority_code
from shelfcast.operators.trends import lagged_price_deltas
from shelfcast.session import settle, settle_all

#: Keys that one level of a map may hold before there are two.
FLAT_KEYS = 64


def map_levels(shops: int) -> int:
    """Maps of the first level for what is kept by shop: 1 while a month has few shops."""
    return 1 if shops <= FLAT_KEYS else math.ceil(math.sqrt(shops))


def maps_by(table: DataFrame, by: Sequence[str], key: str, value: Column, out: str, levels: int = 1) -> DataFrame:
    """One row per ``by`` with a map of ``key`` to ``value``. Missing values have no entry, nor has a row with a missing item or key.

    A pair (by, key) may have one row at most.
    """
    known = value.isNotNull()
    for k in (ITEM, key):
        known = known & F.col(k).isNotNull() if k in table.columns else known
    entry = F.when(known, F.struct(F.col(key), value))
    if levels == 1:
        return table.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias(out))
    part = table.groupBy(*by, _level(key, levels).alias("_level")).agg(F.map_from_entries(F.collect_list(entry)).alias("_map"))
    return part.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_level", "_map"))).alias(out))


def _level(key: str, levels: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(levels)).cast("int")


def look_up(name: str, key: str, levels: int = 1) -> Column:
    """The value of the row's ``key`` in a map of ``maps_by``; NULL if there is none."""
    found = F.col(name) if levels == 1 else F.element_at(name, _level(key, levels))
    return F.element_at(found, F.col(key))


def lag_columns(side: DataFrame, by: Sequence[str], wanted: dict[str, tuple[str, int]]) -> DataFrame:
    """Add calendar lags {name: (column, months)} within ``by``, of any type: one sort for all."""
    frame = Window.partitionBy(*by).orderBy(MONTH)
    maps = {f.name for f in side.schema.fields if f.dataType.typeName() == "map"}  # the only type without an order
    found = {c: F.first(c, ignorenulls=True) if c in maps else F.max(c) for c, _ in wanted.values()}
    return side.withColumns({n: found[c].over(frame.rangeBetween(-k, -k)) for n, (c, k) in wanted.items()})


class Product:
    """The panel of an active grid and the keys to predict, whose target counts as 0; columns are added before ``rows``.

    ``monthly`` holds one row per (month, shop, item) and is read several times: settle it first.
    """

    def __init__(self, monthly: DataFrame, asked: DataFrame | None = None, month: int | None = None):
        self.monthly, self.asked, self.month = monthly, asked, month
        size = grid_size(monthly)
        self.parts, self.levels, self.last = size.partitions, map_levels(size.shops), size.last
        here = F.lit(True).alias("_here")
        items = maps_by(monthly, [MONTH, ITEM], SHOP, F.col("item_quantity"), "_q", self.levels).select("*", here)
        shops = monthly.select(MONTH, SHOP, here).distinct()
        if asked is not None:
            at = F.lit(month).alias(MONTH)
            items = items.unionByName(asked.select(at, ITEM).distinct(), allowMissingColumns=True)
            shops = shops.unionByName(asked.select(at, SHOP).distinct(), allowMissingColumns=True)
        self.items, self.shops = items, shops
        self.item_lags: dict[str, tuple[str, int]] = {}
        self.shop_lags: dict[str, tuple[str, int]] = {}
        self.item_tables: list[tuple[DataFrame, list[str]]] = []
        self.shop_tables: list[tuple[DataFrame, list[str]]] = []
        self.mixed: list[tuple[DataFrame, list[str], list[str]]] = []
        self.made: dict[str, Column] = {}

    def of_shop(self, name: str) -> Column:
        return look_up(name, SHOP, self.levels)

    def units(self, name: str) -> Column:
        """Units of the row's pair from a map; as in a filled panel, none or NaN counts as 0."""
        value = self.of_shop(name)
        if self.monthly.schema["item_quantity"].dataType.typeName() in ("double", "float"):
            value = F.nanvl(value, F.lit(None))
        return F.coalesce(value, F.lit(0).cast(self.monthly.schema["item_quantity"].dataType))

    def present(self, k: int) -> Column:
        """Whether the row's pair was in the grid k months earlier."""
        self.item_lags[f"_i{k}"] = self.shop_lags[f"_s{k}"] = ("_here", k)
        return F.col(f"_i{k}") & F.col(f"_s{k}")

    # -- columns -----------------------------------------------------------------------------------------------------

    def calendar_lags(self, lags: Sequence[int]) -> Product:
        """The pair's units k months earlier, as ``lags.calendar_lags`` gives for the rows.

        Rows after the month to predict do not see its keys: ``last`` must lie before it.
        """
        for k in lags:
            self.item_lags[f"_q{k}"] = ("_q", k)
            self.made[f"item_quantity_lag_{k}"] = F.when(self.present(k), self.units(f"_q{k}"))
        return self

    def calendar_lags_by_join(self, lags: Sequence[int]) -> Product:
        """``lags.calendar_lags_by_join``: a shifted copy of the panel joined back, one join per lag.

        The copy is a product as well and so is the join: each side meets its own shifted copy.
        """
        self.items, self.shops = settle_all(self.items, self.shops)
        for k in lags:
            later = (F.col(MONTH) + k).alias(MONTH)
            self.item_tables.append((self.items.select(later, ITEM, F.col("_q").alias(f"_q{k}")), [MONTH, ITEM]))
            self.shop_tables.append((self.shops.select(later, SHOP, F.col("_here").alias(f"_s{k}")), [MONTH, SHOP]))
            there = F.col(f"_s{k}") & F.col(f"_q{k}").isNotNull()
            self.made[f"item_quantity_lag_{k}"] = F.when(there, self.units(f"_q{k}"))
        return self

    def price_deltas(self, sales: DataFrame, lags: Sequence[int], as_of: int | None = None) -> dict[str, Column]:
        """Columns of ``trends.grid_price_deltas``."""
        self.item_tables.append((lagged_price_deltas(sales, lags, as_of), [MONTH, ITEM]))
        known = F.col(SHOP).isNotNull() & F.col(ITEM).isNotNull()
        names = [f"delta_price_lag_{k}" for k in lags]
        return {n: F.when(self.present(k) & known, F.col(n)) for n, k in zip(names, lags, strict=True)}

    def price_trend(self, sales: DataFrame, lags: Sequence[int], as_of: int | None = None) -> Product:
        """Adds the column of ``trends.grid_price_trend``."""
        self.made["delta_price_lag"] = select_trend(list(self.price_deltas(sales, lags, as_of).values()))
        return self

    def seniority(self) -> Product:
        """Adds the column of ``recency.seniority``."""
        pairs = first_month(self.monthly, [SHOP, ITEM], "_first")
        self.item_tables.append((maps_by(pairs, [ITEM], SHOP, F.col("_first"), "_pair_first", self.levels), [ITEM]))
        self.item_tables.append((first_month(self.monthly, [ITEM], "_item_first"), [ITEM]))
        first = F.least(F.col(MONTH), F.col("_item_first"))
        self.made["item_seniority"] = seniority_code(F.col(MONTH), first, self.of_shop("_pair_first"))
        return self

    def lagged_means(
        self, keys: Sequence[str], lags: Sequence[int], out: str,
        shops: DataFrame | None = None, items: DataFrame | None = None,
    ) -> Product:
        """Adds the columns of ``grid.lagged_means``; ``shops`` and ``items`` have the attributes among the keys."""
        names = {k: f"{out}_lag_{k}" for k in lags}
        known = F.col(SHOP).isNotNull() & F.col(ITEM).isNotNull()
        for key in [k for k in keys if k not in (SHOP, ITEM)]:
            known = known & F.col(key).isNotNull()
        for side, dim, id_ in ((self.shop_tables, shops, SHOP), (self.item_tables, items, ITEM)):
            if dim is not None:
                side.append((dim, [id_]))
        if set(keys) == {SHOP, ITEM}:
            self.item_lags |= {f"_q{k}": ("_q", k) for k in lags}
            values = {k: self.of_shop(f"_q{k}") for k in lags}
        else:
            shifted = lag_table(group_means(self.monthly, keys, out, shops, items), keys, [out], lags)
            values = self._attach(shifted, keys, names, shops)
        for k in lags:
            self.made[names[k]] = F.when(self.present(k) & known, F.coalesce(values[k], F.lit(0.0)))
        return self

    def _attach(
        self, shifted: DataFrame, keys: Sequence[str], names: dict[int, str], shops: DataFrame | None
    ) -> dict[int, Column]:
        on_shop = [k for k in keys if k == SHOP or (shops is not None and k in shops.columns)]
        on_item = [k for k in keys if k not in on_shop]
        if not on_item:
            self.shop_tables.append((shifted, [MONTH, *on_shop]))
        elif not on_shop:
            self.item_tables.append((shifted, [MONTH, *on_item]))
        elif on_item == [ITEM] and len(on_shop) == 1:
            shifted = settle(shifted)
            for name in names.values():
                maps = maps_by(shifted, [MONTH, ITEM], on_shop[0], F.col(name), f"_by_{name}", self.levels)
                self.item_tables.append((maps, [MONTH, ITEM]))
            return {k: look_up(f"_by_{name}", on_shop[0], self.levels) for k, name in names.items()}
        else:
            self.mixed.append((shifted, on_shop, on_item))
        return {k: F.col(name) for k, name in names.items()}

    # -- the product -------------------------------------------------------------------------------------------------

    def rows(self, units: bool = True) -> DataFrame:
        """month, shop, item, target and the added columns. Without the target, unless ``units``, its maps are not made."""
        items, shops = lag_columns(self.items, [ITEM], self.item_lags), lag_columns(self.shops, [SHOP], self.shop_lags)
        if not units:
            items = items.drop("_q")
        for table, on in self.item_tables:
            items = items.join(table, on, "left")
        for table, on in self.shop_tables:
            shops = shops.join(table, on, "left")
        items, shops = settle_all(items, shops)
        kept = [c for c in shops.columns if c != "_here"]
        met: list[str] = []
        for shifted, on_shop, on_item in self.mixed:
            # Once per combination of its month, which the items meet NULL-safe.
            groups = items.select(MONTH, *on_item).distinct()
            shops = expand(groups, shops, MONTH, on_item, settled=True).join(shifted, [MONTH, *on_shop, *on_item], "left")
            kept += [c for c in shifted.columns if c not in (MONTH, *on_shop, *on_item)]
            marked = F.struct(*[F.struct(F.coalesce(F.col(k).cast("string"), F.lit("")), F.col(k).isNull()) for k in on_item])
            items, shops = items.withColumn(f"_on{len(met)}", marked), shops.withColumn(f"_on{len(met)}", marked).drop(*on_item)
            met.append(f"_on{len(met)}")
        if met:
            shops = settle(shops)
        here = F.col("_here").isNotNull()
        few = shops.filter(here).select(*kept, *met)
        dense = expand(items.filter(here).drop("_here"), few, [MONTH, *met], [ITEM], self.parts, settled=True)
        target = [self.units("_q").alias("item_quantity")] if units else []
        out = [*KEYS, *target, *[c.alias(n) for n, c in self.made.items()]]
        if self.asked is None:
            return dense.select(*out)
        asked = self.asked.select(SHOP, ITEM)
        for table, id_, hint in ((items, ITEM, "shuffle_hash"), (shops, SHOP, None)):
            narrow = table.filter(~here).drop("_here").withColumnRenamed(id_, "_id")
            shared = [c for c in (MONTH, *met) if c in asked.columns and c in narrow.columns]
            narrow = narrow.withColumnsRenamed({c: f"_{c}" for c in shared})
            same = F.col(id_).eqNullSafe(F.col("_id"))
            for c in shared:
                same = same & (F.col(c) == F.col(f"_{c}"))
            asked = asked.join(narrow.hint(hint) if hint else narrow, same).drop("_id", *[f"_{c}" for c in shared])
        return dense.select(*out).unionByName(asked.select(*out))
