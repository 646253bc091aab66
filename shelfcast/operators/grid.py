"""What is known of an active grid without touching its rows: months as bit sets, and means from two side counts.

A month's grid is the product of its active shops and active items. So one bit set of months per shop and per item says
which rows exist at any month, and a group has (its active shops) × (its active items) rows. Lags of group means,
prices and revenues then come from narrow tables, and the dense panel is neither sorted nor shuffled: it only meets
hash joins. Panels of an active grid, with or without the keys to predict, have these properties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.config import ITEM, MONTH, SHOP
from shelfcast.operators.layout import expand, join_small
from shelfcast.session import settle, settle_all

WORD = 62  # months per BIGINT


def month_span(monthly: DataFrame) -> tuple[int, int]:
    """First month, and number of words that hold all months from there on."""
    first, last = monthly.agg(F.min(MONTH), F.max(MONTH)).first()
    return (0, 1) if first is None else (first, (last - first) // WORD + 1)


def month_sets(monthly: DataFrame, keys: Sequence[str], span: tuple[int, int], prefix: str) -> DataFrame:
    """One row per key with the set of months it has rows in; a partial ``bit_or`` keeps a hot key to one row a task."""
    sets = [F.bit_or(c).alias(f"{prefix}{w}") for w, c in enumerate(month_words(F.col(MONTH), span))]
    return monthly.groupBy(*keys).agg(*sets)


def month_words(month: Column, span: tuple[int, int]) -> list[Column]:
    """The words of the set of one month: empty if it is missing."""
    since = month - span[0]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (since % WORD).cast("int"))
    here = F.floor(since / WORD)
    return [F.when(here == w, bit).otherwise(F.lit(0).cast("bigint")) for w in range(span[1])]


def words_of(prefix: str, span: tuple[int, int]) -> list[Column]:
    return [F.coalesce(F.col(f"{prefix}{w}"), F.lit(0).cast("bigint")) for w in range(span[1])]


def has_month(words: Sequence[Column], month: Column, span: tuple[int, int]) -> Column:
    since, found = month - span[0], F.lit(False)
    for w, word in enumerate(words):
        bit = F.call_function("shiftright", word, (since - w * WORD).cast("int")).bitwiseAND(F.lit(1).cast("bigint"))
        found = F.when((since >= w * WORD) & (since < (w + 1) * WORD), bit == 1).otherwise(found)
    return found


def first_of(words: Sequence[Column], span: tuple[int, int]) -> Column:
    """The earliest month of a set; NULL if it is empty."""
    # Without a negation, which ANSI SQL checks by a slow call on every row.
    lowest = [F.when(x != 0, F.bit_count(x.bitwiseXOR(x - 1)) + (span[0] + w * WORD - 1)) for w, x in enumerate(words)]
    return F.coalesce(*lowest).cast("int")


def last_before(words: Sequence[Column], month: Column, span: tuple[int, int]) -> Column:
    """The latest month of a set strictly before ``month``; NULL if there is none."""
    since, found = month - span[0], []
    for w, word in enumerate(words):
        below = F.call_function("shiftleft", F.lit(1).cast("bigint"), (since - w * WORD).cast("int")) - 1
        part = F.when(since >= (w + 1) * WORD, word).when(since > w * WORD, word.bitwiseAND(below))
        found.append(F.when(part != 0, span[0] + w * WORD + F.length(F.bin(part)) - 1))
    return F.coalesce(*reversed(found)).cast("int")


def lag_table(table: DataFrame, keys: Sequence[str], cols: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """(month, keys) with the values of k months earlier as ``col_lag_k``, wherever one of them has a row.

    ``table`` has one row per (month, keys), so a single lag is a shift.
    """
    if len(lags) == 1:
        k = lags[0]
        return table.select((F.col(MONTH) + k).alias(MONTH), *keys, *[F.col(c).alias(f"{c}_lag_{k}") for c in cols])
    spread = table.select(MONTH, *keys, *cols, F.explode(F.array(*[F.lit(k) for k in lags])).alias("_k"))
    made = [F.max(F.when(F.col("_k") == k, F.col(c))).alias(f"{c}_lag_{k}") for c in cols for k in lags]
    return spread.groupBy((F.col(MONTH) + F.col("_k")).alias(MONTH), *keys).agg(*made)


class ActiveMonths:
    """Month sets of the shops and items of one grid. ``monthly`` is read several times: settle it first."""

    def __init__(self, monthly: DataFrame):
        self.monthly, self.span = monthly, month_span(monthly)
        self.shops, self.items = settle_all(
            month_sets(monthly, [SHOP], self.span, "_s"), month_sets(monthly, [ITEM], self.span, "_i")
        )
        self.added = [f"{p}{w}" for p in "_s _i".split() for w in range(self.span[1])]

    def attach(self, panel: DataFrame) -> DataFrame:
        """Both sets on every row: a broadcast of the shops if they fit, and a hash join where the item hash lies."""
        return join_small(panel, self.shops, SHOP).join(self.items.hint("shuffle_hash"), ITEM, "left")

    def words(self) -> list[Column]:
        """Months in which the row's pair is in the grid."""
        return [s.bitwiseAND(i) for s, i in zip(words_of("_s", self.span), words_of("_i", self.span), strict=True)]

    def present(self, k: int) -> Column:
        """Whether the row's pair is in the grid k months earlier."""
        return has_month(self.words(), F.col(MONTH) - k, self.span)

    def first_pair_month(self) -> Column:
        """The pair's first month in the panel, where the row's own counts too."""
        return F.least(F.col(MONTH), first_of(self.words(), self.span))

    def first_item_month(self) -> Column:
        return F.least(F.col(MONTH), first_of(words_of("_i", self.span), self.span))


def group_means(
    monthly: DataFrame,
    keys: Sequence[str],
    out: str,
    shops: DataFrame | None = None,
    items: DataFrame | None = None,
    empty: bool = False,
) -> DataFrame:
    """Mean of the zero-filled target per (month, keys) over the grid of ``monthly``, without its rows.

    ``shops`` and ``items`` hold one row per id with the attributes among the keys. Groups without sales are left out
    unless ``empty``: their mean is 0.
    """
    on_shop = [k for k in keys if k == SHOP or (shops is not None and k in shops.columns and k != ITEM)]
    on_item = [k for k in keys if k not in on_shop]

    def with_attributes(table: DataFrame, id_: str, dim: DataFrame | None, wanted: Sequence[str]) -> DataFrame:
        more = [k for k in wanted if k != id_]
        return join_small(table, dim.select(id_, *more), id_) if more else table

    active_shops = with_attributes(monthly.select(MONTH, SHOP).distinct(), SHOP, shops, on_shop)
    active_items = with_attributes(monthly.select(MONTH, ITEM).distinct(), ITEM, items, on_item)
    n_shops, n_items = settle_all(
        active_shops.groupBy(MONTH, *on_shop).agg(F.count(F.lit(1)).alias("_ns")),
        active_items.groupBy(MONTH, *on_item).agg(F.count(F.lit(1)).alias("_ni")),
    )
    rows = with_attributes(with_attributes(monthly, SHOP, shops, on_shop), ITEM, items, on_item)
    sums = rows.groupBy(MONTH, *keys).agg(F.sum("item_quantity").alias("_q"))
    size = F.col("_ns").cast("double") * F.col("_ni")
    mean = (F.coalesce(F.col("_q"), F.lit(0.0)) / size).alias(out)
    # Groups of rows without an attribute are groups as well, so the keys meet NULL-safe.
    marked = [F.struct(F.coalesce(F.col(k).cast("string"), F.lit("")), F.col(k).isNull()).alias(f"_on_{k}") for k in keys]
    named = {k: c for k, c in zip(keys, marked, strict=True)}
    shop_on, item_on = [f"_on_{k}" for k in on_shop], [f"_on_{k}" for k in on_item]
    n_shops = n_shops.select("*", *[named[k] for k in on_shop])
    n_items = n_items.select("*", *[named[k] for k in on_item])
    if not empty:
        sums = sums.select("*", *marked)
        joined = join_small(sums, n_shops.drop(*on_shop), [MONTH, *shop_on], "inner")
        joined = joined.join(n_items.drop(*on_item).hint("shuffle_hash"), [MONTH, *item_on])
        return joined.select(MONTH, *keys, mean)
    groups = expand(n_items, n_shops, MONTH, on_item or [MONTH], settled=True)
    joined = groups.join(
        sums.select(MONTH, *marked, "_q").hint("shuffle_hash"), [MONTH, *shop_on, *item_on], "left"
    )
    return joined.select(MONTH, *keys, mean)


def lagged_means(
    panel: DataFrame,
    months: ActiveMonths,
    keys: Sequence[str],
    lags: Sequence[int],
    out: str,
    shops: DataFrame | None = None,
    items: DataFrame | None = None,
) -> DataFrame:
    """Lags of a group mean on a panel that carries the keys: NULL where the pair's own row, or a key, is missing.

    The same values as ``encodings.lagged_encoding`` gives for such a panel.
    """
    if set(keys) == {SHOP, ITEM}:
        means = months.monthly.select(MONTH, SHOP, ITEM, F.col("item_quantity").alias(out))
    else:
        means = group_means(months.monthly, keys, out, shops, items)
    shifted = lag_table(means, keys, [out], lags)
    on = [MONTH, *keys]
    if ITEM in keys:
        joined = panel.join(shifted.hint("shuffle_hash"), on, "left")
    else:
        joined = join_small(panel, settle(shifted), on)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    marked = months.attach(joined)
    made = {
        f"{out}_lag_{k}": F.when(months.present(k) & known, F.coalesce(F.col(f"{out}_lag_{k}"), F.lit(0.0))) for k in lags
    }
    return marked.withColumns(made).drop(*months.added)
