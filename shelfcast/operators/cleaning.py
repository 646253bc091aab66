"""Row and column cleaning of the sales fact and its dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.config import MONTH, SHOP, Variant
from shelfcast.functions.numeric import clip


def conform(df: DataFrame, mapping: Mapping[str, str], order: Sequence[str] | None = None) -> DataFrame:
    """Rename columns, then keep ``order`` only."""
    renamed = df.withColumnsRenamed(dict(mapping))
    return renamed.select(*order) if order else renamed


def drop_above(df: DataFrame, col: str, cut: float) -> DataFrame:
    """Delete rows above the cutoff; NULL rows stay."""
    return df.filter(F.col(col).isNull() | (F.col(col) <= cut))


def drop_below(df: DataFrame, col: str, cut: float = 0) -> DataFrame:
    """Delete rows below the cutoff; NULL rows stay."""
    return df.filter(F.col(col).isNull() | (F.col(col) >= cut))


def keep_positive(df: DataFrame, col: str) -> DataFrame:
    """Keep strictly positive values; zero and NULL rows go."""
    return df.filter(F.col(col) > 0)


def returns_to_zero(df: DataFrame, col: str = "item_quantity") -> DataFrame:
    """A returned quantity counts as zero; the row, its price and its presence stay."""
    return df.withColumn(col, F.when(F.col(col) < 0, F.lit(0).cast(df.schema[col].dataType)).otherwise(F.col(col)))


def returns_drop(df: DataFrame, col: str = "item_quantity") -> DataFrame:
    """Delete returns."""
    return drop_below(df, col, 0)


def drop_keys(df: DataFrame, col: str, keys: Iterable | DataFrame) -> DataFrame:
    """Delete rows whose key is listed. A list becomes a predicate, a key table an anti join; NULL keys stay."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(F.col(keys.columns[0]).alias(col)), col, "left_anti")
    keys = list(keys)
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(keys)) if keys else df


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """Delete rows that match; rows for which the condition is unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def drop_argmin(df: DataFrame, col: str, tiebreak: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Delete exactly one row: the smallest ``col``, ties broken by ``tiebreak`` and then by the other columns.

    All copies of that row are taken out and all but one put back, so nothing has to tell copies apart. ``unique=True``
    says that no whole row repeats and spares the second step.
    """
    order = [col, *tiebreak, *[c for c in df.columns if c != col and c not in tiebreak]]
    key = F.struct(*order)
    # One row by construction.
    first = F.broadcast(df.filter(F.col(col).isNotNull()).agg(F.min(key).alias("_first")))
    same = key.eqNullSafe(F.col("_first"))
    rest = df.join(first, same, "left_anti")
    if unique:
        return rest
    copies = df.join(first, same, "left_semi").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    returned = copies.withColumn("_copy", F.explode(F.sequence(F.lit(2), F.col("_n")))).select(*df.columns)
    return rest.unionByName(returned)


def remap_keys(df: DataFrame, col: str, mapping: Mapping | DataFrame) -> DataFrame:
    """Replace listed ids. A mapping becomes an expression; a table (old, new) is joined."""
    if isinstance(mapping, DataFrame):
        old, new = mapping.columns
        pairs = mapping.select(F.col(old).alias(col), F.col(new).alias("_new"))
        return df.join(pairs, col, "left").withColumn(col, F.coalesce("_new", col)).select(*df.columns)
    if not mapping:
        return df
    kind = df.schema[col].dataType
    new = None
    for old, target in mapping.items():
        new = (F if new is None else new).when(F.col(col) == old, F.lit(target).cast(kind))
    return df.withColumn(col, new.otherwise(F.col(col)))


def patch_values(dim: DataFrame, key: str, mapping: Mapping, col: str) -> DataFrame:
    """Overwrite ``col`` in the rows whose ``key`` is listed."""
    new = None
    for k, text in mapping.items():
        new = (F if new is None else new).when(F.col(key) == k, F.lit(text))
    return dim.withColumn(col, new.otherwise(F.col(col)) if new is not None else F.col(col))


def burn_in(df: DataFrame, months: int) -> DataFrame:
    """Keep months after ``months``. Apply after the lags exist."""
    return df.filter(F.col(MONTH) > months)


def narrow_schema(df: DataFrame) -> DataFrame:
    """Cast integer columns to the smallest type that holds their range, doubles to float when that is exact.

    One aggregate profiles all columns; nothing wraps around.
    """
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ShortType, T.IntegerType, T.LongType))]
    real = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    if not whole and not real:
        return df
    probes = [F.min(c).alias(f"lo_{c}") for c in whole] + [F.max(c).alias(f"hi_{c}") for c in whole]
    probes += [F.count_if(F.col(c).cast("float").cast("double") != F.col(c)).alias(f"loss_{c}") for c in real]
    found = df.agg(*probes).first()
    casts = {}
    for c in whole:
        low, high = found[f"lo_{c}"] or 0, found[f"hi_{c}"] or 0
        for bits, kind in ((8, "byte"), (16, "short"), (32, "int")):
            if -(2 ** (bits - 1)) <= low and high < 2 ** (bits - 1):
                casts[c] = F.col(c).cast(kind)
                break
    casts.update({c: F.col(c).cast("float") for c in real if not found[f"loss_{c}"]})
    return df.withColumns(casts)


def fill_constant(df: DataFrame, cols: Sequence[str], value: float = 0) -> DataFrame:
    return df.fillna(value, subset=list(cols))


def fill_lags(df: DataFrame, patterns: Sequence[str] = ("item_quantity", "revenue")) -> DataFrame:
    """Fill with 0 the lag columns whose name holds one of the patterns; other lags stay NULL."""
    chosen = [c for c in df.columns if "_lag_" in c and any(p in c for p in patterns)]
    return df.fillna(0, subset=chosen) if chosen else df


def clip_columns(df: DataFrame, low: float = 0, high: float = 20, pattern: str = "item_quantity") -> DataFrame:
    """Clip every column whose name holds the pattern."""
    return df.withColumns({c: clip(c, low, high) for c in df.columns if pattern in c})


def with_period(df: DataFrame, month: int) -> DataFrame:
    """Stamp keys with the month to predict."""
    return df.withColumn(MONTH, F.lit(month))


def consolidate(df: DataFrame, measure: str = "item_quantity") -> DataFrame:
    """Sum ``measure`` over rows that agree in every other column; rows with a missing key are left out."""
    others = [c for c in df.columns if c != measure]
    return df.dropna(subset=others).groupBy(*others).agg(F.sum(measure).alias(measure)).select(*df.columns)


def clean_sales(sales: DataFrame, variant: Variant, items: DataFrame | None = None) -> DataFrame:
    """All cleaning steps of a variant, on the daily fact."""
    if variant.max_quantity is not None:
        sales = drop_above(sales, "item_quantity", variant.max_quantity)
    if variant.max_price is not None:
        sales = drop_above(sales, "item_price", variant.max_price)
    sales = returns_drop(sales) if variant.returns == "drop" else returns_to_zero(sales)
    if variant.drop_negative_price:
        sales = drop_below(sales, "item_price", 0)
    sales = remap_keys(sales, SHOP, variant.shop_remap)
    sales = drop_keys(sales, SHOP, variant.drop_shops)
    if variant.drop_shop_month:
        shop, month = variant.drop_shop_month
        sales = drop_where(sales, (F.col(SHOP) == shop) & (F.col(MONTH) == month))
    if variant.drop_categories:
        # Inner sense on purpose: the category decides, and it comes from the item.
        gone = items.filter(F.col("item_category_id").isin(*variant.drop_categories)).select("item_id")
        sales = drop_keys(sales, "item_id", gone)
    if variant.drop_cheapest_row:
        sales = drop_argmin(consolidate(sales), "item_price", unique=True)
    return sales
