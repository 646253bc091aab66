"""Categorical codes, rare buckets and numeric scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.layout import BROADCAST_BYTES, fits_broadcast, number_rows
from shelfcast.session import settle


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def _ranked(values: DataFrame, order: str, out: str, small: bool) -> DataFrame:
    """Dense codes from 0 in ``order``: one window when the values are known to be few, else range by range."""
    if small:
        return values.withColumn(out, (F.row_number().over(Window.orderBy(order)) - 1).cast("long"))
    return number_rows(values, [order], out)


def _measured(values: DataFrame, small: bool | None, max_bytes: int) -> tuple[DataFrame, bool]:
    """The caller may vouch for the size of a table it has measured; otherwise write the values and measure them."""
    if small is not None:
        return values, small
    values = settle(values)
    return values, fits_broadcast(values, max_bytes)


def _attach_codes(df: DataFrame, codes: DataFrame, col: str, small: bool) -> DataFrame:
    return df.join(F.broadcast(codes) if small else codes, col, "left")


def label_encode(
    df: DataFrame, col: str, out: str, small: bool | None = None, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rank of the value among the sorted distinct values, from 0; NULL stays NULL."""
    values, small = _measured(df.select(col).dropna().distinct(), small, max_bytes)
    return _attach_codes(df, _ranked(values, col, out, small), col, small)


def factorise(
    df: DataFrame, col: str, position: str, out: str, small: bool | None = None, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Code by first appearance in ``position`` order (a unique column); NULL gets −1."""
    firsts = df.dropna(subset=[col]).groupBy(col).agg(F.min(position).alias("_first"))
    firsts, small = _measured(firsts, small, max_bytes)
    codes = _ranked(firsts, "_first", out, small).drop("_first")
    return _attach_codes(df, codes, col, small).fillna(-1, subset=[out])


def dict_code(df: DataFrame, col: str, mapping: Mapping[str, int], out: str) -> DataFrame:
    """Fixed code of a value; unknown values get NULL."""
    code = None
    for value, number in mapping.items():
        code = (F if code is None else code).when(F.col(col) == value, F.lit(number))
    return df.withColumn(out, code)


def rare_bucket(
    df: DataFrame, col: str, more_than: int = 4, other: str = "etc", small: bool | None = None
) -> DataFrame:
    """Keep a value that occurs more than ``more_than`` times, else replace it."""
    kept = value_counts(df, col, "_n").filter(F.col("_n") > more_than).select(col, F.lit(True).alias("_kept"))
    kept, small = _measured(kept, small, BROADCAST_BYTES)
    flagged = _attach_codes(df, kept, col, small)
    return flagged.withColumn(col, F.when(F.col("_kept"), F.col(col)).otherwise(other)).drop("_kept")


def rare_bucket_cross(
    df: DataFrame,
    type_col: str,
    name_col: str,
    fewer_than: int = 40,
    other: str = "etc",
    small: bool | None = None,
) -> DataFrame:
    """Collect the types that occur fewer than ``fewer_than`` times; a *name* equal to such a type is replaced."""
    rare = value_counts(df, type_col, "_n").filter(F.col("_n") < fewer_than)
    rare, small = _measured(rare.select(F.col(type_col).alias(name_col), F.lit(True).alias("_rare")), small, BROADCAST_BYTES)
    replaced = F.when(F.col("_rare"), F.lit(other)).otherwise(F.col(name_col))
    return _attach_codes(df, rare, name_col, small).withColumn(name_col, replaced).drop("_rare")


def one_hot(df: DataFrame, values: Mapping[str, Sequence]) -> DataFrame:
    """0/1 column ``{column}_{value}`` for every listed value of every listed column; other values give zeros.

    The caller names the values, because they become columns. ``one_hot_index`` takes any number of values.
    """
    return df.withColumns(
        {f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c, listed in values.items() for v in listed}
    )


def one_hot_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """Sparse one-hot code without a bound on the values: the place of the 1 among the sorted values, NULL for NULL."""
    return label_encode(df, col, out)


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Range of each column, in one aggregate."""
    found = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (found[f"lo_{c}"], found[f"hi_{c}"]) for c in cols}


def min_max_scale(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Scale to [0, 1] with ranges fitted on the training rows; a constant column becomes 0."""
    return df.withColumns(
        {
            c: (F.col(c).cast("double") - low) / (high - low) if high is not None and high > low else F.col(c).cast("double") * 0
            for c, (low, high) in bounds.items()
        }
    )


def fit_standard(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column, in one aggregate."""
    probes = [f(c).alias(f"{n}_{c}") for c in cols for n, f in (("mean", F.avg), ("dev", F.stddev_pop))]
    found = df.agg(*probes).first()
    return {c: (float(found[f"mean_{c}"]), float(found[f"dev_{c}"])) for c in cols}


def standardise(df: DataFrame, moments: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Mean 0 and population deviation 1; a constant column becomes 0."""
    return df.withColumns({c: (F.col(c).cast("double") - m) / (d or 1.0) for c, (m, d) in moments.items()})
