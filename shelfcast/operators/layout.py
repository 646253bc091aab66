"""Physical helpers: size-checked broadcast, product within a month, distributed running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import parallelism, settle

BROADCAST_BYTES = 64 * 1024 * 1024
SPREAD = 64


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Count the rows and compare their width with the bound. Text columns are measured, not guessed."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    width = 16 + 16 * len(df.columns)
    chars = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(0))
    rows, letters = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(chars), F.lit(0))).first()
    return rows * width + letters <= max_bytes


def sized(small: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``small`` with a broadcast hint when its measured size allows one, else as it is."""
    return F.broadcast(small) if fits_broadcast(small, max_bytes) else small


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``small`` when its measured size allows it; otherwise a shuffle join, which AQE splits on skew."""
    return big.join(sized(small, max_bytes), on, how)


def expand(
    many: DataFrame,
    few: DataFrame,
    on: str | Sequence[str],
    spread_by: Sequence[str],
    partitions: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
    settled: bool = False,
    hashed: bool = True,
) -> DataFrame:
    """Equi-join that multiplies rows: every row of ``many`` meets every row of ``few`` with the same ``on`` key.

    ``many`` is hashed on ``spread_by`` first, with a fixed partition count so that the small input is not merged into
    a few tasks before it grows. With a broadcast ``few`` that layout is kept by the output. A ``few`` beyond the bound
    is replicated over hash buckets of ``spread_by``, so one hot ``on`` key is still handled by many tasks.
    ``settled`` says that ``few`` is already a written table. Unless ``hashed``, the rows stay where the product makes
    them: callers that join nothing to them need no item hash. With a broadcast ``few`` that is where ``many`` lies, which
    must have a task's share in each partition then: a written table of even files.
    """
    on = [on] if isinstance(on, str) else list(on)
    partitions = partitions or parallelism(many.sparkSession)
    few = few if settled else settle(few)
    if fits_broadcast(few, max_bytes):
        # The coalesce keeps the scan's generated code apart from the product's: together the JVM would not compile it.
        laid = many.repartition(partitions, *spread_by) if hashed else many.coalesce(partitions)
        return laid.join(F.broadcast(few), on)
    salted_many = many.withColumn("_bucket", F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int"))
    salted_few = few.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    if not hashed:
        salted_many, salted_few = (t.repartition(partitions, *on, "_bucket") for t in (salted_many, salted_few))
        return salted_many.join(salted_few.hint("shuffle_hash"), [*on, "_bucket"]).drop("_bucket")
    grown = salted_many.join(salted_few.hint("shuffle_hash"), [*on, "_bucket"]).drop("_bucket")
    return grown.repartition(partitions, *spread_by)


def running_total(df: DataFrame, order: Sequence[str], weight: str, out: str) -> DataFrame:
    """Inclusive running sum of ``weight`` in ``order``, without a single-task window.

    Range-partition, total each range, offset every range by the totals before it (one row per range), then sum
    within the range. ``order`` should be close to unique so that ranges stay even.
    """
    ranged = settle(
        df.repartitionByRange(parallelism(df.sparkSession), *order).withColumn("_range", F.spark_partition_id())
    )
    totals = ranged.groupBy("_range").agg(F.sum(weight).alias("_total"))
    # One row per range: bounded by the partition count.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_within", F.sum(weight).over(within))
        .join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_offset") + F.col("_within"))
        .drop("_range", "_within", "_offset")
    )


def number_rows(df: DataFrame, order: Sequence[str], out: str = "ID") -> DataFrame:
    """Dense 0…n−1 id in ``order`` (a unique key), computed range by range."""
    counted = running_total(df.withColumn("_one", F.lit(1)), order, "_one", out)
    return counted.withColumn(out, F.col(out) - 1).drop("_one")
