"""Order without a global sort: ranges by binary search among sampled cuts, running totals by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Rows of a range, and ranges, at most; below the first a single range does.
RANGE_ROWS, RANGES = 200_000, 20_000


def cuts_of(df: DataFrame, key: str, n: int) -> list:
    """At most n - 1 values of a column that part the others into about equal ranges, ascending."""
    if n < 2:
        return []
    if isinstance(df.schema[key].dataType, NumericType):
        return sorted(set(df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10 * n)).first()[0] or []))
    ranges = df.where(F.col(key).isNotNull()).repartitionByRange(n, key).groupBy(F.spark_partition_id().alias("p"))
    return sorted(r["low"] for r in ranges.agg(F.min(key).alias("low")).collect())[1:]


def range_of(value: Column, cuts: list) -> Column:
    """Number of cuts below or at a value, by binary search in a constant array; 0 for null."""
    if not cuts:
        return F.lit(0)
    array = F.array(*map(F.lit, cuts))

    def step(span: Column, _: Column) -> Column:
        mid = F.floor((span["low"] + span["high"]) / 2).cast("int")
        above = F.coalesce(value >= F.get(array, mid), F.lit(False))
        halved = F.struct(F.when(above, mid + 1).otherwise(span["low"]).alias("low"), F.when(above, span["high"]).otherwise(mid).alias("high"))
        return F.when(span["low"] < span["high"], halved).otherwise(span)

    whole = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(cuts).bit_length())), whole, step, lambda span: span["low"])


def running_total(df: DataFrame, key: str, value: Column, out: str, rows: int | None = None) -> DataFrame:
    """Append the sum of ``value`` over all rows with a smaller ``key``, whose values are distinct.

    Rows are dealt in ranges of the key; only the ranges' sums, RANGES at most, meet in one task.
    ``rows`` is the number of rows, if it is known.
    """
    rows = df.count() if rows is None else rows
    cuts = cuts_of(df, key, min(RANGES, -(-rows // RANGE_ROWS)))
    within = F.coalesce(F.sum("value__").over(Window.partitionBy("range__").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = df.withColumn("value__", value).withColumn("range__", range_of(F.col(key), cuts))
    if not cuts:
        return dealt.withColumn(out, within.cast("long")).drop("value__", "range__")
    sums = dealt.groupBy("range__").agg(F.sum("value__").alias("sum__"))
    offsets = sums.select("range__", F.coalesce(F.sum("sum__").over(Window.orderBy("range__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset__"))
    return dealt.join(F.broadcast(offsets), "range__").withColumn(out, (within + F.col("offset__")).cast("long")).drop("value__", "range__", "offset__")
