"""Places in an order, without a task that holds all rows.

Values are counted first, so that ties are one row; the different values are cut into ranges at approximate quantiles, added up
within each range, and the sums of the ranges before are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that an order is cut into: tasks that work on it side by side.
RANGES = 64


def hash_number(text: Column) -> Column:
    """The first 32 bits of the md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def placed(rows: DataFrame, key: str, weight: Column) -> tuple[DataFrame, float | int]:
    """rows with before, the sum of weight over rows with a smaller key (strings go by a hash), and the sum over all rows."""
    text = dict(rows.dtypes)[key] == "string"
    order = (hash_number(F.col(key)) if text else F.col(key)).cast("double")
    shares = [k / RANGES for k in range(1, RANGES)]
    cuts, total = rows.agg(F.percentile_approx(order, shares, 10_000), F.sum(weight)).first()
    if not cuts:
        return rows.withColumn("before", weight), 0
    rows = rows.withColumn("range_", F.size(F.filter(F.array(*(F.lit(float(c)) for c in cuts)), lambda c: c < order)))
    sums = rows.groupBy("range_").agg(F.sum(weight).alias("sum_"))  # a row per range
    earlier = Window.partitionBy(F.lit(0)).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range_", F.coalesce(F.sum("sum_").over(earlier), F.lit(0)).alias("sum_"))
    within = Window.partitionBy("range_").orderBy(order, key).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(weight).over(within), F.lit(0))
    return rows.withColumn("before", inside).join(F.broadcast(sums), "range_").withColumn("before", F.col("before") + F.col("sum_")).drop("range_", "sum_"), total


def ranked(rows: DataFrame, column: str, name: str) -> DataFrame:
    """rows (column not null) with their rank; ties share the mean of theirs."""
    counts, _ = placed(rows.groupBy(column).agg(F.count("*").alias("n_")), column, F.col("n_"))
    return rows.join(counts.select(column, (F.col("before") + (F.col("n_") + 1) / 2.0).alias(name)), column)


def quantiles(rows: DataFrame, column: str, wanted: dict[str, float]) -> DataFrame:
    """One row: exact quantiles by name, interpolated between neighbours; null without values."""
    counts, total = placed(rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_")), column, F.col("n_"))
    value, out = F.col(column).cast("double"), []
    for name, q in wanted.items():
        place = q * ((total or 1) - 1)
        low, high = (F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("n_")), value)) for k in (math.floor(place), math.ceil(place)))
        out.append((low + (high - low) * (place - math.floor(place))).alias(name))
    return counts.agg(*out)
