"""Joins on a band of days, without a nested loop.

Both sides are cut into blocks of width+1 days: a left day d meets right days d-width..d, which lie in its own block or
the one before. The right side is repeated into its block and the next, so the join is an equality on block (and key)
with the exact band as a residual. Where a block or key is hot, the skew-join rule of adaptive execution splits it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _block(day: Column, width: Column | int) -> Column:
    return F.floor(F.unix_date(day) / (width + 1 if isinstance(width, int) else width + F.lit(1)))


def band_pairs(left: DataFrame, right: DataFrame, left_day: str, right_day: str, width: int, keys: list[str] | None = None) -> DataFrame:
    """Left and right rows with 0 <= left_day - right_day <= width (days), and equal keys where given. Null days meet nothing."""
    keys = keys or []
    a = left.withColumn("_block", _block(F.col(left_day), width))
    b = right.withColumn("_block", F.explode(F.array(_block(F.col(right_day), width), _block(F.col(right_day), width) + 1)))
    return a.join(b, [*keys, "_block"]).filter(F.datediff(left_day, right_day).between(0, width)).drop("_block")


def band_count(left: DataFrame, right: DataFrame, left_id: str, left_day: str, right_day: str, width: int, name: str = "n") -> DataFrame:
    """Every left row with the number of right rows in its band, zero included.

    The right side is counted by day before the join, so what meets is days, not rows.
    """
    days = right.filter(F.col(right_day).isNotNull()).groupBy(F.col(right_day).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    n = band_pairs(left.select(left_day).distinct(), days, left_day, "_day", width).groupBy(left_day).agg(F.sum("_n").alias(name))
    return left.join(n, left_day, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def band_sweep(left: DataFrame, right: DataFrame, left_id: str, left_day: str, right_day: str, widths: list[int]) -> DataFrame:
    """(left_id, width, n) for several widths: one join at the widest, counted conditionally."""
    days = right.filter(F.col(right_day).isNotNull()).groupBy(F.col(right_day).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    pairs = band_pairs(left.select(left_day).distinct(), days, left_day, "_day", max(widths))
    gap = F.datediff(left_day, "_day")
    wide = pairs.groupBy(left_day).agg(*[F.coalesce(F.sum(F.when(gap <= w, F.col("_n"))), F.lit(0)).alias(f"w{w}") for w in widths])
    got = left.select(left_id, left_day).join(wide, left_day, "left")
    each = F.explode(F.array(*[F.struct(F.lit(w).cast("bigint").alias("width"), F.coalesce(F.col(f"w{w}"), F.lit(0)).cast("bigint").alias("n")) for w in widths]))
    return got.select(left_id, each.alias("e")).select(left_id, "e.width", "e.n")
