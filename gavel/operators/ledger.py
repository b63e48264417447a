"""A ledger of paid calls: cost from a price table, reports, and the running budget. Prices are the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KINDS = ("input", "output", "cache_write", "cache_read")


def cost(prices: dict[str, float], batch: Column, discount: float = 0.5) -> Column:
    """Cost of a call from its token columns (`<kind>_tokens`) and prices a million tokens, halved in batches, to six places."""
    total = sum((F.coalesce(F.col(f"{k}_tokens"), F.lit(0)) * F.lit(float(prices[k])) for k in KINDS), F.lit(0.0))
    return F.round(total * F.when(batch, F.lit(discount)).otherwise(F.lit(1.0)) / 1e6, 6)


def report(ledger: DataFrame, by: str = "stage") -> DataFrame:
    """Calls, tokens and cost a stage, and their total."""
    g = ledger.rollup(by).agg(F.count(F.lit(1)).alias("calls"), F.sum(F.col("input_tokens") + F.col("output_tokens")).cast("bigint").alias("tokens"), F.round(F.sum("cost_usd"), 6).alias("cost"), F.grouping_id().alias("_g"))
    return g.select(F.when(F.col("_g") > 0, "TOTAL").otherwise(F.col(by)).alias(by), "calls", "tokens", "cost")


def guard(ledger: DataFrame, cap: float, order: list[str], block: str) -> DataFrame:
    """Adds `refused`: the cost of all calls before this one has reached the cap.

    The running sum is made in two steps, inside blocks (a day, an hour) that follow one another in `order`, and over
    the sums of blocks, so no window holds the whole ledger.
    """
    sums = ledger.groupBy(block).agg(F.sum("cost_usd").alias("_s"))
    base = sums.select(block, F.coalesce(F.sum("_s").over(W.orderBy(block).rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("_before"))
    inside = F.coalesce(F.sum("cost_usd").over(W.partitionBy(block).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    return ledger.withColumn("_in", inside).join(base, block).withColumn("refused", F.round(F.col("_in") + F.col("_before"), 9) >= cap).drop("_in", "_before")
