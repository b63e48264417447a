"""Small-sample statistics over DataFrames: ranks, rank correlation, rank-sum test, odds ratios, clustered logit, exact test.

Sufficient statistics are aggregated in Spark; only k x k matrices and a handful of sums reach the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def average_ranks(df: DataFrame, column: str, name: str) -> DataFrame:
    """Average ranks, ties sharing theirs. Ranks come from counts of distinct values, so the global window sees values, not rows."""
    from pyspark.sql import Window as W

    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy(column).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranks = counts.select(column, (before + (F.col("_n") + 1) / 2.0).alias(name))
    return df.join(ranks, column, "left")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """(rho, n) over rows without nulls."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    r = average_ranks(average_ranks(d, x, "_rx"), y, "_ry")
    return r.agg(F.corr("_rx", "_ry").alias("rho"), F.count(F.lit(1)).alias("n"))


def _beta_cf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 300):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return h


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p of Student's t."""
    if math.isinf(t):
        return 0.0
    a, b, x = df / 2, 0.5, df / (df + t * t)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    if not 0 < x < 1:
        return 1.0 if x >= 1 else 0.0
    p = front * _beta_cf(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_cf(b, a, 1 - x) / b
    return min(1.0, max(0.0, p))


def spearman_p(rho: float, n: int) -> float:
    return t_two_sided(rho * math.sqrt((n - 2) / max(1e-300, 1 - rho * rho)), n - 2) if n > 2 else float("nan")


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def mann_whitney(df: DataFrame, value: str, first: Column) -> DataFrame:
    """(u, n1, n2, z, p): rank-sum statistic of the rows where `first` holds, tie-corrected one-sided normal p (first larger)."""
    d = df.filter(F.col(value).isNotNull()).select(value, first.cast("int").alias("_g")).filter("_g IS NOT NULL")
    r = average_ranks(d, value, "_r")
    ties = d.groupBy(value).agg(F.count(F.lit(1)).cast("double").alias("t")).agg(F.sum(F.expr("t * t * t - t")).alias("ties"))
    s = r.agg(F.sum(F.expr("IF(_g = 1, _r, 0)")).alias("r1"), F.sum("_g").cast("bigint").alias("n1"), F.count(F.lit(1)).alias("n")).withColumn("_k", F.lit(1)).join(ties.withColumn("_k", F.lit(1)), "_k")
    s = s.withColumn("n2", F.col("n") - F.col("n1")).withColumn("u", F.expr("r1 - n1 * (n1 + 1) / 2.0"))
    sd = F.sqrt(F.expr("n1 * n2 / 12.0 * ((n + 1) - ties / (n * (n - 1.0)))"))
    s = s.withColumn("z", F.when(sd > 0, (F.expr("u - n1 * n2 / 2.0") - 0.5) / sd))

    @F.pandas_udf("double")
    def tail(z: pd.Series) -> pd.Series:
        return z.map(lambda x: None if x is None or x != x else normal_sf(x))

    return s.select("u", "n1", "n2", "z", tail("z").alias("p"))


def fisher_exact(a: int, b: int, c: int, d: int) -> tuple[float, float]:
    """Odds ratio and two-sided p of a 2 x 2 table."""
    row, col, n = a + b, a + c, a + b + c + d
    logp = lambda k: sum(math.lgamma(x + 1) for x in (row, n - row, col, n - col)) - math.lgamma(n + 1) - sum(math.lgamma(x + 1) for x in (k, row - k, col - k, n - row - col + k))
    here = logp(a)
    p = sum(math.exp(q) for k in range(max(0, row + col - n), min(row, col) + 1) if (q := logp(k)) <= here + 1e-7)
    odds = a * d / (b * c) if b * c else (math.inf if a * d else math.nan)
    return odds, min(1.0, p)


def design(df: DataFrame, y: str, numeric: list[str], categories: dict[str, tuple[str, list[str]]], cluster: str) -> tuple[DataFrame, list[str]]:
    """(y, cluster, x) with treatment-coded dummies. categories: column -> (reference level, other levels)."""
    terms = ["Intercept", *numeric, *[f"{c}[{v}]" for c, (_, vs) in categories.items() for v in vs]]
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in numeric], *[(F.col(c) == v).cast("double") for c, (_, vs) in categories.items() for v in vs]]
    return df.select(F.col(y).cast("double").alias("y"), F.col(cluster).alias("c"), F.array(*x).alias("x")).filter(F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull())), terms


def _step(x: np.ndarray, n: np.ndarray, y: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Score, information and log-likelihood of covariate patterns with n rows and y successes each."""
    eta = np.clip(x @ beta, -35, 35)
    mu = 1 / (1 + np.exp(-eta))
    return x.T @ (y - n * mu), (x * (n * mu * (1 - mu))[:, None]).T @ x, float((y * eta - n * np.log1p(np.exp(eta))).sum())


def _sums(patterns: DataFrame, beta: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    def part(batches):
        for p in batches:
            g, h, ll = _step(np.stack(p["x"].to_numpy()) if len(p) else np.zeros((0, k)), p["n"].to_numpy(float), p["s"].to_numpy(float), beta)
            yield pd.DataFrame({"g": [g.tolist()], "h": [h.ravel().tolist()], "ll": [ll]})

    t = patterns.mapInPandas(part, "g array<double>, h array<double>, ll double").agg(*[F.sum(F.col("g")[i]).alias(f"g{i}") for i in range(k)], *[F.sum(F.col("h")[i]).alias(f"h{i}") for i in range(k * k)], F.sum("ll").alias("ll")).first()
    return np.array([t[f"g{i}"] for i in range(k)]), np.array([t[f"h{i}"] for i in range(k * k)]).reshape(k, k), t["ll"]


def clustered_logit(d: DataFrame, terms: list[str], rounds: int = 25, max_patterns: int = 10_000) -> list[dict]:
    """Coefficients, cluster-robust standard errors, odds ratios, 95 % limits and p of a design.

    Rows are first counted by covariate pattern. Newton steps run on the patterns, on the driver up to `max_patterns`
    of them, else as k scores and k x k information summed over partitions. The sandwich needs one sum of scores a
    cluster, aggregated in Spark and multiplied out there.
    """
    from ..session import cut

    k = len(terms)
    patterns = cut(d.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")))
    few = patterns.limit(max_patterns + 1).collect()
    n = patterns.agg(F.sum("n")).first()[0] or 0
    if not n:
        return []
    local = len(few) <= max_patterns
    x, cnt, hit = (np.array([r["x"] for r in few], float), np.array([r["n"] for r in few], float), np.array([r["s"] for r in few], float)) if local else (None, None, None)
    beta, last = np.zeros(k), -math.inf
    for _ in range(rounds):
        g, h, ll = _step(x, cnt, hit, beta) if local else _sums(patterns, beta, k)
        if ll - last < 1e-10 * (abs(ll) + 0.1):
            break
        last = ll
        beta = beta + np.linalg.pinv(h) @ g
    bread = np.linalg.pinv(h)
    eta = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(b)) for b in beta]), lambda x, b: x * b), F.lit(0.0), lambda a, v: a + v)
    res = F.col("y") - 1 / (1 + F.exp(-eta))
    scores = d.withColumn("_r", res).groupBy("c").agg(*[F.sum(F.col("x")[i] * F.col("_r")).alias(f"s{i}") for i in range(k)])
    meat = scores.agg(F.count(F.lit(1)).alias("g"), *[F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    m = np.array([[meat[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], dtype=float)
    groups = meat["g"]
    factor = groups / (groups - 1) * (n - 1) / (n - k) if groups > 1 and n > k else math.nan
    cov = bread @ m @ bread * factor
    out = []
    for i, t in enumerate(terms):
        se = math.sqrt(max(cov[i, i], 0.0)) if cov[i, i] == cov[i, i] else math.nan
        z = beta[i] / se if se else math.nan
        out.append({"term": t, "coef": float(beta[i]), "se": se, "odds": math.exp(min(beta[i], 700)), "low": math.exp(min(beta[i] - 1.96 * se, 700)), "high": math.exp(min(beta[i] + 1.96 * se, 700)), "p": 2 * normal_sf(abs(z))})
    return out
