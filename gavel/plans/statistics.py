"""Statistics and the cost ledger over the record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import ledger as L
from ..operators import statistics as S
from ..session import table
from .catalogue import query
from .records import _FLAGS, outcome_class, regression_frame, votes


@query("""WITH r AS (SELECT rank() OVER (ORDER BY yes) + (count(*) OVER (PARTITION BY yes) - 1) / 2.0 AS a, rank() OVER (ORDER BY no) + (count(*) OVER (PARTITION BY no) - 1) / 2.0 AS b FROM votes WHERE yes IS NOT NULL AND no IS NOT NULL)
          SELECT round(corr(a, b), 6) AS rho, count(*) AS n FROM r""")
def rank_correlation(spark: SparkSession, d: str) -> DataFrame:
    r = S.spearman(table(spark, d, "votes"), "yes", "no")
    return r.select(F.round("rho", 6).alias("rho"), "n")


@query("""WITH x AS (SELECT no AS v, outcome = 'failed' AS g FROM votes WHERE no IS NOT NULL AND outcome IS NOT NULL),
          r AS (SELECT v, g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM x), n AS (SELECT count(*) FILTER (WHERE g) AS n1, count(*) AS n, sum(rk) FILTER (WHERE g) AS r1 FROM r),
          t AS (SELECT sum(c * c * c - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM x GROUP BY v))
          SELECT CAST(r1 - n1 * (n1 + 1) / 2.0 AS DOUBLE) AS u, n1, n - n1 AS n2, round((r1 - n1 * (n1 + 1) / 2.0 - n1 * (n - n1) / 2.0 - 0.5) / sqrt(n1 * (n - n1) / 12.0 * (n + 1 - ties / (n * (n - 1.0)))), 5) AS z FROM n, t""")
def mann_whitney_u(spark: SparkSession, d: str) -> DataFrame:
    m = S.mann_whitney(table(spark, d, "votes"), "no", F.col("outcome") == "failed")
    return m.select("u", "n1", "n2", F.round("z", 5).alias("z"))


_Z = 1.959963984540054


@query(f"""SELECT application_type, k, n, round((p + {_Z * _Z} / (2 * n) - {_Z} * sqrt(p * (1 - p) / n + {_Z * _Z} / (4 * n * n))) / (1 + {_Z * _Z} / n), 6) AS low,
           round((p + {_Z * _Z} / (2 * n) + {_Z} * sqrt(p * (1 - p) / n + {_Z * _Z} / (4 * n * n))) / (1 + {_Z * _Z} / n), 6) AS high
           FROM (SELECT application_type, k, CAST(n AS BIGINT) AS n, k / CAST(n AS DOUBLE) AS p FROM (SELECT application_type, count(*) FILTER (WHERE contains(lower(board_action), 'den')) AS k, count(*) AS n FROM licenses WHERE board_action IS NOT NULL GROUP BY 1))""")
def wilson(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "licenses").filter("board_action IS NOT NULL").groupBy("application_type").agg(F.count_if(F.lower("board_action").contains("den")).alias("k"), F.count(F.lit(1)).alias("n"))
    low, high = C.wilson(F.col("k"), F.col("n"))
    return g.select("application_type", "k", "n", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("""SELECT round((a * CAST(d AS DOUBLE)) / (b * c), 6) AS odds FROM (SELECT count(*) FILTER (WHERE r AND o) AS a, count(*) FILTER (WHERE r AND NOT o) AS b, count(*) FILTER (WHERE NOT r AND o) AS c, count(*) FILTER (WHERE NOT r AND NOT o) AS d
          FROM (SELECT contains(lower(board_action), 'den') AS o, coalesce(len(list_filter(features, lambda f: contains(lower(f), 'roof'))) > 0, false) AS r FROM licenses WHERE board_action IS NOT NULL))""")
def odds_ratio(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "licenses").filter("board_action IS NOT NULL").select(F.lower("board_action").contains("den").alias("o"), C.any_contains(F.col("features"), "roof").alias("r"))
    g = t.agg(*[F.count_if((F.col("r") == r) & (F.col("o") == o)).cast("double").alias(n) for n, r, o in (("a", True, True), ("b", True, False), ("c", False, True), ("d", False, False))])
    return g.select(F.round(F.expr("try_divide(a * d, b * c)"), 6).alias("odds"))


@query()
def fisher(spark: SparkSession, d: str) -> DataFrame:
    t = regression_frame(spark, d).groupBy("has_rooftop", "denied").count().collect()
    n = {(r[0], r[1]): r[2] for r in t}
    odds, p = S.fisher_exact(*(n.get(k, 0) for k in ((1, 1), (1, 0), (0, 1), (0, 0))))
    return spark.createDataFrame([(float(odds), float(p))], "odds double, p double")


@query()
def logit_cluster(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "licenses").withColumn("o", outcome_class("board_action")).filter("o <> 'other'").select("meeting_id", "license_id")
    f = regression_frame(spark, d).join(t, "license_id")
    x, terms = S.design(f, "denied", [f"has_{w}" for w in _FLAGS], {"type": ("renewal", ["new", "alteration", "other"])}, "meeting_id")
    return spark.createDataFrame(S.clustered_logit(x, terms), "term string, coef double, se double, odds double, low double, high double, p double")


_PRICES = {"input": 2.0, "output": 4.0, "cache_write": 1.0, "cache_read": 0.5}


def _ledger(spark, d) -> DataFrame:
    m = table(spark, d, "meetings").select(F.col("text_source").alias("stage"), "meeting_id", "date", "input_tokens", "output_tokens", F.lit(0).alias("cache_write_tokens"), F.lit(None).cast("int").alias("cache_read_tokens"), F.coalesce("is_revised", F.lit(False)).alias("batch"))
    return m.withColumn("cost_usd", L.cost(_PRICES, F.col("batch")))


_LEDGER = "(SELECT text_source AS stage, meeting_id, date, coalesce(input_tokens, 0) AS i, coalesce(output_tokens, 0) AS o, round((coalesce(input_tokens, 0) * 2.0 + coalesce(output_tokens, 0) * 4.0) * CASE WHEN coalesce(is_revised, false) THEN 0.5 ELSE 1.0 END / 1000000.0, 6) AS cost FROM meetings)"


@query(f"SELECT coalesce(stage, 'TOTAL') AS stage, count(*) AS calls, CAST(sum(i + o) AS BIGINT) AS tokens, CAST(round(sum(cost), 6) AS DOUBLE) AS cost FROM {_LEDGER} GROUP BY ROLLUP (stage)")
def ledger_cost(spark: SparkSession, d: str) -> DataFrame:
    return L.report(_ledger(spark, d))


@query(f"SELECT meeting_id, CAST(round(coalesce(sum(cost) OVER (ORDER BY date, meeting_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 9) AS DOUBLE) >= 1.0 AS refused FROM {_LEDGER}")
def budget_guard(spark: SparkSession, d: str) -> DataFrame:
    x = _ledger(spark, d).withColumn("year", F.year("date"))
    return L.guard(x, 1.0, ["date", "meeting_id"], "year").select("meeting_id", "refused")
