"""Registry of the analytical queries: each with its Spark form and, where SQL can say it, an independent SQL form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


@query("""SELECT v.vote_id, m.date, v.topic_category, v.motion_text, CAST(v.yes AS BIGINT) AS yes, CAST(v.no AS BIGINT) AS no
          FROM votes v JOIN meetings m USING (meeting_id) WHERE v.no > 0""")
def contested_items(spark: SparkSession, d: str) -> DataFrame:
    v, m = table(spark, d, "votes"), table(spark, d, "meetings").select("meeting_id", "date")
    return v.filter("no > 0").join(m, "meeting_id").select("vote_id", "date", "topic_category", "motion_text", F.col("yes").cast("bigint").alias("yes"), F.col("no").cast("bigint").alias("no"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import documents, events, linkage, records, statistics, text  # noqa: F401  each registers its queries

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
