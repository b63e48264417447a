"""SQL functions under the names that queries written for another engine use, as temporary SQL functions (no Python in the plan)."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name(arguments) RETURNS type RETURN body
ALIASES = {
    "regexp_matches(s STRING, p STRING)": ("BOOLEAN", "s RLIKE p"),
    "strftime_month(d DATE)": ("STRING", "date_format(d, 'MMM yyyy')"),
    "list_contains_text(a ARRAY<STRING>, w STRING)": ("BOOLEAN", "coalesce(exists(a, x -> contains(lower(x), lower(w))), false)"),
    "list_len(a ARRAY<STRING>)": ("BIGINT", "CAST(size(a) AS BIGINT)"),
    "days_between(a DATE, b DATE)": ("BIGINT", "CAST(datediff(a, b) AS BIGINT)"),
    "safe_ratio(a DOUBLE, b DOUBLE)": ("DOUBLE", "try_divide(a, b)"),
    "regexp_first(s STRING, p STRING)": ("STRING", "regexp_extract(s, p, 0)"),
}


def register(spark: SparkSession) -> None:
    for head, (kind, body) in ALIASES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
