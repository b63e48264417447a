"""Nested documents into the six tables, with audited overrides, and out to Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLES = ("meetings", "licenses", "votes", "speakers", "incidents", "cannabis")
_ARRAYS = {"licenses": "liquor_licenses", "votes": "votes", "speakers": "public_speakers", "incidents": "traffic_incidents", "cannabis": "cannabis_licenses"}


def flatten(docs: DataFrame) -> dict[str, DataFrame]:
    """The six tables of (valid, defaulted) documents; the rows of a table keep their place as `ord`."""
    m = docs.select("meeting.*", "extraction_meta.*")
    out = {"meetings": m.withColumn("date", F.try_to_date("date", "yyyy-MM-dd")).drop("model", "schema_version", "prompt_version")}
    for name, array in _ARRAYS.items():
        out[name] = docs.select(F.col("meeting.meeting_id").alias("meeting_id"), F.posexplode(array).alias("ord", "r")).select("meeting_id", "ord", "r.*")
    return out


def override_votes(votes: DataFrame, additions: DataFrame, meetings: DataFrame) -> DataFrame:
    """Votes with the additions of loaded meetings; columns an addition lacks are null."""
    extra = additions.join(meetings.select("meeting_id"), "meeting_id", "left_semi")
    return votes.unionByName(extra, allowMissingColumns=True)


def override_dates(meetings: DataFrame, overrides: DataFrame) -> DataFrame:
    """Dates replaced by (meeting_id, date, reason), whose reason joins the warnings."""
    o = overrides.select("meeting_id", F.col("date").alias("_d"), F.col("reason").alias("_why"))
    j = meetings.join(o, "meeting_id", "left")
    warn = F.when(F.col("_why").isNotNull(), F.concat(F.coalesce("warnings", F.expr("CAST(array() AS ARRAY<STRING>)")), F.array("_why"))).otherwise(F.col("warnings"))
    return j.withColumn("date", F.coalesce("_d", "date")).withColumn("warnings", warn).drop("_d", "_why")


def finalize(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Identity fields from the manifest (meeting_id, date, is_revised), not from the extraction; a differing date leaves a warning."""
    m = manifest.select(F.col("meeting_id").alias("_id"), F.col("date").cast("string").alias("_date"), F.col("is_revised").alias("_rev"))
    j = docs.join(m, docs["meeting.meeting_id"] == m["_id"])
    differs = F.col("meeting.date") != F.col("_date")
    warn = F.concat(F.coalesce("extraction_meta.warnings", F.expr("CAST(array() AS ARRAY<STRING>)")), F.when(differs, F.array(F.format_string("date %s differs from the manifest's %s", "meeting.date", "_date"))).otherwise(F.expr("CAST(array() AS ARRAY<STRING>)")))
    j = j.withColumn("extraction_meta", F.col("extraction_meta").withField("warnings", warn))
    return j.withColumn("meeting", F.col("meeting").withField("date", F.col("_date")).withField("is_revised", F.col("_rev"))).drop("_id", "_date", "_rev")


def write_tables(tables: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """One Parquet folder a table; each is committed as a whole."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{path}/{name}.parquet")


def write_documents(docs: DataFrame, path: str) -> None:
    """One JSON line a document, in a folder a meeting."""
    docs.select(F.col("meeting.meeting_id").alias("meeting_id"), F.to_json(F.struct(*docs.columns)).alias("value")).write.mode("overwrite").partitionBy("meeting_id").text(path)


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)
