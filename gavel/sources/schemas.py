"""Schemas of the nested meeting document and checks on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The enumerations of the document.
MEETING_TYPES = ["combined", "public_hearing", "special", "committee", "other"]
APPLICATION_TYPES = ["new", "renewal", "alteration", "transfer", "corporate_change", "other"]
TOPICS = ["liquor", "land_use", "transportation", "parks", "budget", "procedural", "cannabis", "other"]
POSITIONS = ["for", "against", "neutral", "unclear"]
SEVERITIES = ["fatality", "injury", "unspecified"]
OUTCOMES = ["passed", "failed"]

MEETING = "STRUCT<meeting_id STRING, date STRING, meeting_type STRING, location_or_platform STRING, attendance_count INT, quorum_noted BOOLEAN, chair STRING, source_files ARRAY<STRING>, date_source STRING, date_confidence DOUBLE, is_revised BOOLEAN>"
LICENSE = "STRUCT<applicant_name STRING, dba STRING, address STRING, application_type STRING, license_class STRING, features ARRAY<STRING>, committee_recommendation STRING, board_action STRING, source_snippet STRING>"
VOTE = "STRUCT<motion_text STRING, topic_category STRING, mover STRING, seconder STRING, yes INT, no INT, abstain INT, recusal INT, outcome STRING, unanimous BOOLEAN, conditions ARRAY<STRING>, source_snippet STRING>"
SPEAKER = "STRUCT<name STRING, affiliation STRING, topic STRING, position STRING, source_snippet STRING>"
INCIDENT = "STRUCT<victim_name STRING, incident_date STRING, location STRING, severity STRING, source_snippet STRING>"
CANNABIS = "STRUCT<applicant_name STRING, address STRING, application_type STRING, source_snippet STRING>"
ANNOUNCEMENT = "STRUCT<name STRING, affiliation STRING, topic STRING, source_snippet STRING>"
META = "STRUCT<model STRING, text_source STRING, pages_minutes_body INT, pages_attachments_dropped INT, input_tokens INT, output_tokens INT, cost_usd DOUBLE, schema_version STRING, prompt_version STRING, warnings ARRAY<STRING>>"
DOCUMENT = f"meeting {MEETING}, liquor_licenses ARRAY<{LICENSE}>, votes ARRAY<{VOTE}>, public_speakers ARRAY<{SPEAKER}>, traffic_incidents ARRAY<{INCIDENT}>, cannabis_licenses ARRAY<{CANNABIS}>, government_announcements ARRAY<{ANNOUNCEMENT}>, extraction_meta {META}"


def _flag(bad: Column, text: str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(text))


def errors(full: bool = True) -> Column:
    """What is wrong with a document, as an array of texts; empty where it is valid."""
    negative = F.exists("votes", lambda v: F.exists(F.array(v["yes"], v["no"], v["abstain"], v["recusal"]), lambda x: F.coalesce(x, F.lit(0)) < 0))
    checks = [
        _flag(F.col("meeting").isNull() | F.col("meeting.date").isNull(), "meeting.date: missing"),
        _flag(~F.col("meeting.date").rlike(r"^\d{4}-\d{2}-\d{2}$"), "meeting.date: not YYYY-MM-DD"),
        _flag(~F.col("meeting.meeting_type").isin(MEETING_TYPES), "meeting.meeting_type: unknown"),
        _flag(negative, "votes: negative tally"),
        _flag(F.exists("votes", lambda v: ~v["topic_category"].isin(TOPICS)), "votes.topic_category: unknown"),
        _flag(F.exists("votes", lambda v: ~v["outcome"].isin(OUTCOMES)), "votes.outcome: unknown"),
        _flag(F.exists("liquor_licenses", lambda v: ~v["application_type"].isin(APPLICATION_TYPES)), "liquor_licenses.application_type: unknown"),
        _flag(F.exists("public_speakers", lambda v: ~v["position"].isin(POSITIONS)), "public_speakers.position: unknown"),
    ]
    if full:
        checks.append(_flag(F.col("extraction_meta").isNull(), "extraction_meta: missing"))
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def defaults(docs: DataFrame) -> DataFrame:
    """Empty arrays and default values where a document leaves them out."""
    arrays = {"liquor_licenses": LICENSE, "votes": VOTE, "public_speakers": SPEAKER, "traffic_incidents": INCIDENT, "cannabis_licenses": CANNABIS, "government_announcements": ANNOUNCEMENT}
    d = docs.withColumns({c: F.coalesce(F.col(c), F.expr(f"CAST(array() AS ARRAY<{t}>)")) for c, t in arrays.items()})
    d = d.withColumn("votes", F.transform("votes", lambda v: v.withField("topic_category", F.coalesce(v["topic_category"], F.lit("other"))).withField("conditions", F.coalesce(v["conditions"], F.expr("CAST(array() AS ARRAY<STRING>)")))))
    d = d.withColumn("public_speakers", F.transform("public_speakers", lambda v: v.withField("position", F.coalesce(v["position"], F.lit("unclear")))))
    d = d.withColumn("liquor_licenses", F.transform("liquor_licenses", lambda v: v.withField("application_type", F.coalesce(v["application_type"], F.lit("other"))).withField("features", F.coalesce(v["features"], F.expr("CAST(array() AS ARRAY<STRING>)")))))
    return d.withColumn("meeting", F.col("meeting").withField("meeting_type", F.coalesce("meeting.meeting_type", F.lit("combined"))))
