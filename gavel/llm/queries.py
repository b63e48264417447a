"""The queries of the eight data problems, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, table
from . import canonical, formatting_copies, leakage, names, packing, pii, places, residue

PARTIES = {"applicant_name": "party", "dba": "party", "address": "address"}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    speakers = pii.details(table(spark, d, "speakers"), "speaker_id", {"source_snippet": "speakers.source_snippet"})
    incidents = pii.details(table(spark, d, "incidents"), "incident_id", {"victim_name": "incidents.victim_name", "source_snippet": "incidents.source_snippet"})
    return speakers.unionByName(incidents)


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Incidents with placeholders in place of the details."""
    t = table(spark, d, "incidents").select("incident_id", "victim_name", "source_snippet")
    return pii.redact(t, ["victim_name", "source_snippet"])


def p1_redacted_speakers(spark: SparkSession, d: str) -> DataFrame:
    """Speakers' snippets with placeholders in place of the details; with `p1_redacted`, every field that `p1_found` reads."""
    return pii.redact(table(spark, d, "speakers").select("speaker_id", "source_snippet"), ["source_snippet"])


def _typed(spark: SparkSession, d: str) -> DataFrame:
    return canonical.typed_values(table(spark, d, "licenses"), "license_id", ["board_action", "committee_recommendation"], ["features"])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_values(_typed(spark, d), table(spark, d, "canon_values")).withColumnRenamed("id", "license_id")


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Typed values without an entry, and how often each occurs."""
    t = _typed(spark, d)
    none = canonical.map_values(t, table(spark, d, "canon_values")).filter("canon_id = 0")
    return t.join(none.select("id", "field", "pos"), ["id", "field", "pos"], "left_semi").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def _counted(spark: SparkSession, d: str, t: str, c: str) -> DataFrame:
    return table(spark, d, t).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{t}.{c}").alias("field"), "value", "n")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    kinds = {"speakers.name": "person", "speakers.affiliation": "organisation", "licenses.applicant_name": "applicant"}
    values = None
    for f in kinds:
        v = _counted(spark, d, *f.split("."))
        values = v if values is None else values.unionByName(v)
    return names.variants(values, kinds, _counted(spark, d, "licenses", "dba").select("value", "n").filter("value IS NOT NULL"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return formatting_copies.found(table(spark, d, "licenses"), "license_id", ["meeting_id"], PARTIES)


def p4_collapsed(spark: SparkSession, d: str) -> DataFrame:
    """One licence of each group, with the number of its copies."""
    t = table(spark, d, "licenses").select("license_id", "meeting_id", "applicant_name", "dba", "address")
    return formatting_copies.collapse(t, "license_id", ["meeting_id"], PARTIES)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    cols = (("licenses", "address"), ("cannabis", "address"), ("incidents", "location"))
    values = None
    for t, c in cols:
        v = table(spark, d, t).select(F.col(c).alias("value"))
        values = v if values is None else values.unionByName(v)
    return places.same_place(values)


def p6_packed(spark: SparkSession, d: str) -> DataFrame:
    sizes = cut(packing.token_counts(table(spark, d, "documents")))
    return packing.pack(sizes, table(spark, d, "pack_sizes"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p7_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(_leaks(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "documents")).select("doc_id").distinct()


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    """Ids of the documents that hold content."""
    return residue.content_only(table(spark, d, "documents").select("doc_id", "text")).select("doc_id")


def queries() -> dict:
    return {n: f for n, f in globals().items() if n[0] == "p" and n[1:2].isdigit() and callable(f)}


_BARE = "coalesce(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]', '', 'g'), '')"
_P4 = f"""WITH b AS (SELECT license_id, meeting_id, applicant_name, dba, address, {_BARE.format(c="applicant_name")} AS a, {_BARE.format(c="dba")} AS t, {_BARE.format(c="address")} AS p FROM licenses),
w AS (SELECT *, min(license_id) OVER g AS first_id, count(*) OVER g AS copies FROM b WINDOW g AS (PARTITION BY meeting_id, least(a, t), greatest(a, t), p))
"""


_TYPED = """SELECT license_id, 'board_action' AS field, CAST(0 AS BIGINT) AS pos, board_action AS value FROM licenses UNION ALL SELECT license_id, 'committee_recommendation', CAST(0 AS BIGINT), committee_recommendation FROM licenses
UNION ALL SELECT license_id, 'features', CAST(unnest(generate_series(1, len(features))) AS BIGINT), unnest(features) FROM licenses"""


def oracle_sql() -> dict[str, str]:
    found = canonical.oracle("license_id", "licenses", "canon_values", ["board_action", "committee_recommendation"], ["features"])
    return {
        "p2_found": found,
        "p2_unmatched": f"SELECT u.field, u.value, count(*) AS n FROM ({found}) f JOIN ({_TYPED}) u ON u.license_id = f.license_id AND u.field = f.field AND u.pos = f.pos WHERE f.canon_id = 0 GROUP BY u.field, u.value",
        "p4_found": _P4 + "SELECT first_id, license_id AS copy_id FROM w WHERE license_id <> first_id",
        "p4_collapsed": _P4 + "SELECT license_id, meeting_id, applicant_name, dba, address, CAST(copies AS BIGINT) AS copies FROM w WHERE license_id = first_id",
    }
