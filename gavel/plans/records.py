"""Analytical questions over the record tables: meetings, licenses, votes, speakers, incidents, cannabis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.bandjoin import band_count, band_pairs
from ..operators.bandjoin import band_sweep as sweep
from ..session import table
from .catalogue import query

#: Topic domains: the first whose word occurs wins.
DOMAINS = [("nightlife", ["liquor", "bar ", "terrace", "licence"]), ("land use", ["rezon", "housing", "unit", "tower"]), ("parks", ["park", "tree", "dog", "playground"]), ("streets", ["street", "bike", "truck", "bus ", "curb", "crossing"])]


def N():
    return F.count(F.lit(1))


def year(c: str = "date"):
    return F.year(c).cast("bigint").alias("year")


def dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "meetings").select("meeting_id", "date")


def latest(df: DataFrame, key: str) -> DataFrame:
    """One row an id of a file table, the one loaded last; of equal times the one that stands last.

    The ids delivered more than once are found from the id, the time and the row's place alone, and only their rows are held
    against that list, so the columns and filters of the caller reach the scan.
    """
    place = F.struct(F.col("loaded_at"), F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    twice = df.select(F.col(key).alias("_key"), place.alias("_place")).groupBy("_key").agg(F.max("_place").alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return df.withColumn("_place", place).join(twice, F.col(key) == F.col("_key"), "left").filter("_last IS NULL OR _place = _last").select(*df.columns)


def domain(c: str):
    return C.first_label(F.col(c), DOMAINS, "other")


_DOMAIN_SQL = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(coalesce({{c}}, '')), '{w}')" for w in ws) + f" THEN '{label}'" for label, ws in DOMAINS) + " ELSE 'other' END"
_LV = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vote_id ORDER BY loaded_at DESC) AS rn FROM votes) WHERE rn = 1)"
_LS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY loaded_at DESC) AS rn FROM speakers) WHERE rn = 1)"


def votes(spark, d):
    return latest(table(spark, d, "votes"), "vote_id")


def speakers(spark, d):
    return latest(table(spark, d, "speakers"), "speaker_id")


@query("SELECT vote_id, meeting_id, motion_text, loaded_at FROM " + _LV)
def latest_votes(spark: SparkSession, d: str) -> DataFrame:
    return votes(spark, d).select("vote_id", "meeting_id", "motion_text", "loaded_at")


@query(f"SELECT topic_category, count(*) AS n, CAST(sum(no) AS BIGINT) AS no_votes FROM {_LV} v JOIN meetings USING (meeting_id) WHERE no > 0 GROUP BY 1")
def contested_by_topic(spark: SparkSession, d: str) -> DataFrame:
    v = votes(spark, d).filter("no > 0").select("meeting_id", "topic_category", "no")
    return v.join(dates(spark, d), "meeting_id").groupBy("topic_category").agg(N().alias("n"), F.sum("no").cast("bigint").alias("no_votes"))


@query("SELECT count(*) AS meetings, min(date) AS first, max(date) AS last, count(DISTINCT year(date)) AS years FROM meetings")
def corpus_span(spark: SparkSession, d: str) -> DataFrame:
    return dates(spark, d).agg(N().alias("meetings"), F.min("date").alias("first"), F.max("date").alias("last"), F.countDistinct(F.year("date")).alias("years"))


_SOURCES = ["native", "embedded_ocr", "vision_ocr", "mixed"]


@query("SELECT CAST(year(date) AS BIGINT) AS year, " + ", ".join(f"count(*) FILTER (WHERE text_source = '{s}') AS {s}" for s in _SOURCES) + " FROM meetings WHERE date IS NOT NULL GROUP BY 1")
def year_source_pivot(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meetings").filter("date IS NOT NULL")
    return m.groupBy(year()).pivot("text_source", _SOURCES).count().na.fill(0)


@query("SELECT CAST(year(date) AS BIGINT) AS year, count(*) AS records, count(*) FILTER (WHERE application_type = 'new') AS new FROM licenses JOIN meetings USING (meeting_id) GROUP BY 1")
def docket_by_year(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "licenses").select("meeting_id", "application_type").join(dates(spark, d), "meeting_id")
    return t.groupBy(year()).agg(N().alias("records"), F.count_if(F.col("application_type") == "new").alias("new"))


@query(f"""SELECT CAST(year(date) AS BIGINT) AS year, count(*) FILTER (WHERE yes + no > 0) AS tallied, count(*) FILTER (WHERE yes + no > 0 AND no > 0) AS contested,
           round(100.0 * CAST(count(*) FILTER (WHERE yes + no > 0 AND no > 0) AS DOUBLE) / nullif(count(*) FILTER (WHERE yes + no > 0), 0), 2) AS pct FROM {_LV} v JOIN meetings USING (meeting_id) GROUP BY 1""")
def tallied_by_year(spark: SparkSession, d: str) -> DataFrame:
    v = votes(spark, d).select("meeting_id", "yes", "no").join(dates(spark, d), "meeting_id")
    tallied = F.col("yes") + F.col("no") > 0
    g = v.groupBy(year()).agg(F.count_if(tallied).alias("tallied"), F.count_if(tallied & (F.col("no") > 0)).alias("contested"))
    return g.withColumn("pct", F.round(100.0 * F.try_divide(F.col("contested").cast("double"), F.col("tallied")), 2))


@query(f"SELECT vote_id, date, motion_text, outcome FROM {_LV} v JOIN meetings USING (meeting_id) WHERE motion_text ILIKE '%permit%' OR motion_text ILIKE '%street%'")
def motion_search(spark: SparkSession, d: str) -> DataFrame:
    hit = F.col("motion_text").ilike("%permit%") | F.col("motion_text").ilike("%street%")
    return votes(spark, d).filter(hit).join(dates(spark, d), "meeting_id").select("vote_id", "date", "motion_text", "outcome")


@query("""SELECT y.year, count(c.cannabis_id) AS n FROM (SELECT unnest(generate_series(2012, 2028)) AS year) y
          LEFT JOIN (SELECT cannabis_id, year(date) AS year FROM cannabis JOIN meetings USING (meeting_id)) c ON c.year = y.year GROUP BY 1""")
def year_spine(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "cannabis").select("meeting_id").join(dates(spark, d), "meeting_id").groupBy(year()).agg(N().alias("n"))
    return spark.range(2012, 2029).withColumnRenamed("id", "year").join(n, "year", "left").na.fill(0, ["n"])


@query(f"""SELECT CAST(year(date) AS BIGINT) AS year, count(*) FILTER (WHERE position = 'for') AS pro, count(*) FILTER (WHERE position = 'against') AS against,
           count(*) FILTER (WHERE position = 'for') - count(*) FILTER (WHERE position = 'against') AS net
           FROM {_LS} s JOIN meetings USING (meeting_id) WHERE topic ILIKE '%terrace%' OR topic ILIKE '%liquor%' GROUP BY 1""")
def net_by_year(spark: SparkSession, d: str) -> DataFrame:
    s = speakers(spark, d).filter(F.col("topic").ilike("%terrace%") | F.col("topic").ilike("%liquor%")).join(dates(spark, d), "meeting_id")
    g = s.groupBy(year()).agg(F.count_if(F.col("position") == "for").alias("pro"), F.count_if(F.col("position") == "against").alias("against"))
    return g.withColumn("net", F.col("pro") - F.col("against"))


@query("""SELECT l.license_id, date, applicant_name, coalesce(dba, '') AS dba, application_type, board_action FROM licenses l JOIN meetings USING (meeting_id)
          WHERE address ILIKE '%neskiniton%'""")
def biography(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "licenses").filter(F.col("address").ilike("%neskiniton%")).join(dates(spark, d), "meeting_id")
    return t.select("license_id", "date", "applicant_name", F.coalesce("dba", F.lit("")).alias("dba"), "application_type", "board_action")


@query("""SELECT coalesce(text_source, 'TOTAL') AS text_source, count(*) AS meetings, CAST(sum(pages_minutes_body) AS BIGINT) AS pages, round(sum(cost_usd), 4) AS cost
          FROM meetings WHERE text_source IS NOT NULL GROUP BY ROLLUP (text_source)""")
def rollup_cost_source(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meetings").filter("text_source IS NOT NULL").rollup("text_source").agg(N().alias("meetings"), F.sum("pages_minutes_body").cast("bigint").alias("pages"), F.round(F.sum("cost_usd"), 4).alias("cost"), F.grouping_id().alias("g"))
    return m.select(F.when(F.col("g") > 0, "TOTAL").otherwise(F.col("text_source")).alias("text_source"), "meetings", "pages", "cost")


@query(f"SELECT count(*) AS speakers, count(DISTINCT meeting_id) AS meetings, count(DISTINCT name) AS names FROM {_LS}")
def speakers_meetings(spark: SparkSession, d: str) -> DataFrame:
    return speakers(spark, d).agg(N().alias("speakers"), F.countDistinct("meeting_id").alias("meetings"), F.countDistinct("name").alias("names"))


@query(f"SELECT {_DOMAIN_SQL.format(c='topic')} AS topic_domain, count(*) FILTER (WHERE position = 'against') AS against, count(*) FILTER (WHERE position = 'for') AS pro FROM {_LS} GROUP BY 1 HAVING count(*) >= 10")
def domain_case(spark: SparkSession, d: str) -> DataFrame:
    g = speakers(spark, d).groupBy(domain("topic").alias("topic_domain")).agg(N().alias("n"), F.count_if(F.col("position") == "against").alias("against"), F.count_if(F.col("position") == "for").alias("pro"))
    return g.filter("n >= 10").drop("n")


@query(f"""SELECT name, count(*) AS n, count(DISTINCT meeting_id) AS meetings, string_agg(DISTINCT position, ', ' ORDER BY position) AS positions FROM {_LS}
           WHERE name IS NOT NULL GROUP BY 1 ORDER BY n DESC, name LIMIT 20""")
def top_actors(spark: SparkSession, d: str) -> DataFrame:
    g = speakers(spark, d).filter("name IS NOT NULL").groupBy("name").agg(N().alias("n"), F.countDistinct("meeting_id").alias("meetings"), F.array_join(F.sort_array(F.collect_set("position")), ", ").alias("positions"))
    return g.orderBy(F.desc("n"), "name").limit(20)


@query(f"SELECT affiliation, count(*) AS n, count(DISTINCT name) AS people FROM {_LS} WHERE affiliation IS NOT NULL GROUP BY 1 HAVING count(*) >= 5")
def having_affiliation(spark: SparkSession, d: str) -> DataFrame:
    return speakers(spark, d).filter("affiliation IS NOT NULL").groupBy("affiliation").agg(N().alias("n"), F.countDistinct("name").alias("people")).filter("n >= 5")


_ADDRESS = r"[0-9]+[- ]?[0-9]* [A-Za-z]+ (Ave|St|Pl|Rd|Dr|Street|Avenue|Place|Road|Drive)"


@query(f"SELECT count(*) AS n, min(date) AS first FROM incidents JOIN meetings USING (meeting_id) WHERE regexp_extract(location, '{_ADDRESS}', 0) <> '' GROUP BY regexp_extract(location, '{_ADDRESS}', 0)")
def hidden_group_key(spark: SparkSession, d: str) -> DataFrame:
    key = F.regexp_extract("location", _ADDRESS, 0)
    t = table(spark, d, "incidents").filter(key != "").join(dates(spark, d), "meeting_id")
    return t.groupBy(key.alias("_k")).agg(N().alias("n"), F.min("date").alias("first")).drop("_k")


def outcome_class(c: str):
    """approve, deny or other; denial first, as 'not approved' holds both words. ('den' also stands in 'resident'.)"""
    low = F.lower(F.coalesce(F.col(c), F.lit("")))
    return F.when(low.contains("den") | low.contains("disapp"), "deny").when(low.contains("appr"), "approve").otherwise("other")


def _outcome_sql(c: str) -> str:
    low = f"lower(coalesce({c}, ''))"
    return f"CASE WHEN contains({low}, 'den') OR contains({low}, 'disapp') THEN 'deny' WHEN contains({low}, 'appr') THEN 'approve' ELSE 'other' END"


@query(f"SELECT {_outcome_sql('committee_recommendation')} AS committee, {_outcome_sql('board_action')} AS board, count(*) AS n FROM licenses GROUP BY 1, 2")
def cross_tab(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "licenses").groupBy(outcome_class("committee_recommendation").alias("committee"), outcome_class("board_action").alias("board")).agg(N().alias("n"))


@query(f"""SELECT application_type, count(*) AS decided, count(*) FILTER (WHERE o = 'deny') AS denied, round(100.0 * CAST(count(*) FILTER (WHERE o = 'deny') AS DOUBLE) / count(*), 2) AS pct
           FROM (SELECT application_type, {_outcome_sql('board_action')} AS o FROM licenses) WHERE o <> 'other' GROUP BY 1""")
def denial_rate(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "licenses").select("application_type", outcome_class("board_action").alias("o")).filter("o <> 'other'")
    g = t.groupBy("application_type").agg(N().alias("decided"), F.count_if(F.col("o") == "deny").alias("denied"))
    return g.withColumn("pct", F.round(100.0 * F.col("denied").cast("double") / F.col("decided"), 2))


_MENTIONED = "SELECT meeting_id FROM documents WHERE contains(lower(text), 'bike corral') GROUP BY 1"


def mentioned(spark, d, term="bike corral"):
    return table(spark, d, "documents").filter(F.contains(F.lower("text"), F.lit(term))).select("meeting_id").distinct()


@query(f"SELECT topic_category, count(*) AS n, count(*) FILTER (WHERE no > 0) AS contested FROM {_LV} v JOIN meetings USING (meeting_id) JOIN ({_MENTIONED}) x USING (meeting_id) GROUP BY 1")
def votes_where_mentioned(spark: SparkSession, d: str) -> DataFrame:
    v = votes(spark, d).select("meeting_id", "topic_category", "no")
    return v.join(dates(spark, d), "meeting_id").join(mentioned(spark, d), "meeting_id").groupBy("topic_category").agg(N().alias("n"), F.count_if(F.col("no") > 0).alias("contested"))


@query(f"SELECT vote_id, date, CAST(yes AS VARCHAR) || '-' || CAST(no AS VARCHAR) || '-' || CAST(abstain AS VARCHAR) AS tally, substr(motion_text, 1, 60) AS motion FROM {_LV} v JOIN meetings USING (meeting_id) JOIN ({_MENTIONED}) x USING (meeting_id) WHERE no > 0")
def contested_motions(spark: SparkSession, d: str) -> DataFrame:
    v = votes(spark, d).filter("no > 0").join(dates(spark, d), "meeting_id").join(mentioned(spark, d), "meeting_id", "left_semi")
    return v.select("vote_id", "date", F.concat_ws("-", F.col("yes").cast("string"), F.col("no").cast("string"), F.col("abstain").cast("string")).alias("tally"), F.substring("motion_text", 1, 60).alias("motion"))


@query(f"SELECT name, count(DISTINCT meeting_id) AS meetings, min(date) AS first, max(date) AS last, CAST(max(date) - min(date) AS BIGINT) AS days FROM {_LS} s JOIN meetings USING (meeting_id) WHERE name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT meeting_id) >= 3")
def recurrent_speakers(spark: SparkSession, d: str) -> DataFrame:
    s = speakers(spark, d).filter("name IS NOT NULL").select("name", "meeting_id").join(dates(spark, d), "meeting_id")
    g = s.groupBy("name").agg(F.countDistinct("meeting_id").alias("meetings"), F.min("date").alias("first"), F.max("date").alias("last")).filter("meetings >= 3")
    return g.withColumn("days", F.datediff("last", "first").cast("bigint"))


@query(f"SELECT CAST(year(date) AS BIGINT) AS year, coalesce(position, 'unclear') AS position, count(*) AS n FROM {_LS} s JOIN meetings USING (meeting_id) GROUP BY 1, 2")
def positions_per_year(spark: SparkSession, d: str) -> DataFrame:
    return speakers(spark, d).select("meeting_id", F.coalesce("position", F.lit("unclear")).alias("position")).join(dates(spark, d), "meeting_id").groupBy(year(), "position").agg(N().alias("n"))


@query(f"SELECT CAST(year(date) AS BIGINT) AS year, topic_category, count(*) AS n FROM {_LV} v JOIN meetings USING (meeting_id) GROUP BY 1, 2")
def topic_votes_per_year(spark: SparkSession, d: str) -> DataFrame:
    return votes(spark, d).select("meeting_id", "topic_category").join(dates(spark, d), "meeting_id").groupBy(year(), "topic_category").agg(N().alias("n"))


_POS = ["for", "against", "neutral", "unclear"]


@query("SELECT meeting_id, " + ", ".join(f"count(*) FILTER (WHERE position = '{p}') AS \"{p}\"" for p in _POS) + f" FROM {_LS} GROUP BY 1")
def meeting_position_pivot(spark: SparkSession, d: str) -> DataFrame:
    return speakers(spark, d).groupBy("meeting_id").pivot("position", _POS).count().na.fill(0)


@query(f"SELECT vote_id, motion_text, yes, no, abstain, recusal, outcome FROM {_LV} WHERE meeting_id = (SELECT min(meeting_id) FROM votes)")
def meeting_votes(spark: SparkSession, d: str) -> DataFrame:
    v = votes(spark, d)
    one = table(spark, d, "votes").agg(F.min("meeting_id").alias("meeting_id"))
    return v.join(one, "meeting_id", "left_semi").select("vote_id", "motion_text", "yes", "no", "abstain", "recusal", "outcome")


@query(f"SELECT vote_id, CAST(unnest(generate_series(1, len(conditions))) AS BIGINT) AS pos, unnest(conditions) AS condition FROM {_LV} WHERE len(conditions) > 0")
def enumerate_conditions(spark: SparkSession, d: str) -> DataFrame:
    return votes(spark, d).select("vote_id", F.posexplode("conditions").alias("p", "condition")).select("vote_id", (F.col("p") + 1).cast("bigint").alias("pos"), "condition")


@query(f"""SELECT topic_category, count(*) AS n, round(avg(CAST(no > 0 AS INT)), 4) AS rate, round(stddev_samp(CAST(no > 0 AS INT)), 4) AS sd FROM {_LV} WHERE yes + no > 0 GROUP BY 1 HAVING count(*) >= 5""")
def rate_stddev(spark: SparkSession, d: str) -> DataFrame:
    x = (F.col("no") > 0).cast("int")
    g = votes(spark, d).filter("yes + no > 0").groupBy("topic_category").agg(N().alias("n"), F.round(F.avg(x), 4).alias("rate"), F.round(F.stddev_samp(x), 4).alias("sd"))
    return g.filter("n >= 5")


_FLAGS = ["rooftop", "live", "dj", "yard", "sidewalk", "late"]


@query(f"""SELECT license_id, {', '.join(f"CAST(coalesce(len(list_filter(features, lambda f: contains(lower(f), '{w}'))) > 0, false) AS INT) AS has_{w}" for w in _FLAGS)},
           CASE WHEN application_type IN ('new', 'renewal', 'alteration') THEN application_type ELSE 'other' END AS type,
           CASE WHEN year(date) > 2015 AND year(date) <= 2019 THEN 'early' WHEN year(date) > 2019 AND year(date) <= 2022 THEN 'middle' WHEN year(date) > 2022 AND year(date) <= 2027 THEN 'late' END AS era,
           CAST({_outcome_sql('board_action')} = 'deny' AS INT) AS denied FROM licenses JOIN meetings USING (meeting_id) WHERE {_outcome_sql('board_action')} <> 'other'""")
def regression_frame(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "licenses").withColumn("o", outcome_class("board_action")).filter("o <> 'other'").join(dates(spark, d), "meeting_id")
    flags = [C.any_contains(F.col("features"), w).cast("int").alias(f"has_{w}") for w in _FLAGS]
    era = C.right_closed_bins(F.year("date"), [2015, 2019, 2022, 2027], ["early", "middle", "late"])
    return t.select("license_id", *flags, C.collapse_rare(F.col("application_type"), ["new", "renewal", "alteration"]).alias("type"), era.alias("era"), (F.col("o") == "deny").cast("int").alias("denied"))


_NUM = r"([0-9]+) [A-Za-z]"


@query(f"""WITH l AS (SELECT license_id, date, regexp_extract(address, '{_NUM}', 1) AS k, {_outcome_sql('board_action')} AS o FROM licenses JOIN meetings USING (meeting_id)),
           s AS (SELECT date AS sd, regexp_extract(source_snippet, '{_NUM}', 1) AS k FROM {_LS} s JOIN meetings USING (meeting_id) WHERE position = 'against')
           SELECT EXISTS (SELECT 1 FROM s WHERE s.k = l.k AND s.k <> '' AND l.date - s.sd BETWEEN 0 AND 90) AS opposed, count(*) AS n, count(*) FILTER (WHERE o = 'deny') AS denied FROM l WHERE o <> 'other' GROUP BY 1""")
def opposed_denied(spark: SparkSession, d: str) -> DataFrame:
    """Decisions with and without testimony against the house number in the 90 days before: an equality and band semi-join."""
    lic = table(spark, d, "licenses").join(dates(spark, d), "meeting_id").select("license_id", "date", F.regexp_extract("address", _NUM, 1).alias("k"), outcome_class("board_action").alias("o")).filter("o <> 'other'")
    s = speakers(spark, d).filter("position = 'against'").join(dates(spark, d), "meeting_id").select(F.col("date").alias("sd"), F.regexp_extract("source_snippet", _NUM, 1).alias("k")).filter("k <> ''").distinct()
    hit = band_pairs(lic.select("license_id", "date", "k").distinct(), s, "date", "sd", 90, ["k"]).select("license_id").distinct().withColumn("opposed", F.lit(True))
    t = lic.join(hit, "license_id", "left").withColumn("opposed", F.coalesce("opposed", F.lit(False)))
    return t.groupBy("opposed").agg(N().alias("n"), F.count_if(F.col("o") == "deny").alias("denied"))


_KIND_SQL = "CASE WHEN regexp_matches(lower(motion_text), 'application|permit|licen|approve') THEN 'application' ELSE 'advocacy' END"


@query(f"""WITH s AS (SELECT m.date AS sd, count(*) AS n FROM {_LS} s JOIN meetings m USING (meeting_id) GROUP BY 1),
           v AS (SELECT vote_id, date, {_KIND_SQL} AS kind, len(conditions) AS conditions, round((yes + no + abstain - greatest(yes, no)) / CAST(nullif(yes + no + abstain, 0) AS DOUBLE), 6) AS division FROM {_LV} v JOIN meetings USING (meeting_id) WHERE yes + no > 0)
           SELECT vote_id, date, kind, CAST(conditions AS BIGINT) AS conditions, division, CAST((SELECT coalesce(sum(n), 0) FROM s WHERE v.date - s.sd BETWEEN 0 AND 90) AS BIGINT) AS spk90 FROM v""")
def division_panel(spark: SparkSession, d: str) -> DataFrame:
    v = votes(spark, d).filter("yes + no > 0").join(dates(spark, d), "meeting_id")
    kind = F.when(F.lower("motion_text").rlike("application|permit|licen|approve"), "application").otherwise("advocacy")
    v = v.select("vote_id", "date", kind.alias("kind"), F.size("conditions").cast("bigint").alias("conditions"), F.round(C.division(F.col("yes"), F.col("no"), F.col("abstain")), 6).alias("division"))
    s = speakers(spark, d).select("meeting_id").join(dates(spark, d), "meeting_id").select(F.col("date").alias("sd"))
    return band_count(v, s, "vote_id", "date", "sd", 90, "spk90").select("vote_id", "date", "kind", "conditions", "division", "spk90")


@query(f"SELECT meeting_id, date, count(*) FILTER (WHERE position = 'for') AS pro, count(*) FILTER (WHERE position = 'against') AS against FROM {_LS} s JOIN meetings USING (meeting_id) GROUP BY 1, 2 HAVING count(*) FILTER (WHERE position IN ('for', 'against')) > 0")
def testimony_balance(spark: SparkSession, d: str) -> DataFrame:
    s = speakers(spark, d).filter(F.col("position").isin("for", "against")).select("meeting_id", "position").join(dates(spark, d), "meeting_id")
    return s.groupBy("meeting_id", "date").agg(F.count_if(F.col("position") == "for").alias("pro"), F.count_if(F.col("position") == "against").alias("against"))


@query(f"""WITH s AS (SELECT m.date AS sd, count(*) AS n FROM {_LS} s JOIN meetings m USING (meeting_id) GROUP BY 1)
           SELECT m.meeting_id, w.width, CAST((SELECT coalesce(sum(n), 0) FROM s WHERE m.date - s.sd BETWEEN 0 AND w.width) AS BIGINT) AS n
           FROM meetings m, (SELECT CAST(unnest([30, 60, 90, 180]) AS BIGINT) AS width) w""")
def band_sweep(spark: SparkSession, d: str) -> DataFrame:
    s = speakers(spark, d).select("meeting_id").join(dates(spark, d), "meeting_id").select(F.col("date").alias("sd"))
    return sweep(dates(spark, d), s, "meeting_id", "date", "sd", [30, 60, 90, 180])


@query(f"SELECT speaker_id, meeting_id, date, name, {_DOMAIN_SQL.format(c='topic')} AS entity, coalesce(position, 'unclear') AS position FROM {_LS} s JOIN meetings USING (meeting_id) WHERE name IS NOT NULL")
def speaker_frame(spark: SparkSession, d: str) -> DataFrame:
    return speakers(spark, d).filter("name IS NOT NULL").join(dates(spark, d), "meeting_id").select("speaker_id", "meeting_id", "date", "name", domain("topic").alias("entity"), F.coalesce("position", F.lit("unclear")).alias("position"))


@query(f"""WITH e AS (SELECT lower(name) AS who, 'speaker' AS channel, topic AS what FROM {_LS} WHERE name IS NOT NULL UNION ALL SELECT lower(mover), 'mover', topic_category FROM {_LV} WHERE mover IS NOT NULL
           UNION ALL SELECT lower(seconder), 'seconder', topic_category FROM {_LV} WHERE seconder IS NOT NULL)
           SELECT who, count(*) AS records, string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels, string_agg(DISTINCT what, '; ' ORDER BY what) AS topics FROM e GROUP BY 1 HAVING count(DISTINCT channel) > 1""")
def cross_channel(spark: SparkSession, d: str) -> DataFrame:
    v = votes(spark, d)
    e = speakers(spark, d).select(F.lower("name").alias("who"), F.lit("speaker").alias("channel"), F.col("topic").alias("what"))
    for c in ("mover", "seconder"):
        e = e.unionByName(v.select(F.lower(c).alias("who"), F.lit(c).alias("channel"), F.col("topic_category").alias("what")))
    g = e.filter("who IS NOT NULL").groupBy("who").agg(N().alias("records"), F.sort_array(F.collect_set("channel")).alias("c"), F.array_join(F.sort_array(F.collect_set("what")), "; ").alias("topics"))
    return g.filter(F.size("c") > 1).select("who", "records", F.array_join("c", ",").alias("channels"), "topics")


_ADD = [("cb1-2016-01-15", "override motion one", 20, 3), ("cb9-1900-01-01", "override for a meeting not loaded", 1, 1)]


@query("SELECT meeting_id, motion_text, yes, no FROM " + _LV + " UNION ALL SELECT o.* FROM (VALUES " + ", ".join(f"('{a}', '{b}', {y}, {n})" for a, b, y, n in _ADD) + ") o(meeting_id, motion_text, yes, no) WHERE o.meeting_id IN (SELECT meeting_id FROM meetings)")
def overrides_union(spark: SparkSession, d: str) -> DataFrame:
    """Audited additions, only for meetings that are loaded."""
    o = spark.createDataFrame(_ADD, "meeting_id string, motion_text string, yes int, no int")
    return votes(spark, d).select("meeting_id", "motion_text", "yes", "no").unionByName(o.join(dates(spark, d), "meeting_id", "left_semi"))


@query("SELECT meeting_id FROM meetings m WHERE NOT EXISTS (SELECT 1 FROM documents x WHERE x.meeting_id = m.meeting_id) UNION ALL SELECT meeting_id FROM meetings m WHERE NOT EXISTS (SELECT 1 FROM votes v WHERE v.meeting_id = m.meeting_id)")
def anti_worklist(spark: SparkSession, d: str) -> DataFrame:
    """Meetings whose pages or votes are still to be fetched."""
    m = dates(spark, d).select("meeting_id")
    return m.join(table(spark, d, "documents"), "meeting_id", "left_anti").unionByName(m.join(table(spark, d, "votes"), "meeting_id", "left_anti"))


@query("SELECT meeting_id, unnest(source_files) AS source_file, len(warnings) > 0 AS warned FROM meetings")
def source_files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "meetings").select("meeting_id", F.explode("source_files").alias("source_file"), (F.size("warnings") > 0).alias("warned"))


@query("SELECT meeting_id, count(*) AS late, CAST(max(CAST(loaded_at AS DATE) - date) AS BIGINT) AS worst FROM licenses JOIN meetings USING (meeting_id) WHERE CAST(loaded_at AS DATE) - date > 60 GROUP BY 1")
def late_arrivals(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "licenses").select("meeting_id", "loaded_at").join(dates(spark, d), "meeting_id").withColumn("days", F.datediff(F.to_date("loaded_at"), "date")).filter("days > 60")
    return t.groupBy("meeting_id").agg(N().alias("late"), F.max("days").cast("bigint").alias("worst"))


@query("""SELECT incident_id, incident_date, CASE WHEN regexp_matches(incident_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN try_cast(incident_date AS DATE)
          WHEN regexp_matches(incident_date, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$') THEN try_cast(substr(incident_date, 7, 4) || '-' || substr(incident_date, 1, 2) || '-' || substr(incident_date, 4, 2) AS DATE) END AS day FROM incidents""")
def incident_days(spark: SparkSession, d: str) -> DataFrame:
    """Dates typed in one of two full formats; others stay without a day."""
    x = F.col("incident_date")
    day = F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(x, "yyyy-MM-dd")).when(x.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date(x, "MM/dd/yyyy"))
    return table(spark, d, "incidents").select("incident_id", "incident_date", day.alias("day"))


@query("SELECT meeting_id, vote_id, no, CAST(rank() OVER (PARTITION BY meeting_id ORDER BY no DESC, vote_id) AS BIGINT) AS place FROM " + _LV + " QUALIFY place <= 3")
def most_contested(spark: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("meeting_id").orderBy(F.desc("no"), "vote_id")
    return votes(spark, d).select("meeting_id", "vote_id", "no", F.rank().over(w).cast("bigint").alias("place")).filter("place <= 3")


@query(f"SELECT coalesce(position, 'unclear') AS position, count(*) AS n, count(DISTINCT meeting_id) AS meetings FROM {_LS} s WHERE contains(lower(coalesce(topic, '')), 'liquor') GROUP BY 1")
def topic_positions(spark: SparkSession, d: str) -> DataFrame:
    """Positions taken on one topic."""
    s = speakers(spark, d).filter(F.lower("topic").contains("liquor"))
    return s.groupBy(F.coalesce("position", F.lit("unclear")).alias("position")).agg(N().alias("n"), F.countDistinct("meeting_id").alias("meetings"))


@query(f"""SELECT topic_category AS kind, count(*) AS n, count(*) FILTER (WHERE yes > 0 AND no > 0) AS divided, round(avg((yes + no + coalesce(abstain, 0) - greatest(yes, no)) / CAST(yes + no + coalesce(abstain, 0) AS DOUBLE)), 6) AS mean_division, CAST(sum(coalesce(len(conditions), 0)) AS BIGINT) AS conditions
           FROM {_LV} v WHERE yes + no > 0 GROUP BY 1""")
def panel_summary(spark: SparkSession, d: str) -> DataFrame:
    """Divided votes, mean division and conditions of each kind of vote."""
    v = votes(spark, d).filter("yes + no > 0")
    share = C.division(F.col("yes"), F.col("no"), F.coalesce("abstain", F.lit(0)))
    return v.groupBy(F.col("topic_category").alias("kind")).agg(N().alias("n"), F.count_if((F.col("yes") > 0) & (F.col("no") > 0)).alias("divided"), F.round(F.avg(share), 6).alias("mean_division"), F.sum(F.greatest(F.coalesce(F.size("conditions"), F.lit(0)), F.lit(0))).alias("conditions"))


#: Streets of an area of interest; any list will do.
_STREETS = ["harbor", "pier", "river", "street", "quay"]


@query("SELECT " + " OR ".join(f"contains(lower(coalesce(address, '')), '{w}')" for w in _STREETS) + " AS inside, count(*) AS n, count(*) FILTER (WHERE contains(lower(coalesce(board_action, '')), 'den')) AS denied FROM licenses GROUP BY 1")
def area_masks(spark: SparkSession, d: str) -> DataFrame:
    """Licences whose address names a street of an area, and those that do not, with their denials."""
    low = F.lower(F.coalesce("address", F.lit("")))
    inside = low.contains(_STREETS[0])
    for w in _STREETS[1:]:
        inside = inside | low.contains(w)
    denied = F.coalesce(F.lower("board_action").contains("den"), F.lit(False))
    return table(spark, d, "licenses").groupBy(inside.alias("inside")).agg(N().alias("n"), F.count_if(denied).alias("denied"))
