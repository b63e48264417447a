"""Page and file operators over `documents`, and over inline file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import filenames as N
from ..operators import grouping as G
from ..operators import pages as P
from ..session import table
from .catalogue import query

_FLAT = "trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))"


def _hits_sql(words) -> str:
    return "(" + " + ".join(f"CAST(contains(lower(t), '{w}') AS INT)" for w in words) + ")"


_CLASSIFIED = f"""p AS (SELECT doc_id, meeting_id, coalesce(page_no, 0) AS page_no, {_FLAT} AS t FROM documents),
h AS (SELECT *, length(t) AS n, {_hits_sql(P.BODY_WORDS)} AS b, {_hits_sql(P.ATTACHMENT_WORDS)} AS a FROM p),
c AS (SELECT doc_id, meeting_id, page_no, CASE WHEN n < 20 THEN 'blank' WHEN regexp_matches(lower(t), '{P.VOTE_SHEET}') THEN 'vote_sheet' WHEN b >= 3 AND b > a THEN 'body' WHEN a > b THEN 'attachment' WHEN n < 800 AND b < 2 THEN 'attachment' WHEN b >= 1 AND n >= 800 THEN 'body' ELSE 'attachment' END AS label,
  CASE WHEN n < 20 THEN 1.0 WHEN regexp_matches(lower(t), '{P.VOTE_SHEET}') THEN 0.95 WHEN b >= 3 AND b > a THEN CASE WHEN n >= 800 OR b >= 5 THEN 0.85 ELSE 0.7 END WHEN a > b THEN 0.8 WHEN n < 800 AND b < 2 THEN 0.6 WHEN b >= 1 AND n >= 800 THEN 0.55 ELSE 0.4 END AS confidence FROM h)"""


def _pages(spark, d) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", "meeting_id", F.coalesce("page_no", F.lit(0)).alias("page_no"), P.classify(F.col("text")).alias("c"))
    return t.select("doc_id", "meeting_id", "page_no", "c.label", "c.confidence")


@query(f"WITH {_CLASSIFIED} SELECT doc_id, label, CAST(confidence AS DOUBLE) AS confidence FROM c")
def classify_pages(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("doc_id", "label", "confidence")


@query(f"""WITH {_CLASSIFIED}, w AS (SELECT *, last_value(CASE WHEN confidence >= 0.8 THEN label END IGNORE NULLS) OVER (PARTITION BY meeting_id ORDER BY page_no, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS x,
    first_value(CASE WHEN confidence >= 0.8 THEN label END IGNORE NULLS) OVER (PARTITION BY meeting_id ORDER BY page_no, doc_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS y FROM c),
    s AS (SELECT *, coalesce(confidence < 0.8 AND label <> 'blank' AND x = y AND x <> 'blank', false) AS smoothed FROM w)
    SELECT doc_id, CASE WHEN smoothed THEN x ELSE label END AS label, CAST(CASE WHEN smoothed THEN 0.75 ELSE confidence END AS DOUBLE) AS confidence, smoothed FROM s""")
def smooth_pages(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d).withColumn("at", F.struct("page_no", "doc_id"))
    return P.smooth(p, "meeting_id", "at").select("doc_id", "label", "confidence", "smoothed")


@query("""WITH r AS (SELECT meeting_id, length(trim(coalesce(text, ''), ' ')) < 20 AS bare, row_number() OVER (PARTITION BY meeting_id ORDER BY page_no NULLS FIRST, doc_id) AS i FROM documents)
          SELECT meeting_id, bool_and(bare) FILTER (WHERE i <= 3) OR avg(CAST(bare AS INT)) > 0.8 AS scan_first FROM r GROUP BY 1""")
def scan_first(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("meeting_id", F.struct("page_no", "doc_id").alias("at"), "text")
    return P.scan_first(t, "meeting_id", "at", "text")


@query(f"""WITH {_CLASSIFIED}, r AS (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY page_no, doc_id) AS i FROM c),
    l AS (SELECT *, i - coalesce(max(CASE WHEN label IN ('body', 'vote_sheet') THEN i END) OVER (PARTITION BY meeting_id ORDER BY i), 0) AS run FROM r WHERE i <= 40)
    SELECT meeting_id, CAST(coalesce(min(i) FILTER (WHERE run >= 3), max(i)) AS BIGINT) AS scanned FROM l GROUP BY 1""")
def front_scan(spark: SparkSession, d: str) -> DataFrame:
    return P.front_scan(_pages(spark, d).withColumn("at", F.struct("page_no", "doc_id")), "meeting_id", "at")


@query("SELECT meeting_id, string_agg('[p. ' || CAST(doc_id AS VARCHAR) || '] ' || coalesce(text, ''), chr(10) || chr(10) ORDER BY page_no NULLS FIRST, doc_id) AS body, count(*) AS pages FROM documents WHERE source = 'minutes_pdf' GROUP BY 1")
def stitch_body(spark: SparkSession, d: str) -> DataFrame:
    return P.stitch(table(spark, d, "documents").filter("source = 'minutes_pdf'"), "meeting_id", ["page_no", "doc_id"], tag="[p. %s] ")


@query("SELECT source, count(*) AS pages, count(*) FILTER (WHERE length(trim(coalesce(text, ''), ' ')) < 200) AS thin FROM documents GROUP BY 1")
def low_density(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("pages"), F.count_if(P.low_density(F.col("text"))).alias("thin"))


@query("""SELECT doc_id, regexp_extract(text, '([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})', 1) AS typed FROM documents WHERE regexp_matches(text, '^(BOARD MEETING|MEETING MINUTES)') AND regexp_extract(text, '([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})', 1) <> ''""")
def header_dates(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").filter(F.col("text").rlike("^(BOARD MEETING|MEETING MINUTES)"))
    x = F.regexp_extract("text", r"([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})", 1)
    return t.filter(x != "").select("doc_id", x.alias("typed"))


_MONTHS = "|".join(N.LONG_MONTHS)
_AT = "least(" + ", ".join(f"CASE WHEN instr(h, '{w}') > 0 THEN instr(h, '{w}') ELSE 9999 END" for w in N.TITLES) + ")"
_WORD, _NUM = f"'({_MONTHS})[^a-z0-9/]+([0-9]{{1,2}})[^a-z0-9/]+([0-9]{{4}})(?:[^0-9]|$)'", "'(?:^|[^0-9])([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})(?:[^0-9]|$)'"
_DAY = "coalesce(try_strptime(regexp_extract({t}, " + _WORD + ", 3) || '-' || regexp_extract({t}, " + _WORD + ", 1) || '-' || regexp_extract({t}, " + _WORD + ", 2), '%Y-%B-%d'), try_strptime(regexp_extract({t}, " + _NUM + ", 3) || '-' || regexp_extract({t}, " + _NUM + ", 1) || '-' || regexp_extract({t}, " + _NUM + ", 2), '%Y-%m-%d'))"
_TYPE = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(l, '{w}')" for w in ws) + f" THEN '{label}'" for label, ws in N.PAGE_TYPES) + " END"


@query(f"""WITH x AS (SELECT doc_id, lower(left({_FLAT}, 2000)) AS h, lower(left({_FLAT}, 1200)) AS l FROM documents WHERE text IS NOT NULL), y AS (SELECT *, CASE WHEN {_AT} < 9999 THEN substr(h, {_AT}) ELSE h END AS t FROM x)
  SELECT doc_id, CAST(coalesce({_DAY.replace("{t}", "t")}, {_DAY.replace("{t}", "h")}) AS DATE) AS day, {_TYPE} AS type FROM y""")
def first_pages(spark: SparkSession, d: str) -> DataFrame:
    """Date and type that a page's header states."""
    t = table(spark, d, "documents").filter("text IS NOT NULL")
    return t.select("doc_id", N.first_page_date(F.col("text")).alias("day"), N.first_page_type(F.col("text")).alias("type"))


#: File names made from the meetings' days, one form for each remainder of the day by six. {y4} and so on are filled by dialect.
_FORMS = ["'record-' || {ymd}", "'record-' || {m} || '-' || {d} || '-' || {y2} || '-Part-2'", "'Special record ' || {month} || ' ' || {d} || ' ' || {y4}", "'record_' || {mon} || '_' || {y4} || '_revised'", "'committee-record-' || {ym} || '-3'", "'notes-' || ({m} % 9 + 1)"]
_NAME = "CASE day(date) % 6 " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_FORMS)) + " END || '.pdf'"
_SPARK = {"ymd": "date_format(date, 'yyyyMMdd')", "ym": "date_format(date, 'yyyyMM')", "y4": "year(date)", "y2": "date_format(date, 'yy')", "m": "month(date)", "d": "day(date)", "month": "date_format(date, 'MMMM')", "mon": "lower(date_format(date, 'MMM'))"}
_DUCK = {"ymd": "strftime(date, '%Y%m%d')", "ym": "strftime(date, '%Y%m')", "y4": "year(date)", "y2": "strftime(date, '%y')", "m": "month(date)", "d": "day(date)", "month": "monthname(date)", "mon": "lower(left(monthname(date), 3))"}
#: What each form says, straight from the date.
_SAID = f"""f AS (SELECT meeting_id, {_NAME.format(**_DUCK)} AS filename, day(date) % 6 AS k, CASE WHEN day(date) % 6 < 3 THEN date END AS day, CAST(CASE WHEN day(date) % 6 IN (3, 4) THEN year(date) END AS INT) AS y, CAST(CASE WHEN day(date) % 6 IN (3, 4) THEN month(date) END AS INT) AS m,
  CAST(CASE day(date) % 6 WHEN 1 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN month(date) % 9 + 1 END AS INT) AS part_no, day(date) % 6 = 3 AS is_revised, CASE day(date) % 6 WHEN 2 THEN 'special' WHEN 4 THEN 'committee' ELSE 'unknown' END AS doc_type,
  CAST(row_number() OVER (ORDER BY meeting_id) AS INT) AS ord FROM meetings WHERE date IS NOT NULL),
g AS (SELECT *, CASE WHEN k < 3 THEN 'm-' || strftime(day, '%Y-%m-%d') WHEN k < 5 THEN 'm-' || y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') END AS group_id FROM f)"""


def _files(spark, d):
    f = table(spark, d, "meetings").filter("date IS NOT NULL").select("meeting_id", F.expr(_NAME.format(**_SPARK)).alias("filename"))
    # an ordinal by counting the smaller ids of a table of one row a meeting
    f = f.withColumn("ord", F.row_number().over(W.orderBy("meeting_id")))
    return G.parse_files(f.select("ord", F.concat(F.lit("https://files.example/docs/"), "filename").alias("href")))


@query(f"WITH {_SAID} SELECT ord, filename, day, y, m, part_no, is_revised, doc_type FROM f")
def parse_filenames(spark: SparkSession, d: str) -> DataFrame:
    """Names made from every meeting's day, read again."""
    return _files(spark, d).select("ord", "filename", "day", "y", "m", "part_no", "is_revised", "doc_type")


@query(f"WITH {_SAID}, o AS (SELECT DISTINCT group_id, day, filename, part_no, is_revised FROM g WHERE group_id IS NOT NULL) SELECT group_id, min(day) AS day, string_agg(filename, '; ' ORDER BY part_no IS NULL, part_no) AS files, bool_or(is_revised) AS is_revised FROM o GROUP BY 1")
def group_parts(spark: SparkSession, d: str) -> DataFrame:
    return G.group_files(_files(spark, d), "m").select("group_id", "day", F.array_join("files", "; ").alias("files"), "is_revised")


@query(f"WITH {_SAID}, s AS (SELECT DISTINCT 'committee-record-' || y AS stem FROM f WHERE k = 4) SELECT s.stem || '.pdf' AS filename, arg_min(g.group_id, g.ord) AS group_id FROM s JOIN g ON g.k = 4 AND starts_with(g.filename, s.stem) GROUP BY 1")
def inherit_stem(spark: SparkSession, d: str) -> DataFrame:
    """Fragments that only name a year go to the first numbered file of that year."""
    f = _files(spark, d).withColumn("group_id", F.coalesce(F.concat(F.lit("m-"), F.col("day").cast("string")), F.format_string("m-%d-%02d", "y", "m")))
    numbered = f.filter("doc_type = 'committee'")
    stems = numbered.select(F.concat(F.lit("committee-record-"), F.col("y").cast("string")).alias("stem")).distinct()
    return G.inherit(stems.select(F.concat("stem", F.lit(".pdf")).alias("filename"), "stem"), numbered)


@query("""SELECT id, CAST(day AS DATE) AS day, source, CAST(confidence AS DOUBLE) AS confidence, type, CAST(warned AS BIGINT) AS warned FROM (VALUES (1, '2020-01-02', 'content', 1.0, 'special', 0), (2, '2020-01-03', 'content', 0.9, 'combined', 1),
  (3, '2020-01-02', 'filename', 0.5, 'committee', 0), (4, '2020-02-01', 'content', 0.8, 'other', 1), (5, NULL, NULL, 0.0, 'combined', 0)) v(id, day, source, confidence, type, warned)""")
def resolve_dates(spark: SparkSession, d: str) -> DataFrame:
    rows = [(1, "2020-01-02", None, None, "special", "2020-01-02", "other", "text"), (2, "2020-01-02", None, None, "unknown", "2020-01-03", None, "text"), (3, "2020-01-02", None, None, "unknown", None, "committee", "text"), (4, None, 2020, 1, "unknown", "2020-02-01", "other", "vision"), (5, None, None, None, "unknown", None, None, "text")]
    f = spark.createDataFrame(rows, "id int, nd string, ny int, nm int, nt string, pd string, pt string, method string")
    r = N.resolve(F.col("nd").cast("date"), F.col("ny"), F.col("nm"), F.col("nt"), F.col("pd").cast("date"), F.col("pt"), F.col("method"))
    return f.select("id", r.alias("r")).select("id", "r.day", "r.source", "r.confidence", "r.type", F.size("r.warnings").cast("bigint").alias("warned"))
