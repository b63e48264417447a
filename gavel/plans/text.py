"""Full-text questions over `documents`: mentions, keyword in context, extraction, itemisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import fulltext as T
from ..session import table
from .catalogue import query

_TERMS = ["bike corral", "dog run", "street vendor", "composting"]
_INDEX = "(SELECT meeting_id, lower(string_agg(text, ' ' ORDER BY page_no NULLS FIRST, doc_id)) AS t FROM documents WHERE text IS NOT NULL GROUP BY 1)"


def _count_sql(term: str) -> str:
    return f"CAST((length(t) - length(replace(t, '{term}', ''))) / {len(term)} AS BIGINT)"


def _index(spark, d) -> DataFrame:
    return T.index(table(spark, d, "documents"), "meeting_id", ["page_no", "doc_id"], "text")


@query(f"SELECT meeting_id, md5(t) AS digest, length(t) AS chars FROM {_INDEX}")
def text_index(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d).select("meeting_id", F.md5("low").alias("digest"), F.length("low").cast("bigint").alias("chars"))


@query(f"SELECT meeting_id, {_count_sql('dog run')} AS n FROM {_INDEX} WHERE contains(t, 'dog run')")
def mention_count(spark: SparkSession, d: str) -> DataFrame:
    return T.mentions(_index(spark, d), ["dog run"]).filter("n > 0").select("meeting_id", "n")


@query("SELECT term, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (WHERE y = {y}), 0) AS BIGINT) AS y{y}" for y in range(2016, 2021)) + " FROM (" + " UNION ALL ".join(f"SELECT '{w}' AS term, year(date) AS y, {_count_sql(w)} AS n FROM {_INDEX} JOIN meetings USING (meeting_id)" for w in _TERMS) + ") GROUP BY 1")
def mention_pivot(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meetings").select("meeting_id", F.concat(F.lit("y"), F.year("date")).alias("y"))
    cols = [f"y{y}" for y in range(2016, 2021)]
    return T.mentions(_index(spark, d), _TERMS).join(m, "meeting_id").groupBy("term").pivot("y", cols).agg(F.sum("n").cast("bigint")).na.fill(0)


@query("PIVOT (SELECT term, 'y' || year(date) AS y, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (SELECT meeting_id, date, unnest([" + ", ".join(f"'{w}'" for w in _TERMS) + "]) AS term FROM meetings WHERE date IS NOT NULL) LEFT JOIN (" + " UNION ALL ".join(f"SELECT '{w}' AS term, meeting_id, {_count_sql(w)} AS n FROM {_INDEX}" for w in _TERMS) + ") USING (meeting_id, term)) ON y USING CAST(sum(n) AS BIGINT) GROUP BY term")
def mention_pivot_years(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of each term in every year that has meetings, a column a year; `mention_pivot` has the years 2016 to 2020 only."""
    m = table(spark, d, "meetings").filter("date IS NOT NULL").select("meeting_id", F.concat(F.lit("y"), F.year("date")).alias("y"))
    cols = sorted(r["y"] for r in m.select("y").distinct().collect())
    n = m.select("meeting_id", "y", F.explode(F.array(*map(F.lit, _TERMS))).alias("term")).join(T.mentions(_index(spark, d), _TERMS), ["meeting_id", "term"], "left")
    return n.groupBy("term").pivot("y", cols).agg(F.sum("n").cast("bigint")).na.fill(0)


@query("SELECT term, CAST(sum(n) AS BIGINT) AS total, arg_max(meeting_id, (n, meeting_id)) AS peak, max(n) AS most FROM (" + " UNION ALL ".join(f"SELECT '{w}' AS term, meeting_id, {_count_sql(w)} AS n FROM {_INDEX}" for w in _TERMS) + ") GROUP BY 1")
def peak_term(spark: SparkSession, d: str) -> DataFrame:
    m = T.mentions(_index(spark, d), _TERMS)
    return m.groupBy("term").agg(F.sum("n").cast("bigint").alias("total"), F.max_by("meeting_id", F.struct("n", "meeting_id")).alias("peak"), F.max("n").alias("most"))


@query(f"SELECT meeting_id, {_count_sql('composting')} AS n FROM {_INDEX} ORDER BY n DESC, meeting_id LIMIT 5")
def top_mentions(spark: SparkSession, d: str) -> DataFrame:
    """The five meetings that mention a term most."""
    return T.mentions(_index(spark, d), ["composting"]).orderBy(F.desc("n"), "meeting_id").limit(5).select("meeting_id", "n")


@query("""SELECT doc_id, CAST(k AS BIGINT) AS k, trim(regexp_replace(substr(text, greatest(1, p - 30), p - greatest(1, p - 30) + 8 + 30), '[ \\t\\n\\r]+', ' ', 'g')) AS context FROM (
            SELECT doc_id, text, 1 AS k, instr(lower(text), 'petition') AS p FROM documents WHERE contains(lower(text), 'petition'))""")
def kwic(spark: SparkSession, d: str) -> DataFrame:
    """The first mention in each document, with 30 characters on both sides."""
    return T.context(table(spark, d, "documents"), "doc_id", "text", "petition", width=30, most=1)


@query("""SELECT doc_id, k, trim(regexp_replace(substr(text, greatest(1, p - 180), p - greatest(1, p - 180) + 8 + 180), '[ \\t\\n\\r]+', ' ', 'g')) AS context FROM (
            SELECT doc_id, text, k, length(array_to_string(parts[1:k], '')) + (k - 1) * 8 + 1 AS p FROM (
            SELECT doc_id, text, parts, unnest(generate_series(1, len(parts) - 1)) AS k FROM (SELECT doc_id, text, string_split(lower(text), 'petition') AS parts FROM documents WHERE contains(lower(text), 'petition'))))""")
def kwic_all(spark: SparkSession, d: str) -> DataFrame:
    """Every mention in each document, with 180 characters on both sides; `kwic` has the first of each only."""
    return T.context(table(spark, d, "documents"), "doc_id", "text", "petition", width=180, most=None)


_MAIL = "[A-Za-z0-9._+]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"


@query(f"SELECT DISTINCT speaker_id, unnest(regexp_extract_all(source_snippet, '{_MAIL}')) AS address FROM speakers")
def email_extract(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "speakers").select("speaker_id", F.explode(F.regexp_extract_all("source_snippet", F.lit(f"({_MAIL})"))).alias("address"))
    return s.distinct()


_THREAD = "Email thread from (.+?) to the office, subject: ([^.]+)"


@query(f"SELECT DISTINCT speaker_id, unnest(regexp_extract_all(source_snippet, '{_THREAD}', 1)) AS sender, unnest(regexp_extract_all(source_snippet, '{_THREAD}', 2)) AS subject FROM speakers")
def email_threads(spark: SparkSession, d: str) -> DataFrame:
    p = F.lit(_THREAD)
    s = F.col("source_snippet")
    z = F.arrays_zip(F.regexp_extract_all(s, p, 1).alias("sender"), F.regexp_extract_all(s, p, 2).alias("subject"))
    return table(spark, d, "speakers").select("speaker_id", F.explode(z).alias("z")).select("speaker_id", "z.sender", "z.subject").distinct()


@query("""WITH t AS (SELECT meeting_id, string_agg(text, ' ' ORDER BY page_no NULLS FIRST, doc_id) AS t FROM documents WHERE source = 'correspondence' AND text IS NOT NULL GROUP BY 1),
  p AS (SELECT meeting_id, string_split(regexp_replace(t, '(Dear members|To the chair)', chr(1) || '\\1', 'g'), chr(1)) AS parts FROM t),
  i AS (SELECT meeting_id, len(parts) AS n, unnest(generate_series(2, len(parts))) AS k, unnest(parts[2:]) AS item FROM p)
  SELECT meeting_id, count(*) AS items, count(*) FILTER (WHERE regexp_matches(lower(CASE WHEN k = n THEN substr(item, 1, 1500) ELSE item END), 'bike|dog run')) AS hits FROM i GROUP BY 1""")
def itemise_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """Letters a meeting received, cut at salutations, and how many are about a matter."""
    t = T.index(table(spark, d, "documents").filter("source = 'correspondence'"), "meeting_id", ["page_no", "doc_id"], "text")
    return T.itemise(t, "meeting_id", "text", "Dear members|To the chair", "bike|dog run")


@query("SELECT href, CAST(pos AS BIGINT) AS pos, url FROM (VALUES ('/a/Minutes 1.PDF', 0, 'https://www.example.org/a/Minutes%201.PDF'), ('https://x.example.org/b.pdf', 2, 'https://x.example.org/b.pdf')) v(href, pos, url)")
def href_extract(spark: SparkSession, d: str) -> DataFrame:
    html = '<a href="/a/Minutes 1.PDF">1</a> <a href="/a/Minutes 1.PDF">again</a> <a href="https://x.example.org/b.pdf">2</a> <a href="/c.html">3</a>'
    h = T.hrefs(spark.createDataFrame([(1, html)], "page int, html string"), "page", "html")
    return h.select("href", "pos", C.absolute_url(F.col("href"), "https://www.example.org").alias("url"))


_RULES = [("Cannabis", ["cannabis", "dispensary"]), ("Parks", ["park", "playground", "dog run", "tree"]), ("Streets", ["street", "bike", "truck", "bus "]), ("Housing", ["housing", "rezon", "units"])]
_RULE_SQL = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(coalesce(topic, '')), '{w}')" for w in ws) + f" THEN '{label}'" for label, ws in _RULES) + " END"


@query(f"SELECT {_RULE_SQL} AS entity, count(*) AS n FROM speakers GROUP BY 1")
def topic_rules(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "speakers").groupBy(C.first_label(F.col("topic"), _RULES).alias("entity")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT license_id, trim(regexp_replace(regexp_replace(lower(coalesce(applicant_name, '') || ' ' || coalesce(address, '')), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS k FROM licenses")
def normalize_key(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "licenses")
    return t.select("license_id", C.normalize_key(F.concat(F.coalesce("applicant_name", F.lit("")), F.lit(" "), F.coalesce("address", F.lit("")))).alias("k"))


@query(r"SELECT name, regexp_replace(trim(regexp_replace(name, '[ \t\n\r\f\v]+', ' ', 'g')), '^((mr|mrs|ms|mx|dr|hon|councilmember|chairperson|senator|rev)\.? )+', '', 'i') AS bare FROM (SELECT DISTINCT name FROM speakers WHERE name IS NOT NULL)")
def strip_honorifics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "speakers").filter("name IS NOT NULL").select("name").distinct().withColumn("bare", C.strip_honorifics(F.col("name")))


@query("""SELECT i AS id, k AS keys FROM (VALUES (1, ['12|oak']), (2, ['40|west', '7|elm']), (3, [])) v(i, k)""")
def address_keys(spark: SparkSession, d: str) -> DataFrame:
    t = spark.createDataFrame([(1, "noise at 12 Oak Street, again 12 Oak St."), (2, "between 40 West Street and 7 Elm Ave"), (3, "no address")], "id int, t string")
    return t.select("id", C.address_keys(F.col("t")).alias("keys"))


@query("SELECT id, out FROM (VALUES (1, '{\"a\": 1}'), (2, '{\"b\": 2}')) v(id, out)")
def strip_fences(spark: SparkSession, d: str) -> DataFrame:
    t = spark.createDataFrame([(1, '```json\n{"a": 1}\n```'), (2, '{"b": 2}')], "id int, t string")
    return t.select("id", C.strip_fences(F.col("t")).alias("out"))


@query("SELECT v AS raw, t AS titled FROM (VALUES ('o''neil-smith LEAGUE', 'O''Neil-Smith League'), ('civic league', 'Civic League')) v(v, t)")
def title_case(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([("o'neil-smith LEAGUE",), ("civic league",)], "raw string").withColumn("titled", C.title_case(F.col("raw")))
