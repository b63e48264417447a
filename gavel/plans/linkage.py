"""Record linkage, evaluation and the entity graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fuzzy as Z
from ..operators import evaluate as E
from ..operators import graph as G
from ..operators.components import connected_components
from ..session import table
from .catalogue import query
from .records import domain, speakers, votes

_PAIRS = [("harbor light", "harbor light annex"), ("violet", "pilot"), ("x y z", "z y x"), ("old stone mill", "old mill"), ("", "")]


@query("SELECT a, b, CAST(r AS DOUBLE) AS r, CAST(so AS DOUBLE) AS so, CAST(se AS DOUBLE) AS se FROM (VALUES ('harbor light', 'harbor light annex', 80, 80.0, 100), ('violet', 'pilot', 54.5455, 54.5455, 54.5455), ('x y z', 'z y x', 60, 100, 100), ('old stone mill', 'old mill', 72.7273, 72.7273, 100), ('', '', 100, 100, 0)) v(a, b, r, so, se)")
def fuzzy_scores(spark: SparkSession, d: str) -> DataFrame:
    p = spark.createDataFrame(_PAIRS, "a string, b string")
    a, b = F.col("a"), F.col("b")
    return p.select("a", "b", F.round(Z.ratio(a, b), 4).alias("r"), F.round(Z.token_sort_ratio(a, b), 4).alias("so"), F.round(Z.token_set_ratio(a, b), 4).alias("se"))


def _sides(spark, d):
    """Cannabis records of each meeting as found, licences of the meeting as golden."""
    key = C.match_key(F.col("applicant_name"), F.col("address"))
    gold = table(spark, d, "licenses").select("meeting_id", F.col("license_id").alias("gi"), key.alias("key"))
    found = table(spark, d, "cannabis").select("meeting_id", F.col("cannabis_id").alias("ei"), key.alias("key"))
    return gold, found


@query()
def greedy_match(spark: SparkSession, d: str) -> DataFrame:
    gold, found = _sides(spark, d)
    return E.greedy(E.candidates(gold, found, ["meeting_id"]), ["meeting_id"])


@query()
def scorecard(spark: SparkSession, d: str) -> DataFrame:
    gold, found = _sides(spark, d)
    m = E.greedy(E.candidates(gold, found, ["meeting_id"]), ["meeting_id"])
    return E.scorecard(gold, found, m, ["meeting_id"])


@query("SELECT gi, ei FROM (VALUES (0, 1), (1, 0)) v(gi, ei)")
def greedy_prefers_best(spark: SparkSession, d: str) -> DataFrame:
    g = spark.createDataFrame([("m", 0, "harbor light annex"), ("m", 1, "garden house"), ("m", 2, "")], "meeting_id string, gi int, key string")
    e = spark.createDataFrame([("m", 0, "garden houze"), ("m", 1, "harbor lights annex")], "meeting_id string, ei int, key string")
    return E.greedy(E.candidates(g, e, ["meeting_id"]), ["meeting_id"]).select("gi", "ei")


def _delivered(spark, d):
    """Rows of votes delivered twice: the first delivery as golden, the second as extracted, with a few of the golden ones alone."""
    v = table(spark, d, "votes")
    ids = v.groupBy("vote_id").agg(F.min("loaded_at").alias("_lo"), F.max("loaded_at").alias("_hi")).filter("_lo < _hi")
    j = v.join(ids, "vote_id")
    return j.filter("loaded_at = _lo").drop("_lo", "_hi"), j.filter("loaded_at = _hi AND vote_id % 7 <> 3").drop("_lo", "_hi")


@query("""WITH i AS (SELECT vote_id, min(loaded_at) AS lo, max(loaded_at) AS hi FROM votes GROUP BY 1 HAVING lo < hi), g AS (SELECT v.* FROM votes v JOIN i ON v.vote_id = i.vote_id AND v.loaded_at = i.lo)
  SELECT 'votes' AS entity, CAST(count(*) AS BIGINT) AS golden, count(*) FILTER (WHERE vote_id % 7 <> 3) AS extracted, count(*) FILTER (WHERE vote_id % 7 <> 3) AS matched, CAST(1 AS DOUBLE) AS precision, round(count(*) FILTER (WHERE vote_id % 7 <> 3) / CAST(count(*) AS DOUBLE), 6) AS recall FROM g""")
def scorecard_votes(spark: SparkSession, d: str) -> DataFrame:
    """Second deliveries held against the first: what was left out is missed, the rest matches in every meeting."""
    a, b = _delivered(spark, d)
    gold, found = E.side(a, "votes", "vote_id", "gi"), E.side(b, "votes", "vote_id", "ei")
    keys = ["meeting_id", "entity"]
    m = E.greedy(E.candidates(gold, found, keys), keys)
    return E.roll_up(E.report(gold, found, m)).select("entity", "golden", "extracted", "matched", "precision", F.round("recall", 6).alias("recall"))


@query()
def scorecard_fields(spark: SparkSession, d: str) -> DataFrame:
    """Cannabis records held against the licences of their meeting: counts, field accuracy and the three lists of every meeting."""
    gold, found = E.side(table(spark, d, "licenses"), "cannabis_licenses", "license_id", "gi"), E.side(table(spark, d, "cannabis"), "cannabis_licenses", "cannabis_id", "ei")
    keys = ["meeting_id", "entity"]
    return E.report(gold, found, E.greedy(E.candidates(gold, found, keys), keys))


@query("SELECT CAST(count(*) AS BIGINT) AS votes, count(*) FILTER (WHERE a.yes = b.yes AND a.no = b.no AND a.abstain = b.abstain AND a.recusal = b.recusal) AS exact FROM votes a JOIN votes b ON a.vote_id = b.vote_id AND a.loaded_at < b.loaded_at")
def tallies_exact(spark: SparkSession, d: str) -> DataFrame:
    """Rows delivered twice: how many have the same tally."""
    v = table(spark, d, "votes").select("vote_id", "loaded_at", "yes", "no", "abstain", "recusal")
    names = ["yes", "no", "abstain", "recusal"]
    w = v.select("vote_id", F.col("loaded_at").alias("later"), *[F.col(c).alias(f"{c}2") for c in names])
    j = v.join(w, "vote_id").filter("loaded_at < later")
    return j.agg(F.count(F.lit(1)).alias("votes"), F.count_if(E.tallies_exact([F.col(c) for c in names], [F.col(f"{c}2") for c in names])).alias("exact"))


@query()
def canonical_names(spark: SparkSession, d: str) -> DataFrame:
    n = speakers(spark, d).filter("name IS NOT NULL").groupBy(C.strip_honorifics(F.col("name")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return G.canonical_names(n)


def _frame(spark, d):
    dates = table(spark, d, "meetings").select("meeting_id", "date")
    s = speakers(spark, d).select("meeting_id", F.lower("name").alias("person"), domain("topic").alias("entity"), F.lit("testimony").alias("channel"), F.coalesce("position", F.lit("unclear")).alias("position"), F.col("speaker_id").alias("ord"), "topic")
    v = votes(spark, d).select("meeting_id", F.lower("mover").alias("person"), domain("motion_text").alias("entity"), F.lit("motion").alias("channel"), F.lit("for").alias("position"), F.col("vote_id").alias("ord"), F.col("topic_category").alias("topic"))
    return s.unionByName(v).join(dates, "meeting_id")


@query()
def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    e = G.edges(_frame(spark, d))
    return e.withColumn("samples", F.array_join("samples", "; "))


@query()
def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    return G.nodes(G.edges(_frame(spark, d)))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT lower(mover) AS a, lower(seconder) AS b FROM votes WHERE mover IS NOT NULL AND seconder IS NOT NULL AND lower(mover) <> lower(seconder)),
  s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(id, root) AS (SELECT a, a FROM s UNION SELECT s.b, r.root FROM r JOIN s ON s.a = r.id)
  SELECT id, min(root) AS component FROM r GROUP BY 1""")
def motion_circles(spark: SparkSession, d: str) -> DataFrame:
    """Members joined by moving and seconding."""
    e = table(spark, d, "votes").select(F.lower("mover").alias("src"), F.lower("seconder").alias("dst")).dropna()
    return connected_components(e)
