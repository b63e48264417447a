"""Stream and load questions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, table
from ..sources import loader, readers, schemas
from ..streaming import ledger as L
from .catalogue import query


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def streamed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts of the event stream, run to its end into Parquet files. The rows are not in time order, so the watermark spans the table's month; a last
    row far beyond it closes every window."""
    path = f"{checkpoint_dir(spark)}/windows-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "*events*").parquet(d).withColumn("at", F.col("ts").cast("timestamp"))
    spark.range(1).select(F.expr("timestamp'2100-01-01 00:00:00'").alias("at"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value")).write.parquet(f"{path}/end")
    end = spark.readStream.schema("at timestamp, event_type string, value double").parquet(f"{path}/end")
    late = "400 days"
    q = L.windowed(rows.select("at", "event_type", "value").union(end), "at", ["event_type"], late=late).writeStream.outputMode("append").format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{path}/out").filter("event_type <> 'end'").select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "n", "total")


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(avg(value), 4) AS mean FROM events GROUP BY 1")
def event_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.round(F.avg("value"), 4).alias("mean"))


_DOC = """{"meeting": {"meeting_id": "north-2019-11-04", "date": "2019-11-04", "meeting_type": "special"}, "liquor_licenses": [{"applicant_name": "Lantern Works", "address": "7 Quill Lane"}, {"applicant_name": "Otter Hall"}],
 "votes": [{"motion_text": "repair the pier", "topic_category": "parks", "yes": 9, "no": 4, "abstain": 0, "recusal": 2, "outcome": "passed"}, {"motion_text": "thank the staff", "topic_category": "other", "yes": 15, "no": 0, "abstain": 0, "recusal": 0, "outcome": "passed", "unanimous": true}, {"motion_text": "move the stage", "topic_category": "parks", "yes": 6, "no": 8, "abstain": 1, "recusal": 0, "outcome": "failed"}],
 "extraction_meta": {"model": "own", "text_source": "vision_ocr", "pages_minutes_body": 5, "pages_attachments_dropped": 31}}"""
_BAD = '{"meeting": {"meeting_id": "b", "date": "4 Nov 2019"}, "votes": [{"topic_category": "weather", "yes": -3}]}'


@query("SELECT topic_category, CAST(yes AS INT) AS yes, CAST(no AS INT) AS no, CAST(day AS DATE) AS day FROM (VALUES ('parks', 9, 4, '2019-11-04'), ('parks', 6, 8, '2019-11-04')) v(topic_category, yes, no, day)")
def load_documents(spark: SparkSession, d: str) -> DataFrame:
    """A nested document through parsing, checks, defaults and flattening to the contested votes."""
    raw = spark.createDataFrame([("```json\n" + _DOC + "\n```",), (_BAD,), ("not json",)], "body string")
    docs = readers.parse_documents(raw, "body").withColumn("errors", schemas.errors())
    t = loader.flatten(schemas.defaults(docs.filter("size(errors) = 0").drop("errors")))
    return t["votes"].filter("no > 0").join(t["meetings"].select("meeting_id", "date"), "meeting_id").select("topic_category", "yes", "no", F.col("date").alias("day"))


@query("SELECT n, errors FROM (VALUES (0, ''), (1, 'meeting.date: not YYYY-MM-DD; votes: negative tally; votes.topic_category: unknown; extraction_meta: missing'), (2, 'meeting.date: missing; extraction_meta: missing')) v(n, errors)")
def validate_documents(spark: SparkSession, d: str) -> DataFrame:
    raw = spark.createDataFrame([(0, _DOC), (1, _BAD), (2, "not json")], "n int, body string")
    return readers.parse_documents(raw, "body").select("n", F.array_join(schemas.errors(), "; ").alias("errors"))


@query("SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1")
def segment_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'").select("o_custkey", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def line_summary(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").filter("l_shipdate <= TIMESTAMP_NTZ '1998-09-02'")
    return t.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))
