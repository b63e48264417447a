"""Pages of files: classification, smoothing over neighbours, scan triggers, stitching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.filenames import let

# Words that mark pages of minutes and pages of attachments.
BODY_WORDS = ("motion", "seconded", "vote was", "adjourn", "roll call", "committee", "chairperson", "district manager", "old business", "new business", "public session", "minutes", "recommendation", "agenda", "presentation", "moment of silence", "quorum")
ATTACHMENT_WORDS = ("questionnaire", "sincerely", "dear ", "respectfully submitted", "www.", "@gmail", "@yahoo", "press release", "article")
TITLE = r"combined\s+public\s+hearing|minutes\s+of\s+the|board\s+meeting|public\s+hearing"
VOTE_SHEET = r"yes\s+no\s+abs\s+rec|1st\s+2nd\s+3rd|(?:\bx\s+){5,}"


def hits(text: Column, words: Sequence[str]) -> Column:
    """How many different words occur in a lower-case text."""
    return sum((F.contains(text, F.lit(w)).cast("int") for w in words), F.lit(0))


def classify(text: Column, letterhead: str | None = None) -> Column:
    """STRUCT<label, confidence> of one page from its text; null counts as blank."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    out = lambda label, c: F.struct(F.lit(label).alias("label"), (F.lit(c) if isinstance(c, float) else c).cast("double").alias("confidence"))

    def count(low: Column) -> Column:
        head = F.substring(low, 1, 700)
        marked = head.rlike(letterhead) & head.rlike(TITLE) if letterhead else F.lit(False)
        return F.struct(F.length(low).alias("n"), low.rlike(VOTE_SHEET).alias("sheet"), marked.alias("marked"), hits(low, BODY_WORDS).alias("body"), hits(low, ATTACHMENT_WORDS).alias("attached"))

    def label(x: Column) -> Column:
        body, attached, dense = x["body"], x["attached"], x["n"] >= 800
        return (
            F.when(x["n"] < 20, out("blank", 1.0))
            .when(x["sheet"], out("vote_sheet", 0.95))
            .when(x["marked"], out("body", 0.95))
            .when((body >= 3) & (body > attached), out("body", F.when(dense | (body >= 5), 0.85).otherwise(0.7)))
            .when(attached > body, out("attachment", 0.8))
            .when(~dense & (body < 2), out("attachment", 0.6))
            .when((body >= 1) & dense, out("body", 0.55))
            .otherwise(out("attachment", 0.4))
        )

    return let(let(F.lower(flat), count), label)


def low_density(text: Column, chars: int = 200) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) < chars


def smooth(pages: DataFrame, file: str, page: str, sure: float = 0.8) -> DataFrame:
    """label, confidence and smoothed: an unsure page takes the label that the nearest sure pages on both sides share.

    Smoothed pages never become anchors, so the order of smoothing does not matter. The window runs inside one file.
    """
    before = W.partitionBy(file).orderBy(page).rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy(file).orderBy(page).rowsBetween(1, W.unboundedFollowing)
    anchor = F.when(F.col("confidence") >= sure, F.col("label"))
    p = pages.withColumn("_a", F.last(anchor, ignorenulls=True).over(before)).withColumn("_b", F.first(anchor, ignorenulls=True).over(after))
    take = (F.col("confidence") < sure) & (F.col("label") != "blank") & (F.col("_a") == F.col("_b")) & (F.col("_a") != "blank")
    take = F.coalesce(take, F.lit(False))
    return p.withColumn("label", F.when(take, F.col("_a")).otherwise(F.col("label"))).withColumn("confidence", F.when(take, 0.75).otherwise(F.col("confidence"))).withColumn("smoothed", take).drop("_a", "_b")


def scan_first(pages: DataFrame, file: str, page: str, text: str, chars: int = 20, share: float = 0.8) -> DataFrame:
    """(file, scan_first): the first three pages are textless, or more than `share` of all are."""
    bare = F.length(F.trim(F.coalesce(F.col(text), F.lit("")))) < chars
    # the three first pages by an aggregation: no file is sorted
    first = F.slice(F.sort_array(F.collect_list(F.struct(F.col(page).alias("p"), bare.alias("b")))), 1, 3)
    small = pages.withColumn("_r", F.col(page)).groupBy(file).agg(F.avg(bare.cast("double")).alias("_s"), first.alias("_f"))
    return small.select(file, (F.forall("_f", lambda x: x["b"]) | (F.col("_s") > share)).alias("scan_first"))


def front_scan(pages: DataFrame, file: str, page: str, limit: int = 40, misses: int = 3) -> DataFrame:
    """(file, scanned): how many pages a forward scan looks at that stops at `limit` or after so many pages in a row that are no minutes."""
    w = W.partitionBy(file).orderBy(page)
    good = F.col("label").isin("body", "vote_sheet").cast("int")
    p = pages.withColumn("_i", F.row_number().over(w)).filter(F.col("_i") <= limit).withColumn("_g", good)
    # pages since the last good one
    p = p.withColumn("_last", F.max(F.when(F.col("_g") == 1, F.col("_i"))).over(w)).withColumn("_run", F.col("_i") - F.coalesce("_last", F.lit(0)))
    stop = F.min(F.when(F.col("_run") >= misses, F.col("_i")))
    return p.groupBy(file).agg(F.coalesce(stop, F.max("_i")).cast("bigint").alias("scanned"))


def overlay(pages: DataFrame, scans: DataFrame, keys: list[str], text: str = "text", scan: str = "scan_text", chars: int = 20) -> DataFrame:
    """The text of a scan where the text layer has fewer than `chars` characters."""
    j = pages.join(scans.select(*keys, F.col(scan).alias("_s")), keys, "left")
    bare = F.length(F.trim(F.coalesce(F.col(text), F.lit("")))) < chars
    return j.withColumn(text, F.when(bare & F.col("_s").isNotNull(), F.col("_s")).otherwise(F.col(text))).drop("_s")


def stitch(pages: DataFrame, group: str, order: list[str], text: str = "text", separator: str = "\n\n", tag: str | None = None) -> DataFrame:
    """(group, body, pages): the texts of a group in order. tag: a format with one %s for the last order column, put before each page."""
    t = F.coalesce(F.col(text), F.lit(""))
    if tag:
        t = F.concat(F.format_string(tag, F.col(order[-1]).cast("string")), t)
    rows = F.sort_array(F.collect_list(F.struct(*order, t.alias("_t"))))
    return pages.groupBy(group).agg(rows.alias("_r")).select(group, F.array_join(F.transform("_r", lambda r: r["_t"]), separator).alias("body"), F.size("_r").cast("bigint").alias("pages"))
