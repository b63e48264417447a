"""Full text: one text a group, term counts, keyword in context, items between boundaries, links."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def index(docs: DataFrame, group: str, order: list[str], text: str) -> DataFrame:
    """(group, text, low): the texts of a group in order, joined by a blank; low in lower case. Null texts are left out."""
    rows = F.sort_array(F.collect_list(F.struct(*order, F.col(text).alias("_t"))))
    t = docs.filter(F.col(text).isNotNull()).groupBy(group).agg(F.array_join(F.transform(rows, lambda r: r["_t"]), " ").alias("text"))
    return t.withColumn("low", F.lower("text"))


def mentions(idx: DataFrame, terms: list[str]) -> DataFrame:
    """(..., term, n): non-overlapping mentions of every term in every text, zeros included. One pass over the text for all terms."""
    each = [F.struct(F.lit(t).alias("term"), F.expr("CAST((length(low) - length(replace(low, {0}, ''))) / {1} AS BIGINT)".format("'" + t.lower().replace("'", "\\'") + "'", len(t))).alias("n")) for t in terms]
    keep = [c for c in idx.columns if c not in ("text", "low")]
    return idx.select(*keep, F.explode(F.array(*each)).alias("e")).select(*keep, "e.term", "e.n")


def context(docs: DataFrame, key: str, text: str, term: str, width: int = 60, most: int | None = 3) -> DataFrame:
    """(key, k, context): the first `most` mentions (all of them if None) with `width` characters on both sides, blanks collapsed."""
    parts = F.split(F.lower(F.col(text)), re.escape(term.lower()))
    n = len(term)
    last = F.size(parts) - 1 if most is None else F.least(F.size(parts) - 1, F.lit(most))
    starts = F.transform(F.sequence(F.lit(1), last), lambda k: F.struct(k.alias("k"), (F.aggregate(F.slice(parts, 1, k), F.lit(0), lambda a, x: a + F.length(x)) + (k - 1) * n + 1).alias("at")))
    d = docs.filter(F.contains(F.lower(F.col(text)), F.lit(term.lower()))).select(key, F.col(text).alias("_t"), F.explode(starts).alias("s"))
    begin = F.greatest(F.lit(1), F.col("s.at") - width)
    piece = F.substr(F.col("_t"), begin, F.col("s.at") - begin + n + width)
    return d.select(key, F.col("s.k").cast("bigint").alias("k"), F.trim(F.regexp_replace(piece, r"\s+", " ")).alias("context"))


def itemise(texts: DataFrame, group: str, text: str, boundary: str, about: str, last: int = 1500) -> DataFrame:
    """(group, items, hits): pieces from one boundary to the next, the last one `last` characters long, and those that match `about`."""
    mark = "\u0001"
    parts = F.split(F.regexp_replace(F.col(text), f"({boundary})", mark + "$1"), mark)
    t = texts.select(group, parts.alias("p")).filter(F.size("p") > 1).select(group, F.slice("p", 2, F.size("p") - 1).alias("p"))
    items = F.transform("p", lambda x, i: F.when(i == F.size("p") - 1, F.substring(x, 1, last)).otherwise(x))
    return t.select(group, F.size("p").cast("bigint").alias("items"), F.size(F.filter(items, lambda x: F.lower(x).rlike(about))).cast("bigint").alias("hits"))


def hrefs(pages: DataFrame, key: str, html: str, pattern: str = r'(?i)href="([^"]*\.pdf)"') -> DataFrame:
    """(key, href, pos): distinct links of a page, each with its first position."""
    e = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), 1)).alias("pos", "href"))
    return e.groupBy(key, "href").agg(F.min("pos").cast("bigint").alias("pos"))
