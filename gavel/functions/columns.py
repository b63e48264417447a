"""Column functions shared by the operators: match keys, dates, bins, flags."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_key(c: Column) -> Column:
    """'' for null; lower case; everything but letters, digits and blanks to a blank; blanks collapsed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def match_key(*cs: Column) -> Column:
    """A match key of several fields; a null field counts as the word none."""
    return normalize_key(F.concat_ws(" ", *[F.coalesce(c, F.lit("None")) for c in cs]))


def strip_honorifics(c: Column, titles: str = "mr|mrs|ms|mx|dr|hon|councilmember|chairperson|senator|rev") -> Column:
    """Blanks collapsed, titles in front removed until none is left."""
    return F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), rf"(?i)^(?:(?:{titles})\.? )+", "")


def title_case(c: Column) -> Column:
    """A capital after every non-letter, so also after an apostrophe or hyphen, the rest in lower case."""
    @F.pandas_udf("string")
    def f(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else x.title())

    return f(c)


def strip_fences(c: Column) -> Column:
    """JSON text without a Markdown fence around it."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"^```(?:json)?\s*", ""), r"\s*```$", "")


def percent_quoted(c: Column) -> Column:
    """A path with blanks, quotes and non-ASCII characters percent-encoded; '/', ':' and '%' stay."""
    @F.pandas_udf("string")
    def f(s: pd.Series) -> pd.Series:
        from urllib.parse import quote

        return s.map(lambda x: None if x is None else quote(x, safe="/:%"))

    return F.when(c.rlike(r"^[A-Za-z0-9._~/:%-]*$"), c).otherwise(f(c))


def absolute_url(href: Column, base: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), percent_quoted(F.regexp_replace(href, "^/", ""))))


def right_closed_bins(c: Column, edges: list[float], labels: list[str]) -> Column:
    """The label of (edge, next edge] that holds the value; null outside."""
    e = F.when(F.lit(False), F.lit(None).cast("string"))
    for lo, hi, label in zip(edges, edges[1:], labels):
        e = e.when((c > lo) & (c <= hi), F.lit(label))
    return e


def collapse_rare(c: Column, keep: list[str], other: str = "other") -> Column:
    return F.when(c.isin(keep), c).otherwise(F.lit(other))


def any_contains(items: Column, word: str) -> Column:
    """Whether any entry of an array contains the word, letter case aside; false for null."""
    return F.coalesce(F.exists(items, lambda x: F.contains(F.lower(x), F.lit(word.lower()))), F.lit(False))


def first_label(c: Column, rules: list[tuple[str, list[str]]], otherwise: str | None = None) -> Column:
    """Label of the first rule of which a keyword occurs in the text, letter case aside."""
    low = F.lower(F.coalesce(c, F.lit("")))
    e = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, words in rules:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        e = e.when(hit, F.lit(label))
    return e.otherwise(F.lit(otherwise)) if otherwise is not None else e


def division(yes: Column, no: Column, abstain: Column) -> Column:
    """Share of the votes cast off the larger side; null without votes."""
    total = yes + no + abstain
    return F.when(total > 0, (total - F.greatest(yes, no)) / total)


#: Words that end the name of a street.
STREET_ENDS = "street st avenue ave place pl road rd blvd boulevard drive lane court square".split()


def address_keys(text: Column, ends: list[str] = STREET_ENDS, most: int = 4) -> Column:
    """Distinct 'number|word' keys of the addresses in a text: the house number, without a letter, and the last word of the street's name.

    A text is read as numbers, words and signs. A house number has up to four digits; the name has up to `most` words, and
    ends at a word of `ends`, a sign, or the end of the text; where nothing ends it there is no address.
    """
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"([0-9]+|[a-z][a-z0-9]*|[,.;(])"), 1)
    stop = F.array(*[F.lit(w) for w in ends])

    def key(t: Column, i: Column) -> Column:
        rest = F.slice(t, i + 2, most + 3)
        rest = F.when(F.length(F.get(rest, F.lit(0))) == 1, F.slice(rest, 2, most + 2)).otherwise(rest)
        # words read so far, and whether the name has ended
        begin = F.struct(F.lit("").alias("last"), F.lit(0).alias("n"), F.lit(False).alias("over"))
        step = lambda x, w: F.when(x["over"], x).when(F.array_contains(stop, w) | w.rlike("^[^a-z]"), F.struct(x["last"].alias("last"), x["n"].alias("n"), F.lit(True).alias("over"))).otherwise(F.struct(w.alias("last"), (x["n"] + 1).alias("n"), F.lit(False).alias("over")))
        end = F.aggregate(rest, begin, step, lambda x: F.when((x["n"] > 0) & (x["n"] <= most) & (x["over"] | (F.size(rest) == x["n"])), x["last"]))
        return F.concat_ws("|", F.get(t, i), end)

    at = lambda t: F.filter(F.sequence(F.lit(0), F.greatest(F.size(t) - 1, F.lit(0))), lambda i: F.get(t, i).rlike("^[0-9]{1,4}$"))
    found = F.get(F.transform(F.array(tokens), lambda t: F.transform(at(t), lambda i: key(t, i))), F.lit(0))
    return F.array_distinct(F.filter(found, lambda k: k.contains("|")))


def wilson(k: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Wilson score interval of k in n; null for n = 0."""
    nn = F.when(n > 0, n.cast("double"))
    p = k / nn
    mid, half, den = p + z * z / (2 * nn), z * F.sqrt(p * (1 - p) / nn + z * z / (4 * nn * nn)), 1 + z * z / nn
    return (mid - half) / den, (mid + half) / den
