"""Canonical person names and the graph of people, organisations and topics."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import indel


def canonical_names(names: DataFrame, least: float = 90.0, veto: set[tuple[str, str]] | None = None) -> DataFrame:
    """(name, canonical) for (name, n): the most frequent earlier name whose first word and this one's begin alike and that scores `least`.

    A first word that is a prefix of the other starts with the same letter, so names are blocked by the first letter alone.
    Inside a block only heads whose first word is a prefix of this one's or begins with it are looked up, in the order
    in which they came; equal names were made one before, so a block holds distinct names only.
    """
    veto = veto or set()

    def block(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["n", "name"], ascending=[False, True])
        # heads by their first word, and by every prefix of it; each list in the order of the heads
        whole: dict[str, list[tuple[int, str, str]]] = {}
        begun: dict[str, list[tuple[int, str, str]]] = {}
        out = []
        for k, name in enumerate(p["name"]):
            low = name.lower()
            first = low.split()[0].rstrip(".") if low.split() else ""
            like = heapq.merge(begun.get(first, ()), *(whole.get(first[:i], ()) for i in range(len(first))))
            # the shorter of two names bounds what they have in common
            near = (h for _, h, x in like if 200.0 * min(len(x), len(low)) >= least * (len(x) + len(low)) and indel(low, x) >= least and (name, h) not in veto)
            hit = next(near, None)
            if hit is None:
                whole.setdefault(first, []).append((k, name, low))
                for i in range(len(first) + 1):
                    begun.setdefault(first[:i], []).append((k, name, low))
            out.append((name, hit or name))
        return pd.DataFrame(out, columns=["name", "canonical"])

    key = F.substring(F.regexp_replace(F.lower("name"), r"(?U)^\s+", ""), 1, 1)
    return names.filter("name IS NOT NULL AND name <> ''").groupBy(key.alias("_k")).applyInPandas(block, "name string, canonical string")


def edges(frame: DataFrame, people: int = 2) -> DataFrame:
    """(person, entity, channel, weight, position, first, last, samples) of people with at least so many records.

    frame: person, entity, channel, position, date, ord, topic. The position is the most common one, at ties the first seen.
    """
    f = frame.filter("person IS NOT NULL AND entity IS NOT NULL")
    busy = f.groupBy("person").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= people).select("person")
    f = f.join(busy, "person", "left_semi")
    key = ["person", "entity", "channel"]
    pos = f.groupBy(*key, "position").agg(F.count(F.lit(1)).alias("c"), F.min("ord").alias("o")).groupBy(*key).agg(F.min_by("position", F.struct(-F.col("c"), F.col("o"))).alias("position"))
    e = f.groupBy(*key).agg(F.count(F.lit(1)).alias("weight"), F.min("date").alias("first"), F.max("date").alias("last"), F.slice(F.array_sort(F.collect_set("topic")), 1, 3).alias("samples"))
    return e.join(pos, key)


def nodes(edge: DataFrame) -> DataFrame:
    """(node, kind, weight) of an edge table."""
    p = edge.groupBy(F.col("person").alias("node")).agg(F.sum("weight").alias("weight")).withColumn("kind", F.lit("person"))
    t = edge.groupBy(F.col("entity").alias("node")).agg(F.sum("weight").alias("weight")).withColumn("kind", F.lit("topic"))
    return p.unionByName(t).select("node", "kind", "weight")
