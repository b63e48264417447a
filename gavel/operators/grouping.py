"""Files grouped into meetings: revised uploads win, parts in order, undated fragments inherit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import filenames as N


def parse_files(files: DataFrame, href: str = "href", ordinal: str = "ord") -> DataFrame:
    """File name, date guess, year and month, part number, revision and type of every href."""
    name = N.stem(F.col(href))
    p = files.select(F.col(ordinal).alias("ord"), F.col(href).alias("href"), F.element_at(F.split(F.col(href), "/"), -1).alias("filename"), name.alias("stem"), N.filename_date(name).alias("d"))
    return p.select("ord", "href", "filename", "stem", F.col("d.day").alias("day"), F.col("d.y").alias("y"), F.col("d.m").alias("m"), N.part_number(F.col("stem"), F.col("d.until")).alias("part_no"), N.revised(F.col("stem")).alias("is_revised"), N.document_type(F.col("stem")).alias("doc_type"))


def keep_revised(files: DataFrame, group: str) -> DataFrame:
    """One file a (group, part): a revised one before a plain one, else the first; with the warnings that duplicates give."""
    w = W.partitionBy(group, "part_no").orderBy("ord")
    seen = F.max(F.col("is_revised").cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1))
    part = F.coalesce(F.col("part_no").cast("string"), F.lit("none"))
    note = F.when(seen.isNull(), F.lit(None)).when((seen == 1) != F.col("is_revised"), F.concat(F.lit("kept revised over plain for part "), part)).otherwise(F.concat(F.lit("duplicate upload for part "), part, F.lit(": "), F.col("filename")))
    best = F.row_number().over(W.partitionBy(group, "part_no").orderBy(F.desc("is_revised"), "ord"))
    return files.withColumn("note", note).withColumn("kept", best == 1)


def group_files(files: DataFrame, prefix: str) -> DataFrame:
    """(group_id, day, files, is_revised, warnings) of the dated files of `parse_files`; days and bare months never merge."""
    f = files.filter("day IS NOT NULL OR y IS NOT NULL").withColumn("group_id", F.coalesce(F.concat(F.lit(prefix + "-"), F.col("day").cast("string")), F.format_string(prefix + "-%d-%02d", "y", "m")))
    k = keep_revised(f, "group_id")
    parts = F.sort_array(F.collect_list(F.when(F.col("kept"), F.struct(F.col("part_no").isNull().alias("n"), F.coalesce("part_no", F.lit(0)).alias("p"), "filename"))))
    notes = F.transform(F.sort_array(F.collect_list(F.when(F.col("note").isNotNull(), F.struct("ord", "note")))), lambda x: x["note"])
    g = k.groupBy("group_id").agg(F.first("day").alias("day"), parts.alias("s"), notes.alias("w"), F.max(F.when(F.col("kept"), F.col("is_revised"))).alias("is_revised"))
    mixed = F.exists("s", lambda x: x["n"]) & (F.size("s") > 1)
    warn = F.when(mixed, F.concat("w", F.array(F.lit("a file without a part number beside numbered parts")))).otherwise(F.col("w"))
    return g.select("group_id", "day", F.transform("s", lambda x: x["filename"]).alias("files"), "is_revised", warn.alias("warnings"))


def inherit(fragments: DataFrame, files: DataFrame, group: str = "group_id") -> DataFrame:
    """(filename, group_id): an undated fragment goes to the first group with a numbered file whose name starts with its stem.

    A prefix join made an equality: every file name is cut to the lengths that fragment stems have (at most as many as a file name has characters).
    """
    lens = [r[0] for r in fragments.select(F.length("stem")).distinct().orderBy(F.length("stem")).collect()]
    if not lens:
        return fragments.select("filename").limit(0).withColumn(group, F.lit(None).cast("string"))
    cut = F.explode(F.filter(F.array(*[F.when(F.length("stem") >= n, F.substring(F.lower("stem"), 1, n)) for n in lens]), lambda x: x.isNotNull()))
    f = files.filter("part_no IS NOT NULL").select(group, "ord", cut.alias("_k"))
    return fragments.select("filename", F.lower("stem").alias("_k")).join(f, "_k").groupBy("filename").agg(F.min_by(group, "ord").alias(group))


def meeting_types(files: DataFrame, group: str) -> DataFrame:
    """(group, type, source, confidence): the last type that is not 'combined'; source and confidence of the first file."""
    t = F.max_by("type", F.when(F.col("type") != "combined", F.col("ord")))
    return files.groupBy(group).agg(F.coalesce(t, F.lit("combined")).alias("type"), F.min_by("source", "ord").alias("source"), F.min_by("confidence", "ord").alias("confidence"))
