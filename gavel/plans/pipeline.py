"""From files and pages to the six tables: each stage a function of DataFrames, written down only around a predictor.

files: href, ord, sha256; pages: sha256, page_no, text; scans: sha256, page_no, scan_text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import filenames as N
from ..operators import grouping as G
from ..operators import pages as P
from ..operators import predict
from ..sources import loader, readers, schemas


def identify(files: DataFrame, pages: DataFrame, date_overrides: DataFrame | None = None, *, prefix: str) -> DataFrame:
    """Each file with its date, how it was found, type and meeting: overrides first, then later parts by name, then the first page, then the name.

    Undated fragments inherit the meeting of a numbered file whose name begins with theirs; what stays undated has no meeting_id.
    """
    f = G.parse_files(files.withColumn("_s", F.col("sha256"))).join(files.select("ord", "sha256"), "ord")
    first = pages.groupBy("sha256").agg(F.min_by("text", "page_no").alias("page1"))
    f = f.join(first, "sha256", "left")
    later = F.coalesce(F.col("part_no") >= 2, F.lit(False)) & F.col("day").isNotNull()
    content = F.when(~later, N.first_page_date(F.col("page1")))
    r = N.resolve(F.col("day"), F.col("y"), F.col("m"), F.col("doc_type"), content, F.when(~later, N.first_page_type(F.col("page1"))), F.lit("text"))
    f = f.withColumn("r", r).select("ord", "href", "filename", "stem", "sha256", "part_no", "is_revised", "r.day", "r.source", "r.confidence", "r.type", "r.warnings")
    if date_overrides is not None:
        o = date_overrides.select("filename", F.col("date").cast("date").alias("_d"))
        f = f.join(F.broadcast(o), "filename", "left").withColumn("source", F.when(F.col("_d").isNotNull(), "override").otherwise(F.col("source"))).withColumn("confidence", F.when(F.col("_d").isNotNull(), 1.0).otherwise(F.col("confidence"))).withColumn("day", F.coalesce("_d", "day")).drop("_d")
    f = f.withColumn("group_id", F.when(F.col("day").isNotNull(), F.concat(F.lit(prefix + "-"), F.col("day").cast("string"))))
    loose = f.filter("group_id IS NULL")
    heirs = G.inherit(loose.select("filename", F.regexp_replace("stem", r"[-_]\d$", "").alias("stem")), f.filter("group_id IS NOT NULL"))
    f = f.join(heirs.withColumnRenamed("group_id", "_g"), "filename", "left").withColumn("group_id", F.coalesce("group_id", "_g")).drop("_g")
    kept = G.keep_revised(f.filter("group_id IS NOT NULL"), "group_id").filter("kept").drop("note", "kept")
    return kept.unionByName(f.filter("group_id IS NULL")).withColumnRenamed("group_id", "meeting_id")


def segment(pages: DataFrame, scans: DataFrame | None = None, letterhead: str | None = None) -> DataFrame:
    """Pages with a label, smoothed; textless pages are read from their scans."""
    p = P.overlay(pages, scans, ["sha256", "page_no"]) if scans is not None else pages
    p = p.withColumn("_c", P.classify(F.col("text"), letterhead)).select(*p.columns, F.col("_c.label").alias("label"), F.col("_c.confidence").alias("confidence"))
    return P.smooth(p, "sha256", "page_no")


def bodies(files: DataFrame, pages: DataFrame) -> DataFrame:
    """(meeting_id, body, pages) of the minutes pages of each meeting, in part and page order, tagged by page."""
    j = files.filter("meeting_id IS NOT NULL").select("meeting_id", "sha256", F.coalesce("part_no", F.lit(999)).alias("part"), "ord").join(pages.filter("label = 'body'"), "sha256")
    return P.stitch(j, "meeting_id", ["part", "ord", "page_no"], tag="[page %s]\n")


def _merged(p: DataFrame) -> DataFrame:
    """One document of the parts (meeting_id, k, n, attempt, document columns) of each meeting, where all of them are there.

    Records follow one another in the order of the parts, single fields come from the first part that has them, counts and costs are summed.
    """
    names = [f.name for f in p.schema if f.name not in ("meeting_id", "k", "n", "attempt")]
    g = p.groupBy("meeting_id", "n").agg(F.sort_array(F.collect_list(F.struct("k", *names))).alias("_r"), F.max("attempt").alias("attempt"), F.countDistinct("k").alias("_k")).filter("_k = n")

    def values(name: str, field: str | None = None):
        return F.filter(F.transform("_r", lambda r: r[name] if field is None else r[name][field]), lambda v: v.isNotNull())

    def single(name: str, field):
        v = values(name, field.name)
        if name == "extraction_meta" and field.name == "warnings":
            return F.concat(F.flatten(v), F.array(F.format_string("body read in %d parts", "n")))
        if name == "extraction_meta" and field.dataType.typeName() in ("integer", "double"):
            return F.when(F.size(v) > 0, F.aggregate(v, F.lit(0).cast(field.dataType), lambda x, y: x + y))
        return F.get(v, F.lit(0))

    cols = [F.flatten(values(f.name)).alias(f.name) if f.dataType.typeName() == "array" else F.struct(*[single(f.name, x).alias(x.name) for x in f.dataType]).alias(f.name) for f in p.select(*names).schema]
    return g.select("meeting_id", "attempt", *cols)


def extract(body: DataFrame, done: DataFrame, make: Callable, keep: Callable[[DataFrame], DataFrame], template: str = "%s", most: int = 350_000) -> DataFrame:
    """Validated documents of the meetings not done yet: (meeting_id, document columns, errors, attempt).

    A body of more than `most` characters goes to the predictor in several parts, each under a line that names its meeting,
    with the key meeting_id#k/n; their records are merged. A meeting of which a part stays invalid comes out another time.
    """
    todo = predict.work_list(body, done, ["meeting_id"]).withColumn("_b", predict.body_parts("body", most))
    todo = todo.select("meeting_id", F.size("_b").alias("n"), F.posexplode_outer("_b").alias("k", "part")).withColumn("p", predict.build_prompt("part", template, most))
    mark = F.format_string("%d/%d", F.col("k") + 1, F.col("n"))
    todo = todo.select(
        F.when(F.col("n") > 1, F.concat(F.col("meeting_id"), F.lit("#"), mark)).otherwise(F.col("meeting_id")).alias("key"),
        F.when(F.col("n") > 1, F.concat(F.lit("Part "), mark, F.lit(" of meeting "), F.col("meeting_id"), F.lit("\n\n"), F.col("p.prompt"))).otherwise(F.col("p.prompt")).alias("prompt"),
    )

    def check(a: DataFrame) -> DataFrame:
        d = readers.parse_documents(a.withColumn("_text", F.col("answer")), "_text").withColumn("_e", schemas.errors(full=False))
        problem = F.when(F.col("error").isNotNull(), F.col("error")).when(F.size("_e") > 0, F.array_join("_e", "; "))
        return d.withColumn("problem", problem).select("key", "answer", "error", "problem")

    a = predict.with_retry(todo, "key", "prompt", make, check, keep)
    d = readers.parse_documents(a.select("key", "answer", "problem", "attempt"), "answer").filter("problem IS NULL").drop("problem", "_corrupt_record")
    place = r"^(.*)#(\d+)/(\d+)$"
    whole = d.filter(~F.col("key").rlike(place)).withColumnRenamed("key", "meeting_id")
    p = d.filter(F.col("key").rlike(place)).select(F.regexp_extract("key", place, 1).alias("meeting_id"), *[F.regexp_extract("key", place, i).cast("int").alias(c) for i, c in ((2, "k"), (3, "n"))], *[c for c in d.columns if c != "key"])
    return schemas.defaults(whole.unionByName(_merged(p)))


def load(docs: DataFrame, manifest: DataFrame, vote_additions: DataFrame | None = None) -> dict[str, DataFrame]:
    """The six tables, identity pinned to the manifest, votes with their audited additions."""
    t = loader.flatten(loader.finalize(docs.drop("meeting_id", "attempt"), manifest))
    if vote_additions is not None:
        t["votes"] = loader.override_votes(t["votes"], vote_additions, t["meetings"])
    return t


def escalate(scans: DataFrame, words: int = 10) -> tuple[DataFrame, DataFrame]:
    """Provenance of scanned pages, and those with so few words that a better reader should see them."""
    n = F.size(F.filter(F.split(F.coalesce("scan_text", F.lit("")), r"\s+"), lambda w: w != ""))
    p = scans.select("sha256", "page_no", n.cast("bigint").alias("words"))
    return p, p.filter(F.col("words") < words)


def manifest(files: DataFrame) -> DataFrame:
    """(meeting_id, date, is_revised, meeting_type, files) of the identified files."""
    f = files.filter("meeting_id IS NOT NULL")
    g = f.groupBy("meeting_id").agg(F.max("day").alias("date"), F.max("is_revised").alias("is_revised"), F.transform(F.sort_array(F.collect_list(F.struct(F.coalesce("part_no", F.lit(999)).alias("p"), "ord", "filename"))), lambda x: x["filename"]).alias("files"))
    return g.join(G.meeting_types(f, "meeting_id").select("meeting_id", F.col("type").alias("meeting_type")), "meeting_id")
