"""Sources: nested JSON documents, JSON maps, ledgers, texts, page files, Parquet views, line lists, literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import DOCUMENT

LEDGER = "ts DOUBLE, stage STRING, meeting STRING, model STRING, input_tokens BIGINT, output_tokens BIGINT, cache_write_tokens BIGINT, cache_read_tokens BIGINT, batch BOOLEAN, cost_usd DOUBLE"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Nested documents, one a file; unreadable ones keep their text in `_corrupt_record`."""
    return spark.read.schema(DOCUMENT + ", _corrupt_record STRING").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", glob).json(path)


def parse_documents(raw: DataFrame, text: str) -> DataFrame:
    """Documents from a text column, with fences around them or not; `_corrupt_record` holds what does not parse."""
    from ..functions.columns import strip_fences

    parsed = raw.withColumn("_d", F.from_json(strip_fences(F.col(text)), DOCUMENT + ", _corrupt_record STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    return parsed.select(*[c for c in raw.columns if c != text], "_d.*")


def json_map(spark: SparkSession, path: str, value: str, field: str | None = None) -> DataFrame:
    """(key, value) of a JSON object, or of the object in one of its fields. value: the type of its values."""
    body = spark.read.text(path, wholetext=True)
    m = F.from_json("value", f"MAP<STRING, {value}>") if field is None else F.from_json(F.get_json_object("value", f"$.{field}"), f"MAP<STRING, {value}>")
    return body.select(F.explode(m).alias("key", "value"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger lines; a missing file is an empty ledger, blank lines are skipped."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).json(path).filter("stage IS NOT NULL OR cost_usd IS NOT NULL")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, value) of the lines of a text file, in file order: byte positions, not partition order, make the ordinal."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("ord", "value"))


def scanned_texts(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, page_no, scan_text) of text files named <64 characters>-p<page>.txt."""
    t = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("n"))
    return t.select(F.substring("n", 1, 64).alias("sha256"), F.regexp_extract("n", r"-p(\d+)\.txt$", 1).try_cast("int").alias("page_no"), F.col("value").alias("scan_text"))


def page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, page_no, text) of JSON arrays of pages, one file a document, named by its hash."""
    t = spark.read.text(path, wholetext=True).select("value", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("sha256"))
    return t.select("sha256", F.posexplode(F.from_json("value", "ARRAY<STRING>")).alias("p", "text")).select("sha256", (F.col("p") + 1).alias("page_no"), "text")


def binaries(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, sha256, size) and content of files of any kind."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return b.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"), "content")


def views(spark: SparkSession, paths: dict[str, str]) -> None:
    """Registers Parquet tables as views, read when queried."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def to_fetch(hrefs: DataFrame, manifest: DataFrame, key: str = "href") -> DataFrame:
    """Links without an entry in the manifest."""
    return hrefs.join(manifest.select(key), key, "left_anti")


def safe_names(hrefs: DataFrame, href: str = "href", order: str = "ord") -> DataFrame:
    """`local`: a file name of safe characters; names that differ only in case get a hash before all but the first."""
    from pyspark.sql import Window as W

    base = F.regexp_replace(F.element_at(F.split(F.col(href), "/"), -1), "[^A-Za-z0-9._-]", "_")
    n = F.row_number().over(W.partitionBy(F.lower("_b")).orderBy(order))
    return hrefs.withColumn("_b", base).withColumn("local", F.when(n == 1, F.col("_b")).otherwise(F.concat(F.substring(F.sha2(F.col(href), 256), 1, 8), F.lit("-"), F.col("_b")))).drop("_b")


def fetch(spark: SparkSession, hrefs: DataFrame, url: str, get) -> DataFrame:
    """Rows of (url, body, error) from `get(url) -> bytes`, run where the rows are; a failure is an error text, not a failed job."""
    import pandas as pd

    def run(batches):
        for b in batches:
            rows = []
            for u in b["u"]:
                try:
                    rows.append((u, get(u), None))
                except Exception as e:  # noqa: BLE001  one bad link must not end the job
                    rows.append((u, None, str(e)))
            yield pd.DataFrame(rows, columns=["url", "body", "error"])

    return hrefs.select(F.col(url).alias("u")).mapInPandas(run, "url string, body binary, error string")
