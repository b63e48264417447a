"""Session set-up, table reading and lineage cuts shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings that hold at any size. Partition counts and memory belong to the cluster.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("gavel")
    for k, v in CONF.items():
        b = b.config(k, v)
    spark = (
        b.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where it is unset, one machine (tests) uses a folder of its own; on a cluster that is an error."""
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        shared = os.path.join(tempfile.gettempdir(), f"gavel-checkpoint-{uuid.uuid4().hex[:8]}")
    sc.setCheckpointDir(shared)
    return shared


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and written to the shared checkpoint folder: survives the loss of executors.

    The result starts anew for the optimiser. A checkpointed table otherwise keeps the size estimates of its plan, and
    joins multiply estimates: over the rounds of an iteration they grow to numbers of millions of digits.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    done = df.checkpoint(eager=True)
    rows = done._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, done._jdf.schema(), False), spark)


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most that many rows; reads no more than one beyond the bound."""
    return df.limit(rows + 1).agg(F.count(F.lit(1))).first()[0] <= rows
