"""Session settings that every tickloom entry point relies on."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}

#: Rows that one task of a sweep sorts; 1,000,000 boundaries of gaps took about 150 MB.
ROWS_A_TASK = 1_000_000


def local_session(cores: int | None = None, partitions: int | None = None) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName("tickloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions or n))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only for a local session without that setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tickloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{own}")
    return f"file://{own}"


def staged(df, name: str):
    """df as a table in the shared folder, read back: what several results are made of is computed once, and a lost
    executor costs the tasks it ran."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, rows: int, *keys: str):
    """df shuffled by keys to tasks of about ROWS_A_TASK of its rows; where the session's tasks are enough for that,
    Spark deals them."""
    spark = df.sparkSession
    own = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    n = -(-rows // ROWS_A_TASK)
    return df.repartition(n, *keys) if n > own else df.repartition(*keys)


def table(spark: SparkSession, sf_dir: str, name: str):
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
