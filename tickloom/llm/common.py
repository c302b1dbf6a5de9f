"""What the operators share: word pattern, staging in the shared folder, columns by name."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import shared_dir

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A word of a text: a run of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


@contextlib.contextmanager
def _freed_shuffles(spark: SparkSession):
    """While a table is staged, Spark deletes its shuffle files as soon as it is written, not at some later
    garbage collection: nothing reads them again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: the lineage ends there, and a lost
    executor costs no more than the tasks it ran."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with _freed_shuffles(spark):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_at = path
    return back


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_staged_at", None)
        if path:
            spark = df.sparkSession
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of an id as text, modulo n: the split of rows that every learning operator uses."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % n


def word_count(text: str | Column) -> Column:
    """Words of a text as a long; none for null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, base: str) -> str:
    """A column name like base that df does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
