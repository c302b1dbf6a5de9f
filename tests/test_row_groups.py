"""Row groups: bounded by the writer, counted from footers before anything is decoded."""

import pytest
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.sources import datasets, envelopes


def test_groups_are_bounded_and_counted_before_decoding(spark, tmp_path):
    path = f"file://{tmp_path}/events"
    datasets.write(envelopes.synthetic_events(spark, 25_000, 1_791_466_200_000_000_000).coalesce(1), path, "event_v1")
    groups = datasets.row_groups(spark, path)
    assert [g["rows"] for g in groups] == [10_000, 10_000, 5_000] and all(g["uncompressed"] == g["columns"] > 0 for g in groups)
    datasets.check_budget(spark, path)
    for limit in ({"most_groups": 2}, {"most_bytes": 1000}, {"most_group_bytes": 1000}, {"most_files": 0}):
        with pytest.raises(errors.InputLimit):
            datasets.check_budget(spark, path, **limit)


def test_many_small_groups_are_refused(spark, tmp_path):
    path = f"file://{tmp_path}/many"
    spark.range(1030).select(F.col("id"), F.col("id").cast("string").alias("s")).coalesce(1).write.option("parquet.block.row.count.limit", "1").parquet(path)
    assert len(datasets.row_groups(spark, path)) == 1030
    with pytest.raises(errors.InputLimit):
        datasets.check_budget(spark, path)
    datasets.check_budget(spark, path, most_groups=1030)
    spark.range(0).write.parquet(f"file://{tmp_path}/none")
    with pytest.raises(errors.InputLimit):
        datasets.check_budget(spark, f"file://{tmp_path}/none")
