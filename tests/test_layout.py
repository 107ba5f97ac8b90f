"""File layout, running totals over many files, and resuming an export."""

import os
import random

import pytest
from pyspark.sql import functions as F

from plyforge.operators.loader import eval_sample, pool_files
from plyforge.operators.ranking import running_before
from plyforge.plans.training import resume_export
from plyforge.sources.sinks import load_progress, save_progress, write_batches, write_records


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("count", [0, 1, 3000])
def test_running_totals_without_a_task_of_all_rows(spark, count):
    rng = random.Random(count)
    rows = [(f"f{i:05}", rng.randint(0, 50)) for i in range(count)]
    rng.shuffle(rows)
    files = spark.createDataFrame(rows, "file string, rows long").repartition(7)
    summed = running_before(files, "file", "rows", "before")
    want, total = {}, 0
    for name, n in sorted(rows):
        want[name], total = total, total + n
    assert {r["file"]: r["before"] for r in summed.collect()} == want
    assert "SinglePartition" not in plan_of(summed)


def test_pool_of_many_files(spark):
    rows = spark.range(20_000).select(F.format_string("f%05d", F.floor(F.col("id") / 10)).alias("file"), (F.col("id") % 10).alias("row_index"))
    pool = pool_files(rows, 1234)
    assert {r["file"]: r["before"] for r in pool.collect()} == {f"f{i:05}": i * 10 for i in range(124)}
    sample = eval_sample(rows.withColumn("eval", F.lit(0)), pool_rows=1234, sample_rows=5000)
    assert sample.count() == 1234 and "SinglePartition" not in plan_of(pool)


def test_files_are_bounded_and_whole(spark, tmp_path):
    out = str(tmp_path / "records")
    rows = spark.range(10_000).select(F.col("id"), F.when(F.col("id") % 20 == 0, "test").otherwise("train").alias("setType")).repartition(40)
    write_records(rows, out, rows_per_file=1500)
    sizes = [r["n"] for r in spark.read.parquet(out).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 10_000 and max(sizes) <= 1500 and len(sizes) <= 16
    assert spark.read.parquet(out).select("id").distinct().count() == 10_000


def test_resumed_export_opens_only_what_is_to_come(spark, tmp_path):
    out = str(tmp_path / "batches")
    rows = spark.range(2000).select(
        (F.col("id") % 2).cast("int").alias("shard"), F.floor(F.col("id") / 200).cast("int").alias("window_index"),
        F.floor(F.col("id") % 200 / 20).cast("int").alias("batch_index"), F.col("id").alias("rn"))
    write_batches(rows, out)
    assert load_progress(spark, out) == {} and resume_export(spark, out).count() == 2000
    save_progress(spark, out, {0: (7, 3), 1: (10, 0)})
    save_progress(spark, out, {0: (8, 4), 1: (9, 0)})
    assert load_progress(spark, out) == {0: (8, 4), 1: (9, 0)}
    got = resume_export(spark, out)
    assert {r["rn"] for r in got.collect()} == {
        i for i in range(2000) if (i // 200, i % 200 // 20) >= ((8, 4) if i % 2 == 0 else (9, 0))}
    filters = plan_of(got).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "window_index" in filters and "shard" in filters
    files = got.select("_metadata.file_path").distinct().collect()
    assert {int(r[0].split("window_index=")[1].split("/")[0]) for r in files} == {8, 9}
    assert os.path.exists(f"{out}/_progress.json")
