"""Writers of the training dataset, of training batches and of the metrics history."""

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.sources.paths import exists, file_system, read_text, write_text

#: Most rows of a data file.
ROWS_PER_FILE = 1 << 20
#: The leading underscore keeps it out of scans.
PROGRESS = "_progress.json"

METRICS = [
    "step", "epoch", "train_loss", "train_grad_norm", "train_grad_clipped",
    "test_loss", "test_winning_ratio", "test_losing_ratio",
]


def require_empty(spark: SparkSession, path: str) -> None:
    """Creates the folder if it is missing and fails if it holds anything."""
    fs, jpath = file_system(spark, path)
    if fs.exists(jpath) and len(fs.listStatus(jpath)):
        raise ValueError(f"output folder is not empty: {path}")
    fs.mkdirs(jpath)


def write_records(records: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Appends to the dataset, one folder per split. Guard a first write with `require_empty`.

    Rows are rebalanced into files of an even size, none of more than `rows_per_file`: the shuffle windows of training follow the largest file.
    """
    writer = records.hint("rebalance", "setType").write.mode("append").partitionBy("setType")
    writer.option("maxRecordsPerFile", rows_per_file).parquet(path)


def save_progress(spark: SparkSession, path: str, state: Mapping[int, tuple[int, int]]) -> None:
    """Puts the next (window_index, batch_index) of each shard beside the exported batches, as a whole or not at all."""
    write_text(spark, f"{path.rstrip('/')}/{PROGRESS}", json.dumps({str(shard): list(at) for shard, at in state.items()}))


def load_progress(spark: SparkSession, path: str) -> dict[int, tuple[int, int]]:
    """What was saved last; nothing for an export that was not begun."""
    file = f"{path.rstrip('/')}/{PROGRESS}"
    saved = json.loads(read_text(spark, file)) if exists(spark, file) else {}
    return {int(shard): tuple(at) for shard, at in saved.items()}


def write_batches(batches: DataFrame, path: str, batches_per_file: int = 64) -> None:
    """Training batches by shard and window, in delivery order within each file; a batch is never in two files."""
    (
        batches.repartition("shard", "window_index", F.floor(F.col("batch_index") / batches_per_file))
        .sortWithinPartitions("shard", "window_index", "rn")
        .write.partitionBy("shard", "window_index").parquet(path)
    )


def append_metrics(rollup: DataFrame, test_metrics: DataFrame, path: str) -> None:
    """Joins training rollups with evaluation metrics by step and appends them as CSV with a header."""
    tested = test_metrics.select(
        "step", F.col("loss").alias("test_loss"), F.col("winning_ratio").alias("test_winning_ratio"),
        F.col("losing_ratio").alias("test_losing_ratio"))
    (
        rollup.join(tested, "step").select(*METRICS).withColumn("epoch", F.round("epoch", 5))
        .coalesce(1).sortWithinPartitions("step")
        .write.mode("append").option("header", True).csv(path)
    )
