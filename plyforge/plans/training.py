"""Dataset to training batches, the evaluation sample, and a scored evaluation."""

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.operators.loader import (
    batch_shortfall, check_feature_width, epoch_plan, eval_sample, file_table, first_batches, fixed_batches,
    plan_windows, pool_files, resume_batches, window_shuffle, with_label,
)
from plyforge.operators.metrics import eval_metrics, run_sizing
from plyforge.operators.scoring import score_boards
from plyforge.schemas import (
    BATCH_ROWS, EVAL_POOL_ROWS, EVAL_SAMPLE_ROWS, EVAL_SEED, LOADER_SHARDS, TRAIN_SEED, WINDOW_ROWS,
)
from plyforge.sources.dataset import scan_records, scan_rows
from plyforge.sources.paths import stored
from plyforge.sources.sinks import load_progress, write_batches

BATCH_COLUMNS = ["shard", "window_index", "batch_index", "rn", "features", "label"]


def stored_windows(
    rows: DataFrame, epochs: int, window_rows: int = WINDOW_ROWS, shards: int = LOADER_SHARDS, seed: int = TRAIN_SEED
) -> DataFrame:
    """The window plan, stored before rows meet it: it is small, and its size decides how Spark joins it.

    The file table is stored as well, since the plan reads it several times and it costs a pass over all rows.
    """
    files = stored(file_table(rows), "files")
    return stored(plan_windows(epoch_plan(files, epochs, shards, seed), window_rows), "windows")


def training_batches(
    rows: DataFrame, epochs: int, batch_rows: int = BATCH_ROWS, window_rows: int = WINDOW_ROWS,
    shards: int = LOADER_SHARDS, seed: int = TRAIN_SEED,
) -> DataFrame:
    """`shard, window_index, batch_index, rn, features, label` for every row that training will see.

    `rows` has `file, row_index, features, eval`.
    """
    windows = stored_windows(rows, epochs, window_rows, shards, seed)
    batches = fixed_batches(window_shuffle(rows, windows, seed), batch_rows)
    return with_label(check_feature_width(batches)).select(*BATCH_COLUMNS)


def budgeted_batches(
    rows: DataFrame, train_boards: int, batch_rows: int = BATCH_ROWS, window_rows: int = WINDOW_ROWS,
    shards: int = LOADER_SHARDS, seed: int = TRAIN_SEED,
) -> tuple[DataFrame, DataFrame]:
    """The batches of a run over `train_boards` boards, and its shortfall (one row).

    Epochs follow from the budget and the rows of the train split; delivery stops at the run's number of steps.
    """
    sizing = run_sizing(rows.select(F.lit("train").alias("setType")), train_boards, batch_rows).first()
    windows = stored_windows(rows, int(sizing["epochs"] or 0), window_rows, shards, seed)
    batches = fixed_batches(window_shuffle(rows, windows, seed), batch_rows)
    kept = first_batches(batches, windows, sizing["iterations"], batch_rows)
    wanted = with_label(check_feature_width(kept)).select(*BATCH_COLUMNS)
    return wanted, batch_shortfall(windows, sizing["iterations"], batch_rows)


def export_training_batches(spark: SparkSession, dataset: str, output: str, epochs: int, **options) -> None:
    """All batches of so many epochs, each batch within one file."""
    write_batches(training_batches(scan_rows(spark, dataset, "train"), epochs, **options), output)


def export_by_budget(spark: SparkSession, dataset: str, output: str, train_boards: int, **options) -> dict:
    """The batches of a run over `train_boards` boards; returns how many it wants, gets and misses."""
    batches, shortfall = budgeted_batches(scan_rows(spark, dataset, "train"), train_boards, **options)
    write_batches(batches, output)
    return shortfall.first().asDict()


def resume_export(spark: SparkSession, output: str) -> DataFrame:
    """Exported batches still to deliver, by the progress saved beside them; folders of earlier windows are not opened."""
    return resume_batches(spark.read.parquet(output), load_progress(spark, output))


def load_eval_sample(
    spark: SparkSession, dataset: str, pool_rows: int = EVAL_POOL_ROWS, sample_rows: int = EVAL_SAMPLE_ROWS,
    seed: int = EVAL_SEED,
) -> DataFrame:
    """The fixed evaluation sample with labels and row ids, ready for scoring.

    The pool is the head of the test split. Its files are looked up first (a count per file, no data columns), and
    the reader is given those files alone. There are no more of them than the pool has rows.
    """
    rows = scan_rows(spark, dataset, "test")
    names = [row["file"] for row in pool_files(rows, pool_rows).select("file").collect()]
    if names:
        folder = f"{dataset.rstrip('/')}/setType=test"
        files = spark.read.schema(scan_records(spark, dataset).schema).option("basePath", dataset).parquet(
            *[f"{folder}/{name}" for name in names])
        rows = files.select(
            F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row_index"), "features", "eval")
    return with_row_id(with_label(eval_sample(rows, pool_rows, sample_rows, seed)))


def with_row_id(sample: DataFrame) -> DataFrame:
    return sample.withColumn("row_id", F.concat_ws(":", "file", "row_index"))


def evaluate_sample(
    sample: DataFrame, make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]], step: int,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """One row of metrics of the user's model at `step`, as `append_metrics` takes it."""
    scored = stored(score_boards(sample, make_predict_fn).select("row_id", "logit", "label"), "scored")
    return eval_metrics(scored, batch_rows).withColumn("step", F.lit(step).cast("bigint"))
