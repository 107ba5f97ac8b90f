"""Counts, run sizing, evaluation metrics, step rollups and the dataset digest."""

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyforge.functions.evals import sigmoid, sigmoid_cross_entropy
from plyforge.functions.hashing import order_hash
from plyforge.schemas import (
    BATCH_ROWS, CLIP_GRAD_NORM, EVAL_EVERY_BOARDS, EVAL_SEED, LOSING_BELOW, WINNING_ABOVE,
)


def count_by_split(records: DataFrame) -> DataFrame:
    return records.groupBy("setType").agg(F.count("*").alias("rows"))


def run_sizing(records: DataFrame, train_boards: int, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """One row: steps, epochs and evaluation cadence of a run over the train split; without rows there, epochs is null."""
    iterations = train_boards // batch_rows
    if iterations == 0:
        raise ValueError(f"{train_boards} boards are less than one batch of {batch_rows}")
    train = F.col("train_rows")
    return (
        records.where(F.col("setType") == "train").agg(F.count("*").alias("train_rows"))
        .select(
            "train_rows",
            F.lit(iterations).cast("bigint").alias("iterations"),
            F.ceil(F.try_divide(F.lit(train_boards), train)).alias("epochs"),
            F.ceil(train / batch_rows).alias("steps_per_epoch"),
            F.lit(EVAL_EVERY_BOARDS // batch_rows).cast("bigint").alias("validation_freq"),
        )
    )


def eval_metrics(scored: DataFrame, batch_rows: int = BATCH_ROWS, seed: int = EVAL_SEED) -> DataFrame:
    """Loss and winning / losing share over the full batches of a scored sample (`row_id, logit, label`).

    All batches have one size, so the mean of their means is the mean over their rows.
    """
    # Fewer rows than one batch are left over: the last ones in hash order, taken by a top-k of that size.
    drawn = scored.withColumn("_order", order_hash(seed, F.col("row_id")))
    left = drawn.count() % batch_rows
    over = drawn.select(F.col("_order").alias("_last"), F.col("row_id").alias("_id")).orderBy(F.desc("_last"), F.desc("_id")).limit(left)
    kept = drawn.join(F.broadcast(over), (F.col("_order") == F.col("_last")) & (F.col("row_id") == F.col("_id")), "left_anti") \
        if left else drawn
    prediction = sigmoid(F.col("logit"))
    return kept.agg(
        F.avg(sigmoid_cross_entropy(F.col("logit"), F.col("label"))).alias("loss"),
        F.avg((prediction > WINNING_ABOVE).cast("int")).alias("winning_ratio"),
        F.avg((prediction < LOSING_BELOW).cast("int")).alias("losing_ratio"),
        F.count("*").alias("rows"),
    )


def step_rollup(steps: DataFrame, freq: int, batch_rows: int, steps_per_epoch: int) -> DataFrame:
    """Training means between evaluations, which fall on every `freq`-th step and on the last one.

    `steps` has one row per step: `step, loss, grad_norm, seconds`.
    """
    last = steps.agg(F.max("step")).scalar()
    evaluated_at = F.least(F.ceil(F.col("step") / freq) * freq, last)
    return (
        steps.groupBy(evaluated_at.alias("step"))
        .agg(
            F.avg("loss").alias("train_loss"),
            F.avg("grad_norm").alias("train_grad_norm"),
            F.avg((F.col("grad_norm") > CLIP_GRAD_NORM).cast("int")).alias("train_grad_clipped"),
            (F.count("*") * batch_rows / F.sum("seconds")).alias("boards_per_second"),
        )
        .withColumns({"epoch": F.col("step") / steps_per_epoch, "boards": F.col("step") * batch_rows})
    )


def _digest(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    split, sha = None, None
    for frame in frames:
        for s, name, length in zip(frame["split"].tolist(), frame["name"].tolist(), frame["length"].tolist()):
            if s != split:
                if sha is not None:
                    yield pd.DataFrame({"split": [split], "digest": [sha.hexdigest()[:8]]})
                split, sha = s, hashlib.sha256()
            sha.update(f"{name}:{length}".encode())
    if sha is not None:
        yield pd.DataFrame({"split": [split], "digest": [sha.hexdigest()[:8]]})


def dataset_digest(files: DataFrame, dataset: str) -> DataFrame:
    """Per split the first 8 hex digits of SHA-256 over the `name:length` of its files in name order.

    `files` has `split, name, length`. The hash runs over the sorted listing as a stream; no list is built.
    """
    listing = files.select("split", "name", F.col("length").cast("bigint").alias("length"))
    in_order = listing.repartition("split").sortWithinPartitions("split", "name")
    return (
        in_order.mapInPandas(_digest, "split string, digest string")
        .select(F.concat(F.lit(f"{dataset}-"), F.col("split")).alias("source"), "digest")
    )
