"""Training reads: seeded file order, epochs, shards, shuffle windows, fixed batches, resume, eval sample.

Plans are made on the file table (one row per data file); rows only ever meet the finished plan.
"""

from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyforge.functions.evals import win_probability
from plyforge.functions.hashing import order_hash
from plyforge.operators.ranking import rank_by_hash, running_before, slice_bits
from plyforge.schemas import (
    BATCH_ROWS, EVAL_POOL_ROWS, EVAL_SAMPLE_ROWS, EVAL_SEED, LOADER_SHARDS, SQUARES, TRAIN_SEED, WINDOW_ROWS,
)


def file_table(rows: DataFrame) -> DataFrame:
    """Rows per data file."""
    return rows.groupBy("file").agg(F.count("*").alias("rows"))


def file_order(files: DataFrame, seed: int = TRAIN_SEED) -> DataFrame:
    """Adds `ord`, the 0-based place of each file in the seeded shuffle."""
    total = files.agg(F.count("*")).scalar()
    drawn = files.withColumns({"_order": order_hash(seed, F.col("file")), "_total": total})
    ranked = rank_by_hash(drawn, [], "_order", ["file"], slice_bits(F.col("_total")), "ord")
    return ranked.withColumn("ord", F.col("ord") - 1).drop("_order", "_total")


def epoch_plan(
    files: DataFrame, epochs: int, shards: int = LOADER_SHARDS, seed: int = TRAIN_SEED
) -> DataFrame:
    """The shuffled file list repeated `epochs` times and dealt out to `shards`, one row per reading of a file; none for no epochs."""
    ordered = file_order(files, seed)
    total = files.agg(F.count("*")).scalar()
    return (
        ordered
        .select("*", F.posexplode(F.array_repeat(F.lit(0), epochs)).alias("epoch", "_")).drop("_")
        .withColumn("pos", F.col("epoch") * total + F.col("ord"))
        .withColumn("shard", (F.col("pos") % shards).cast("int"))
    )


def _fill_windows(window_rows: int):
    """Greedy fold in file order: a window takes whole files until it holds `window_rows`, then the next starts."""

    def fold(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, window, filled = None, 0, 0
        for frame in frames:
            windows = []
            for s, rows in zip(frame["shard"].tolist(), frame["rows"].tolist()):
                if s != shard:
                    shard, window, filled = s, 0, 0
                elif filled >= window_rows:
                    window, filled = window + 1, 0
                filled += rows
                windows.append(window)
            yield frame.assign(window_index=pd.Series(windows, dtype="int32"))

    return fold


def plan_windows(plan: DataFrame, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Adds `window_index` and `window_size` to the epoch plan.

    The fold streams through each shard's files in order and keeps three numbers, whatever their count.
    """
    plan = plan.select("shard", "pos", "epoch", "file", "rows")
    in_order = plan.repartition("shard").sortWithinPartitions("shard", "pos")
    schema = "shard int, pos long, epoch int, file string, rows long, window_index int"
    filled = in_order.mapInPandas(_fill_windows(window_rows), schema)
    sizes = F.sum("rows").over(Window.partitionBy("shard", "window_index"))
    return filled.withColumn("window_size", sizes)


def window_shuffle(rows: DataFrame, windows: DataFrame, seed: int = TRAIN_SEED) -> DataFrame:
    """Every row at its place `rn` (1-based) in the permutation of its window.

    `rows` needs `file` and `row_index`. A file that makes a window huge only makes more slices.
    """
    placed = (
        rows.join(windows.drop("rows"), "file")
        .withColumn("_order", order_hash(seed, *[F.col(c) for c in ("shard", "window_index", "pos", "row_index")]))
    )
    return rank_by_hash(
        placed, ["shard", "window_index"], "_order", ["pos", "row_index"], slice_bits(F.col("window_size"))
    ).drop("_order")


def batch_of(rank: Column, batch_rows: int = BATCH_ROWS) -> Column:
    return F.floor((rank - 1) / batch_rows)


def fixed_batches(shuffled: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Adds `batch_index`; the rows after the last full batch of a window are dropped."""
    full = F.floor(F.col("window_size") / batch_rows)
    return (
        shuffled.withColumn("batch_index", batch_of(F.col("rn"), batch_rows)).where(F.col("batch_index") < full)
    )


def first_batches(
    batches: DataFrame, windows: DataFrame, iterations: int, batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """The first `iterations` batches in delivery order: the shards take turns, and one that is done is passed over.

    A batch's place follows from its number within its shard and the totals of all shards; nothing is sorted.
    """
    per_window = windows.select("shard", "window_index", "window_size").distinct().withColumn(
        "full", F.floor(F.col("window_size") / batch_rows))
    earlier = Window.partitionBy("shard").orderBy("window_index").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_window.select("shard", "window_index", F.coalesce(F.sum("full").over(earlier), F.lit(0)).alias("_start"))
    totals = {r["shard"]: r["n"] for r in per_window.groupBy("shard").agg(F.sum("full").alias("n")).collect()}
    number = F.col("_start") + F.col("batch_index")
    place = F.lit(0)
    for shard, total in sorted(totals.items()):
        place = place + F.least(F.lit(total), number + (F.lit(shard) < F.col("shard")).cast("int"))
    return batches.join(starts, ["shard", "window_index"]).where(place < iterations).drop("_start")


def batch_shortfall(windows: DataFrame, iterations: int, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """One row: batches the plan delivers, batches the run wants, and how many are missing."""
    per_window = windows.select("shard", "window_index", "window_size").distinct()
    return (
        per_window.agg(F.coalesce(F.sum(F.floor(F.col("window_size") / batch_rows)), F.lit(0)).alias("batches"))
        .withColumn("iterations", F.lit(iterations).cast("bigint"))
        .withColumn("missing", F.greatest(F.col("iterations") - F.col("batches"), F.lit(0)))
    )


def resume_batches(batches: DataFrame, state: Mapping[int, tuple[int, int]]) -> DataFrame:
    """Batches still to deliver. `state` gives per shard the next (window_index, batch_index).

    The windows still to come are asked for on their own as well, so that of exported batches only their folders are read.
    """
    pending = F.lit(True)
    for shard, (window, batch) in state.items():
        ahead = (F.col("shard") != shard) | (F.col("window_index") >= window)
        begun = (F.col("shard") != shard) | (F.col("window_index") != window) | (F.col("batch_index") >= batch)
        pending = pending & ahead & begun
    return batches.where(pending)


def check_feature_width(rows: DataFrame, mode: str = "failfast", width: int = SQUARES) -> DataFrame:
    """Rows whose `features` hold `width` values; `failfast` fails the job on any other row."""
    right = F.coalesce(F.size("features") == width, F.lit(False))
    if mode == "failfast":
        return rows.where(F.assert_true(right, F.lit(f"features must hold {width} values")).isNull())
    return rows.where(right)


def feature_width_rejects(rows: DataFrame, width: int = SQUARES) -> DataFrame:
    return rows.where(~F.coalesce(F.size("features") == width, F.lit(False)))


def with_label(rows: DataFrame) -> DataFrame:
    """`label`: win probability of the evaluation."""
    return rows.withColumn("label", win_probability(F.col("eval")).cast("float"))


def pool_files(rows: DataFrame, pool_rows: int = EVAL_POOL_ROWS) -> DataFrame:
    """Files that hold the first `pool_rows` rows in scan order, with the rows `before` each."""
    return running_before(file_table(rows), "file", "rows", "before").select("file", "before").where(F.col("before") < pool_rows)


def eval_sample(
    rows: DataFrame, pool_rows: int = EVAL_POOL_ROWS, sample_rows: int = EVAL_SAMPLE_ROWS, seed: int = EVAL_SEED
) -> DataFrame:
    """A fixed, seeded, uniform sample of the first `pool_rows` rows in scan order.

    Whether a row is in the pool follows from its file's offset and its row index, without sorting rows. The
    sample size is bounded by design, so its top-k needs one small merge.
    """
    return (
        rows.join(pool_files(rows, pool_rows), "file")
        .where(F.col("before") + F.col("row_index") < pool_rows)
        .drop("before")
        .withColumn("sample_order", order_hash(seed, F.col("file"), F.col("row_index")))
        .orderBy("sample_order", "file", "row_index")
        .limit(sample_rows)
    )


def eval_sample_size(rows: DataFrame, pool_rows: int = EVAL_POOL_ROWS) -> DataFrame:
    """One row: test rows and the part of them in the sampling pool."""
    return rows.agg(F.count("*").alias("test_rows")).withColumn(
        "pool_rows", F.least(F.col("test_rows"), F.lit(pool_rows)))
