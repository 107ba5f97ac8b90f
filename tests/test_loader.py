"""Training reads against plain Python on small inputs, and their invariants."""

import pytest
from pyspark.sql import functions as F

from plyforge.operators import loader as L
from plyforge.operators.metrics import eval_metrics, run_sizing, step_rollup
from plyforge.operators.ranking import rank_by_hash, slice_bits
from plyforge.plans.training import (
    budgeted_batches, evaluate_sample, export_by_budget, export_training_batches, load_eval_sample, training_batches,
)
from plyforge.sources import dataset
from plyforge.sources.sinks import write_batches, write_records

SIZES = [700, 20, 300, 1, 999, 450, 450, 10, 3000, 5, 600]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"f{i:02}", n) for i, n in enumerate(SIZES)]
    files = spark.createDataFrame(data, "file string, n long")
    return files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("row_index")).withColumns(
        {"eval": (F.col("row_index") * 37 % 2001 - 1000).cast("int"),
         "features": F.array_repeat(F.lit(0).cast("tinyint"), 64)}).cache()


def greedy(plan, window):
    """(shard, pos) -> window by the plain loop."""
    out = {}
    for shard in {p["shard"] for p in plan}:
        index, filled = 0, 0
        for p in sorted((p for p in plan if p["shard"] == shard), key=lambda p: p["pos"]):
            if filled >= window:
                index, filled = index + 1, 0
            filled += p["rows"]
            out[shard, p["pos"]] = index
    return out


@pytest.mark.parametrize("window,epochs,shards", [(500, 3, 4), (1, 1, 2), (10_000, 2, 3), (1300, 5, 4)])
def test_windows_are_greedy(spark, rows, window, epochs, shards):
    plan = L.epoch_plan(L.file_table(rows), epochs, shards)
    got = L.plan_windows(plan, window).collect()
    want = greedy(plan.collect(), window)
    assert {(r["shard"], r["pos"]): r["window_index"] for r in got} == want
    assert len(got) == len(SIZES) * epochs
    assert sorted({r["pos"] for r in got}) == list(range(len(SIZES) * epochs))


def test_epochs_repeat_one_file_order(rows):
    plan = L.epoch_plan(L.file_table(rows), 3).orderBy("pos").collect()
    n = len(SIZES)
    order = [r["file"] for r in plan]
    assert order[:n] == order[n:2 * n] == order[2 * n:] and sorted(order[:n]) == sorted(f"f{i:02}" for i in range(n))
    assert order[:n] != sorted(order[:n])
    other = [r["file"] for r in L.epoch_plan(L.file_table(rows), 1, seed=1).orderBy("pos").collect()]
    assert other != order[:n]


def test_no_epochs_are_no_rows(rows):
    assert L.epoch_plan(L.file_table(rows), 0).count() == 0
    batches, shortfall = budgeted_batches(rows.where("false"), 10_000, 64, 500, 2)
    assert batches.count() == 0 and shortfall.count() == 1


@pytest.mark.parametrize("bits", [0, 3, 12])
def test_sliced_rank_is_the_plain_rank(spark, bits):
    df = spark.range(5000).selectExpr("id", "id % 3 as g", "shiftright(abs(xxhash64(id)), 4) as h")
    got = {r["id"]: r["rn"] for r in rank_by_hash(df, ["g"], "h", ["id"], F.lit(bits)).collect()}
    rows = sorted((r["g"], r["h"], r["id"]) for r in df.collect())
    want, last = {}, None
    for g, _, i in rows:
        rank = rank + 1 if g == last else 1
        want[i], last = rank, g
    assert got == want


def test_slice_bits(spark):
    got = spark.createDataFrame([(1,), (1 << 18,), ((1 << 18) + 1,), (1 << 23,)], "n long").select(slice_bits(F.col("n"))).collect()
    assert [r[0] for r in got] == [0, 0, 1, 5]


def test_every_batch_is_full_and_rows_are_permuted(spark, rows):
    windows = L.plan_windows(L.epoch_plan(L.file_table(rows), 2), 900)
    shuffled = L.window_shuffle(rows, windows).cache()
    assert shuffled.count() == 2 * sum(SIZES)
    per_window = shuffled.groupBy("shard", "window_index").agg(
        F.count("*").alias("n"), F.countDistinct("rn").alias("d"), F.max("rn").alias("m"), F.first("window_size").alias("w"))
    assert per_window.where("n <> d or n <> m or n <> w").count() == 0
    batches = L.fixed_batches(shuffled, 64)
    sizes = batches.groupBy("shard", "window_index", "batch_index").count()
    assert sizes.where("count <> 64").count() == 0
    want = sum(r["n"] // 64 for r in per_window.collect())
    assert sizes.count() == want
    short = L.batch_shortfall(windows, want + 5, 64).first()
    assert (short["batches"], short["missing"]) == (want, 5)


def test_resume_continues_where_the_state_points(spark, rows):
    windows = L.plan_windows(L.epoch_plan(L.file_table(rows), 1), 900)
    batches = L.fixed_batches(L.window_shuffle(rows, windows), 64).select("shard", "window_index", "batch_index").distinct().cache()
    places = sorted(map(tuple, batches.where("shard = 1").collect()))
    left = L.resume_batches(batches, {1: places[3][1:]})
    assert sorted(map(tuple, left.where("shard = 1").collect())) == places[3:]
    assert left.where("shard <> 1").count() == batches.where("shard <> 1").count()


def test_eval_sample_comes_from_the_pool(spark, rows):
    pool, size = 1500, 400
    got = L.eval_sample(rows, pool, size)
    place = {(f"f{i:02}", r): sum(SIZES[:i]) + r for i, n in enumerate(SIZES) for r in range(n)}
    at = [place[r["file"], r["row_index"]] for r in got.collect()]
    assert len(at) == len(set(at)) == size and max(at) < pool
    assert 500 < sum(at) / size < 1000
    again = L.eval_sample(rows.repartition(5), pool, size).collect()
    assert sorted(place[r["file"], r["row_index"]] for r in again) == sorted(at)
    assert L.eval_sample(rows, pool, 10_000).count() == pool
    assert tuple(L.eval_sample_size(rows, pool).first()) == (sum(SIZES), pool)


def test_feature_width(spark):
    df = spark.createDataFrame([(1, [0] * 64), (2, [0] * 63), (3, None)], "i int, features array<int>")
    assert [r["i"] for r in L.check_feature_width(df, "dropmalformed").collect()] == [1]
    assert [r["i"] for r in L.feature_width_rejects(df).orderBy("i").collect()] == [2, 3]
    assert L.check_feature_width(df.where("i = 1")).count() == 1
    with pytest.raises(Exception, match="must hold 64 values"):
        L.check_feature_width(df).collect()


def test_labels(spark):
    df = spark.createDataFrame([(0,), (400,), (-10000,)], "eval int")
    assert [round(r["label"], 4) for r in L.with_label(df).collect()] == [0.5, 0.7311, 0.0]


def test_run_sizing(spark):
    df = spark.range(1000).selectExpr("if(id < 950, 'train', 'test') as setType")
    got = run_sizing(df, 5000, 64).first()
    assert tuple(got) == (950, 78, 6, 15, 32768)
    with pytest.raises(ValueError, match="less than one batch"):
        run_sizing(df, 63, 64)


def test_rollup_windows_end_at_evaluations(spark):
    steps = spark.range(11).selectExpr("id as step", "cast(id as double) as loss", "0.5D + id / 10 as grad_norm", "0.5D as seconds")
    got = step_rollup(steps, 4, 64, 5).orderBy("step").collect()
    assert [(r["step"], r["train_loss"], r["boards"]) for r in got] == [(0, 0.0, 0), (4, 2.5, 256), (8, 6.5, 512), (10, 9.5, 640)]
    assert [round(r["train_grad_clipped"], 3) for r in got] == [0.0, 0.0, 0.75, 1.0]
    assert got[1]["boards_per_second"] == 128.0 and got[3]["epoch"] == 2.0


def test_metrics_use_full_batches_only(spark):
    df = spark.range(100).selectExpr("id as row_id", "3.0D as logit", "1.0D as label")
    got = eval_metrics(df, 32).first()
    assert (got["rows"], got["winning_ratio"], got["losing_ratio"]) == (96, 1.0, 0.0)
    assert round(got["loss"], 6) == 0.048587


def test_export_and_sample_from_a_dataset_on_disk(spark, tmp_path):
    root, out = str(tmp_path / "data"), str(tmp_path / "batches")
    records = spark.range(3000).selectExpr(
        "cast(null as string) as fen", "array_repeat(cast(1 as tinyint), 64) as features", "cast(id as int) as eval",
        "0 as outcome", "2000 as minElo", "if(id % 20 = 0, 'test', 'train') as setType")
    write_records(records.repartition(6), root)
    export_training_batches(spark, root, out, epochs=2, batch_rows=50, window_rows=400)
    got = spark.read.parquet(out)
    sizes = got.groupBy("shard", "window_index", "batch_index").agg(F.count("*").alias("n"), F.max("rn").alias("last"))
    assert sizes.where("n <> 50 or last <> 50 * (batch_index + 1)").count() == 0 and got.count() > 4000
    sample = load_eval_sample(spark, root, pool_rows=100, sample_rows=40)
    assert sample.count() == 40 and sample.where("label between 0 and 1").count() == 40
    assert dataset.scan_projected(spark, root).columns == ["features", "eval"]


def test_a_hot_file_is_spread_over_tasks(spark):
    """One file with most rows makes one huge window; its ranking still runs in many slices."""
    files = spark.createDataFrame([("hot", 400_000), ("b", 10), ("c", 10)], "file string, n long")
    rows = files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("row_index"))
    rows = rows.withColumns({"eval": F.lit(1), "features": F.array_repeat(F.lit(0).cast("tinyint"), 64)})
    windows = L.plan_windows(L.epoch_plan(L.file_table(rows), 1, 1), 100)
    bits = windows.select(slice_bits(F.col("window_size"), 1 << 12).alias("b")).agg(F.max("b")).first()[0]
    assert bits == 7
    got = training_batches(rows, 1, 1000, 100, 1)
    assert got.count() == 400_000


def test_a_run_takes_its_budget_in_turns(spark, tmp_path):
    rows = spark.range(1000).select(
        F.concat(F.lit("f"), F.floor(F.col("id") / 100).cast("string")).alias("file"), (F.col("id") % 100).alias("row_index"),
        F.expr("transform(sequence(1, 64), x -> cast(0 as tinyint))").alias("features"), F.col("id").cast("int").alias("eval"))
    got, shortfall = budgeted_batches(rows, 1500, batch_rows=10, window_rows=150, shards=3)
    batches = {(r["shard"], r["window_index"], r["batch_index"]) for r in got.select("shard", "window_index", "batch_index").distinct().collect()}
    assert len(batches) == 150 and shortfall.first()["missing"] == 0
    assert [sum(b[0] == s for b in batches) for s in range(3)] == [50, 50, 50]
    write_batches(got, str(tmp_path / "out"), batches_per_file=4)
    files = spark.read.parquet(str(tmp_path / "out")).groupBy("shard", "window_index", "batch_index").agg(
        F.countDistinct("_metadata.file_path").alias("n"), F.count("*").alias("rows"))
    assert files.where("n <> 1 or rows <> 10").count() == 0


def test_sample_to_metrics(spark, tmp_path):
    records = spark.range(500).select(
        F.lit(None).cast("string").alias("fen"), F.expr("transform(sequence(1, 64), x -> cast(id % 7 as tinyint))").alias("features"),
        (F.col("id") * 3).cast("int").alias("eval"), F.lit(1).alias("outcome"), F.lit(2000).alias("minElo"),
        F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("setType"))
    write_records(records, str(tmp_path / "set"))
    sample = load_eval_sample(spark, str(tmp_path / "set"), pool_rows=60, sample_rows=50)
    got = evaluate_sample(sample, lambda: lambda boards: boards[:, 0].astype("float64") - 3, step=256, batch_rows=16).first()
    assert sample.count() == 50 and (got["step"], got["rows"]) == (256, 48)
    export = export_by_budget(spark, str(tmp_path / "set"), str(tmp_path / "batches"), train_boards=600, batch_rows=10, window_rows=100, shards=2)
    assert export["iterations"] == 60 <= export["batches"] and export["missing"] == 0
    assert spark.read.parquet(str(tmp_path / "batches")).count() == 600
