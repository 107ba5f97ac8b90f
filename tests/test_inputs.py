"""The inputs derived for the queries: their tasks grow in number, not in size."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import catalog, inputs
from plyforge.functions.boards import board_to_placement
from plyforge.operators.games import parse_movetext
from plyforge.operators.replay import placements, replay_moves


@pytest.fixture
def orders(tmp_path):
    keys = list(range(400))
    pq.write_table(pa.table({
        "o_orderkey": pa.array(keys, pa.int64()), "o_custkey": pa.array(keys, pa.int64()),
        "o_orderstatus": ["FOP"[k % 3] for k in keys]}), tmp_path / "orders.parquet")
    return str(tmp_path)


def test_tables_are_cut_into_more_tasks(spark, orders, monkeypatch):
    monkeypatch.setattr(inputs, "TASK_ROWS", 10, raising=False)
    sizes = inputs.table(spark, orders, "orders", "o_orderkey").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 40 and max(n for _, n in sizes) <= 20


def test_an_archive_is_compressed_in_parts(spark, orders):
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = catalog.archives_by_file(spark, orders)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    frames = [bytes(r["content"]).count(b"\x28\xb5\x2f\xfd") for r in spark.read.format("binaryFile").load(folder).collect()]
    assert len(frames) == 4 and max(frames) > 1
    read = catalog.read_games(spark, folder).orderBy("file", "game_ord").select("file", "movetext").collect()
    wrote = inputs.games(spark, orders).orderBy("file", "game_ord").select("file", "movetext").collect()
    assert [r["file"] for r in read] == [f"{r['file']}.pgn.zst" for r in wrote]
    assert [r["movetext"] for r in read] == [r["movetext"] for r in wrote]


def test_placements_come_with_the_replay(spark, orders):
    rng = np.random.default_rng(5)
    boards = rng.choice(np.frombuffer(b"......Pk", np.uint8), (300, 64))
    boards[:2] = [np.full(64, ord(".")), np.full(64, ord("P"))]
    texts = spark.createDataFrame([(i, bytes(b).decode()) for i, b in enumerate(boards)], "i int, board string")
    want = [r[0] for r in texts.orderBy("i").select(board_to_placement(F.col("board"))).collect()]
    assert placements(boards).to_pylist() == want and placements(boards[:0]).to_pylist() == []
    moves = parse_movetext(inputs.games(spark, orders), comments=False).select("game_id", "moves")
    plies = replay_moves(moves, placement=True).select(F.inline("plies"))
    assert plies.where(F.col("placement") != board_to_placement(F.col("board"))).isEmpty() and not plies.isEmpty()


@pytest.fixture
def events(tmp_path):
    keys = list(range(2000))
    pq.write_table(pa.table({
        "event_id": pa.array(keys, pa.int64()), "user_id": pa.array([k % 7 for k in keys], pa.int64()),
        "event_type": ["abc"[k % 3] for k in keys], "value": [k / 20 for k in keys]}), tmp_path / "events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("query", ["training_batches", "export_by_budget"])
def test_boards_are_encoded_once(spark, events, monkeypatch, query):
    made, plain = spark.sparkContext.accumulator(0), inputs.rows

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    def counted(*args, **options):
        rows = plain(*args, **options)
        return rows.mapInArrow(seen, rows.schema)

    monkeypatch.setattr(inputs, "rows", counted)
    assert catalog.QUERIES[query](spark, events).collect()
    assert made.value == 2000


def slow_movetext(k, result, broken):
    """Half-move by half-move, with remainders that have the sign of the key."""
    parts = []
    if k is not None:
        game = inputs.GAMES[int(math.fmod(k, 5) + 1) - 1 if math.fmod(k, 5) > -1 else int(math.fmod(k, 5)) + 1].split(" ")
        if broken and k % 37 == 0:
            game[4] = "Zz9"
        texts, clock, mates, large = inputs.comments()
        for p, san in enumerate(game, 1):
            parts.append(f"{(p + 1) // 2}. {san}" if p % 2 else san)
            if k % 11:
                odd = int(math.fmod(k, 2) == 1)
                at = clock if (k + p * 3) % 13 == 0 else odd * 5 + p % 5 + mates if (k + p) % 23 == 0 else \
                    odd + large if (k + p) % 101 == 0 else int(math.fmod(k * 31 + p * 17, 1999)) + 1998
                parts.append(texts[at])
    return " ".join([*parts, *([] if result is None else [result])])


@pytest.mark.parametrize("broken", [False, True])
def test_movetexts_are_put_together_in_bulk(spark, broken):
    keys = [None, 0, 5, 5, 11, 23, 37, 55, 101, 407, 10**12 + 3, -2, -3, -4, -5, -7, -37, -55, -407, None]
    table = [(k, r) for k in keys for r in ("1-0", "*", None)]
    got = inputs.with_movetext(spark.createDataFrame(table, "game_ord long, result string"), broken)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((k, r, slow_movetext(k, r, broken)) for k, r in table), key=repr)
    assert inputs.with_movetext(spark.createDataFrame([], "game_ord long, result string"), broken).isEmpty()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "transform(" not in plan and "lambda" not in plan
