"""Archives on disk to a dataset on disk, whole and in steps."""

import hashlib
import json
import os
import shutil
import time

import pytest
import zstandard
from pyspark.sql import functions as F

from plyforge.operators.dedup import cap_positions, dedup_first_wins
from plyforge.operators.metrics import count_by_split, dataset_digest, run_sizing
from plyforge.functions.evals import extract_eval
from plyforge.operators.positions import to_mover_pov
from plyforge.plans.dataset import build_dataset, qualifying_games, unique_positions
from plyforge.sources import dataset
from plyforge.sources.archives import list_archives, pgn_records, read_games, scan_archives
from plyforge.sources.sinks import append_metrics, require_empty
from plyforge.sources.keys import KeyTable
from plyforge.sources.paths import stored
from plyforge.streaming import ingest
from tests.brute_chess import Position
from tests.test_replay_kernel import random_game

import random


def pgn(moves, elo=2300, result="1-0", eol="\n"):
    body = " ".join(f"{m} {{ [%eval {i % 7}.{i % 10}5] }}" for i, m in enumerate(moves, 1))
    tags = [("Event", "Rated"), ("WhiteElo", elo), ("BlackElo", 2200), ("Result", result)]
    return eol.join([*(f'[{k} "{v}"]' for k, v in tags), "", f"{body} {result}", "", ""])


def write_archive(path, texts, frames=1):
    """A compressed archive, optionally of several frames."""
    data = [t.encode() for t in texts]
    step = -(-len(data) // frames)
    with open(path, "wb") as out:
        for i in range(0, len(data), step):
            out.write(zstandard.compress(b"".join(data[i:i + step])))


@pytest.fixture(scope="module")
def games():
    rng = random.Random(3)
    opening = "e4 e5 Nf3 Nc6 Bc4 Bc5".split()
    found = []
    for _ in range(24):
        position = Position()
        for san in opening:
            position = position.push(position.find(san))
        moves = list(opening)
        for _ in range(10):
            move = rng.choice(sorted(position.legal()))
            moves.append(position.san(move))
            position = position.push(move)
        found.append(moves)
    return found + found[:6] + [random_game(rng, 40) for _ in range(4)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory, games):
    path = tmp_path_factory.mktemp("archives")
    write_archive(path / "b.pgn.zst", [pgn(g) for g in games[:10]], frames=3)
    write_archive(path / "a.pgn.zst", [pgn(g, eol="\r\n") for g in games[10:20]])
    write_archive(path / "c.pgn.zst", [pgn(g) for g in games[20:]] + [pgn(games[0], elo=1500), pgn(games[1], result="*")])
    (path / "notes.txt").write_text("not an archive")
    return str(path)


def expected(games_by_file, skip=10):
    """Unique (key, eval, file, ply) by walking the games in order with the plain generator."""
    seen = {}
    for name, moves_list in games_by_file:
        for moves in moves_list:
            position = Position()
            for ply, san in enumerate(moves, 1):
                position = position.push(position.find(san))
                if len(position.at) < 7 or next(position.legal(), None) is None:
                    break
                key = " ".join(position.fen().split()[:4])
                if ply > skip and key not in seen:
                    seen[key] = (name, ply, int(float(f"{ply % 7}.{ply % 10}5") * 100))
    return seen


def test_listing(spark, folder, tmp_path):
    assert [os.path.basename(r["path"]) for r in list_archives(spark, folder).collect()] == [
        "a.pgn.zst", "b.pgn.zst", "c.pgn.zst"]
    with pytest.raises(ValueError, match="no "):
        list_archives(spark, str(tmp_path))
    with pytest.raises(ValueError, match="not a folder"):
        list_archives(spark, f"{folder}/a.pgn.zst")


def test_games_are_split_whatever_the_line_ends(spark, folder, games):
    got = read_games(spark, folder).orderBy("file", "game_ord").collect()
    assert [r["file"] for r in got] == ["a.pgn.zst"] * 10 + ["b.pgn.zst"] * 10 + ["c.pgn.zst"] * (len(games) - 18)
    assert [r["movetext"].split()[0] for r in got][:20] == [g[0] for g in games[10:20] + games[:10]]
    assert {r["white_elo"] for r in got} == {2300, 1500}
    assert scan_archives(spark, f"{folder}/b.pgn.zst").count() == 10


def test_first_occurrence_wins_however_rows_are_spread(spark, folder, games):
    want = expected([("a.pgn.zst", games[10:20]), ("b.pgn.zst", games[:10]), ("c.pgn.zst", games[20:])])
    records = scan_archives(spark, folder)
    for source in (records, records.repartition(7)):
        got = unique_positions(source).selectExpr("file", "ply", "eval").collect()
        assert sorted(map(tuple, got)) == sorted(want.values())


def test_dedup_keeps_one_row_of_a_hot_key(spark):
    rows = spark.range(0, 60000).selectExpr("'f' as file", "id as game_ord", "1 as ply", "if(id % 3 = 0, 0, id) as k")
    got = dedup_first_wins(rows, ["k"])
    assert got.count() == 40001 - 0 and got.where("k = 0").first()["game_ord"] == 0
    assert got.exceptAll(dedup_first_wins(rows.repartition(11), ["k"])).count() == 0


@pytest.mark.parametrize("limit", [0, 1, 4999, 5000, 5001, 29999, 30000, 30001])
def test_cap_takes_exactly_the_first_rows(spark, limit):
    rows = spark.range(30000).selectExpr(
        "concat('f', cast(id % 3 as string)) as file", "(id * 7919) % 30011 as game_ord", "cast(id % 5 as int) as ply")
    got = cap_positions(rows, limit)
    want = rows.orderBy("file", "game_ord", "ply").limit(limit)
    assert got.count() == min(limit, 30000) and got.exceptAll(want).count() == 0


def test_output_must_be_empty(spark, tmp_path):
    require_empty(spark, str(tmp_path / "new"))
    require_empty(spark, str(tmp_path / "new"))
    (tmp_path / "new" / "x").write_text("x")
    with pytest.raises(ValueError, match="not empty"):
        require_empty(spark, str(tmp_path / "new"))


def test_build_dataset(spark, folder, games, tmp_path):
    out = str(tmp_path / "out")
    stats = build_dataset(spark, folder, out, debug_fen=True)
    want = expected([("a.pgn.zst", games[10:20]), ("b.pgn.zst", games[:10]), ("c.pgn.zst", games[20:])])
    got = dataset.scan_records(spark, out)
    assert stats["unique_positions"] == got.count() == len(want)
    assert {" ".join(r["fen"].split()[:4]) for r in got.collect()} == set(want)
    assert got.where("size(features) = 64").count() == len(want)
    counted = {r["setType"]: r["rows"] for r in count_by_split(got).collect()}
    assert sum(counted.values()) == len(want)
    assert sorted(d for d in os.listdir(out) if d.startswith("setType")) == [f"setType={s}" for s in sorted(counted)]
    assert dataset.scan_split(spark, out, "train").count() == counted["train"]
    plan = dataset.scan_split(spark, out, "train").select("eval")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(setType" in plan and "ReadSchema: struct<eval:int>" in plan
    with pytest.raises(ValueError, match="not empty"):
        build_dataset(spark, folder, out)


@pytest.mark.parametrize("limit", [1, 30, 95, 10_000])
def test_limited_build_takes_archives_in_order(spark, folder, games, tmp_path, limit):
    out = str(tmp_path / "out")
    stats = build_dataset(spark, folder, out, limit=limit, debug_fen=True)
    want = list(expected([("a.pgn.zst", games[10:20]), ("b.pgn.zst", games[:10]), ("c.pgn.zst", games[20:])]))
    got = [" ".join(r["fen"].split()[:4]) for r in dataset.scan_records(spark, out).collect()]
    assert stats["unique_positions"] == len(got) and sorted(got) == sorted(want[:limit])
    assert stats["archives"] == {1: 1, 30: 1}.get(limit, stats["archives"])


def test_no_position_is_in_both_splits(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    build_dataset(spark, folder, out, debug_fen=True)
    keys = dataset.scan_records(spark, out).select(F.substring_index("fen", " ", 4).alias("k"), "setType").distinct()
    assert keys.count() == keys.select("k").distinct().count()


def test_incremental_ingest(spark, games, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    write_archive(inbox / "b.pgn.zst", [pgn(g) for g in games[:10]])
    for name, part in (("b.pgn.zst", games[:10]), ("a.pgn.zst", games[5:20]), (None, [])):
        if name == "a.pgn.zst":
            write_archive(inbox / name, [pgn(g) for g in part])
        query = ingest.ingest_new_archives(spark, str(inbox), out, debug_fen=True)
        query.awaitTermination()
        assert query.exception() is None
        done = games[:10] if name == "b.pgn.zst" else games[:20]
        got = [" ".join(r["fen"].split()[:4]) for r in dataset.scan_records(spark, out).collect()]
        assert sorted(got) == sorted(expected([("x", done)]))


def test_known_positions_are_absent(spark, folder, tmp_path):
    found = stored(unique_positions(scan_archives(spark, folder)), "found")
    known = KeyTable(spark, str(tmp_path / "keys"))
    assert ingest.absent_positions(found, known).count() == found.count()
    known.add("a", found.where("file = 'a.pgn.zst'"))
    assert ingest.absent_positions(found, known).count() == found.where("file <> 'a.pgn.zst'").count()


def some_keys(spark, first, last):
    board = F.translate(F.concat(F.md5(F.col("id").cast("string")), F.md5(F.concat(F.lit("b"), F.col("id")))), "0123456789abcdef", "....PNBRQKpnbrqk")
    return spark.range(first, last).select(board.alias("board"), (F.col("id") % 2 == 0).alias("white_to_move"), F.lit("-").alias("castling"),
                                           F.lit("-").alias("en_passant"))


def test_stored_keys_are_not_exchanged(spark, tmp_path):
    known = KeyTable(spark, str(tmp_path / "keys"), buckets=5)
    known.add("1", some_keys(spark, 0, 3000))
    known.add("2", some_keys(spark, 3000, 4000))
    candidates = stored(some_keys(spark, 3500, 6000), "candidates")
    got = known.known_among(candidates)
    assert got.count() == 500
    plan = got._jdf.queryExecution().sparkPlan().toString(), got._jdf.queryExecution().executedPlan().toString()
    tree = plan[1].split("== Initial Plan ==")[-1]
    assert tree.count("Exchange") == 1 and "ShuffledHashJoin" in tree and "Bucketed: true" in tree and "Sort" not in tree
    scan, moved = tree.index("Bucketed: true"), tree.index("Exchange")
    assert scan < moved  # the exchange lies above the candidates, the second child


def test_bloom_filters_leave_out_row_groups(spark, tmp_path):
    known = KeyTable(spark, str(tmp_path / "keys"), buckets=2, row_group_bytes=65_536)
    known.add("1", some_keys(spark, 0, 40_000))
    candidates = stored(some_keys(spark, 39_990, 40_003), "few")
    rows = {}
    for few in (0, 256):
        got = known.known_among(candidates, few)
        assert got.count() == 10
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = known.known_among(candidates, few)
            execution = plan._jdf.queryExecution()
            execution.toRdd().count()
            leaves = execution.executedPlan().collectLeaves()
            scan = next(leaves.apply(i) for i in range(leaves.size()) if "Bucketed" in leaves.apply(i).toString())
            rows[few] = scan.metrics().apply("numOutputRows").value()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert rows[0] == 40_000 and rows[256] < 20_000


def test_parts_of_the_key_table_are_merged(spark, tmp_path):
    path = str(tmp_path / "keys")
    known = KeyTable(spark, path, buckets=3)
    for i in range(10):
        known.add(f"g{i}", some_keys(spark, i * 100, i * 100 + 100))
        known.add(f"g{i}", some_keys(spark, 0, 5))  # a repeated group
    assert sorted(known.parts().values()) == [0, 0, 1]
    assert known.keys().count() == known.keys().distinct().count() == 1000
    assert len([d for d in os.listdir(path) if d.startswith("part=")]) == 3
    spark.sql(f"DROP TABLE {known.name}")  # as in a new session
    again = KeyTable(spark, path)
    assert again.buckets == 3 and again.keys().count() == 1000


def test_ingest_after_a_build_reads_only_new_archives(spark, folder, games, tmp_path, monkeypatch):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    shutil.copytree(folder, inbox)
    built = build_dataset(spark, str(inbox), out, debug_fen=True)["unique_positions"]
    write_archive(inbox / "d.pgn.zst", [pgn(random_game(random.Random(99), 40))])
    read = []
    monkeypatch.setattr(ingest, "pgn_records", lambda batch, path: read.append(
        {r[0].rsplit("/", 1)[-1] for r in batch.select("file_path").distinct().collect()}) or pgn_records(batch, path))
    query = ingest.ingest_new_archives(spark, str(inbox), out, debug_fen=True)
    query.awaitTermination()
    assert query.exception() is None and set().union(*read) == {"d.pgn.zst"}
    assert dataset.scan_records(spark, out).count() > built


def test_clock_only_games_do_not_reach_the_exchange(spark):
    def text(comment):
        return '[Event "x"]\n[WhiteElo "2300"]\n[BlackElo "2300"]\n[Result "1-0"]\n\n1. e4 { [%clk 0:01:00] } e5 { ' + comment + " } 1-0"

    rows = [("f", i, text("[%eval 0.3]" if i % 10 == 0 else "[%clk 0:00:59]")) for i in range(50)]
    records = spark.createDataFrame(rows, "file string, game_ord long, pgn string")
    assert qualifying_games(records).count() == 5


def test_malformed_games_are_counted_and_listed(spark, games, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    broken = [*games[1][:12], "Zz9", *games[1][13:]]
    write_archive(inbox / "a.pgn.zst", [pgn(games[0]), pgn(broken), pgn(games[2])])
    stats = build_dataset(spark, str(inbox), out, debug_fen=True, mode="dropmalformed")
    assert stats["malformed_games"] == 1 and stats["games"] == stats["annotated"] == 3 and stats["positions"] >= stats["unique_positions"]
    rejects = spark.read.parquet(f"{out}/_ingest/group=build-0/rejects").collect()
    assert [(r["file"], r["failed_ply"]) for r in rejects] == [("a.pgn.zst", 13)]
    got = {" ".join(r["fen"].split()[:4]) for r in dataset.scan_records(spark, out).collect()}
    assert got == set(expected([("a.pgn.zst", [games[0], games[2]])]))


def test_ingest_lists_malformed_games_as_the_build_does(spark, games, tmp_path):
    inbox, built, streamed = tmp_path / "in", str(tmp_path / "built"), str(tmp_path / "streamed")
    inbox.mkdir()
    for k, name in enumerate("ab"):
        broken = [*games[k][:12], "Zz9", *games[k][13:]]
        write_archive(inbox / f"{name}.pgn.zst", [pgn(games[k]), pgn(broken), pgn(games[k + 2])])
    stats = build_dataset(spark, str(inbox), built, debug_fen=True, mode="dropmalformed", group_bytes=1)
    assert stats["malformed_games"] == 2 and stats["games"] == 6 and stats["archives"] == 2
    query = ingest.ingest_new_archives(spark, str(inbox), streamed, debug_fen=True, mode="dropmalformed")
    query.awaitTermination()
    assert query.exception() is None

    def rejects(out):
        return sorted(map(tuple, spark.read.parquet(f"{out}/_ingest/group=*/rejects").select("file", "failed_ply").collect()))

    assert rejects(built) == rejects(streamed) == [("a.pgn.zst", 13), ("b.pgn.zst", 13)]
    assert dataset.scan_records(spark, built).count() == dataset.scan_records(spark, streamed).count() == stats["unique_positions"]
    counted = ingest.DatasetWriter(spark, streamed).group_counts("stream-0")
    assert counted["games"] == 6 and counted["malformed_games"] == 2 and counted["unique_positions"] == stats["unique_positions"]


def test_progress_of_an_ingest_is_logged(spark, games, tmp_path, caplog):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    write_archive(inbox / "a.pgn.zst", [pgn(g) for g in games[:4]])
    with caplog.at_level("INFO", logger="plyforge.streaming.ingest"):
        ingest.ingest_new_archives(spark, str(inbox), out).awaitTermination()
        for _ in range(100):
            if caplog.records:
                break
            time.sleep(0.1)
    assert any("'games': 4" in r.getMessage() for r in caplog.records)


def test_run_sizing_without_train_rows(spark):
    got = run_sizing(spark.createDataFrame([("test",)], "setType string"), 10_000).first()
    assert got["train_rows"] == 0 and got["epochs"] is None and got["steps_per_epoch"] == 0


def test_scores_beyond_an_integer(spark):
    rows = [("[%eval 99999999.00]", True), ("[%eval -99999999.00]", True), ("[%eval -99999999.00]", False), ("[%eval 0.29]", False)]
    got = spark.createDataFrame(rows, "c string, white_to_move boolean").withColumns(
        {"eval": extract_eval(F.col("c")), "white_outcome": F.lit(1)})
    assert [r["eval"] for r in got.collect()] == [2**31 - 1, -2**31, -2**31, 28]
    assert [r["eval"] for r in to_mover_pov(got).collect()] == [2**31 - 1, -2**31, -2**31, -28]


def test_a_repeated_group_adds_nothing_and_a_broken_one_is_taken_back(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    writer = ingest.DatasetWriter(spark, out)
    first = unique_positions(scan_archives(spark, f"{folder}/a.pgn.zst"))
    second = unique_positions(scan_archives(spark, f"{folder}/b.pgn.zst"))
    n = writer.append("1", first)
    assert writer.append("1", first) == n
    writer.append("2", second)
    total = dataset.scan_records(spark, out).count()
    os.remove(f"{out}/_ingest/group=2/done")  # as if the job died right after its append
    moved = f"{out}/setType=train/2-000000.parquet"
    if os.path.exists(moved):  # or in the middle of it
        source = next(s for s, t in json.load(open(f"{out}/_ingest/group=2/manifest.json"))["moves"] if t.endswith("train/2-000000.parquet"))
        os.makedirs(os.path.dirname(source.removeprefix("file:")), exist_ok=True)
        os.rename(moved, source.removeprefix("file:"))
    writer.append("2", second)
    assert dataset.scan_records(spark, out).count() == total


def test_digest_of_real_files(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    build_dataset(spark, folder, out)
    got = {r["source"]: r["digest"] for r in dataset_digest(dataset.split_files(spark, out), "out").collect()}
    for split in ("train", "test"):
        if f"out-{split}" in got:
            sha, place = hashlib.sha256(), f"{out}/setType={split}"
            for name in sorted(f for f in os.listdir(place) if f.endswith(".parquet")):
                sha.update(f"{name}:{os.path.getsize(f'{place}/{name}')}".encode())
            assert got[f"out-{split}"] == sha.hexdigest()[:8]
    assert dataset.train_files(spark, out).count() == len(
        [f for f in os.listdir(f"{out}/setType=train") if f.endswith(".parquet")])


def test_metrics_csv(spark, tmp_path):
    out = str(tmp_path / "metrics")
    for step in (0, 128):
        rollup = spark.createDataFrame([(step, step / 7, 0.5, 1.0, 0.25)],
                                       "step long, epoch double, train_loss double, train_grad_norm double, train_grad_clipped double")
        tested = spark.createDataFrame([(step, 0.6, 0.1, 0.2)], "step long, loss double, winning_ratio double, losing_ratio double")
        append_metrics(rollup, tested, out)
    rows = spark.read.option("header", True).csv(out).orderBy(F.col("step").cast("int")).collect()
    assert [(r["step"], r["epoch"], r["test_losing_ratio"]) for r in rows] == [("0", "0.0", "0.2"), ("128", "18.28571", "0.2")]
