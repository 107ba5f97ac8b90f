"""PGN text to games, movetext to half-moves, evaluations, and replay edge cases."""

import pytest
from pyspark.sql import functions as F

from plyforge.functions.evals import extract_eval, has_eval
from plyforge.operators import games as G
from plyforge.operators.positions import comment_evals, game_positions
from plyforge.operators.replay import illegal_games, legal_games, replay_moves
from plyforge.plans.dataset import positions_from_records


def parse(spark, movetext):
    row = G.parse_movetext(spark.createDataFrame([("g", movetext)], "game_id string, movetext string")).first()
    return list(row["moves"]), [c.strip() for c in row["comments"]]


@pytest.mark.parametrize("text,moves", [
    ("1. e4 e5 2. Nf3 1-0", "e4 e5 Nf3"), ("1.e4 e5 2.Nf3", "e4 e5 Nf3"), ("1. e4 1... e5 *", "e4 e5"),
    ("1. e4! e5?! $1 $12 2. Nf3 !? 1/2-1/2", "e4! e5?! Nf3"), ("1. e4 (1. d4 d5 (1... Nf6 2. c4)) 1... e5", "e4 e5"),
    ("1. e4 {a ( b} e5 (1... c5 {x ) y} 2. Nf3) 2. Nf3", "e4 e5 Nf3"), ("1. e4 ; rest e5\n1... c5", "e4 c5"),
    ("1. e4\r\n1... e5\r\n2. O-O-O 0-0 0-1", "e4 e5 O-O-O 0-0"), ("{start} 1. {pre} e4 e5", "e4 e5"),
    ("1. e4 {a ; b} e5", "e4 e5"), ("", ""), ("*", ""), ("1. e4 Zz9 2. d4", "e4 Zz9 d4"),
])
def test_moves(spark, text, moves):
    assert parse(spark, text)[0] == moves.split()


def test_comments_belong_to_the_half_move_before(spark):
    moves, comments = parse(spark, "{intro} 1. e4 { a } 1... e5 {b} {c} 2. Nf3 $4 {d} Nc6 1-0")
    assert moves == ["e4", "e5", "Nf3", "Nc6"]
    assert [c.replace("1...", "").replace("2.", "").strip() for c in comments] == ["{ a }", "{b} {c}", "$4 {d}", "1-0"]


@pytest.mark.parametrize("comment,cp", [
    ("[%eval 0.29]", 28), ("[%eval -0.29]", -28), ("[%eval 0.57]", 56), ("[%eval 1.15]", 114), ("[%eval +1.5]", 150),
    ("[%eval #3]", 10000), ("[%eval #-3]", -10000), ("[%eval #0]", 10000), ("[%eval #+2]", 10000),
    ("[%eval 2]", None), ("[%eval 0.2,18]", None), ("no", None), (None, None), ("[%clk 1] [%eval 0.10] [%eval 9.0]", 10),
])
def test_extract_eval(spark, comment, cp):
    df = spark.createDataFrame([(comment,)], "c string")
    assert tuple(df.select(extract_eval(F.col("c")), has_eval(F.col("c"))).first()) == (cp, cp is not None)


def test_tags(spark):
    pgn = ('[Event "a \\"b\\" c"]\r\n[Site "s"]\r\n[WhiteElo "2100"]\r\n[BlackElo "?"]\r\n[Result "1-0"]\r\n\r\n'
           "1. e4 { [Result \"0-1\"] } 1-0\r\n\r\n")
    rows = [("f", 1, pgn), ("f", 2, '[Event "x"]\n\n1. d4 *')]
    got = G.games_from_pgn(spark.createDataFrame(rows, "file string, game_ord long, pgn string")).orderBy("game_ord")
    first, second = got.collect()
    assert (first["white_elo"], first["black_elo"], first["result"]) == (2100, 0, "1-0")
    assert first["movetext"] == '1. e4 { [Result "0-1"] } 1-0'
    assert (second["white_elo"], second["result"], second["movetext"]) == (0, "", "1. d4 *")


def replay(spark, movetext, evals=True):
    if evals:
        movetext = " ".join(f"{m} {{[%eval {i}.00]}}" for i, m in enumerate(movetext.split(), 1))
    df = spark.createDataFrame(
        [("g", "f", 1, movetext, 2000, 1, "train")],
        "game_id string, file string, game_ord long, movetext string, min_elo int, white_outcome int, set_type string")
    return replay_moves(comment_evals(G.parse_movetext(df)))


def test_plies_stop_before_the_mate_and_skip_the_opening(spark):
    game = ("e4 e5 Nf3 d6 d4 Bg4 dxe5 Bxf3 Qxf3 dxe5 Bc4 Nf6 Qb3 Qe7 Nc3 c6 Bg5 b5 Nxb5 cxb5 Bxb5+ Nbd7 O-O-O Rd8 "
            "Rxd7 Rxd7 Rd1 Qe6 Bxd7+ Nxd7 Qb8+ Nxb8 Rd8#")
    got = game_positions(legal_games(replay(spark, game))).orderBy("ply").collect()
    assert [r["ply"] for r in got] == list(range(11, 33))
    assert [r["eval"] for r in got] == [100 * p for p in range(11, 33)]


def test_missing_eval_skips_only_that_half_move(spark):
    text = " ".join(f"{m} {{[%eval {i}.00]}}" if i != 12 else m for i, m in enumerate(
        "e4 e5 Nf3 Nc6 Bc4 Bc5 O-O Nf6 d3 d6 c3 O-O Nbd2 a6".split(), 1))
    assert [r["ply"] for r in game_positions(legal_games(replay(spark, text, False))).collect()] == [11, 13, 14]


def test_illegal_moves_fail_or_are_dropped(spark):
    bad = replay(spark, "e4 e5 Ke3")
    assert [(r["game_id"], r["failed_ply"]) for r in illegal_games(bad).collect()] == [("g", 3)]
    assert legal_games(bad, "dropmalformed").count() == 0
    with pytest.raises(Exception, match="illegal half-move 3 in game g"):
        legal_games(bad).collect()


def test_game_filters(spark):
    rows = [("a", 2000, 2500, "1-0"), ("b", 1999, 2500, "0-1"), ("c", 2100, None, "1-0"), ("d", 2100, 2100, "*"),
            ("e", 2100, 2200, "1/2-1/2"), ("f", 2300, 2200, "0-1"), ("h", 2300, 2200, None)]
    df = spark.createDataFrame(rows, "game_id string, white_elo int, black_elo int, result string")
    got = {r["game_id"]: (r["min_elo"], r["white_outcome"]) for r in G.decode_outcome(G.filter_min_elo(df)).collect()}
    assert got == {"a": (2000, 1), "e": (2100, 0), "f": (2200, -1)}


def test_split_is_constant_per_game_and_seeded(spark):
    df = spark.range(40000).select((F.col("id") % 20000).cast("string").alias("game_id"))
    got = G.split_by_game(df).distinct()
    assert got.count() == 20000
    assert 800 < got.where("set_type = 'test'").count() < 1200
    assert got.exceptAll(G.split_by_game(df.repartition(5)).distinct()).count() == 0
    assert got.exceptAll(G.split_by_game(df, seed=1).distinct()).count() > 0


def test_whole_game_is_dropped_without_an_eval_at_the_gate(spark):
    head = '[Event "x"]\n[WhiteElo "2400"]\n[BlackElo "2300"]\n[Result "1-0"]\n\n'
    moves = "e4 e5 Nf3 Nc6 Bc4 Bc5 O-O Nf6 d3 d6 c3 O-O Nbd2 a6".split()

    def text(without):
        return head + " ".join(m if i in without else f"{m} {{[%eval 0.1{i % 10}]}}" for i, m in enumerate(moves, 1))

    rows = [("f", 1, text([11])), ("f", 2, text([12])), ("f", 3, text(range(20))), ("f", 4, text([]))]
    got = positions_from_records(spark.createDataFrame(rows, "file string, game_ord long, pgn string")).collect()
    assert sorted((r["game_ord"], r["ply"]) for r in got) == [(2, 11), (2, 13), (2, 14), (4, 11), (4, 12), (4, 13), (4, 14)]
