"""Hand-checked encodings, and the mirror property."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from plyforge.functions import boards as B
from plyforge.operators.encode import encode_fen, training_records
from plyforge.operators.positions import encodable, encode_rejects

RANKS = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR"
BACK = [10, 4, 6, 12, 14, 6, 4, 10]


def encode(spark, *fens):
    df = spark.createDataFrame([(i, f) for i, f in enumerate(fens)], "i int, fen string")
    return [list(r["features"]) for r in encode_fen(df).orderBy("i").collect()]


def test_start_position_for_both_sides(spark):
    white, black = encode(spark, f"{RANKS} w KQkq - 0 1", f"{RANKS} b KQkq - 0 1")
    assert white == BACK + [2] * 8 + [0] * 32 + [3] * 8 + [t + 1 for t in BACK]
    assert black == white


def test_black_sees_the_board_mirrored(spark):
    [e] = encode(spark, "rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq e3 0 1")
    assert (e[36], e[28], e[8:16]) == (3, 0, [2] * 8)
    assert 1 not in e


def test_en_passant_only_when_a_pawn_can_take(spark):
    got = encode(
        spark, "rnbqkbnr/pp1ppppp/8/8/2pP4/8/PPP1PPPP/RNBQKBNR b KQkq d3 0 2",
        "4k3/8/8/pP6/8/8/8/4K3 w - a6 0 1", "4k3/8/8/p6P/8/8/8/4K3 w - a6 0 1", "4k3/8/8/6Pp/8/8/8/4K3 w - h6 0 1",
        "4k3/8/8/8/Pp6/8/8/4K3 b - a3 0 1", "4k3/8/8/8/P6p/8/8/4K3 b - a3 0 1")
    assert (got[0][35], got[0][34]) == (1, 2)
    assert [e.count(1) for e in got] == [1, 1, 0, 1, 1, 0]
    assert (got[1][32], got[3][39], got[4][32]) == (1, 1, 1)


def test_castling_tokens_follow_rights_and_side(spark):
    white, black = encode(spark, f"{RANKS} w Kq - 0 1", f"{RANKS} b Kq - 0 1")
    assert [white[i] for i in (0, 7, 56, 63)] == [8, 10, 11, 9]
    assert [black[i] for i in (0, 7, 56, 63)] == [10, 8, 9, 11]


def test_castling_token_does_not_look_for_a_rook(spark):
    [e] = encode(spark, "4k3/8/8/8/8/8/8/4K3 w KQkq - 0 1")
    assert [e[i] for i in (0, 7, 56, 63)] == [10, 10, 11, 11]


def test_colour_flip_and_mirror_give_the_same_tokens(spark):
    fens = ["r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQ - 0 1",
            "8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1", "4k3/8/8/pP6/8/8/8/4K3 w q a6 0 1"]

    def flip(fen):
        ranks, side, castling, ep, *rest = fen.split()
        ep = ep if ep == "-" else ep[0] + {"3": "6", "6": "3"}[ep[1]]
        rights = "".join(sorted(castling.swapcase(), key="KQkq-".index))
        return " ".join([
            "/".join(r.swapcase() for r in reversed(ranks.split("/"))), "b" if side == "w" else "w", rights, ep, *rest])

    assert encode(spark, *fens) == encode(spark, *map(flip, fens))


@pytest.mark.parametrize("fen,good", [
    (f"{RANKS} w KQkq - 0 1", True), ("44/8/8/8/8/8/8/4K3 b - e3 0 1", True),
    ("8/8/8/8/8/8/8 w - - 0 1", False), ("9/8/8/8/8/8/8/8 w - - 0 1", False), (f"{RANKS} x KQkq - 0 1", False),
    (f"{RANKS} w QK - 0 1", False), (f"{RANKS} w KQkq e4 0 1", False), ("", False), (None, False), (RANKS, False),
    (RANKS.replace("q", "x") + " w - - 0 1", False),
])
def test_valid_fen(spark, fen, good):
    df = spark.createDataFrame([(fen,)], "fen string")
    assert (encodable(df).count(), encode_rejects(df).count()) == ((1, 0) if good else (0, 1))


def test_board_text_round_trip(spark):
    fens = [f"{RANKS} w KQkq - 0 1", "8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1"]
    df = spark.createDataFrame([(f,) for f in fens], "fen string")
    back = df.select(B.board_to_placement(B.fen_to_board(F.col("fen"))).alias("p")).collect()
    assert [r["p"] for r in back] == [f.split()[0] for f in fens]


@pytest.mark.parametrize("pieces,stops", [
    ("4k3/8/8/8/8/8/8/4K3", True), ("4k3/8/8/8/8/8/8/4KN2", True), ("4k3/8/8/8/8/8/8/4KB2", True),
    ("4k3/8/8/8/8/8/8/4KR2", False), ("4k3/8/8/8/8/8/8/3NKN2", False), ("4kb2/8/8/8/8/8/8/2B1K3", True),
    ("2b1k3/8/8/8/8/8/8/2B1K3", False), ("4k3/8/8/8/8/8/P7/4K3", False),
])
def test_insufficient_material(spark, pieces, stops):
    df = spark.createDataFrame([(f"{pieces} w - - 0 1",)], "fen string").withColumn("b", B.fen_to_board(F.col("fen")))
    count = sum(c.isalpha() for c in pieces)
    assert df.select(B.insufficient_material(F.col("b"), F.lit(count))).first()[0] is stops


def test_records_from_the_mover_s_side(spark):
    rows = [(f"{RANKS} w KQkq - 0 1", 30, 1), (f"{RANKS} b KQkq - 0 1", 30, 1), ("junk", 1, 1)]
    df = spark.createDataFrame(rows, "fen string, eval int, white_outcome int").selectExpr(
        "*", "2100 as min_elo", "'train' as set_type")
    got = {r["fen"]: (r["eval"], r["outcome"], r["minElo"], r["setType"]) for r in training_records(df, True).collect()}
    assert got == {rows[0][0]: (30, 1, 2100, "train"), rows[1][0]: (-30, -1, 2100, "train")}
    rejects = Observation()
    assert [r["fen"] for r in training_records(df, observation=rejects).collect()] == [None, None]
    assert rejects.get["rejected"] == 1
