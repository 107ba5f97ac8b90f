"""The lockstep replayer against the plain move generator, on random games."""

import random

import numpy as np
import pytest

from plyforge.operators import replay as R
from tests.brute_chess import Position, perft, play


def run(games):
    names = sorted({m for g in games for m in g})
    moves = np.array([names.index(m) for g in games for m in g], np.intp)
    return R.replay(moves, np.array([len(g) for g in games], np.intp), R.parse_san(names))


def fens(out, games):
    i, result = 0, []
    for game in games:
        rows = []
        for ply in range(1, len(game) + 1):
            board = out["board"][i].tobytes().decode()
            ranks = "/".join(board[8 * r:8 * r + 8] for r in range(8))
            for n in range(8, 0, -1):
                ranks = ranks.replace("." * n, str(n))
            rows.append((
                f"{ranks} {'b' if ply % 2 else 'w'} {R.CASTLING_TEXT[int(out['castling'][i])]} "
                f"{R.SQUARE_TEXT[int(out['en_passant'][i])]} {out['halfmove_clock'][i]} {ply // 2 + 1}",
                int(out["repeats"][i]), bool(out["stuck"][i]),
            ))
            i += 1
        result.append(rows)
    return result


def random_game(rng, limit):
    position, sans = Position(), []
    for _ in range(limit):
        legal = sorted(position.legal())
        if not legal:
            break
        quiet = rng.random() < 0.5
        loud = [m for m in legal if m[1] in position.at or m[2] or m[1] == position.ep]
        castle = [m for m in legal if position.at[m[0]] in "Kk" and abs(m[0][0] - m[1][0]) == 2]
        move = rng.choice(castle or (legal if quiet or not loud else loud))
        sans.append(position.san(move))
        position = position.push(move)
    return sans


@pytest.mark.parametrize("depth,nodes", [(1, 20), (2, 400), (3, 8902)])
def test_plain_generator_perft(depth, nodes):
    assert perft(Position(), depth) == nodes


@pytest.mark.parametrize("fen,depth,nodes", [
    ("r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1", 2, 2039),
    ("8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1", 3, 2812),
    ("r3k2r/Pppp1ppp/1b3nbN/nP6/BBP1P3/q4N2/Pp1P2PP/R2Q1RK1 w kq - 0 1", 2, 264),
])
def test_plain_generator_perft_positions(fen, depth, nodes):
    assert perft(Position(fen), depth) == nodes


def test_random_games_agree():
    rng = random.Random(7)
    games = [random_game(rng, rng.choice([1, 9, 40, 120, 200])) for _ in range(60)]
    out, failed = run(games)
    assert failed.tolist() == [0] * len(games)
    for game, got in zip(games, fens(out, games)):
        assert got == play(game)


def test_known_mate():
    game = ("e4 e5 Nf3 d6 d4 Bg4 dxe5 Bxf3 Qxf3 dxe5 Bc4 Nf6 Qb3 Qe7 Nc3 c6 Bg5 b5 Nxb5 cxb5 Bxb5+ Nbd7 O-O-O Rd8 "
            "Rxd7 Rxd7 Rd1 Qe6 Bxd7+ Nxd7 Qb8+ Nxb8 Rd8#").split()
    out, failed = run([game])
    last = fens(out, [game])[0][-1]
    assert failed[0] == 0 and last == ("1n1Rkb1r/p4ppp/4q3/4p1B1/4P3/8/PPP2PPP/2K5 b k - 1 17", 1, True)


def test_stalemate_and_repetition():
    stale = "e3 a5 Qh5 Ra6 Qxa5 h5 h4 Rah6 Qxc7 f6 Qxd7+ Kf7 Qxb7 Qd3 Qxb8 Qh7 Qxc8 Kg6 Qe6".split()
    again = "Nf3 Nf6 Ng1 Ng8 Nf3 Nf6 Ng1 Ng8".split()
    double = "e4 e5 Nf3 Nc6 Ng1 Nb8 Nf3 Nc6 Ng1 Nb8".split()
    out, failed = run([stale, again, double])
    got = fens(out, [stale, again, double])
    assert failed.tolist() == [0, 0, 0]
    assert got[0][-1][2] and not any(r[2] for r in got[0][:-1])
    assert [r[1] for r in got[1]] == [1, 1, 1, 2, 2, 2, 2, 3]
    # e6 after 1... e5 cannot be taken, so the position after it counts as the first of three.
    assert [r[1] for r in got[2]] == [1, 1, 1, 1, 1, 2, 2, 2, 2, 3]


@pytest.mark.parametrize("game,bad", [
    ("e4 e5 Ke3", 3), ("e5", 1), ("e4 e5 Zz9", 3), ("e4 d5 exd5 Qxd5 Qxd5", 5), ("e4 e5 O-O", 3),
    ("e4 e5 Qh5 Nc6 Qxf7+ Nb8", 6), ("Nf3 d6 Nc3 e6 Nd2", 5), ("e4 e5 Bc4 Bc5 Nf3 Nf6 Nxe4", 7),
    ("a4 b5 axb5 a6 bxa6 h6 a7 h5 axb8", 9), ("e4 e5 Nf3 Nf6 Bb5 a6 Bxd7+ a5", 8), ("d4 e5 exd6", 3),
    ("e4 a6 e5 d5 a3 a5 exd6", 7),
])
def test_illegal_moves_are_located(game, bad):
    good = "e4 a6 e5 d5 exd6 cxd6".split()
    out, failed = run([good, game.split()])
    assert failed.tolist() == [0, bad]


def test_pin_decides_between_two_knights():
    # After 3... Bb4 the knight on c3 is pinned to the king, so Ne2 can only be the other one.
    game = "e4 e6 d4 d5 Nc3 Bb4 Ne2".split()
    out, failed = run([game])
    assert failed[0] == 0 and fens(out, [game])[0][-1][0].startswith("rnbqk1nr/ppp2ppp/4p3/3p4/1b1PP3/2N5/PPP1NPPP/R1BQKB1R")


def test_a_long_unreadable_game_ends_early_and_long_shuffles_are_counted():
    shuffle = ("Nf3 Nf6 Ng1 Ng8 " * 40).split()
    garbage = ["e4"] + ["??"] * 50_000
    out, failed = run([shuffle, garbage])
    assert failed.tolist() == [0, 2]
    repeats, clocks = out["repeats"][:160], out["halfmove_clock"][:160]
    assert np.flatnonzero(repeats >= 3)[0] == 7 and clocks[99] == 100
