"""Move replay: SAN half-moves to board states.

Spark spreads the games; inside a task one Arrow batch of games is replayed in lockstep, half-move by
half-move, with numpy over all games of the batch. Nothing here loops over games in Python.

Squares run a8=0 ... h1=63; square 64 stands for "off the board". Boards are ASCII codes, '.' when empty.
"""

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyforge.schemas import PLY

EMPTY, OFF = ord("."), 64
START = np.frombuffer(b"rnbqkbnrpppppppp" + b"." * 32 + b"PPPPPPPPRNBQKBNR\0", np.uint8)
# (row, column) steps: four straight lines, then four diagonals; a line and its opposite sum to 7 per half.
LINES = [(-1, 0), (0, -1), (0, 1), (1, 0), (-1, -1), (-1, 1), (1, -1), (1, 1)]
OPPOSITE = [3, 2, 1, 0, 7, 6, 5, 4]
JUMPS = [(-2, -1), (-2, 1), (-1, -2), (-1, 2), (1, -2), (1, 2), (2, -1), (2, 1)]
SAN = re.compile(r"([NBRQK])?([a-h])?([1-8])?x?([a-h])([1-8])(?:=?([NBRQ]))?[+#]?[!?]*")
CASTLE = re.compile(r"[O0]-[O0](-[O0])?[+#]?[!?]*")
CASTLING_TEXT = pa.array(["".join(c for i, c in enumerate("KQkq") if m >> i & 1) or "-" for m in range(16)])
SQUARE_TEXT = pa.array([f"{'abcdefgh'[s % 8]}{8 - s // 8}" for s in range(64)] + ["-"])
RIGHTS_LOST = np.zeros(65, np.uint8)
RIGHTS_LOST[[60, 63, 56, 4, 7, 0]] = [3, 1, 2, 12, 4, 8]
# Positions kept to count repetitions. Only the moves since the last capture or pawn move can repeat a position,
# and a hundred of those end the game.
REMEMBERED = 128
KEYS = np.random.default_rng(1).integers(1, 2**63, (128 + 16 + 65, 64), np.uint64)
KEYS[EMPTY] = 0


def _reach(steps, length):
    """Squares reached from each square along each step, padded with OFF."""
    table = np.full((64, len(steps), length), OFF, np.intp)
    for square in range(64):
        for i, (dr, dc) in enumerate(steps):
            for k in range(length):
                r, c = square // 8 + dr * (k + 1), square % 8 + dc * (k + 1)
                if 0 <= r < 8 and 0 <= c < 8:
                    table[square, i, k] = r * 8 + c
    return table


RAYS, LEAPS = _reach(LINES, 7), _reach(JUMPS, 1)[:, :, 0]


def _hits():
    """[white, line, adjacent, piece]: does a piece met first along a line from a square attack that square?"""
    table = np.zeros((2, 8, 2, 128), bool)
    for white in (0, 1):
        queen, rook, bishop, king, pawn = (ord(c) for c in ("QRBKP" if white else "qrbkp"))
        table[white, :, :, queen] = True
        table[white, :4, :, rook] = True
        table[white, 4:, :, bishop] = True
        table[white, :, 1, king] = True
        table[white, [6, 7] if white else [4, 5], 1, pawn] = True
    return table


HITS = _hits()


def _own(pieces, white):
    return (pieces >= 65) & (pieces < 97) if white else pieces >= 97


def attackers(board, square, white):
    """The 16 lines and leaps out of `square`: origin squares, and the piece there if it attacks `square`."""
    rows = np.arange(len(board))[:, None] * 65
    flat, rays = board.reshape(-1), RAYS[square]
    first = (flat.take(rays + rows[:, :, None]) != EMPTY).argmax(2)
    seen_at = np.take_along_axis(rays, first[:, :, None], 2)[:, :, 0]
    seen = flat.take(seen_at + rows)
    seen = np.where(HITS[int(white), np.arange(8), (first == 0).astype(np.intp), seen], seen, 0)
    leap_at = LEAPS[square]
    leap = flat.take(leap_at + rows)
    leap = np.where(leap == (ord("N") if white else ord("n")), leap, 0)
    return np.concatenate([seen_at, leap_at], 1), np.concatenate([seen, leap], 1)


def attacked(board, square, white):
    return attackers(board, square, white)[1].any(1)


def _safe_after(board, origin, target, king, white, removed=OFF):
    """Is our king safe once the piece on `origin` stands on `target` and `removed` is taken off?"""
    trial, rows = board.copy(), np.arange(len(board))
    piece = trial[rows, origin]
    trial[rows, removed] = EMPTY
    trial[:, OFF] = 0
    trial[rows, origin] = EMPTY
    trial[rows, target] = piece
    return ~attacked(trial, np.where(origin == king, target, king), not white)


def stuck(board, white, king, ep):
    """Rows in which the side to move has no legal move. Rows leave the search at their first legal move."""
    found, pawn, forward = np.zeros(len(board), bool), ord("P" if white else "p"), 0 if white else 3
    start_row, behind = (6, 8) if white else (1, -8)
    for origin in range(64):
        rows = np.flatnonzero(~found & _own(board[:, origin], white))
        if not len(rows):
            continue
        piece = board[rows, origin]
        paths = [(line, RAYS[origin, line]) for line in range(8)] + [(8, LEAPS[origin, [i]]) for i in range(8)]
        for line, path in paths:
            clear = np.ones(len(rows), bool)
            for k, target in enumerate(path[path != OFF]):
                there = board[rows, target]
                if line == 8:
                    can = piece == ord("N" if white else "n")
                else:
                    can = HITS[int(white), OPPOSITE[line], int(k == 0), piece]
                if line in (4, 5, 6, 7):
                    can = can & ((piece != pawn) | (there != EMPTY) | (ep[rows] == target))
                elif line == forward and (k == 0 or (k == 1 and origin // 8 == start_row)):
                    can = can | ((piece == pawn) & (there == EMPTY))
                can = can & clear & ~_own(there, white) & ~found[rows]
                clear &= there == EMPTY
                if can.any():
                    hit, taken = rows[can], np.where(
                        (piece[can] == pawn) & (ep[rows[can]] == target) & (line > 3), target + behind, OFF)
                    full = np.full(len(hit), origin), np.full(len(hit), target)
                    found[hit] |= _safe_after(board[hit], *full, king[hit], white, taken)
                if not clear.any():
                    break
    return ~found


def parse_san(texts):
    """Per distinct SAN: kind (0 move, 1 short, 2 long castling, -1 unreadable), piece, file, row, target, promotion."""
    out = np.full((len(texts), 6), -1, np.intp)
    for i, text in enumerate(texts):
        castle, move = CASTLE.fullmatch(text), SAN.fullmatch(text)
        if castle:
            out[i] = (2 if castle[1] else 1, ord("K"), -1, -1, OFF, 0)
        elif move:
            piece, file, rank, to_file, to_rank, promotion = move.groups()
            out[i] = (0, ord(piece or "P"), "abcdefgh".index(file) if file else -1, 8 - int(rank) if rank else -1,
                      (8 - int(to_rank)) * 8 + "abcdefgh".index(to_file), ord(promotion or "\0"))
    return out


def _origins(board, san, white, king):
    """Origin square of each move, OFF where no single legal candidate exists."""
    letter, file, row, target = san[:, 1], san[:, 2], san[:, 3], san[:, 4]
    piece = letter if white else letter | 32
    squares, pieces = attackers(board, np.minimum(target, 63), white)
    fits = (pieces == piece[:, None]) & ((file < 0)[:, None] | (squares % 8 == file[:, None]))
    fits &= (row < 0)[:, None] | (squares // 8 == row[:, None])
    several = fits.sum(1) > 1
    for column in np.flatnonzero(fits[several].any(0)):
        rows = np.flatnonzero(several & fits[:, column])
        fits[rows, column] = _safe_after(board[rows], squares[rows, column], target[rows], king[rows], white)
    origin = np.where(fits.sum(1) == 1, np.take_along_axis(squares, fits.argmax(1)[:, None], 1)[:, 0], OFF)
    push = np.flatnonzero((letter == ord("P")) & ((file < 0) | (file == target % 8)))
    if len(push):
        back, goal = 8 if white else -8, target[push]
        one, two = np.clip(goal + back, 0, 63), np.clip(goal + 2 * back, 0, 63)
        single = board[push, one] == piece[push]
        double = (board[push, one] == EMPTY) & (board[push, two] == piece[push]) & (goal // 8 == (4 if white else 3))
        origin[push] = np.where(board[push, goal] != EMPTY, OFF, np.where(single, one, np.where(double, two, OFF)))
    return origin


def replay(moves, lengths, san):
    """Replay games of `lengths` half-moves; `moves` indexes `san` and is flat, game after game.

    Returns the flat per-half-move columns, and per game the number of the half-move that failed (0: none).
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    n, longest = len(lengths), int(lengths.max(initial=0))
    board = np.tile(START, (n, 1))
    rights, clock = np.full(n, 15, np.uint8), np.zeros(n, np.int32)
    king = np.tile(np.array([4, 60]), (n, 1))
    failed = np.zeros(n, np.int32)
    history = np.zeros((n, REMEMBERED), np.uint64)
    placed_key = np.full(n, np.bitwise_xor.reduce(KEYS[START[:64], np.arange(64)]))
    pieces = np.full(n, 32, np.int32)
    history[:, 0] = placed_key ^ KEYS[128 + 15, 0]
    total = len(moves)
    out = {
        "board": np.zeros((total, 64), np.uint8), "castling": np.zeros(total, np.uint8),
        "en_passant": np.full(total, OFF, np.uint8), "halfmove_clock": np.zeros(total, np.int32),
        "repeats": np.zeros(total, np.int32), "piece_count": np.zeros(total, np.int32),
        "stuck": np.zeros(total, bool),
    }
    ep = np.full(n, OFF, np.intp)
    for t in range(longest):
        white = t % 2 == 0
        m = int(np.searchsorted(-lengths[order], -t, "left"))
        if (failed[:m] > 0).all():
            break
        at = starts[:m] + t
        move, rows, b = san[moves[at]], np.arange(m), board[:m]
        kind, target, promotion = move[:, 0].copy(), move[:, 4].copy(), move[:, 5]
        our_king = king[:m, int(white)]
        origin = _origins(b, move, white, our_king)
        home = 60 if white else 4
        for side in (1, 2):
            # Castling: king at home with the right, nothing between, no check on the way.
            pick = np.flatnonzero(kind == side)
            if len(pick):
                step = 1 if side == 1 else -1
                between = [home + 1, home + 2] if side == 1 else [home - 1, home - 2, home - 3]
                fine = (rights[pick] >> (side - 1 + (0 if white else 2)) & 1 == 1)
                fine &= (b[pick][:, between] == EMPTY).all(1)
                for square in (home, home + step):
                    fine &= ~attacked(b[pick], np.full(len(pick), square), not white)
                origin[pick], target[pick] = np.where(fine, home, OFF), home + 2 * step
        target = np.where(target == OFF, 0, target)
        piece, captured = b[rows, origin], b[rows, target]
        pawn = (piece | 32) == ord("p")
        takes_ep = pawn & (target == ep[:m]) & (origin % 8 != target % 8) & (origin != OFF)
        last_row = target // 8 == (0 if white else 7)
        good = (failed[:m] == 0) & (kind >= 0) & (origin != OFF) & ~_own(captured, white)
        good &= ~pawn | (((captured != EMPTY) | takes_ep) == (origin % 8 != target % 8))
        good &= (promotion != 0) == (pawn & last_row)

        g = np.flatnonzero(good)
        o, d = origin[g], target[g]
        promoted = promotion[g] if white else promotion[g] | 32
        b[g, o] = EMPTY
        landed = np.where(promotion[g] != 0, promoted, piece[g]).astype(np.uint8)
        b[g, d] = landed
        placed_key[g] ^= KEYS[piece[g], o] ^ KEYS[landed, d] ^ KEYS[captured[g], d]
        e = g[takes_ep[g]]
        passed = target[e] + (8 if white else -8)
        placed_key[e] ^= KEYS[b[e, passed], passed]
        b[e, passed] = EMPTY
        pieces[g] -= (captured[g] != EMPTY) | takes_ep[g]
        for side, corner, to in ((1, home + 3, home + 1), (2, home - 4, home - 1)):
            c = g[kind[g] == side]
            placed_key[c] ^= KEYS[b[c, corner], to] ^ KEYS[b[c, corner], corner]
            b[c, to], b[c, corner] = b[c, corner], EMPTY
        moved_king = g[(piece[g] | 32) == ord("k")]
        king[moved_king, int(white)] = target[moved_king]
        rights[g] &= ~(RIGHTS_LOST[o] | RIGHTS_LOST[d])
        clock[:m] = np.where(pawn | (captured != EMPTY), 0, clock[:m] + 1)
        double = good & pawn & (np.abs(target - origin) == 16)
        ep[:m] = np.where(double, (target + origin) // 2, OFF)
        good[g] = ~attacked(b[g], king[g, int(white)], not white)
        failed[:m] = np.where(good | (failed[:m] > 0), failed[:m], t + 1)

        # Same position: pieces, side, rights, and an en-passant square only when a pawn stands ready to take.
        ready = np.zeros(m, bool)
        for step, edge in ((-1, 0), (1, 7)):
            beside = np.where(double & (target % 8 != edge), target + step, OFF)
            ready |= b[rows, beside] == ord("p" if white else "P")
        key = placed_key[:m] ^ KEYS[128 + rights[:m], 0]
        key ^= np.where(ready, KEYS[144 + ep[:m], 0], 0) ^ (KEYS[208, 1] if white else np.uint64(0))
        history[:m, (t + 1) % REMEMBERED] = key
        out["board"][at] = b[:, :64]
        out["castling"][at] = rights[:m]
        out["en_passant"][at] = ep[:m]
        out["halfmove_clock"][at] = clock[:m]
        out["repeats"][at] = (history[:m, :min(t + 2, REMEMBERED)] == key[:, None]).sum(1)
        out["piece_count"][at] = pieces[:m]
        # Only the last half-move can end the game by mate or stalemate: any other was followed by a legal one.
        last = np.flatnonzero((lengths[order[:m]] == t + 1) & (failed[:m] == 0))
        if len(last):
            out["stuck"][at[last]] = stuck(b[last], not white, king[last, int(not white)], ep[last])
    by_game = np.empty(n, np.int32)
    by_game[order] = failed
    return out, by_game


def placements(boards):
    """FEN placements of boards (rows of 64 letters), as a string array."""
    n = len(boards)
    letters = np.full((n, 8, 9), ord("/"), np.uint8)
    letters[:, :, :8] = boards.reshape(n, 8, 8)
    kept, run = np.ones((n, 8, 9), bool), np.zeros((n, 8), np.uint8)
    kept[:, 7, 8] = False
    for column in range(8):
        here = letters[:, :, column]
        empty = here == EMPTY
        run = (run + 1) * empty
        # The last square of an empty run becomes its length, the others go.
        kept[:, :, column] = ~empty | (letters[:, :, column + 1] != EMPTY)
        np.copyto(here, run + ord("0"), where=empty)
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(kept.sum((1, 2)), out=offsets[1:])
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(letters[kept]))


def _replay_batches(batches, placement=False):
    for batch in batches:
        index = batch.schema.get_field_index("moves")
        games = batch.column(index)
        lengths = np.diff(games.offsets.to_numpy()).astype(np.intp)
        codes = games.flatten().dictionary_encode()
        san = parse_san(codes.dictionary.to_pylist())
        out, failed = replay(codes.indices.to_numpy().astype(np.intp), lengths, san)
        keep = np.repeat(failed == 0, lengths)
        kept = np.where(failed == 0, lengths, 0)
        ply = (np.arange(len(keep)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1)[keep]
        boards = np.ascontiguousarray(out["board"][keep])
        columns = {
            "ply": pa.array(ply, pa.int32()),
            "board": pa.StringArray.from_buffers(
                len(ply), pa.py_buffer(np.arange(len(ply) + 1, dtype=np.int32) * 64), pa.py_buffer(boards)),
            "castling": CASTLING_TEXT.take(pa.array(out["castling"][keep])),
            "en_passant": SQUARE_TEXT.take(pa.array(out["en_passant"][keep])),
            "halfmove_clock": pa.array(out["halfmove_clock"][keep]),
            "piece_count": pa.array(out["piece_count"][keep]),
            "repeats": pa.array(out["repeats"][keep]),
            "stuck": pa.array(out["stuck"][keep]),
        }
        if placement:
            columns["placement"] = placements(boards)
        plies = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32()),
            pa.StructArray.from_arrays(list(columns.values()), list(columns)))
        rest = [i for i in range(batch.num_columns) if i != index]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in rest] + [plies, pa.array(failed)],
            [batch.schema.field(i).name for i in rest] + ["plies", "failed_ply"])


def replay_moves(games: DataFrame, placement: bool = False) -> DataFrame:
    """Replaces `moves` by `plies`, and adds `failed_ply`: the first half-move that is not legal, else 0.

    A game that fails has no plies. All other columns pass through Python, so carry only what is needed.
    `placement` adds the FEN placement to each half-move, for jobs that write a FEN for all of them.
    """
    ply = T.StructType([*PLY.fields, T.StructField("placement", T.StringType())]) if placement else PLY
    fields = [f for f in games.schema.fields if f.name != "moves"]
    schema = T.StructType([
        *fields, T.StructField("plies", T.ArrayType(ply)), T.StructField("failed_ply", T.IntegerType()),
    ])
    return games.mapInArrow(partial(_replay_batches, placement=placement), schema)


def legal_games(replayed: DataFrame, mode: str = "failfast") -> DataFrame:
    """Games whose moves were all legal. `failfast` fails the job on any other, `dropmalformed` drops it."""
    if mode == "failfast":
        message = F.format_string("illegal half-move %d in game %s", "failed_ply", F.col("game_id").cast("string"))
        checked = F.when(F.col("failed_ply") > 0, F.raise_error(message).cast("int")).otherwise(0)
        return replayed.withColumn("failed_ply", checked).where("failed_ply = 0").drop("failed_ply")
    return replayed.where("failed_ply = 0").drop("failed_ply")


def illegal_games(replayed: DataFrame) -> DataFrame:
    """The games that `dropmalformed` drops, with the half-move that failed."""
    return replayed.where("failed_ply > 0").drop("plies")
