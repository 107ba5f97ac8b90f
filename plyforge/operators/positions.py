"""From replayed games to positions, and the position-level projections."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.functions import boards
from plyforge.functions.evals import LEAST_INT, extract_eval
from plyforge.schemas import MIN_PIECES, PLY, SKIP_HALF_MOVES

POSITION_KEY = ["board", "white_to_move", "castling", "en_passant"]
POSITION_ORDER = ["file", "game_ord", "ply"]


def too_few_pieces(ply: Column, min_pieces: int = MIN_PIECES) -> Column:
    return ply["piece_count"] < min_pieces


def terminal(ply: Column) -> Column:
    """Mate, stalemate, third occurrence, fifty moves without progress, or insufficient material."""
    return (
        ply["stuck"] | (ply["repeats"] >= 3) | (ply["halfmove_clock"] >= 100)
        | boards.insufficient_material(ply["board"], ply["piece_count"])
    )


def first_stop(plies: Column, stop: Callable[[Column], Column]) -> Column:
    """1-based index of the first element for which `stop` holds, null without one."""
    return F.nullif(F.array_position(F.transform(plies, stop), True), F.lit(0))


def prefix_until(df: DataFrame, column: str, stop: Callable[[Column], Column]) -> DataFrame:
    """Cuts an array column before its first element for which `stop` holds. No shuffle."""
    length = F.coalesce((first_stop(F.col(column), stop) - 1).cast("int"), F.size(column))
    return df.withColumn(column, F.slice(column, F.lit(1), length))


def stop_min_pieces(games: DataFrame, min_pieces: int = MIN_PIECES) -> DataFrame:
    return prefix_until(games, "plies", lambda p: too_few_pieces(p, min_pieces))


def stop_terminal(games: DataFrame) -> DataFrame:
    return prefix_until(games, "plies", terminal)


def skip_opening(games: DataFrame, skip: int = SKIP_HALF_MOVES) -> DataFrame:
    return games.withColumn("plies", F.filter("plies", lambda p: p["ply"] > skip))


def comment_evals(games: DataFrame) -> DataFrame:
    """Replaces `comments` by `evals`, so that four bytes per half-move travel on instead of text."""
    return games.withColumn("evals", F.transform("comments", extract_eval)).drop("comments")


def explode_plies(games: DataFrame) -> DataFrame:
    """One row per half-move with its evaluation; all game columns are carried."""
    keep = [c for c in games.columns if c not in ("plies", "evals")]
    return (
        games
        .select(*keep, F.inline(F.arrays_zip("plies", F.col("evals").alias("eval"))))
        .select(*keep, "plies.*", "eval")
        .withColumn("white_to_move", F.col("ply") % 2 == 0)
    )


def game_positions(games: DataFrame, skip: int = SKIP_HALF_MOVES, min_pieces: int = MIN_PIECES) -> DataFrame:
    """Evaluated positions of replayed games: before the first stop, after the opening.

    The stop is looked for in the array, once per game; the rows are cut after the explode, in generated code. Games that still
    have their `failed_ply` keep it, and one that failed becomes one row without a board, whose ply is the half-move that failed.
    """
    stop = first_stop(F.col("plies"), lambda p: too_few_pieces(p, min_pieces) | terminal(p))
    routed = "failed_ply" in games.columns
    games = games.withColumn("_stop", stop)
    wanted = (F.col("ply") > skip) & F.col("eval").isNotNull() & (F.col("_stop").isNull() | (F.col("ply") < F.col("_stop")))
    if routed:
        failed = F.col("failed_ply") > 0
        nothing = {"ply": F.col("failed_ply"), "board": F.lit(""), "castling": F.lit(""), "en_passant": F.lit(""), "stuck": F.lit(False)}
        reject = F.struct(*[nothing.get(f.name, F.lit(0)).cast(f.dataType).alias(f.name) for f in PLY.fields])
        games = games.withColumns({
            "plies": F.when(failed, F.array(reject)).otherwise(F.col("plies")),
            "evals": F.when(failed, F.array(F.lit(0))).otherwise(F.col("evals"))})
        wanted = wanted | failed
    return explode_plies(games).where(wanted).select(
        "game_id", *POSITION_ORDER, *POSITION_KEY, "halfmove_clock",
        "eval", "min_elo", "white_outcome", "set_type", *(["failed_ply"] if routed else []))


def with_fen(positions: DataFrame) -> DataFrame:
    """Adds the FEN; a `placement` from the replay is used as it is."""
    col = F.col
    placement = col("placement") if "placement" in positions.columns else boards.board_to_placement(col("board"))
    return positions.withColumn("fen", boards.fen_text(
        placement, col("white_to_move"), col("castling"), col("en_passant"), col("halfmove_clock"), col("ply")))


def to_mover_pov(positions: DataFrame) -> DataFrame:
    """`eval` and `outcome` as seen by the side to move. The least integer has no opposite and stays as it is."""
    white = F.col("white_to_move") if "white_to_move" in positions.columns else boards.white_to_move(F.col("fen"))
    return positions.withColumns({
        "eval": F.when(white | (F.col("eval") == LEAST_INT), F.col("eval")).otherwise(-F.col("eval")),
        "outcome": F.when(white, F.col("white_outcome")).otherwise(-F.col("white_outcome")),
    })


def encodable(positions: DataFrame) -> DataFrame:
    return positions.where(boards.valid_fen(F.col("fen")))


def encode_rejects(positions: DataFrame) -> DataFrame:
    """Positions whose FEN cannot be encoded; `encodable` is the rest."""
    return positions.where(~boards.valid_fen(F.col("fen")))
