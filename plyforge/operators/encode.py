"""Board encoding and the training-record projection.

Each step is its own projection because the next one reads it several times: Catalyst then keeps the steps
apart and every string is built once per row, inside one generated stage.
"""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from plyforge.functions import boards
from plyforge.operators.positions import encodable, to_mover_pov, with_fen

BOARD_COLUMNS = ["board", "white_to_move", "castling", "en_passant"]


def parse_fen(positions: DataFrame, fen: str = "fen") -> DataFrame:
    """FEN text to the board columns the encoder reads."""
    col = F.col(fen)
    return positions.withColumns({
        "board": boards.fen_to_board(col),
        "white_to_move": boards.white_to_move(col),
        "castling": boards.fen_field(col, 3),
        "en_passant": boards.fen_field(col, 4),
    })


def encode_boards(positions: DataFrame, features: str = "features") -> DataFrame:
    """Adds 64 tokens per board, A1=0 ... H8=63 from the mover's side."""
    white, tokens = F.col("white_to_move"), F.col("_tokens")
    return (
        positions
        .withColumn("_tokens", boards.piece_tokens(F.col("board"), white))
        .withColumns({
            "_file": boards.capturable_file(tokens, F.col("en_passant")),
            "_tokens": boards.with_castling(tokens, F.col("castling"), white),
        })
        .withColumn("_tokens", boards.with_en_passant(tokens, F.col("_file")))
        .withColumn(features, boards.token_array(tokens))
        .drop("_tokens", "_file")
    )


def encode_fen(positions: DataFrame, features: str = "features") -> DataFrame:
    """``encode_boards`` for positions that only have a FEN."""
    return encode_boards(parse_fen(positions), features).drop(*BOARD_COLUMNS)


def training_records(
    positions: DataFrame, debug_fen: bool = False, observation: Observation | None = None
) -> DataFrame:
    """Positions to rows of the training dataset, under its on-disk names.

    Positions that only have a FEN are dropped if it cannot be encoded; `observation` counts them as `rejected`.
    """
    if "board" not in positions.columns:
        if observation is not None:
            positions = positions.observe(observation, F.count_if(~boards.valid_fen(F.col("fen"))).alias("rejected"))
        source = parse_fen(encodable(positions))
    else:
        source = with_fen(positions) if debug_fen else positions
    return (
        encode_boards(to_mover_pov(source))
        .select(
            (F.col("fen") if debug_fen else F.lit(None).cast("string")).alias("fen"),
            "features", "eval", "outcome", F.col("min_elo").alias("minElo"), F.col("set_type").alias("setType"),
        )
    )
