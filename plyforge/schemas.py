"""Table schemas and the constants that decide results."""

from pyspark.sql import types as T

# They decide which positions exist and what the dataset holds.
MATE_CENTIPAWNS = 10_000
DEFAULT_MIN_ELO = 2_000
SKIP_HALF_MOVES = 10
MIN_PIECES = 7
TEST_FRACTION = 0.05
SQUARES = 64
LOGISTIC_SCALING = 400.0
EVAL_SAMPLE_ROWS = 1 << 16
EVAL_POOL_ROWS = 1 << 22
EVAL_SEED = 271_828
WINDOW_ROWS = 1 << 23
LOADER_SHARDS = 4
BATCH_ROWS = 1 << 10
EVAL_EVERY_BOARDS = 1 << 21
TRAIN_SEED = 314_159
CLIP_GRAD_NORM = 1.0
WINNING_ABOVE = 0.8
LOSING_BELOW = 0.2
ARCHIVE_GLOB = "*.pgn.zst"

# What a replayed half-move carries. `board` is 64 characters, a8 first, '.' for an empty square.
PLY = T.StructType([
    T.StructField("ply", T.IntegerType(), False),
    T.StructField("board", T.StringType(), False),
    T.StructField("castling", T.StringType(), False),
    T.StructField("en_passant", T.StringType(), False),
    T.StructField("halfmove_clock", T.IntegerType(), False),
    T.StructField("piece_count", T.IntegerType(), False),
    T.StructField("repeats", T.IntegerType(), False),
    T.StructField("stuck", T.BooleanType(), False),
])

# On-disk names of the training dataset. `setType` is the partition column.
RECORDS = T.StructType([
    T.StructField("fen", T.StringType(), True),
    T.StructField("features", T.ArrayType(T.ByteType(), True), True),
    T.StructField("eval", T.IntegerType(), True),
    T.StructField("outcome", T.IntegerType(), True),
    T.StructField("minElo", T.IntegerType(), True),
    T.StructField("setType", T.StringType(), True),
])
