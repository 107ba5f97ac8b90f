"""Chess inputs derived from the given tables with expressions that Spark and DuckDB share.

games    one annotated game per order, its moves from a template game
boards   one board per event, from a hash; not legal, which encoding does not need
rows     the boards' evaluations as rows of data files of 512
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.template_games import GAMES
from plyforge.functions.boards import board_to_placement
from plyforge.functions.hashing import uniform32
from plyforge.operators.encode import encode_fen
from plyforge.operators.once import evaluated_once
from plyforge.schemas import TRAIN_SEED
from plyforge.sources.paths import scratch

FILE_ROWS = 512
#: Rows of a task that derives inputs, about.
TASK_ROWS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A given table, spread over the cores, since deriving costs more than reading; the tasks grow in number, not in size."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS)))


def comments() -> tuple[list[str], int, int, int]:
    """All comments that a half-move can have: scores by the remainder of 1999 they come from, also negative ones, then a clock, mates and far
    too large scores; and where these three begin."""
    scores = []
    for remainder in range(-1998, 1999):
        cp = remainder - 999
        scores.append(f"{'-' if cp < 0 else ''}{abs(cp) // 100}.{abs(cp) % 100:02d}")
    mates = [f"#{sign}{n}" for sign in ("", "-") for n in range(1, 6)]
    evals = [*scores, *mates, "99999999.00", "-99999999.00"]
    texts = [f"{{ [%eval {e}] }}" for e in evals]
    return [*texts, "{ [%clk 0:03:00] }"], len(texts), len(scores), len(scores) + len(mates)


def comment_places(k: np.ndarray, p: int, clock: int, mates: int, large: int) -> np.ndarray:
    """Places in `comments()`, which gives the last three numbers, of the comments of half-move `p`: an evaluation in pawns, now and then far
    too large, a mate distance, or only a clock. Remainders have the sign of the key, as in SQL."""
    odd = np.fmod(k, 2) == 1
    return np.select(
        [np.fmod(k + p * 3, 13) == 0, np.fmod(k + p, 23) == 0, np.fmod(k + p, 101) == 0],
        [clock, odd * 5 + p % 5 + mates, odd + large], np.fmod(k * 31 + p * 17, 1999) + 1998)


def half_moves(broken: bool) -> list[list[str]]:
    """The half-moves of each template game as they stand in a movetext, with numbers before White's."""
    games = [g.split(" ") for g in GAMES]
    if broken:
        games = [[*g[:4], "Zz9", *g[5:]] for g in games]
    return [[f"{i // 2 + 1}. {san}" if i % 2 == 0 else san for i, san in enumerate(g)] for g in games]


def tagged_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tags of the games say; `game_id` is the order key."""
    k = F.col("o_orderkey")
    result = (
        F.when(F.col("o_orderstatus") == "F", "1-0").when(F.col("o_orderstatus") == "O", "0-1")
        .when(k % 5 == 0, "*").otherwise("1/2-1/2")
    )
    elo = F.when(k % 29 == 0, 0)
    return table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus").select(
        k.cast("string").alias("game_id"),
        F.concat(F.lit("archive-"), (k % 4).cast("string")).alias("file"),
        k.alias("game_ord"),
        elo.otherwise((F.col("o_custkey") * 13 % 1000 + 1600).cast("int")).alias("white_elo"),
        elo.otherwise(((k * 7) % 1000 + 1500).cast("int")).alias("black_elo"),
        result.alias("result"),
    )


def movetext_writer(broken: bool):
    """A function that writes the movetext of games of the given keys and results, a batch at a time.

    Games of a template are put together half-move by half-move, all at once, from the template's text and looked-up comments.
    """
    plain, other = half_moves(False), half_moves(True)
    every, *begins = comments()
    texts = pa.array(every)

    def of_template(game: list[str], k: np.ndarray) -> pa.Array:
        parts = []
        for p, text in enumerate(game, 1):
            parts += [pa.scalar(text), texts.take(pa.array(comment_places(k, p, *begins)))]
        return pc.binary_join_element_wise(*parts, " ")

    @F.arrow_udf("string")
    def movetext(key: pa.Array, result: pa.Array) -> pa.Array:
        known = np.flatnonzero(np.asarray(key.is_valid()))
        k = key.drop_null().to_numpy()
        if len(k) and np.abs(k.astype(np.float64)).max() >= 2.0**58:
            raise OverflowError("a key is too large to draw comments from")
        at = np.fmod(k, len(GAMES)) + 1
        if (at == 0).any():
            raise ValueError("a key has no template")
        at = np.where(at > 0, at - 1, at + len(GAMES))
        wrong, bare = (np.fmod(k, 37) == 0) & broken, np.fmod(k, 11) == 0
        found, places = [], []
        for template, games in enumerate(zip(plain, other, strict=True)):
            for game, chosen in zip(games, (~wrong, wrong), strict=True):
                for rows in (np.flatnonzero((at == template) & chosen & b) for b in (~bare, bare)):
                    if len(rows):
                        found.append(pa.array([" ".join(game)] * len(rows)) if bare[rows[0]] else of_template(game, k[rows]))
                        places.append(rows)
        moves = pa.array([], pa.string())
        if found:
            moves = pa.concat_arrays(found).take(pa.array(np.argsort(np.concatenate(places))))
        place = np.zeros(len(key), np.int64)
        place[known] = np.arange(len(known))
        # A game without a key has no half-moves, only its result.
        moves = moves.take(pa.array(place, mask=~np.asarray(key.is_valid())))
        return pc.coalesce(pc.binary_join_element_wise(moves, result, " "), moves, result, pa.scalar(""))

    return movetext


def with_movetext(tagged: DataFrame, broken: bool = False) -> DataFrame:
    """Games with their movetext. `broken` writes nonsense for the fifth half-move of every 37th game."""
    return evaluated_once(tagged, {"movetext": movetext_writer(broken)("game_ord", "result")})


def games(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """The games table."""
    return with_movetext(tagged_games(spark, sf_dir), broken)


def pgn_records(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """The same games as PGN text."""
    return as_pgn(games(spark, sf_dir, broken))


def as_pgn(found: DataFrame) -> DataFrame:

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'[{name} "'), value, F.lit('"]\n'))

    def rating(elo: str) -> Column:
        return F.when(F.col(elo) == 0, "?").otherwise(F.col(elo).cast("string"))

    text = F.concat(
        line("Event", F.lit("Rated game")), line("Site", F.col("game_id")), line("Result", F.col("result")),
        line("WhiteElo", rating("white_elo")), line("BlackElo", rating("black_elo")),
        F.lit("\n"), F.col("movetext"))
    return found.select("file", "game_ord", text.alias("pgn"))


def archive_folder(spark: SparkSession, sf_dir: str, broken: bool = False) -> str:
    """The PGN text as compressed archives in key order, in a new scratch folder."""
    folder = scratch(spark, "archives")
    # The tags are put in order before the text is made, so that no text moves.
    ordered = tagged_games(spark, sf_dir).repartitionByRange("game_ord").sortWithinPartitions("game_ord")
    (
        as_pgn(with_movetext(ordered, broken))
        .select(F.concat("pgn", F.lit("\n\n")))
        .write.option("compression", "gzip").text(folder)
    )
    return folder


def hashed_board(seed: Column) -> Column:
    return F.translate(
        F.concat(F.md5(seed), F.md5(F.concat(F.lit("b"), seed))), "0123456789abcdef", "....PNBRQKpnbrqk")


def hashed_fen(seed: Column, k: Column) -> Column:
    """A FEN from a text seed and a number."""
    letters = F.concat(
        F.when(k % 2 == 1, "K").otherwise(""), F.when(k % 4 >= 2, "Q").otherwise(""),
        F.when(k % 8 >= 4, "k").otherwise(""), F.when(k % 16 >= 8, "q").otherwise(""))
    ep_rank = F.when(k % 2 == 0, "6").otherwise("3")
    file = F.substr(F.lit("abcdefgh"), (k % 8 + 1).cast("int"), F.lit(1))
    return F.concat_ws(
        " ", board_to_placement(hashed_board(seed)), F.when(k % 2 == 0, "w").otherwise("b"),
        F.when(k % 16 == 0, "-").otherwise(letters),
        F.when(k % 3 == 0, F.concat(file, ep_rank)).otherwise("-"), F.lit("0"), F.lit("1"))


def boards(spark: SparkSession, sf_dir: str, repeated: bool = False, faulty: bool = False) -> DataFrame:
    """Positions with a FEN. `repeated` gives all events of one user and type the same board; `faulty` breaks some."""
    k = F.col("event_id")
    seed = F.concat_ws("-", "user_id", "event_type") if repeated else k.cast("string")
    positions = evaluated_once(events(spark, sf_dir), {"fen": hashed_fen(seed, F.col("user_id") if repeated else k)})
    if not faulty:
        return positions
    fen = F.col("fen")
    broken = (
        F.when(k % 37 == 0, F.regexp_replace(fen, "^[^/]*/", ""))
        .when(k % 41 == 0, F.replace(fen, F.lit(" w "), F.lit(" x ")))
        .when(k % 43 == 0, F.concat(F.lit("Z"), fen)).otherwise(fen)
    )
    return evaluated_once(positions, {"fen": broken})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the boards carry besides the FEN."""
    k = F.col("event_id")
    return table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value").select(
        k, F.col("event_type").alias("file"), F.col("user_id").alias("game_ord"), k.cast("int").alias("ply"),
        "user_id", "event_type", ((F.col("value") * 100).cast("int") - 5000).alias("eval"),
        (k % 500 + 2000).cast("int").alias("min_elo"), (k % 3 - 1).cast("int").alias("white_outcome"),
        F.when(uniform32(TRAIN_SEED, k) < 214748365, "test").otherwise("train").alias("set_type"),
    )


def rows(spark: SparkSession, sf_dir: str, features: bool = False) -> DataFrame:
    """Rows of data files: `file, row_index, eval`, and `features` on demand."""
    k = F.col("event_id")
    source = events(spark, sf_dir)
    if features:
        source = evaluated_once(encode_fen(boards(spark, sf_dir)).withColumnRenamed("features", "_f"), {"features": F.col("_f")})
    return source.select(
        F.concat(F.lit("part-"), F.lpad(F.floor(k / FILE_ROWS).cast("string"), 8, "0")).alias("file"),
        (k % FILE_ROWS).alias("row_index"), "eval", *(["features"] if features else []))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`row_id, logit, label`; the label is the win probability of the board's evaluation."""
    k = F.col("event_id")
    return events(spark, sf_dir).select(
        k.alias("row_id"), ((k % 2001 - 1000) / F.lit(250.0)).alias("logit"),
        (1 / (1 + F.exp(-F.col("eval") / F.lit(400.0)))).alias("label"))


def step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`step, loss, grad_norm, seconds`, one row per event."""
    return table(spark, sf_dir, "events", "event_id", "value").select(
        F.col("event_id").alias("step"), F.col("value").alias("loss"), (F.col("value") / 50).alias("grad_norm"),
        ((F.col("event_id") % 7 + 1) / F.lit(100.0)).alias("seconds"))
