"""Game-level steps: PGN records to games, the filters that need no moves, and the movetext split."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.functions.evals import has_eval
from plyforge.functions.hashing import uniform32
from plyforge.operators.once import evaluated_once
from plyforge.schemas import DEFAULT_MIN_ELO, SKIP_HALF_MOVES, TEST_FRACTION, TRAIN_SEED

QUOTED = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
TAG_SECTION = rf"^(?:\s*+\[\w++\s++{QUOTED.replace('(', '(?:', 1)}\s*+\])*+"

# Movetext pieces. A comment ends at its first closing brace.
COMMENT = r"\{[^}]*+\}"
NUMBER = r"\d++\.++"
GLYPH = r"\$\d++|[!?]++"
RESULT = r"(?:1-0|0-1|1/2-1/2|\*)(?=\s|$)"
BETWEEN = rf"\s++|{COMMENT}|{NUMBER}|{GLYPH}|{RESULT}"
HALF_MOVE = rf"([^\s{{}}]++)((?:{BETWEEN})*+)"


def tag(section: Column, name: str) -> Column:
    """Value of a PGN tag, or an empty string."""
    return F.regexp_extract(section, rf"(?m)^\s*\[{name}\s+{QUOTED}\s*\]", 1)


def elo(value: Column) -> Column:
    """Rating as an integer; missing or non-numeric is 0."""
    return F.coalesce(F.trim(value).try_cast("int"), F.lit(0))


def games_from_pgn(records: DataFrame) -> DataFrame:
    """One PGN text per row (`file, game_ord, pgn`) to the games table.

    The game id is a hash of the text: it stays the same whichever other archives are read with it.
    """
    tags = evaluated_once(records, {"_tags": F.regexp_extract("pgn", TAG_SECTION, 0)})
    headed = evaluated_once(tags, {
        "white_elo": elo(tag(F.col("_tags"), "WhiteElo")),
        "black_elo": elo(tag(F.col("_tags"), "BlackElo")),
        "result": tag(F.col("_tags"), "Result"),
    })
    blank = F.lit(" \t\r\n")
    return headed.select(
        F.md5(F.trim("pgn", blank)).alias("game_id"), "file", "game_ord", "white_elo", "black_elo", "result",
        F.trim(F.substr("pgn", F.length("_tags") + 1), blank).alias("movetext"),
    )


def filter_min_elo(games: DataFrame, min_elo: int = DEFAULT_MIN_ELO) -> DataFrame:
    """Both players rated at least `min_elo`; the lower rating is kept as `min_elo`."""
    lower = F.least(F.coalesce("white_elo", F.lit(0)), F.coalesce("black_elo", F.lit(0)))
    return games.withColumn("min_elo", lower).where(F.col("min_elo") >= min_elo)


def decode_outcome(games: DataFrame) -> DataFrame:
    """Result as +1 / -1 / 0 from White's side; unfinished games are dropped."""
    outcome = (
        F.when(F.col("result") == "1-0", 1)
        .when(F.col("result") == "0-1", -1)
        .when(F.col("result") == "1/2-1/2", 0)
    )
    return games.withColumn("white_outcome", outcome).where(F.col("white_outcome").isNotNull())


def split_by_game(
    games: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = TRAIN_SEED
) -> DataFrame:
    """`set_type` drawn once per game, so neighbouring positions never straddle the split."""
    threshold = round(test_fraction * 2**32)
    in_test = uniform32(seed, F.col("game_id")) < threshold
    return games.withColumn("set_type", F.when(in_test, "test").otherwise("train"))


def main_line(movetext: Column) -> Column:
    """Movetext without `;` comments and variations, which are looked for only where they can be."""
    no_rest_of_line = F.when(
        movetext.contains(";"), F.regexp_replace(movetext, rf"({COMMENT})|;[^\r\n]*+", "$1")
    ).otherwise(movetext)
    # Nesting is counted token by token: depth goes up at '(' and down at ')', text is kept at depth 0.
    tokens = F.regexp_extract_all(no_rest_of_line, F.lit(rf"({COMMENT}|[()]|[^\s{{}}()]++)"), 1)
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"))

    def step(acc, token):
        return F.struct(
            (acc["depth"] + F.when(token == "(", 1).when((token == ")") & (acc["depth"] > 0), -1).otherwise(0))
            .alias("depth"),
            F.when((acc["depth"] == 0) & ~token.isin("(", ")"), F.concat_ws(" ", acc["text"], token))
            .otherwise(acc["text"]).alias("text"),
        )

    outside = F.aggregate(tokens, start, step, lambda acc: acc["text"])
    return F.when(no_rest_of_line.contains("("), outside).otherwise(no_rest_of_line)


def parse_movetext(games: DataFrame, comments: bool = True) -> DataFrame:
    """Adds `moves` and, aligned with it, `comments`: the text between a half-move and the next one.

    Replaces `movetext`. Comments before the first move belong to no half-move and are dropped. A job that reads the moves alone
    saves a pass over the text without `comments`.
    """
    first_move = F.regexp_replace(main_line(F.col("movetext")), rf"^(?:{BETWEEN})*+", "")
    line = evaluated_once(games, {"_line": first_move}).drop("movetext")
    wanted = {"moves": 1, "comments": 2} if comments else {"moves": 1}
    return evaluated_once(
        line, {name: F.regexp_extract_all("_line", F.lit(HALF_MOVE), group) for name, group in wanted.items()}).drop("_line")


def filter_commented(games: DataFrame) -> DataFrame:
    """Games with at least one comment. Works on raw movetext or on parsed comments."""
    if "movetext" in games.columns:
        return games.where(F.col("movetext").contains("{"))
    return games.where(F.exists("comments", lambda c: c.contains("{")))


def annotation_gate(games: DataFrame, skip: int = SKIP_HALF_MOVES) -> DataFrame:
    """The first half-move after the skipped opening must carry an evaluation, else the game goes."""
    return games.where(has_eval(F.try_element_at("comments", F.lit(skip + 1))))
