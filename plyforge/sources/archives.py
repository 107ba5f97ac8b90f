"""Game archives: listing, text scan, and one record per game."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.operators.games import games_from_pgn
from plyforge.schemas import ARCHIVE_GLOB
from plyforge.sources.paths import file_system

# Every game starts with this tag. As the line separator it cuts the text into games whatever the line ends
# and blank lines are, while the file is being decompressed.
FIRST_TAG = '[Event "'


def list_archives(spark: SparkSession, folder: str, pattern: str = ARCHIVE_GLOB) -> DataFrame:
    """`path, length` of the archives of a folder in name order. Fails on no folder and on no archive."""
    fs, path = file_system(spark, folder)
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        raise ValueError(f"not a folder: {folder}")
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, pattern))
    if not any(status.isFile() for status in found):
        raise ValueError(f"no {pattern} in {folder}")
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        .select("path", "length")
        .orderBy(F.substring_index("path", "/", -1))
    )


def pgn_records(text: DataFrame, path: str = "_metadata.file_path") -> DataFrame:
    """Records split at the first tag, as `file, game_ord, pgn`.

    `game_ord` only orders the games of one file: an archive is read by one task, in order. It has to be drawn
    straight after the scan, before anything moves rows.
    """
    return (
        text.select(
            F.substring_index(F.col(path), "/", -1).alias("file"),
            F.monotonically_increasing_id().alias("game_ord"),
            F.concat(F.lit(FIRST_TAG), F.col("value")).alias("pgn"),
            F.col("value").contains("]").alias("_game"),
        )
        .where("_game")
        .drop("_game")
    )


def scan_archives(spark: SparkSession, paths: str | Sequence[str], pattern: str = ARCHIVE_GLOB) -> DataFrame:
    """Records of the given folders or files. Spark decompresses; an archive is one task, so keep it light."""
    reader = spark.read.option("pathGlobFilter", pattern).option("lineSep", FIRST_TAG)
    return pgn_records(reader.text([paths] if isinstance(paths, str) else list(paths)))


def read_games(spark: SparkSession, paths: str | Sequence[str], pattern: str = ARCHIVE_GLOB) -> DataFrame:
    return games_from_pgn(scan_archives(spark, paths, pattern))
