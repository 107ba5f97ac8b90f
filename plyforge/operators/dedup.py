"""First-wins dedup over the whole corpus, and the cap on unique positions."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plyforge.operators.positions import POSITION_KEY, POSITION_ORDER
from plyforge.operators.ranking import running_before

GAMES_PER_BLOCK_BITS = 12


def dedup_first_wins(
    positions: DataFrame, key: Sequence[str] = POSITION_KEY, order: Sequence[str] = POSITION_ORDER
) -> DataFrame:
    """One row per key: the first in `order`.

    A minimum of structs that start with `order`. It is taken in every map task before the exchange, so a
    position that occurs in a third of all games sends one row per task. The leading hash makes the sorts
    compare longs before boards.
    """
    rest = [c for c in positions.columns if c not in key and c not in order]
    first = positions.groupBy(F.xxhash64(*key).alias("_hash"), *key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*key, "_first.*").select(*positions.columns)


def cap_positions(positions: DataFrame, limit: int) -> DataFrame:
    """Exactly the first `limit` rows in (file, game, half-move) order; give it a stored table.

    Nothing is sorted as a whole. Rows are counted per block of games, the block in which the limit falls is
    looked up (one row to the driver), rows before it stay, and only that block is ordered and cut.
    """
    block = F.shiftright("game_ord", GAMES_PER_BLOCK_BITS)
    counts = positions.groupBy("file", block.alias("block")).agg(F.count("*").alias("n"))
    by_block = Window.partitionBy("file").orderBy("block")
    files = counts.groupBy("file").agg(F.sum("n").alias("total"))
    edge = (
        counts.join(running_before(files, "file", "total", "before").select("file", "before").where(F.col("before") <= limit), "file")
        .withColumn("start", F.col("before") + F.sum("n").over(by_block) - F.col("n"))
        .where((F.col("start") <= limit) & (F.col("start") + F.col("n") > limit))
        .select("file", "block", "start")
        .first()
    )
    if edge is None:
        return positions
    file, at, start = edge
    whole = (F.col("file") < file) | ((F.col("file") == file) & (block < at))
    last = positions.where((F.col("file") == file) & (block == at))
    return positions.where(whole).unionByName(last.orderBy(*POSITION_ORDER).limit(limit - start))


def new_keys(positions: DataFrame, known: DataFrame, key: Sequence[str] = POSITION_KEY) -> DataFrame:
    """Positions whose key is not among the `known` keys yet."""
    return positions.join(known.select(*key), list(key), "left_anti")
