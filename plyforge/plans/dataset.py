"""Archives to training dataset."""

import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.functions.evals import has_eval
from plyforge.operators.dedup import dedup_first_wins
from plyforge.operators.games import (
    annotation_gate, decode_outcome, filter_commented, filter_min_elo, games_from_pgn, parse_movetext,
    split_by_game,
)
from plyforge.operators.positions import POSITION_KEY, comment_evals, game_positions
from plyforge.operators.progress import STAGES, StageCounts, counted
from plyforge.operators.replay import legal_games, replay_moves
from plyforge.schemas import ARCHIVE_GLOB, DEFAULT_MIN_ELO, MIN_PIECES, SKIP_HALF_MOVES
from plyforge.sources.archives import list_archives, scan_archives
from plyforge.sources.sinks import require_empty
from plyforge.streaming.ingest import DatasetWriter

log = logging.getLogger(__name__)

#: Archives of about so many bytes are read and committed together.
GROUP_BYTES = 1 << 40


def qualifying_games(records: DataFrame, min_elo: int = DEFAULT_MIN_ELO, counts: StageCounts | None = None) -> DataFrame:
    """What tags and a look for an evaluation can decide; cheap enough for the task that decompresses.

    Clock comments are on almost every move and evaluations in few games, so most games end here. A game that
    passes the gate has an evaluation somewhere, whatever its movetext looks like.
    """
    return qualified(games_from_pgn(records), min_elo, counts).where(has_eval(F.col("movetext")))


def qualified(games: DataFrame, min_elo: int = DEFAULT_MIN_ELO, counts: StageCounts | None = None) -> DataFrame:
    """Games that are rated, decided and commented; `counts` gets how many are left after each step."""
    rated = counted(counts, "rated", filter_min_elo(counted(counts, "games", games), min_elo))
    decided = counted(counts, "decided", decode_outcome(rated))
    return counted(counts, "commented", filter_commented(decided))


def annotated_games(games: DataFrame, skip: int = SKIP_HALF_MOVES) -> DataFrame:
    """Parsed games that pass the annotation gate, with split, moves and evaluations."""
    return comment_evals(split_by_game(annotation_gate(parse_movetext(games), skip)))


def replayed_games(annotated: DataFrame, mode: str = "failfast", routed: bool = False) -> DataFrame:
    """Replays the moves; only what positions need goes through Python.

    `routed` leaves the games that `mode="dropmalformed"` would drop among the others, with their `failed_ply`.
    """
    needed = ["game_id", "file", "game_ord", "min_elo", "white_outcome", "set_type", "evals", "moves"]
    replayed = replay_moves(annotated.select(*needed))
    return replayed if routed and mode == "dropmalformed" else legal_games(replayed, mode)


def positions_from_records(
    records: DataFrame, min_elo: int = DEFAULT_MIN_ELO, skip: int = SKIP_HALF_MOVES,
    min_pieces: int = MIN_PIECES, mode: str = "failfast", counts: StageCounts | None = None, routed: bool = False,
) -> DataFrame:
    """PGN records to evaluated positions, not yet unique; with `routed` also a row for each malformed game."""
    annotated = counted(counts, "annotated", spread_annotated(qualifying_games(records, min_elo, counts), skip))
    rows = game_positions(replayed_games(annotated, mode, routed), skip, min_pieces)
    return counted(counts, "positions", rows, F.col("failed_ply") == 0 if "failed_ply" in rows.columns else None)


def spread_annotated(qualifying: DataFrame, skip: int = SKIP_HALF_MOVES) -> DataFrame:
    """Archives cannot be split, so the games that qualify are spread over the cluster before the expensive parse.

    Hashing by file and ordinal is even and repeatable, unlike round-robin, and needs no sort.
    """
    return annotated_games(qualifying.repartition("file", "game_ord"), skip)


def unique_positions(records: DataFrame, **options) -> DataFrame:
    """First occurrences only. The game id has served the split and would only widen the shuffle."""
    return dedup_first_wins(positions_from_records(records, **options).drop("game_id"))


def routed_positions(records: DataFrame, counts: StageCounts | None = None, **options) -> DataFrame:
    """First occurrences and, with `mode="dropmalformed"`, malformed games, from one replay: `rejected` tells them apart.

    A rejected row has the game's file and ordinal and, as its ply, the half-move that failed. It goes through the dedup under a key of its own.
    """
    rows = positions_from_records(records, counts=counts, routed=True, **options).drop("game_id")
    if "failed_ply" not in rows.columns:
        rows = rows.withColumn("failed_ply", F.lit(0))
    own = F.when(F.col("failed_ply") > 0, F.concat_ws("#", "file", "game_ord"))
    unique = dedup_first_wins(rows.withColumn("_reject", own), [*POSITION_KEY, "_reject"])
    routed = unique.withColumn("rejected", F.col("failed_ply") > 0).drop("_reject", "failed_ply")
    return counted(counts, "unique_positions", routed, ~F.col("rejected"))


def malformed_games(routed: DataFrame) -> DataFrame:
    """`file, game_ord, failed_ply` of the rejected rows."""
    return routed.where("rejected").select("file", "game_ord", F.col("ply").alias("failed_ply"))


def build_dataset(
    spark: SparkSession, archives: str, output: str, limit: int | None = None,
    min_elo: int = DEFAULT_MIN_ELO, debug_fen: bool = False, mode: str = "failfast", pattern: str = ARCHIVE_GLOB,
    group_bytes: int = GROUP_BYTES,
) -> dict:
    """Builds the dataset in an empty folder; stops reading archives once `limit` positions are unique.

    With a limit, archives are taken in name order in growing groups: the first one alone, then as many as its
    yield says are needed. Returns the final counts.
    Without one, groups are of about `group_bytes` of archives, each of them committed before the next one begins.

    With `mode="dropmalformed"` games with an illegal half-move are listed by the same replay:
    `<output>/_ingest/group=build-N/rejects`. The counts of the steps are taken while the rows pass.
    """
    require_empty(spark, output)
    listing = [(row["path"], row["length"]) for row in list_archives(spark, archives, pattern).collect()]
    log.info("processing %d archives", len(listing))
    writer = DatasetWriter(spark, output, debug_fen)
    started, total, used, group = time.monotonic(), 0, 0, 0
    sums = dict.fromkeys([*STAGES[:-1], "malformed_games"], 0)

    def taken(wanted: float) -> int:
        """How many archives hold the wanted bytes, one at least."""
        size, planned = 0, 0
        while used + size < len(listing) and (size == 0 or planned < wanted):
            planned += listing[used + size][1]
            size += 1
        return size

    size = taken(group_bytes if limit is None else 1)
    while used < len(listing) and (limit is None or total < limit):
        batch = [path for path, _ in listing[used:used + size]]
        counts = StageCounts()
        routed = routed_positions(scan_archives(spark, batch, pattern), counts, min_elo=min_elo, mode=mode)
        names = [path.rsplit("/", 1)[-1] for path in batch]
        total += writer.append(f"build-{group}", routed, None if limit is None else limit - total, names, counts)
        found = writer.group_counts(f"build-{group}")
        sums = {k: v + found.get(k, 0) for k, v in sums.items()}
        used, group = used + len(batch), group + 1
        seconds = time.monotonic() - started
        done = "" if limit is None else f" ({total * 100 // limit}%)"
        log.info("%d unique positions%s from %d of %d archives, last group %s, %.1f s", total, done, used, len(listing), found, seconds)
        read = sum(length for _, length in listing[:used])
        size = taken(group_bytes if limit is None else read * (limit - total) / max(total, 1) * 1.2)
    seconds = time.monotonic() - started
    stats = {"unique_positions": total, "archives": used, **sums, "seconds": seconds, "per_second": total / seconds}
    log.info("final: %s", stats)
    return stats
