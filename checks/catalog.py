"""The registered queries. Each reads its whole tables."""

import shutil
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import inputs
from plyforge.functions import boards as B
from plyforge.functions.evals import extract_eval
from plyforge.operators import dedup, encode, games, loader, metrics, positions
from plyforge.operators.progress import STAGES, StageCounts
from plyforge.operators.replay import legal_games, replay_moves
from plyforge.operators.scoring import score_boards
from plyforge.plans.dataset import (
    annotated_games, build_dataset, malformed_games, qualified, replayed_games, routed_positions,
)
from plyforge.plans.training import budgeted_batches, evaluate_sample, resume_export, training_batches, with_row_id
from plyforge.schemas import TRAIN_SEED
from plyforge.sources import dataset
from plyforge.sources.keys import KeyTable
from plyforge.sources.archives import list_archives, read_games, scan_archives
from plyforge.sources.paths import file_system, scratch, stored
from plyforge.sources.sinks import METRICS, append_metrics, require_empty, save_progress, write_batches, write_records
from plyforge.streaming.ingest import absent_positions

WINDOW, BATCH, EPOCHS, SHARDS = 1300, 64, 2, 4
CAP = 5000
FILE_BOUND = 400
PIECE_VALUES = [0, -1, 1, -1, 3, -3, 3, -3, 5, -5, 5, -5, 9, -9, 0, 0]


def text(features: str = "features") -> Column:
    return F.array_join(features, ",")


def as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("features", text())


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return games.parse_movetext(inputs.games(spark, sf))


def replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Every game replayed, whatever its rating or result."""
    slim = games.parse_movetext(inputs.games(spark, sf), comments=False).select("game_id", "moves")
    return legal_games(replay_moves(slim, placement=True))


def plies(replayed_games: DataFrame) -> DataFrame:
    """Half-moves in long form."""
    rows = replayed_games.select("game_id", F.inline("plies")).withColumn("white_to_move", F.col("ply") % 2 == 0)
    return positions.with_fen(rows)


def kept_plies(replayed_games: DataFrame) -> DataFrame:
    return plies(replayed_games).select("game_id", "ply", "fen")


def replay_positions(spark, sf):
    ends = positions.terminal({c: F.col(c) for c in ("stuck", "repeats", "halfmove_clock", "board", "piece_count")})
    return plies(replayed(spark, sf)).select("game_id", "ply", "fen", "piece_count", ends.alias("terminal"))


def extract_evals(spark, sf):
    rows = parsed(spark, sf).select("game_id", F.posexplode("comments").alias("i", "comment"))
    return rows.select("game_id", (F.col("i") + 1).alias("ply"), extract_eval(F.col("comment")).alias("eval"))


def game_positions(spark, sf):
    found = positions.game_positions(replayed_games(annotated_games(games.filter_commented(games.decode_outcome(
        games.filter_min_elo(inputs.games(spark, sf)))))))
    return positions.with_fen(found).select(
        "game_id", "ply", "fen", "eval", "min_elo", "white_outcome", "set_type")


def stage_counts(spark, sf):
    """What is observed on the way from games to unique positions, in one pass."""
    counts = StageCounts()
    annotated = counts.at("annotated", annotated_games(qualified(inputs.games(spark, sf), counts=counts)))
    found = counts.at("positions", positions.game_positions(replayed_games(annotated)))
    unique = counts.at("unique_positions", found.groupBy(*positions.POSITION_KEY).agg(F.count("*")))
    unique.write.format("noop").mode("overwrite").save()
    got = counts.counts()
    return spark.createDataFrame([tuple(got[s] for s in STAGES)], ", ".join(f"{s} long" for s in STAGES))


def board_tokens(spark, sf, layer: Callable[[DataFrame], Column]) -> DataFrame:
    parsed_fen = encode.parse_fen(inputs.boards(spark, sf))
    tokens = parsed_fen.withColumn("_tokens", B.piece_tokens(F.col("board"), F.col("white_to_move")))
    return tokens.withColumn("_tokens", layer(tokens)).select("event_id", B.token_array(F.col("_tokens")).alias("features"))


def encode_pieces(spark, sf):
    return as_text(board_tokens(spark, sf, lambda d: F.col("_tokens")))


def encode_castling(spark, sf):
    return as_text(board_tokens(
        spark, sf, lambda d: B.with_castling(F.col("_tokens"), F.col("castling"), F.col("white_to_move"))))


def encode_en_passant(spark, sf):
    return as_text(board_tokens(spark, sf, lambda d: B.with_en_passant(
        F.col("_tokens"), B.capturable_file(F.col("_tokens"), F.col("en_passant")))))


def to_mover_pov(spark, sf):
    return positions.to_mover_pov(inputs.boards(spark, sf)).select("event_id", "eval", "outcome")


def fen_keyed(spark, sf):
    return inputs.boards(spark, sf, repeated=True).withColumn("key", B.position_key(F.col("fen")))


def dedup_first_wins(spark, sf):
    return dedup.dedup_first_wins(fen_keyed(spark, sf), ["key"]).select("key", "file", "game_ord", "ply", "eval")


def cap_positions(spark, sf):
    source = stored(inputs.boards(spark, sf), "cap")
    return dedup.cap_positions(source, CAP).select("file", "game_ord", "ply", "fen")


def incremental_new_keys(spark, sf):
    """Two of every five games are in the dataset already; then all of them arrive."""
    source = inputs.games(spark, sf)

    def unique(df):
        return dedup.dedup_first_wins(positions.game_positions(replayed_games(annotated_games(
            games.filter_commented(games.decode_outcome(games.filter_min_elo(df)))))))

    known = KeyTable(spark, scratch(spark, "keys"))
    known.add("earlier", unique(source.where(F.col("game_ord") % 5 < 2)))
    fresh = stored(unique(source), "fresh")
    return positions.with_fen(absent_positions(fresh, known)).select("fen", "file", "game_ord", "ply", "eval")


def write_dataset(spark, sf) -> str:
    path = scratch(spark, "records")
    require_empty(spark, path)
    write_records(encode.training_records(inputs.boards(spark, sf), debug_fen=True), path)
    return path


def run_sizing(spark, sf):
    records = inputs.events(spark, sf).withColumnRenamed("set_type", "setType")
    return metrics.run_sizing(records, train_boards=1_000_000, batch_rows=BATCH)


def dataset_digest(spark, sf):
    files = loader.file_table(inputs.rows(spark, sf)).select(
        F.when(F.substring("file", -1, 1) < "5", "train").otherwise("test").alias("split"),
        F.col("file").alias("name"), (F.col("rows") * 64).alias("length"))
    return metrics.dataset_digest(files, "boards")


def eval_metrics(spark, sf):
    got = metrics.eval_metrics(inputs.predictions(spark, sf), BATCH)
    return got.select(*[F.round(c, 6).alias(c) for c in ("loss", "winning_ratio", "losing_ratio")], "rows")


def step_rollup(spark, sf):
    got = metrics.step_rollup(inputs.step_log(spark, sf), freq=128, batch_rows=BATCH, steps_per_epoch=157)
    places = {"epoch": 6, "train_loss": 10, "train_grad_norm": 10, "train_grad_clipped": 8, "boards_per_second": 6}
    return got.select("step", "boards", *[F.round(c, n).alias(c) for c, n in places.items()])


def windows(spark, sf) -> DataFrame:
    plan = loader.epoch_plan(loader.file_table(inputs.rows(spark, sf)), EPOCHS, SHARDS)
    return stored(loader.plan_windows(plan, WINDOW), "windows")


def window_shuffle(spark, sf):
    return loader.window_shuffle(inputs.rows(spark, sf), windows(spark, sf))


def fixed_batches(spark, sf):
    return loader.fixed_batches(window_shuffle(spark, sf), BATCH)


BATCH_PLACE = ["shard", "window_index", "batch_index", "rn", "file", "row_index", "epoch"]


def resume_batches(spark, sf):
    state = {0: (1, 3), 1: (0, 20), 2: (2, 0), 3: (0, 0)}
    path = scratch(spark, "batches")
    write_batches(fixed_batches(spark, sf), path)
    save_progress(spark, path, state)
    return resume_export(spark, path).select(*BATCH_PLACE)


def encoded_rows(spark, sf) -> DataFrame:
    """Rows with their features as a stored table, as training has them: a job that plans windows reads the names of the files alone."""
    return stored(inputs.rows(spark, sf, features=True), "rows")


def all_training_batches(spark, sf):
    got = training_batches(encoded_rows(spark, sf), EPOCHS, BATCH, WINDOW, SHARDS)
    return as_text(got).withColumn("label", F.round(F.col("label").cast("double"), 5))


def eval_sample(spark, sf):
    sample = loader.eval_sample(inputs.rows(spark, sf), pool_rows=4000, sample_rows=1024)
    return sample.select("file", "row_index", "eval")


def check_feature_width(spark, sf):
    rows = inputs.rows(spark, sf, features=True)
    cut = F.when(F.col("row_index") % 97 == 0, F.slice("features", 1, 63)).otherwise(F.col("features"))
    return as_text(loader.check_feature_width(rows.withColumn("features", cut), "dropmalformed"))


def win_prob_label(spark, sf):
    labelled = loader.with_label(inputs.events(spark, sf))
    return labelled.select("event_id", F.round(F.col("label").cast("double"), 5).alias("label"))


def material_scorer():
    """A linear model: the sum of piece values in pawns."""
    values = np.array(PIECE_VALUES, np.float64)
    return lambda boards: values[np.asarray(boards, np.intp)].sum(axis=1)


def score(spark, sf):
    scored = score_boards(encode.encode_fen(inputs.boards(spark, sf)), material_scorer)
    return scored.select("event_id", "logit", F.round("probability", 6).alias("probability"))


def built_dataset(spark, sf):
    archives, output = inputs.archive_folder(spark, sf), scratch(spark, "dataset")
    build_dataset(spark, archives, output, debug_fen=True, pattern="*.txt.gz")
    return as_text(dataset.scan_records(spark, output))


def malformed(spark, sf):
    routed = routed_positions(inputs.pgn_records(spark, sf, broken=True), mode="dropmalformed")
    return malformed_games(stored(routed, "routed"))


def build_stats(spark, sf):
    archives, output = inputs.archive_folder(spark, sf, broken=True), scratch(spark, "dataset")
    stats = build_dataset(spark, archives, output, mode="dropmalformed", pattern="*.txt.gz")
    counts = [(stats["unique_positions"], stats["malformed_games"])]
    return spark.createDataFrame(counts, "unique_positions long, malformed_games long")


def evaluated_sample(spark, sf):
    sample = loader.eval_sample(inputs.rows(spark, sf, features=True), pool_rows=4000, sample_rows=1024)
    got = evaluate_sample(with_row_id(loader.with_label(sample)), material_scorer, step=128, batch_rows=BATCH)
    return got.select("step", "rows", *[F.round(c, 5).alias(c) for c in ("loss", "winning_ratio", "losing_ratio")])


def exported_by_budget(spark, sf):
    """Two epochs but for 300 boards, written and read back: the rows and files of each batch."""
    rows, path = encoded_rows(spark, sf), scratch(spark, "batches")
    batches, _ = budgeted_batches(rows, 2 * rows.count() - 300, BATCH, WINDOW, SHARDS)
    write_batches(batches, path)
    return spark.read.parquet(path).groupBy("shard", "window_index", "batch_index").agg(
        F.count("*").alias("rows"), F.countDistinct("_metadata.file_path").alias("files"))


def metrics_history(spark, sf):
    """Training means and test metrics appended to the history in two parts, and read back."""
    rollup = metrics.step_rollup(inputs.step_log(spark, sf), freq=128, batch_rows=BATCH, steps_per_epoch=157)
    path = scratch(spark, "metrics")
    tested = rollup.select("step", (F.col("step") / 8).alias("loss"), (F.col("step") / 16).alias("winning_ratio"),
                           (F.col("step") / 32).alias("losing_ratio"))
    for half in (F.col("step") % 256 == 0, F.col("step") % 256 != 0):
        append_metrics(rollup.where(half), tested, path)
    read = spark.read.option("header", True).csv(path)
    return read.select(F.col("step").cast("long").alias("step"), F.round(F.col("epoch").cast("double"), 4).alias("epoch"), *[
        F.round(F.col(c).cast("double"), 10).alias(c) for c in METRICS[2:]])


def local_folder(spark, folder: str) -> str:
    """A new folder as Python sees it."""
    require_empty(spark, folder)
    fs, path = file_system(spark, folder)
    return fs.makeQualified(path).toString().removeprefix("file:")


def archives_by_file(spark, sf) -> str:
    """Each file of the PGN records as one archive of that name, compressed with zstd.

    The games of a file are compressed in parts, side by side and in order; one task then strings the parts together, as zstd frames may
    follow one another. No task holds or sorts a file.
    """
    folder = scratch(spark, "zst")
    address, aside = local_folder(spark, folder), local_folder(spark, scratch(spark, "parts"))

    def compress(batches):
        import zstandard
        from pyspark import TaskContext

        out, name, number = None, None, TaskContext.get().partitionId()
        for batch in batches:
            for file, pgn in zip(batch.column("file").to_pylist(), batch.column("pgn").to_pylist(), strict=True):
                if out is None or file != name:
                    if out is not None:
                        out.close()
                    name, part = file, f"{aside}/{number:08d}-{file}"
                    out = zstandard.open(part, "wb")
                    yield pa.RecordBatch.from_pydict({"file": [file], "part": [part]})
                out.write(f"{pgn}\n\n".encode())
        if out is not None:
            out.close()

    def string(batches):
        out, name = None, None
        for batch in batches:
            for file, part in zip(batch.column("file").to_pylist(), batch.column("part").to_pylist(), strict=True):
                if out is None or file != name:
                    if out is not None:
                        out.close()
                    name, out = file, open(f"{address}/{file}.pgn.zst", "wb")
                with open(part, "rb") as source:
                    shutil.copyfileobj(source, out)
        if out is not None:
            out.close()
        yield from ()

    ordered = inputs.tagged_games(spark, sf).repartitionByRange("file", "game_ord").sortWithinPartitions("file", "game_ord")
    records = inputs.as_pgn(inputs.with_movetext(ordered)).select("file", "pgn")
    parts = stored(records.mapInArrow(compress, "file string, part string"), "parts")
    by_file = parts.repartition("file").sortWithinPartitions("file", "part")
    by_file.mapInArrow(string, "file string").write.format("noop").mode("overwrite").save()
    return folder


def archive_listing(spark, sf):
    """Archives in name order, and the games that each holds."""
    folder = archives_by_file(spark, sf)
    names = list_archives(spark, folder).select(F.substring_index("path", "/", -1).alias("file"), "length")
    held = scan_archives(spark, folder).groupBy("file").agg(F.count("*").alias("games"))
    order = F.row_number().over(Window.orderBy("file"))
    return names.withColumn("place", order.cast("long")).join(held, "file").where("length > 0").select("file", "place", "games")


def archive_scan(spark, sf):
    """The games of zstd archives, read back."""
    return read_games(spark, archives_by_file(spark, sf)).drop("game_ord")


def listed_rows(spark, sf, files: Callable[[SparkSession, str], DataFrame]):
    """Rows of the data files that `files` lists, by split; a file counts if its listed length is the one that the scan sees."""
    path = write_dataset(spark, sf)
    seen = dataset.scan_records(spark, path).groupBy(
        F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("length")).agg(F.count("*").alias("rows"))
    return files(spark, path).join(seen, ["name", "length"]).groupBy("split").agg(F.sum("rows").alias("rows"))


def output_guard(spark, sf):
    """What the guard does with a missing folder, an empty one, and one that holds the dataset, and the rows that are there."""
    path, found = scratch(spark, "guarded"), []
    for case in ("missing", "empty", "written"):
        try:
            require_empty(spark, path)
            allowed = True
        except ValueError:
            allowed = False
        if case == "empty":
            write_records(encode.training_records(inputs.boards(spark, sf)), path)
        held = dataset.scan_records(spark, path).count() if case == "written" else 0
        found.append((case, allowed, held))
    return spark.createDataFrame(found, "state string, allowed boolean, rows long")


def file_layout(spark, sf):
    """Rows by split, and whether every file keeps within the bound."""
    path = scratch(spark, "records")
    write_records(encode.training_records(inputs.boards(spark, sf)), path, rows_per_file=FILE_BOUND)
    files = dataset.scan_records(spark, path).groupBy("setType", F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("n"))
    return files.groupBy("setType").agg(F.sum("n").alias("rows"), (F.max("n") <= FILE_BOUND).alias("bounded"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "games_from_pgn": lambda s, d: games.games_from_pgn(inputs.pgn_records(s, d)),
    "filter_min_elo": lambda s, d: games.filter_min_elo(inputs.tagged_games(s, d)).select("game_id", "min_elo"),
    "decode_outcome": lambda s, d: games.decode_outcome(inputs.tagged_games(s, d)).select("game_id", "white_outcome"),
    "filter_commented": lambda s, d: games.filter_commented(parsed(s, d)).select("game_id", F.size("moves").alias("n")),
    "annotation_gate": lambda s, d: games.annotation_gate(parsed(s, d)).select("game_id"),
    "split_by_game": lambda s, d: games.split_by_game(inputs.tagged_games(s, d)).select("game_id", "set_type"),
    "replay_positions": replay_positions,
    "extract_eval": extract_evals,
    "stop_min_pieces": lambda s, d: kept_plies(positions.stop_min_pieces(replayed(s, d))),
    "stop_terminal": lambda s, d: kept_plies(positions.stop_terminal(replayed(s, d))),
    "prefix_until": lambda s, d: kept_plies(positions.prefix_until(
        replayed(s, d), "plies", lambda p: positions.too_few_pieces(p) | positions.terminal(p))),
    "skip_opening": lambda s, d: kept_plies(positions.skip_opening(replayed(s, d))),
    "game_positions": game_positions,
    "position_key": lambda s, d: inputs.boards(s, d).select("event_id", B.position_key(F.col("fen")).alias("key")),
    "to_mover_pov": to_mover_pov,
    "encode_rejects": lambda s, d: positions.encode_rejects(
        inputs.boards(s, d, faulty=True)).select("event_id", "fen"),
    "fen_to_board": lambda s, d: inputs.boards(s, d).select("event_id", B.fen_to_board(F.col("fen")).alias("board")),
    "encode_pieces": encode_pieces,
    "encode_castling": encode_castling,
    "encode_en_passant": encode_en_passant,
    "encode_fen": lambda s, d: as_text(encode.encode_fen(inputs.boards(s, d))).select("event_id", "features"),
    "training_records": lambda s, d: as_text(encode.training_records(inputs.boards(s, d, faulty=True), True)),
    "dedup_first_wins": dedup_first_wins,
    "cap_positions": cap_positions,
    "stage_counts": stage_counts,
    "count_by_split": lambda s, d: metrics.count_by_split(
        inputs.events(s, d).withColumnRenamed("set_type", "setType")),
    "run_sizing": run_sizing,
    "eval_metrics": eval_metrics,
    "step_rollup": step_rollup,
    "dataset_digest": dataset_digest,
    "scan_projected": lambda s, d: as_text(dataset.scan_projected(s, write_dataset(s, d))),
    "scan_split": lambda s, d: as_text(dataset.scan_split(s, write_dataset(s, d), "test")),
    "write_records": lambda s, d: as_text(dataset.scan_records(s, write_dataset(s, d))),
    "eval_sample": eval_sample,
    "file_order": lambda s, d: loader.file_order(loader.file_table(inputs.rows(s, d))),
    "epoch_plan": lambda s, d: loader.epoch_plan(loader.file_table(inputs.rows(s, d)), EPOCHS, SHARDS),
    "plan_windows": windows,
    "window_shuffle": window_shuffle,
    "fixed_batches": lambda s, d: fixed_batches(s, d).select(*BATCH_PLACE),
    "batch_shortfall": lambda s, d: loader.batch_shortfall(windows(s, d), iterations=1_000, batch_rows=BATCH),
    "check_feature_width": check_feature_width,
    "win_prob_label": win_prob_label,
    "resume_batches": resume_batches,
    "training_batches": all_training_batches,
    "score_boards": score,
    "incremental_new_keys": incremental_new_keys,
    "build_dataset": built_dataset,
    "malformed_games": malformed,
    "build_stats": build_stats,
    "evaluate_sample": evaluated_sample,
    "export_by_budget": exported_by_budget,
    "metrics_history": metrics_history,
    "archive_listing": archive_listing,
    "archive_scan": archive_scan,
    "train_files": lambda s, d: listed_rows(s, d, dataset.train_files),
    "split_files": lambda s, d: listed_rows(s, d, dataset.split_files),
    "output_guard": output_guard,
    "file_layout": file_layout,
}
