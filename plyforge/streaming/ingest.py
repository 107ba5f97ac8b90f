"""Adding archives to a dataset: positions that it already holds are not added again."""

import json
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from plyforge.operators.dedup import cap_positions, new_keys
from plyforge.operators.encode import training_records
from plyforge.operators.progress import StageCounts
from plyforge.schemas import ARCHIVE_GLOB, DEFAULT_MIN_ELO
from plyforge.sources.archives import FIRST_TAG, pgn_records
from plyforge.sources.keys import BUCKETS, KeyTable
from plyforge.sources.paths import delete, exists, file_system, read_text, write_text
from plyforge.sources.sinks import write_records

log = logging.getLogger(__name__)


def absent_positions(candidates: DataFrame, known: KeyTable) -> DataFrame:
    """Candidates (stored, unique) whose key the table does not have yet.

    The keys grow without bound and the candidates need not: the table is scanned in place, and what it shares with the
    candidates is no more than these.
    """
    return new_keys(candidates, known.known_among(candidates))


class DatasetWriter:
    """Appends groups of unique positions to a dataset, each exactly once; one writer at a time.

    `<output>/_ingest/keys` has the keys of all finished groups. `<output>/_ingest/group=NAME` holds a group at work: its new
    positions, and its data files, which are written there and then moved into the dataset under names of the group, which a manifest lists
    first; a repeat finishes the moves. Nothing ever lists the files of the whole dataset. Of a finished group the manifest, its
    rejects and the names of its archives stay.
    """

    def __init__(self, spark: SparkSession, output: str, debug_fen: bool = False, buckets: int = BUCKETS):
        self.spark, self.output, self.debug_fen = spark, output.rstrip("/"), debug_fen
        self.state = f"{self.output}/_ingest"
        self.keys = KeyTable(spark, f"{self.state}/keys", buckets)

    def append(
        self, group: str, routed: DataFrame, limit: int | None = None, archives: list[str] | None = None, counts: StageCounts | None = None,
    ) -> int:
        """Adds the positions that are new, at most `limit`, and lists the rejected games; returns how many positions.

        Both are written by one pass over `routed`. `<group>/rejects` has the file, the game's ordinal and the half-move that failed,
        `<group>/counts.json` what `counts` has observed.
        """
        folder = f"{self.state}/group={group}"
        kept, found, done = f"{folder}/positions", f"{folder}/found", f"{folder}/done"
        data, manifest = f"{folder}/data", f"{folder}/manifest.json"
        schema = routed.drop("rejected").schema
        read = self.spark.read.schema(schema)

        def part(rejected: str) -> DataFrame | None:
            path = f"{found}/rejected={rejected}"
            return read.parquet(path) if exists(self.spark, path) else None

        if not exists(self.spark, done):
            if not exists(self.spark, manifest):
                if "rejected" not in routed.columns:
                    routed = routed.withColumn("rejected", F.lit(False))
                routed.write.mode("overwrite").partitionBy("rejected").parquet(found)
                rejects = part("true")
                figures = counts.counts() if counts else {}
                if rejects is not None:
                    listed = rejects.select("file", "game_ord", F.col("ply").alias("failed_ply"))
                    listed.write.mode("overwrite").parquet(f"{folder}/rejects")
                    figures["malformed_games"] = rejects.count()
                write_text(self.spark, f"{folder}/counts.json", json.dumps(figures))
                fresh = part("false")
                if fresh is None:
                    fresh = self.spark.createDataFrame([], schema)
                elif self.keys.parts():
                    fresh = absent_positions(fresh, self.keys)
                if limit is not None:
                    fresh = cap_positions(fresh, limit)
                # Rows that are found and not new, or beyond the limit, must not come back in a repeat.
                fresh.write.mode("overwrite").parquet(kept)
                delete(self.spark, data)
                write_records(training_records(read.parquet(kept), self.debug_fen), data)
                planned = {"rows": read.parquet(kept).count(), "moves": self._planned_moves(data, group)}
                write_text(self.spark, manifest, json.dumps(planned))
            for source, target in json.loads(read_text(self.spark, manifest))["moves"]:
                self._move(source, target)
            if exists(self.spark, kept):
                self.keys.add(group, read.parquet(kept))
            write_text(self.spark, f"{folder}/archives.json", json.dumps(archives or []))
            write_text(self.spark, done, "")
            for path in (found, data, kept):
                delete(self.spark, path)
        return json.loads(read_text(self.spark, manifest))["rows"]

    def group_counts(self, group: str) -> dict[str, int]:
        """What was counted while a group was read; empty if there is no such group."""
        path = f"{self.state}/group={group}/counts.json"
        return json.loads(read_text(self.spark, path)) if exists(self.spark, path) else {}

    def read_archives(self) -> list[str]:
        """Names of the archives of finished groups; a folder of archives is short."""
        fs, pattern = file_system(self.spark, f"{self.state}/group=*/archives.json")
        return sorted({name for s in fs.globStatus(pattern) or [] for name in json.loads(read_text(self.spark, s.getPath().toString()))})

    def _planned_moves(self, data: str, group: str) -> list[tuple[str, str]]:
        fs, pattern = file_system(self.spark, f"{data}/setType=*/*.parquet")
        paths = sorted(status.getPath().toString() for status in fs.globStatus(pattern) or [])
        return [(p, f"{self.output}/{p.split('/')[-2]}/{group}-{i:06d}.parquet") for i, p in enumerate(paths)]

    def _move(self, source: str, target: str) -> None:
        fs, there = file_system(self.spark, source)
        if fs.exists(there):
            _, goal = file_system(self.spark, target)
            fs.mkdirs(goal.getParent())
            if not fs.rename(there, goal):
                raise OSError(f"cannot move {source} to {target}")


class IngestProgress(StreamingQueryListener):
    """Logs every micro-batch of one ingest with its counts, and takes itself off when the query ends."""

    def __init__(self, writer: DatasetWriter):
        self.writer, self.query, self.seen = writer, f"ingest-{uuid.uuid4().hex}", []

    def onQueryStarted(self, event) -> None:
        if event.name == self.query:
            self.id = event.id

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name == self.query:
            counts = self.writer.group_counts(f"stream-{progress.batchId}")
            self.seen.append((progress.batchId, progress.numInputRows, counts))
            log.info("batch %d: %d records, %s, %d ms", progress.batchId, progress.numInputRows, counts, progress.batchDuration)

    def onQueryTerminated(self, event) -> None:
        if event.id == getattr(self, "id", None):
            self.writer.spark.streams.removeListener(self)


def ingest_new_archives(
    spark: SparkSession, archives: str, output: str, min_elo: int = DEFAULT_MIN_ELO, debug_fen: bool = False,
    mode: str = "failfast", pattern: str = ARCHIVE_GLOB,
):
    """Streams archives that arrived since the last run into the dataset, then stops.

    With `mode="dropmalformed"` malformed games are listed beside the group. While it runs, the progress of each micro-batch is logged
    with what was counted in it. The file source remembers what it has read, and archives that a build has read are left out by name; every micro-batch goes
    through the batch job. Returns the query.
    """
    from plyforge.plans.dataset import routed_positions

    writer = DatasetWriter(spark, output, debug_fen)
    text = (
        spark.readStream.format("text").option("lineSep", FIRST_TAG).option("pathGlobFilter", pattern).load(archives)
        .where(~F.col("_metadata.file_name").isin(writer.read_archives()))
        .select("value", "_metadata.file_path")
    )

    def add(batch: DataFrame, batch_id: int) -> None:
        counts = StageCounts()
        routed = routed_positions(pgn_records(batch, "file_path"), counts, min_elo=min_elo, mode=mode)
        writer.append(f"stream-{batch_id}", routed, counts=counts)

    progress = IngestProgress(writer)
    spark.streams.addListener(progress)
    return (
        text.writeStream.foreachBatch(add).queryName(progress.query)
        .option("checkpointLocation", f"{writer.state}/stream").trigger(availableNow=True).start()
    )
