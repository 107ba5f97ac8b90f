"""The keys of all positions of a dataset, in buckets, so that new ones are found without moving the old ones."""

import hashlib
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.operators.positions import POSITION_KEY
from plyforge.sources.paths import delete, exists, read_text, write_text

BUCKETS = 64
#: So many parts of one level become one of the next.
FAN = 8
#: Up to so many candidates their hashes go into the scan, where Bloom filters leave out row groups.
FEW = 256


class KeyTable:
    """`<path>/part=NAME`: the keys that one group has added, as Parquet in buckets by key, with a Bloom filter on the key's hash `h`.

    The table is bucketed by the columns that are joined, so a scan of it needs no exchange; only the candidates move. A part
    is written as a whole, so that a repeat replaces it. `_live.json` lists the parts that count, with their level; every `FAN` parts of a level
    become one, so that a key is rewritten a logarithmic number of times and a bucket stays a few files.
    The session's catalog gets an entry for the folder, under a name that follows from the path.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, row_group_bytes: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.state = f"{self.path}/_live.json"
        known = self._state()
        self.buckets = known["buckets"] if known else buckets
        self.name = f"plyforge_keys_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"
        size = f", 'parquet.block.size' '{row_group_bytes}'" if row_group_bytes else ""
        spark.sql(f"""
            CREATE TABLE IF NOT EXISTS {self.name}
              (h BIGINT, board STRING, white_to_move BOOLEAN, castling STRING, en_passant STRING, part STRING)
            USING parquet OPTIONS ('parquet.bloom.filter.enabled#h' 'true'{size})
            PARTITIONED BY (part) CLUSTERED BY ({', '.join(POSITION_KEY)}) SORTED BY (h) INTO {self.buckets} BUCKETS
            LOCATION '{self.path}'""")
        if known:
            spark.catalog.recoverPartitions(self.name)

    def _state(self) -> dict | None:
        return json.loads(read_text(self.spark, self.state)) if exists(self.spark, self.state) else None

    def parts(self) -> dict[str, int]:
        """The parts that count, with their level."""
        state = self._state()
        return state["parts"] if state else {}

    def keys(self) -> DataFrame | None:
        """All keys with their hash; None if there are none yet."""
        live = list(self.parts())
        return self.spark.table(self.name).where(F.col("part").isin(live)).drop("part") if live else None

    def _write(self, keys: DataFrame, part: str) -> None:
        # One file for each bucket: the exchange hashes as the buckets do.
        rows = keys.select(F.xxhash64(*POSITION_KEY).alias("h"), *POSITION_KEY, F.lit(part).alias("part"))
        rows = rows.repartition(self.buckets, *POSITION_KEY)
        rows.createOrReplaceTempView(f"{self.name}_rows")
        self.spark.sql(f"""INSERT OVERWRITE TABLE {self.name} PARTITION (part = '{part}')
            SELECT h, {', '.join(POSITION_KEY)} FROM {self.name}_rows""")
        self.spark.catalog.dropTempView(f"{self.name}_rows")

    def _commit(self, parts: dict[str, int], last: str) -> None:
        write_text(self.spark, self.state, json.dumps({"buckets": self.buckets, "parts": parts, "last": last}))

    def add(self, part: str, positions: DataFrame) -> None:
        """Adds the keys of a group, by one writer at a time; the last group may be repeated, whether it has been merged or not."""
        state = self._state() or {"parts": {}, "last": None}
        if part != state["last"]:
            self._write(positions, part)
            self._commit({**state["parts"], part: 0}, part)
        self.compact()

    def compact(self) -> None:
        """Merges full levels. The list of parts is replaced before the merged ones go, so a failure leaves at most unlisted files."""
        state = self._state() or {"parts": {}}
        live = state["parts"]
        for level in sorted(set(live.values())):
            own = [p for p, at in live.items() if at == level]
            if len(own) >= FAN:
                merged = f"level-{level + 1}-{own[-1]}"
                # Spark does not write to a table that it reads, so the folders are read; this moves a key once for each level.
                self._write(self.spark.read.parquet(*[f"{self.path}/part={p}" for p in own]), merged)
                live = {**{p: at for p, at in live.items() if p not in own}, merged: level + 1}
                self._commit(live, state["last"])
                for p in own:
                    self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (part = '{p}')")
                    delete(self.spark, f"{self.path}/part={p}")

    def known_among(self, candidates: DataFrame, few: int = FEW) -> DataFrame:
        """Those candidate keys (of a stored table) that the table has.

        The table is scanned bucket by bucket and never exchanged or sorted; the candidates of a bucket are hashed in memory. With few
        candidates, their hashes are pushed to the scan as well: the Bloom filters then leave out row groups that have none of them.
        """
        keys, wanted = self.keys(), candidates.select(*POSITION_KEY)
        if keys is None:
            return wanted.limit(0)
        hashes = [r[0] for r in wanted.select(F.xxhash64(*POSITION_KEY)).limit(few + 1).collect()] if few else []
        if 0 < len(hashes) <= few:
            keys = keys.where(_any([F.col("h") == h for h in hashes]))
        return keys.select(*POSITION_KEY).join(wanted.hint("shuffle_hash"), POSITION_KEY, "left_semi")


def _any(conditions: list):
    """One condition as a balanced tree, which Parquet can check against its filters."""
    while len(conditions) > 1:
        conditions = [reduce(lambda a, b: a | b, conditions[i:i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]
