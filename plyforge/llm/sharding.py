"""Placement of rows on shards by a hierarchical weighted hash tree."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyforge.sources.paths import stored

RACK_SHARDS, REGION_RACKS = 4, 2
ROWS_PER_SLICE = 1_000_000
LEAST_SLICES = 64
RUN = 65_536


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree_of(shards: int) -> list[Leaf]:
    """Shards 0 to `shards` - 1 of equal weight, four to a rack and two racks to a region."""
    racks = [i // RACK_SHARDS for i in range(shards)]
    return [Leaf(f"r{k // REGION_RACKS}", f"r{k // REGION_RACKS}k{k % REGION_RACKS}", i) for i, k in enumerate(racks)]


def with_new_region(tree: list[Leaf]) -> list[Leaf]:
    """The tree and one more shard in a region of its own. No other subtree changes its weight, so rows move to it alone."""
    shard = max((leaf.shard for leaf in tree), default=-1) + 1
    return [*tree, Leaf(f"new{shard}", f"new{shard}k0", shard)]


def _drawn(key: Column, weights: dict[str, float]) -> Column:
    """The child with the smallest exponential draw; a child wins in proportion to its weight.

    The draw of a child depends on the key and the child's name only. If one weight grows, keys move to that child and
    between no others.
    """
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    uniform = {c: (F.shiftrightunsigned(F.xxhash64(key, F.lit(c)), 11) + 1).cast("double") / 2.0 ** 53 for c in weights}
    draws = [F.struct((-F.log(uniform[c]) / w).alias("draw"), F.lit(c).alias("child")) for c, w in weights.items()]
    return F.array_min(F.array(*draws))["child"]


def place(df: DataFrame, key: str, tree: list[Leaf], shard: str = "shard", levels: bool = False) -> DataFrame:
    """Adds the shard of each row, found by descending region, rack and shard; also region and rack if `levels`.

    A null key is a key like any other, and equal keys go to the same shard.
    """
    regions: dict[str, dict[str, dict[str, float]]] = {}
    for leaf in tree:
        if leaf.weight > 0:
            regions.setdefault(leaf.region, {}).setdefault(leaf.rack, {})[str(leaf.shard)] = leaf.weight
    if not regions:
        raise ValueError("the tree has no shard with a positive weight")
    racks = {k: shards for region in regions.values() for k, shards in region.items()}

    def chosen(at: Column, children: dict[str, dict[str, float]]) -> Column:
        found = F.lit(None).cast("string")
        for name, weights in children.items():
            found = F.when(at == name, _drawn(F.col(key), weights)).otherwise(found)
        return found

    totals = {r: {k: sum(s.values()) for k, s in region.items()} for r, region in regions.items()}
    got = df.withColumn("_region", _drawn(F.col(key), {r: sum(k.values()) for r, k in totals.items()}))
    got = got.withColumn("_rack", chosen(F.col("_region"), totals))
    got = got.withColumn(shard, chosen(F.col("_rack"), racks).cast("int"))
    if levels:
        got = got.withColumn("region", F.col("_region")).withColumn("rack", F.col("_rack"))
    return got.drop("_region", "_rack")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Every row's shard and its place (slot) in that shard, by the law that key and shard count decide.

    Columns: doc_id, size (UTF-8 bytes and 1), text_crc32, law, shard, slot, grown_shard (with one more shard), region,
    rack. A null text has size 1 and the checksum of no bytes. Repeated rows are counted before they are shuffled and
    get slots of their own. A slot is the rank within a hash slice of the shard plus the rows of earlier slices, so no
    task ranks a whole shard. An empty table gives no rows.
    """
    tree = tree_of(shards)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "shards")
    slices = max(LEAST_SLICES, -(-rows.count() // (shards * ROWS_PER_SLICE)))
    placed = place(place(rows, "doc_id", tree, levels=True), "doc_id", with_new_region(tree), "grown_shard")
    placed = placed.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slices)))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard and slice: a size fixed by the two counts.
    slice_start = placed.groupBy("shard", "slice").agg(F.sum("copies").alias("n")).select(
        "shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("slice_start"))
    order = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = placed.withColumn("start", F.coalesce(F.sum("copies").over(order), F.lit(0))).join(
        slice_start, ["shard", "slice"])
    # Many copies of a row are written out in runs, so that no array grows with them.
    runs = ranked.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / RUN))))
    left = F.least(F.lit(RUN), F.col("copies") - F.col("run") * RUN)
    each = runs.withColumn("i", F.explode(F.sequence(F.lit(0), (left - 1).cast("int"))))
    slot = F.col("slice_start") + F.col("start") + F.col("run") * RUN + F.col("i")
    return each.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slot.cast("long").alias("slot"),
                       "grown_shard", "region", "rack")
