"""Row numbers in hash order for groups too large for one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyforge.functions.hashing import ORDER_BITS
from plyforge.sources.paths import stored


def rank_by_hash(
    df: DataFrame, groups: Sequence[str], order: str, ties: Sequence[str], bits: Column, rank: str = "rn"
) -> DataFrame:
    """Adds the 1-based rank by (`order`, `ties`) within `groups`.

    `order` is a uniform hash, so its leading `bits` cut a group into equal slices. Slices are ranked in
    separate tasks and shifted by the rows in the slices before them; no task sees a whole group. The counting
    pass reads only the group columns and the hash inputs.
    """
    sliced = (
        df.withColumn("_bits", bits.cast("int"))
        .withColumn("_slice", F.coalesce(F.expr(f"shiftright({order}, {ORDER_BITS} - _bits)"), F.lit(0)))
    )
    parts = [*groups, "_slice"]
    counts = sliced.groupBy(*parts).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*parts, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    within = Window.partitionBy(*parts).orderBy(order, *ties)
    return (
        sliced.withColumn(rank, F.row_number().over(within))
        .join(shifts, parts)
        .withColumn(rank, F.col(rank) + F.col("_shift"))
        .drop("_slice", "_bits", "_n", "_shift")
    )


def running_before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Adds the sum of `value` over all rows that come before in `order`, which is unique.

    A prefix sum over sorted range partitions: each is summed up for itself and shifted by the totals of those before it, one number
    for each partition. No task sees all rows.
    """
    ranged = stored(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranged")
    total, shifts = 0, []
    for row in ranged.groupBy("_part").agg(F.sum(value).alias("n")).orderBy("_part").collect():
        shifts.append((row["_part"], total))
        total += row["n"] or 0
    within = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = ranged.withColumn(name, F.coalesce(F.sum(value).over(within), F.lit(0)).cast("long"))
    table = df.sparkSession.createDataFrame(shifts, "_part int, _shift long")
    return earlier.join(table, "_part").withColumn(name, F.col(name) + F.col("_shift")).drop("_part", "_shift")


def slice_bits(rows: Column, per_slice: int = 1 << 18) -> Column:
    """Hash bits that cut `rows` into slices of about `per_slice` rows."""
    return F.greatest(F.lit(0), F.ceil(F.log2(rows / F.lit(per_slice)))).cast("int")
