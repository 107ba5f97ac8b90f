"""Reads of the training dataset: projected, by split, and from metadata only."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.schemas import RECORDS


def scan_records(spark: SparkSession, root: str) -> DataFrame:
    """The whole dataset under its declared schema; `setType` comes from the folder names."""
    return spark.read.schema(RECORDS).parquet(root)


def scan_projected(spark: SparkSession, root: str) -> DataFrame:
    """Only what training reads."""
    return scan_records(spark, root).select("features", "eval")


def scan_split(spark: SparkSession, root: str, split: str) -> DataFrame:
    """One split; the other's folder is never listed into the scan."""
    return scan_records(spark, root).where(F.col("setType") == split)


def scan_rows(spark: SparkSession, root: str, split: str) -> DataFrame:
    """One split with the place of every row, as the loader wants it: `file, row_index, features, eval`."""
    return scan_split(spark, root, split).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row_index"),
        "features", "eval",
    )


def split_files(spark: SparkSession, root: str) -> DataFrame:
    """`split, name, length` of every data file, from the file system alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    return files.select(
        F.col("setType").alias("split"), F.substring_index("path", "/", -1).alias("name"), "length")


def train_files(spark: SparkSession, root: str) -> DataFrame:
    return split_files(spark, root).where(F.col("split") == "train")
