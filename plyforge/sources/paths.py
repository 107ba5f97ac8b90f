"""Hadoop file-system access and the shared scratch folder."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(FileSystem, Path) of the path, local or shared."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = file_system(spark, path)
    return fs.exists(jpath)


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = file_system(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written aside and renamed, so that the file is there whole or not at all."""
    fs, aside = file_system(spark, f"{path}.part")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    _, jpath = file_system(spark, path)
    fs.delete(jpath, False)
    fs.rename(aside, jpath)


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = file_system(spark, path)
    fs.delete(jpath, True)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"plyforge-{application}-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under `spark.checkpoint.dir`, where every executor can read it back.

    Only a local session, as in tests, may go without that setting; it gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df, name: str):
    """The DataFrame written to scratch and read back: short lineage, known size, safe to scan twice."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
