"""Columns that are worth computing only once per row."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds columns as the output of a one-row generator.

    Catalyst copies a projected expression into every filter on it; it does not push filters through a
    generator. So a filter on an expensive column reads the value instead of computing it a second time.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
