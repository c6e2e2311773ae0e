"""Batch reads: plain tables, the raw lake, one dataset of a source-of-truth table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlake.sources.schemas import LAKE


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table, with zone-less timestamps read as UTC timestamps."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def read_lake(spark: SparkSession, root: str, first: date | None = None,
              last: date | None = None, schema: T.StructType = LAKE) -> DataFrame:
    """The raw envelope lake, pruned to the ingest dates ``first`` to ``last`` inclusive.

    The schema is given, so that no file footer is opened before the folders are pruned; columns a
    file lacks are null.
    """
    lake = spark.read.schema(schema).parquet(root)
    if first is not None:
        lake = lake.where(F.col("date") >= F.lit(first))
    if last is not None:
        lake = lake.where(F.col("date") <= F.lit(last))
    return lake


def read_dataset(records: DataFrame, dataset: str) -> DataFrame:
    """Every record of one dataset of a source-of-truth table."""
    return records.where(F.col("dataset") == F.lit(dataset))
