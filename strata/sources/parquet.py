"""Processed-table storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_processed(df: DataFrame, path: str, partition_by: str | None = "YearStart",
                   sort_within=("YearStart", "LocationAbbr")) -> str:
    """Overwrite ``path`` with Parquet (directories are created).

    Rows are range-partitioned and sorted by ``sort_within`` (missing last),
    which is the distributed form of the F7 ordering.
    """
    keys = [c for c in sort_within if c in df.columns]
    writer_df = df
    if keys:
        # Range partitioning on the sort keys gives balanced tasks that each
        # hold a narrow key range (few files per year directory). The hash of
        # the whole row is the last range key so that one hot (year, state)
        # pair can still be split across several tasks.
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        writer_df = writer_df.repartitionByRange(*[F.col(k).asc_nulls_last() for k in keys], spread)
        writer_df = writer_df.sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in keys])
    writer = writer_df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path


def load_processed(spark: SparkSession, path: str) -> DataFrame:
    """Read the processed table (schema carried by the files)."""
    return spark.read.parquet(path)


def register_fact_table(df: DataFrame, name: str = "cdi_observations", cache: bool = False) -> DataFrame:
    """S3: expose the fact table to SQL; optionally cache it for a mart batch."""
    if cache:
        df = df.persist()
    df.createOrReplaceTempView(name)
    return df
