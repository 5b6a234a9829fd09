"""Extract sinks: mart CSVs (S6) and model outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Header CSV, comma-delimited, in directory ``path``.

    ``single_file`` brings the rows into one task, for reports of a few rows.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("delimiter", ",").csv(path)
    return path


def export_marts(marts: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """One CSV directory per mart below ``out_dir``."""
    return {name: write_csv(df, f"{out_dir.rstrip('/')}/{name}") for name, df in marts.items()}


def read_manifest(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row count of each written extract, read back from storage."""
    parts = [spark.read.option("header", True).csv(p)
             .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("extract"), "rows")
             for name, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
