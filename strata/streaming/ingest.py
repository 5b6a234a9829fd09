"""File-stream ingest: raw CSV directory -> cleaned rows -> Parquet (append)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.constants import MISSING_TOKENS
from strata.operators.clean import coerce_numeric, drop_listed_columns, parse_geolocation
from strata.operators.features import add_duration, add_mortality_flag, add_risk_level


def clean_rows(df: DataFrame) -> DataFrame:
    """Row-local cleaning and features; valid on batch and streaming frames."""
    tokens = list(MISSING_TOKENS)
    df = df.withColumns({c: F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string"))
                         .otherwise(F.col(f"`{c}`")) for c, t in df.dtypes if t == "string"})
    df = coerce_numeric(df)
    keep = F.col("DataValueAlt").isNotNull()
    if "GeoLocation" in df.columns:
        keep = keep & F.col("GeoLocation").isNotNull()
    df = parse_geolocation(drop_listed_columns(df.filter(keep)))
    return add_risk_level(add_duration(add_mortality_flag(df)))


def start_ingest(spark: SparkSession, source_dir: str, schema, out_path: str,
                 checkpoint: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream raw CSV files from ``source_dir`` into ``out_path`` (Parquet,
    partitioned by year). ``checkpoint`` is a folder on shared storage that the
    caller keeps: a query started again with it resumes where it stopped, and
    every file is processed exactly once."""
    reader = (spark.readStream.schema(schema).option("header", True).option("multiLine", True)
              .option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = clean_rows(reader.csv(source_dir))
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .partitionBy("YearStart"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(out_path)
