"""L1 — cleaning pipeline (C16): raw -> clean -> geo -> impute -> features -> encode -> Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.constants import MIN_CLEAN_ROWS
from strata.operators.clean import (
    CleanReport,
    check_min_rows,
    clean,
    coerce_numeric,
    drop_listed_columns,
    drop_missing,
    impute_unit,
    parse_geolocation,
    require_column,
)
from strata.operators.features import (
    MAX_DUMMY_COLUMNS,
    add_duration,
    add_mortality_flag,
    add_risk_level,
    distinct_values,
    encode_categoricals,
    engineer_features,
)
from strata.sources.bridge import obs_raw


def core_facts(raw: DataFrame) -> DataFrame:
    """Cleaned rows with the row-level features (F1-F5) but without what
    depends on the data as a whole: the size gate, columns dropped for being
    empty, one-hot columns and label codes. Marts read this; it is lazy and
    starts no job, and the unit join runs only for queries that read the unit.
    """
    df = drop_listed_columns(drop_missing(coerce_numeric(raw), ["DataValueAlt", "GeoLocation"]))
    df = impute_unit(parse_geolocation(df))
    df = add_mortality_flag(df)
    df = add_duration(df)
    return add_risk_level(df)


def processed(raw: DataFrame, report: CleanReport | None = None, sort: bool = False) -> DataFrame:
    """Full processed table: core facts plus topic one-hot columns (F6),
    optional ordering (F7) and integer label codes (E1)."""
    df = clean(raw, report=report)
    df = parse_geolocation(df)
    df = impute_unit(df, written=True)
    df = engineer_features(df, sort=sort)
    return encode_categoricals(df)


def bridge_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core facts built from the driver tables through the bridge."""
    return core_facts(obs_raw(spark, sf_dir))


def stage_cleaned(spark: SparkSession, raw: DataFrame, path: str,
                  report: CleanReport | None = None, min_rows: int = MIN_CLEAN_ROWS) -> DataFrame:
    """C1-C8 in one pass over the raw input, written to ``path``.

    The raw input (CSV parse, bridge joins) is read exactly once: every row
    is written with two flags (has a value / is kept). The gate and drop
    counts then come from one aggregate over the staged Parquet (flags and
    null counts only), entirely-missing columns are dropped, the size gate
    raises before anything else runs, and the kept rows are read back through
    a filter that Parquet pushes down.
    """
    typed = coerce_numeric(raw)
    require_column(typed, "DataValueAlt")
    keep_value = F.col("DataValueAlt").isNotNull()
    keep = keep_value & F.col("GeoLocation").isNotNull() if "GeoLocation" in typed.columns else keep_value
    flagged = drop_listed_columns(typed).withColumns({"_has_value": keep_value, "_keep": keep})
    parse_geolocation(flagged).write.mode("overwrite").parquet(path)

    stored = spark.read.parquet(path)
    # Entirely-missing columns are judged on the cleaned input columns (the
    # parsed coordinates are added after that step, as in the reference).
    cols = [c for c in drop_listed_columns(typed).columns if c in stored.columns]
    kept_flag = F.col("_keep")
    row = stored.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count(F.when(~F.col("_has_value"), 1)).alias("no_value"),
        F.count(F.when(F.col("_has_value") & ~kept_flag, 1)).alias("no_location"),
        F.count(F.when(kept_flag, 1)).alias("rows_out"),
        *[F.count(F.when(kept_flag, F.col(f"`{c}`"))).alias(f"nn_{i}") for i, c in enumerate(cols)],
    ).first()
    rows_out = int(row["rows_out"])
    empty = [c for i, c in enumerate(cols) if int(row[f"nn_{i}"]) == 0]
    if report is not None:
        report.rows_in = int(row["rows_in"])
        report.dropped_missing_value = int(row["no_value"])
        report.dropped_missing_location = int(row["no_location"])
        report.rows_out = rows_out
        report.dropped_columns = [c for c in raw.columns if c not in drop_listed_columns(raw).columns]
        report.empty_columns = empty
    check_min_rows(rows_out, min_rows)
    staged = stored.filter(kept_flag).drop("_has_value", "_keep")
    return staged.drop(*empty) if empty else staged


def run_pipeline(spark: SparkSession, raw: DataFrame, out_path: str,
                 partition_by: str | None = "YearStart", report: CleanReport | None = None,
                 staging_path: str | None = None) -> DataFrame:
    """The whole cleaning pipeline, written as Parquet.

    1. raw -> cleaned rows, staged in the shared checkpoint folder (one pass
       over the raw input; the lineage is cut there, so a lost executor never
       re-reads raw files or re-runs joins);
    2. topic list and label dictionary from the staged table;
    3. unit imputation, features and codes, written partitioned by year and
       range-sorted by (YearStart, LocationAbbr).

    Returns the written table read back from storage.
    """
    from strata.session import scratch_path
    from strata.sources.parquet import load_processed, save_processed

    staged = stage_cleaned(spark, raw, staging_path or scratch_path(spark, "cleaned"), report)
    topics = distinct_values(staged, "Topic", MAX_DUMMY_COLUMNS) if "Topic" in staged.columns else None
    df = engineer_features(impute_unit(staged, written=True), topics=topics)
    df = encode_categoricals(df, source=staged)
    save_processed(df, out_path, partition_by=partition_by)
    return load_processed(spark, out_path)
