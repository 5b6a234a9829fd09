"""Cleaning operators.

``clean`` runs exactly one Spark job: a single aggregate that yields the
number of dropped rows, the per-column non-null counts (to drop columns that
are entirely missing) and the size gate. Everything else is lazy.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import DROP_COLUMNS, MIN_CLEAN_ROWS
from strata.functions.geo import point_coordinate
from strata.functions.numeric import to_number


class TooFewRowsError(AssertionError):
    """Raised when a cleaned table does not exceed the minimum size."""


@dataclass
class CleanReport:
    rows_in: int = 0
    dropped_missing_value: int = 0
    dropped_missing_location: int = 0
    rows_out: int = 0
    dropped_columns: list = field(default_factory=list)
    empty_columns: list = field(default_factory=list)


def coerce_numeric(df: DataFrame, columns=("DataValue", "DataValueAlt")) -> DataFrame:
    """Text -> double for the listed columns that exist; bad -> null."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    kinds = dict(df.dtypes)
    return df.withColumns({c: to_number(c, kinds[c]) for c in present})


def require_column(df: DataFrame, column: str) -> None:
    """Raise KeyError when a required column is absent (no Spark job)."""
    if column not in df.columns:
        raise KeyError(f"{column} is required for analysis")


def drop_missing(df: DataFrame, columns) -> DataFrame:
    """Drop rows where any of the existing ``columns`` is null."""
    present = [c for c in columns if c in df.columns]
    return df.dropna(subset=present) if present else df


def drop_listed_columns(df: DataFrame, columns=DROP_COLUMNS) -> DataFrame:
    """Drop a fixed list of columns, ignoring absent names."""
    return df.drop(*[c for c in columns if c in df.columns])


def non_null_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    """One aggregate: row count and non-null count of every column."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"__nn{i}") for i, c in enumerate(df.columns)]
    row = df.agg(*aggs).first()
    return int(row["__rows"]), {c: int(row[f"__nn{i}"]) for i, c in enumerate(df.columns)}


def drop_empty_columns(df: DataFrame, counts: dict[str, int] | None = None) -> DataFrame:
    """Drop columns that are entirely null (one aggregate job if needed)."""
    if counts is None:
        _, counts = non_null_counts(df)
    empty = [c for c, n in counts.items() if n == 0]
    return df.drop(*empty) if empty else df


def check_min_rows(n_rows: int, min_rows: int = MIN_CLEAN_ROWS) -> None:
    """The cleaned table must hold more than ``min_rows`` rows."""
    if n_rows <= min_rows:
        raise TooFewRowsError(
            f"{n_rows} rows are left; a cleaned table needs more than {min_rows}")


def _keep_condition(df: DataFrame, value_col: str, location_col: str):
    keep_value = F.col(value_col).isNotNull()
    if location_col in df.columns:
        return keep_value, keep_value & F.col(location_col).isNotNull()
    return keep_value, keep_value


def clean_counts(df: DataFrame, value_col: str = "DataValueAlt", location_col: str = "GeoLocation",
                 drop_cols=DROP_COLUMNS, min_rows: int = MIN_CLEAN_ROWS) -> DataFrame:
    """C3/C4/C6/C7 bookkeeping as one lazy aggregate over coerced input:
    rows in, rows dropped for a missing value / location, rows out, the gate,
    and the non-null count of every surviving column (``nn_<column>``)."""
    keep_value, keep = _keep_condition(df, value_col, location_col)
    survivors = drop_listed_columns(df, drop_cols).columns
    aggs = [
        F.count(F.lit(1)).alias("rows_in"),
        F.count(F.when(~keep_value, 1)).alias("dropped_missing_value"),
        F.count(F.when(keep_value & ~keep, 1)).alias("dropped_missing_location"),
        F.count(F.when(keep, 1)).alias("rows_out"),
    ]
    aggs += [F.count(F.when(keep, F.col(f"`{c}`"))).alias(f"nn_{c}") for c in survivors]
    return df.agg(*aggs).withColumn("passes_gate", F.col("rows_out") > F.lit(min_rows))


def clean(df: DataFrame, value_col: str = "DataValueAlt", location_col: str = "GeoLocation",
          numeric_cols=("DataValue", "DataValueAlt"), drop_cols=DROP_COLUMNS,
          min_rows: int = MIN_CLEAN_ROWS, report: CleanReport | None = None) -> DataFrame:
    """Coerce numbers, drop rows without value or location, drop listed
    and entirely-missing columns, enforce the size gate.

    All counts come from one aggregate over the coerced input.
    """
    df = coerce_numeric(df, numeric_cols)
    require_column(df, value_col)
    _, keep = _keep_condition(df, value_col, location_col)
    survivors = drop_listed_columns(df, drop_cols).columns
    row = clean_counts(df, value_col, location_col, drop_cols, min_rows).first()

    rows_out = int(row["rows_out"])
    empty = [c for c in survivors if int(row[f"nn_{c}"]) == 0]
    if report is not None:
        report.rows_in = int(row["rows_in"])
        report.dropped_missing_value = int(row["dropped_missing_value"])
        report.dropped_missing_location = int(row["dropped_missing_location"])
        report.rows_out = rows_out
        report.dropped_columns = [c for c in drop_cols if c in df.columns]
        report.empty_columns = empty
    check_min_rows(rows_out, min_rows)

    out = df.filter(keep)
    out = drop_listed_columns(out, drop_cols)
    return out.drop(*empty) if empty else out


def parse_geolocation(df: DataFrame, column: str = "GeoLocation") -> DataFrame:
    """WKT point -> Longitude (1st number), Latitude (2nd); drop the source.

    Without the source column both coordinates exist and are null.
    """
    if column not in df.columns:
        return df.withColumns({"Longitude": F.lit(None).cast("double"),
                               "Latitude": F.lit(None).cast("double")})
    return df.withColumns({
        "Longitude": point_coordinate(column, 1),
        "Latitude": point_coordinate(column, 2),
    }).drop(column)


def group_mode(df: DataFrame, keys, value: str, out: str = "mode_value") -> DataFrame:
    """Most frequent non-null ``value`` per ``keys``; ties -> smallest.

    Rows are first collapsed to ``(keys, value, n)`` (partial aggregation
    absorbs hot keys), then one struct-min per key picks the winner. No
    window, no per-group collection.
    """
    keys = list(keys)
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    best = counts.groupBy(*keys).agg(
        F.min(F.struct((-F.col("_n")).alias("neg_n"), F.col(value).alias("v"))).alias("_best"))
    return best.select(*keys, F.col("_best.v").alias(out))


def group_mode_by_rank(df: DataFrame, keys, value: str, out: str = "mode_value") -> DataFrame:
    """A20, portable form (count -> row_number by count desc, value asc)."""
    keys = list(keys)
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(*keys).orderBy(F.col("_n").desc(), F.col(value).asc())
    return (counts.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select(*keys, F.col(value).alias(out)))


def impute_unit(df: DataFrame, unit: str = "DataValueUnit", keys=("Topic", "Question"), written: bool = False) -> DataFrame:
    """Fill a missing unit with the mode of its (Topic, Question) group.

    Groups without any non-null unit, and rows with a null key, stay missing.
    The mode table has one row per key. The plan leaves its size to Spark, which
    broadcasts it if its bytes allow and splits skewed keys otherwise. Only a
    ``written`` mode table has known bytes before the rows are shuffled for the join.
    """
    keys = list(keys)
    if not set(keys + [unit]).issubset(df.columns):
        return df
    modes = group_mode(df, keys, unit, "_mode_unit")
    if written:
        from strata.operators.priority import materialize
        modes = materialize(modes, "modes")
    cols = df.columns
    return (df.join(modes, on=keys, how="left")
            .withColumn(unit, F.coalesce(F.col(unit), F.col("_mode_unit")))
            .select(*cols))
