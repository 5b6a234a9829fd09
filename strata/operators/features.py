"""Feature engineering (F1-F7) and label encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import ENCODE_COLUMNS
from strata.functions.indicators import clipped_duration, mortality_flag, risk_level
from strata.functions.numeric import to_number

# Largest number of distinct values turned into one-hot columns; beyond it
# one-hot raises (the schema would explode).
MAX_DUMMY_COLUMNS = 1_000


def add_mortality_flag(df: DataFrame, source: str = "DataSource") -> DataFrame:
    """is_mortality 0/1; absent source column -> 0."""
    flag = mortality_flag(source) if source in df.columns else F.lit(0)
    return df.withColumn("is_mortality", flag)


def coerce_year(c: str, kind: str | None = None):
    """year text or number -> int; unparseable -> null. ``kind``: its type, if known."""
    if kind in ("tinyint", "smallint", "int"):
        return F.col(c).cast("int")
    return to_number(c, kind).try_cast("int")


def add_duration(df: DataFrame, start: str = "YearStart", end: str = "YearEnd") -> DataFrame:
    """coerce years; disease_duration = max(end - start, 0), null stays null."""
    if {start, end}.issubset(df.columns):
        kinds = dict(df.dtypes)
        df = df.withColumns({c: coerce_year(c, kinds[c]) for c in (start, end)})
        return df.withColumn("disease_duration", clipped_duration(start, end))
    return df.withColumn("disease_duration", F.lit(0))


def add_risk_level(df: DataFrame, value: str = "DataValueAlt") -> DataFrame:
    """value_normalized (a copy of the value) and the right-closed risk bins."""
    return df.withColumns({
        "value_normalized": F.col(value),
        "risk_level": risk_level(value),
    })


def distinct_values(df: DataFrame, column: str, limit: int) -> list:
    """Sorted distinct non-null values of a column; raises beyond ``limit``.

    ``limit + 1`` rows at most reach the driver.
    """
    rows = (df.select(column).where(F.col(column).isNotNull()).distinct()
            .limit(limit + 1).collect())
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values")
    return sorted(r[0] for r in rows)


def dummy_name(prefix: str, value) -> str:
    return f"{prefix}_{value}"


def add_topic_dummies(df: DataFrame, column: str = "Topic", prefix: str = "topic",
                      values: list | None = None, max_columns: int = MAX_DUMMY_COLUMNS) -> DataFrame:
    """one 0/1 column per distinct value, named ``<prefix>_<value>``,
    in value order; a null value sets every column to 0.

    Needs the distinct values on the driver (one small job unless given).
    """
    if column not in df.columns:
        return df
    if values is None:
        values = distinct_values(df, column, max_columns)
    c = F.col(column)
    return df.withColumns({
        dummy_name(prefix, v): F.coalesce(c == F.lit(v), F.lit(False)).cast("int") for v in values
    })


def order_rows(df: DataFrame, keys=("YearStart", "LocationAbbr")) -> DataFrame:
    """total order by the keys, missing last (range-partitioned sort)."""
    present = [k for k in keys if k in df.columns]
    if len(present) < len(keys):
        return df
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in present])


def engineer_features(df: DataFrame, topics: list | None = None, sort: bool = False) -> DataFrame:
    """F1-F7 in the reference order."""
    df = add_mortality_flag(df)
    df = add_duration(df)
    df = add_risk_level(df)
    df = add_topic_dummies(df, values=topics)
    return order_rows(df) if sort else df


def _as_label(column: str):
    """Text form of a value; a missing value becomes the text 'nan'."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def label_dictionary(df: DataFrame, columns) -> DataFrame:
    """``(column, label, code)``: codes 0..k-1 of each column's labels in code
    point order, for all columns together.

    The distinct labels are range-sorted over the cluster and written with
    their partition number; a label's code is the number of its column's labels
    in earlier partitions plus its place in its own. One path for any number of
    labels, and none of them reaches the driver.
    """
    from strata.operators.priority import materialize
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), _as_label(c).alias("label")) for c in columns)))
    labels = df.select(pairs.alias("e")).select("e.*").distinct()
    labels = materialize(labels.repartitionByRange("column", "label").withColumn("part", F.spark_partition_id()), "labels")
    inside = Window.partitionBy("column", "part").orderBy("label")
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = labels.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "column", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    codes = labels.withColumn("place", F.row_number().over(inside)).join(before, ["column", "part"]).select(
        "column", "label", (F.col("before") + F.col("place") - 1).cast("int").alias("code"))
    return materialize(codes, "codes")


def encode_categoricals(df: DataFrame, columns=ENCODE_COLUMNS, source: DataFrame | None = None) -> DataFrame:
    """``<column>_enc`` for every listed column that exists, by a join with
    the label dictionary of ``source`` (default: ``df``; a stored table with
    the same labels saves recomputing ``df``)."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    codes = label_dictionary(df if source is None else source, columns)
    for c in columns:
        own = codes.filter(F.col("column") == c).select(F.col("label").alias("_label"), F.col("code").alias(f"{c}_enc"))
        df = df.withColumn("_label", _as_label(c)).join(own, "_label", "left").drop("_label")
    return df


def column_codes(encoded: DataFrame, columns=ENCODE_COLUMNS) -> DataFrame:
    """``(column_name, label, code)`` of all encoded columns, as the rows hold them, in one pass."""
    held = [F.struct(F.lit(c).alias("column_name"), _as_label(c).alias("label"), F.col(f"{c}_enc").alias("code"))
            for c in columns if c in encoded.columns]
    return encoded.select(F.explode(F.array(*held)).alias("e")).select("e.*").distinct()


def encode_column(df: DataFrame, column: str) -> DataFrame:
    """E1 for one column."""
    return encode_categoricals(df, [column])
