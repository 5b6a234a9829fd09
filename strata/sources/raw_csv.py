"""Raw CSV source (S1) with the input existence check."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.constants import MISSING_TOKENS
from strata.functions.numeric import to_number

# Raw columns that are numbers in the extract; all other columns stay text.
INTEGER_COLUMNS = ("YearStart", "YearEnd", "LocationID")
DOUBLE_COLUMNS = ("LowConfidenceLimit", "HighConfidenceLimit")


def load_raw(spark: SparkSession, path: str, missing_tokens=MISSING_TOKENS, multiline: bool = True,
             columns: list[str] | None = None) -> DataFrame:
    """Read a raw extract with a header row.

    * every column is read as text (no inference pass over the data);
    * quoted fields may hold commas, doubled quotes and newlines;
    * the usual missing-value tokens ("NA", "N/A", "null", ...) become null;
    * known integer / decimal columns are coerced (bad text -> null); the
      value columns are left to the cleaning step (C1).

    ``multiline`` keeps newlines inside quotes but makes each file one task;
    switch it off for extracts known to have none. ``columns`` names the
    columns: every file must then carry them in that order, and a header that
    differs is an error.

    A missing path raises FileNotFoundError (S8).
    """
    try:
        reader = (spark.read.option("header", True).option("multiLine", multiline)
                  .option("escape", '"').option("quote", '"').option("mode", "PERMISSIVE"))
        if columns:
            reader = reader.option("enforceSchema", False).schema(
                StructType([StructField(c, StringType()) for c in columns]))
        df = reader.csv(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"no raw extract at {path}") from exc
        raise
    tokens = list(missing_tokens)
    cols = {c: F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string"))
            .otherwise(F.col(f"`{c}`")) for c in df.columns}
    df = df.withColumns(cols)
    typed = {c: to_number(c).try_cast("int") for c in INTEGER_COLUMNS if c in df.columns}
    typed.update({c: to_number(c) for c in DOUBLE_COLUMNS if c in df.columns})
    return df.withColumns(typed) if typed else df


def write_raw(df: DataFrame, path: str) -> str:
    """Write a raw-shaped table as header CSV (quotes and newlines escaped)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("quoteAll", False).csv(path))
    return path
