"""Named steps of a long run, written when ready and read back after a stop.

A step is a table below ``path/steps/<key>``; Spark's ``_SUCCESS`` marker, written
after the last file is in place, says that it is whole. A run that is started
again with the same key reads the steps that are whole and runs the rest; a
half-written step is replaced. The key stands for the input and all parameters,
so results of another input or other parameters are never picked up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(df: DataFrame) -> dict:
    """Number of rows and a hash that depends on every row, not on their order."""
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")).alias("hash")).first()
    return {"columns": df.columns, "rows": row["rows"], "hash": str(row["hash"])}


class Steps:
    """``steps(name, make)`` is the table that ``make()`` gives, run once."""

    def __init__(self, spark: SparkSession, path: str, key: dict):
        self.spark = spark
        digest = hashlib.sha256(json.dumps(key, sort_keys=True).encode()).hexdigest()[:16]
        self.path = f"{path.rstrip('/')}/steps/{digest}"
        self.ran: list[str] = []

    def done(self, name: str) -> bool:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def __call__(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        at = f"{self.path}/{name}"
        if not self.done(name):
            make().write.mode("overwrite").parquet(at)
            self.ran.append(name)
        return self.spark.read.parquet(at)
