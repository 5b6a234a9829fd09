"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path


#: Has Spark remove the shuffle files of a query when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage
    ends there, and a lost executor costs no recomputation before it. Nothing
    reads the shuffles of the write again, so their files go when it ends and
    not when the driver next collects garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``links``; ``root`` is the smallest
    node reachable. Null ends and self-links join nothing.

    Each round writes its edges to the shared folder. Minima are partially
    aggregated and joins carry one row per edge, so a node with very many
    neighbours is split like any skewed join key. Rounds grow with the
    logarithm of the longest chain; only one summary row reaches the driver.
    """
    edges = (links.select(F.col(a).alias("u"), F.col(b).alias("v"))
             .filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "links")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))
                 .distinct())
        edges = stored(small, "links")
        now = edges.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if now == mark or not now.n:
            break
        mark = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
