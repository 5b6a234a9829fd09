"""Distributed percent rank / ordinals equal the single-task window forms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.ranking import percent_rank


def _data(spark):
    rows = [(i, float((i * 7919) % 97) if i % 11 else None, i % 5) for i in range(600)]
    rows += [(1000 + i, 0.0, 1) for i in range(300)]  # one hot value: a third of all rows
    return spark.createDataFrame(rows, "id long, v double, g int")


def test_percent_rank_matches_window(spark):
    df = _data(spark)
    expected = {r.id: r.pr for r in df.select(
        "id", F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last())).alias("pr")).collect()}
    for target in (10, 1_000_000):
        got = {r.id: r.pr for r in percent_rank(df, {"pr": "v"}, target_rows=target).collect()}
        assert got == expected


def test_percent_rank_by_group(spark):
    df = _data(spark)
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last())
    expected = {r.id: r.pr for r in df.select("id", F.percent_rank().over(w).alias("pr")).collect()}
    got = {r.id: r.pr for r in percent_rank(df, {"pr": "v"}, by=["g"], target_rows=7).collect()}
    assert got == expected


def test_single_row_and_all_tied(spark):
    one = spark.createDataFrame([(1, 5.0)], "id int, v double")
    assert percent_rank(one, {"pr": "v"}).first().pr == 0.0
    tied = spark.createDataFrame([(i, 2.0) for i in range(10)], "id int, v double")
    assert {r.pr for r in percent_rank(tied, {"pr": "v"}, target_rows=2).collect()} == {0.0}
