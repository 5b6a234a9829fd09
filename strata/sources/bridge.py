"""Indicator-shaped raw observations derived from the star-schema tables.

No indicator extract is supplied with the test data, so the raw observation
table is derived from lineitem joined to orders, customer, nation and part
(inner joins on the foreign keys). Every hard case of the cleaning layer
occurs in it: unparseable value text, missing values, units, sources,
locations and strata, negative spans, ties in the unit mode, a column without
values, one that is dropped by name, a class of a few rows, more topics than
the charts show, years on both sides of the heatmap's bound, strata outside
the charted list, and values with up to ten decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.sources.tables import table

# --- fixed values: mapping of the bridge --------------------------------------
RETURNFLAG_SOURCE = {"R": "NVSS, Mortality", "A": "BRFSS"}
UNIT_FOR_FINISHED = "%"
UNIT_OTHERWISE = "cases"
NOT_A_NUMBER_TEXT = "not a number"
SEGMENT_WITHOUT_STRATUM = "HOUSEHOLD"
NATION_WITHOUT_LOCATION = 24
LINE_WITHOUT_UNIT = 1
LINE_WITH_BAD_VALUE = 2
LINE_WITHOUT_VALUE = 7
YEARS_LATER = 12
TOPICS = (
    "Alcohol", "Arthritis", "Asthma", "Cancer", "Cardiovascular Disease",
    "Chronic Kidney Disease", "Diabetes", "Disability", "Mental Health",
    "Nutrition, Physical Activity, and Weight Status", "Oral Health", "Tobacco",
)
STRATUM_OF_PRIORITY = {"1": "Overall", "2": "Male", "3": "Female", "4": "Hispanic"}
OTHER_STRATUM = "Asian, non-Hispanic"
RARE_TYPE = "Provisional"  # of part 1, line 6: a class of a few rows at any scale
VALUE_STEP = 1024.0  # quantity over this: values with up to ten decimals


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a scan by ``key`` when it has fewer partitions than the
    cluster has cores (e.g. a file with a single row group), so the joins
    after it run in parallel. A large scan already has enough splits and is
    left untouched (no extra shuffle at scale)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, key)
    return df


def obs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations, one per line item (column names of the raw extract)."""
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate"), "l_orderkey")
    od = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"), "o_orderkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation has 25 rows at every scale factor: a fixed-size dimension.
    na = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand")

    # Join order: orders gets its customer and nation first (shuffles of
    # orders-sized data), then line items meet orders on the order key and
    # part on the part key: two shuffles of the largest table, not three.
    orders_ctx = (od.join(cu, od.o_custkey == cu.c_custkey)
                  .join(na, F.col("c_nationkey") == na.n_nationkey))
    joined = (
        li.join(orders_ctx, li.l_orderkey == orders_ctx.o_orderkey)
        .join(pa, F.col("l_partkey") == pa.p_partkey)
    )
    flag = F.col("l_returnflag")
    source = None
    for key, value in RETURNFLAG_SOURCE.items():
        source = F.when(flag == key, value) if source is None else source.when(flag == key, value)
    nk = F.col("n_nationkey")
    geo = F.concat(
        F.lit("POINT ("), (F.lit(-70) - nk).cast("string"), F.lit(".5 "),
        (F.lit(25) + nk).cast("string"), F.lit(".25)"))
    line = F.col("l_linenumber")
    topic = F.element_at(F.array(*map(F.lit, TOPICS)), (F.col("p_partkey") % len(TOPICS) + 1).cast("int"))
    priority = F.substring("o_orderpriority", 1, 1)
    stratum = F.coalesce(*(F.when(priority == k, v) for k, v in STRATUM_OF_PRIORITY.items()), F.lit(OTHER_STRATUM))
    return joined.select(
        (F.year("o_orderdate") + YEARS_LATER).alias("YearStart"),
        (F.year("l_shipdate") + YEARS_LATER).alias("YearEnd"),
        F.col("n_name").alias("LocationAbbr"),
        source.alias("DataSource"),
        topic.alias("Topic"),
        F.col("p_brand").alias("Question"),
        F.when(line == LINE_WITHOUT_UNIT, F.lit(None).cast("string"))
        .when(F.col("l_linestatus") == "F", F.lit(UNIT_FOR_FINISHED))
        .otherwise(F.lit(UNIT_OTHERWISE)).alias("DataValueUnit"),
        F.when((F.col("p_partkey") == 1) & (line == 6), F.lit(RARE_TYPE))
        .otherwise(F.col("l_linestatus")).alias("DataValueType"),
        F.when(line == LINE_WITH_BAD_VALUE, F.lit(NOT_A_NUMBER_TEXT))
        .otherwise(F.col("l_quantity").cast("string")).alias("DataValue"),
        F.when(line == LINE_WITHOUT_VALUE, F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice") + F.col("l_extendedprice") + F.col("l_quantity") / VALUE_STEP)
        .alias("DataValueAlt"),
        F.when(F.col("c_mktsegment") == SEGMENT_WITHOUT_STRATUM, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("StratificationCategory1"),
        stratum.alias("Stratification1"),
        F.when(nk == NATION_WITHOUT_LOCATION, F.lit(None).cast("string"))
        .otherwise(geo).alias("GeoLocation"),
        # A column that cleaning drops by name, and one without any value.
        F.col("n_name").alias("LocationDesc"), F.lit(None).cast("string").alias("Notes"),
    )


def customer_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(LocationAbbr, year, population)``: customers of a nation who have placed
    an order by a year, with a row for every year in which their number grew."""
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("first"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # 25 rows at every scale
    new = (first.join(customers, first.o_custkey == customers.c_custkey)
           .join(nation, F.col("c_nationkey") == nation.n_nationkey)
           .groupBy(F.col("n_name").alias("LocationAbbr"), (F.col("first") + YEARS_LATER).alias("year"))
           .agg(F.count(F.lit(1)).alias("n")).filter(F.col("year").isNotNull()))
    so_far = Window.partitionBy("LocationAbbr").orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    return new.select("LocationAbbr", "year", F.sum("n").over(so_far).alias("population"))
