"""Cleaning, features and label codes on rows made for each rule."""

import math

import pytest
from pyspark.sql import functions as F

from strata.constants import DROP_COLUMNS, RISK_LABELS
from strata.functions.indicators import risk_level
from strata.functions.numeric import exact_mean, to_number
from strata.operators import clean as C
from strata.operators import features as FE
from tests.fixtures import raw_extract


def column(spark, values, kind, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"`{name}` {kind}")


NUMBERS = [
    (None, None), ("NaN", None), ("", None), ("NA", None), ("1,000", None), ("3f", None), ("1d", None), ("0x1", None),
    (" 12 ", 12.0), ("-2.5e3", -2500.0), (".5", 0.5), ("7.", 7.0), ("inf", math.inf), ("-Infinity", -math.inf),
]
RISKS = [
    (None, None), (-math.inf, None), (-5.0, "Low"), (100000.0, "Low"), (100000.01, "Moderate"), (250000.0, "Moderate"),
    (250000.5, "High"), (500000.0, "High"), (500000.5, "Very High"), (math.inf, "Very High"),
]


@pytest.mark.parametrize("cases, kind, rule", [(NUMBERS, "string", to_number), (RISKS, "double", risk_level)],
                         ids=["numbers", "risk bins"])
def test_value_rules(spark, cases, kind, rule):
    rows = column(spark, [given for given, _ in cases], kind)
    assert [r[0] for r in rows.select(rule("v")).collect()] == [want for _, want in cases]


@pytest.mark.parametrize("values, want", [
    ([0.004, 0.004, 0.0129], 0.0209 / 3),
    ([1e17, 1.0], 5e16),
    ([math.inf, 1.0], math.inf), ([math.inf, -math.inf], math.nan),
    ([1e300, 1e300], 1e300), ([None, 2.5, None], 2.5), ([None], None), ([], None),
    ([0.1] * 10 + [-0.1] * 10, 0.0),
])
def test_means_keep_what_the_values_hold(spark, values, want):
    got = column(spark, values, "double").select(exact_mean("v")).first()[0]
    assert got == want if want is None or math.isinf(want) else math.isnan(got) if math.isnan(want) \
        else got == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_means_agree_with_plain_averages_and_any_order(spark):
    obs = raw_extract(spark, 5000).withColumn("DataValueAlt", F.col("DataValueAlt") / 997)
    two = obs.groupBy("Topic").agg(exact_mean("DataValueAlt").alias("m"), F.avg("DataValueAlt").alias("plain")).collect()
    assert all(r.m == pytest.approx(r.plain, rel=1e-9) for r in two)
    other = obs.repartition(7, "LocationAbbr").groupBy("Topic").agg(exact_mean("DataValueAlt").alias("m")).collect()
    assert {r.Topic: r.m for r in two} == {r.Topic: r.m for r in other}


def test_cleaning_drops_and_counts(spark):
    damaged = (raw_extract(spark).withColumn("Blank", F.lit(None).cast("double"))
               .withColumn("DataValueAlt", F.when(F.col("LocationID") != 1, F.col("DataValueAlt")))
               .withColumn("GeoLocation", F.when(F.col("YearStart") != 2010, F.col("GeoLocation"))))
    report = C.CleanReport()
    out = C.clean(damaged, min_rows=20, report=report)
    keep = damaged.filter("DataValueAlt IS NOT NULL")
    assert out.count() == report.rows_out == keep.filter("GeoLocation IS NOT NULL").count() > 20
    assert report.rows_in == 240 and report.dropped_missing_value == 240 - keep.count()
    assert report.dropped_missing_location == keep.filter("GeoLocation IS NULL").count() > 0
    assert not set(out.columns) & {*DROP_COLUMNS, "Blank"} and report.empty_columns == ["Blank"]
    assert dict(out.dtypes)["DataValue"] == "double" and out.filter("DataValue IS NULL").count() > 0


@pytest.mark.parametrize("rows, passes", [(0, False), (100, False), (101, True)])
def test_size_gate(spark, rows, passes):
    data = raw_extract(spark, rows)
    if passes:
        assert C.clean(data).count() == rows
    else:
        with pytest.raises(C.TooFewRowsError):
            C.clean(data)


def test_value_column_is_required(spark):
    with pytest.raises(KeyError):
        C.clean(raw_extract(spark).drop("DataValueAlt"))


def test_points(spark):
    cases = {"POINT (-70.5 25.25)": (-70.5, 25.25), "POINT(1 2)": (None, None), "somewhere": (None, None),
             "POINT (3f 1.0d)": (None, None), "POINT (1e1 .5)": (10.0, 0.5), "POINT (NaN 4)": (None, 4.0), None: (None, None)}
    out = C.parse_geolocation(column(spark, list(cases), "string", "GeoLocation"))
    assert [(r.Longitude, r.Latitude) for r in out.collect()] == list(cases.values()) and "GeoLocation" not in out.columns
    without = C.parse_geolocation(column(spark, ["POINT (1 2)"], "string", "elsewhere")).first()
    assert (without.Longitude, without.Latitude) == (None, None)


UNITS = [  # topic, question, units before, units after
    ("T", "tie", ["b", "a", None], ["a", "a", "b"]), ("T", "none", [None, None], [None, None]),
    ("T", None, ["x", None], [None, "x"]), ("U", "most", ["z", "z", "y", None], ["y", "z", "z", "z"]),
]


def test_units_are_filled_with_the_commonest(spark):
    rows = [(t, q, u) for t, q, units, _ in UNITS for u in units]
    df = spark.createDataFrame(rows, "Topic string, Question string, DataValueUnit string")
    out = C.impute_unit(df).collect()
    for topic, question, _, after in UNITS:
        assert sorted((r.DataValueUnit for r in out if (r.Topic, r.Question) == (topic, question)), key=str) == sorted(after, key=str)
    keys = ["Topic", "Question"]
    one, two = (sorted(map(str, f(df, keys, "DataValueUnit").collect())) for f in (C.group_mode, C.group_mode_by_rank))
    assert one == two


def test_features_of_an_extract(spark):
    out = FE.engineer_features(C.clean(raw_extract(spark))).cache()
    assert {r[0] for r in out.select("risk_level").distinct().collect()} <= {*RISK_LABELS}
    assert out.filter("disease_duration <> greatest(YearEnd - YearStart, 0)").count() == 0
    assert out.filter("(is_mortality = 1) <> coalesce(DataSource IN ('NVSS', 'Death Certificate'), false)").count() == 0
    topics = [c for c in out.columns if c.startswith("topic_")]
    assert topics == [f"topic_{t}" for t in sorted({r[0] for r in out.select("Topic").distinct().collect()})]
    assert out.filter(" + ".join(f"`{c}`" for c in topics) + " <> 1").count() == 0


def test_features_of_missing_inputs(spark):
    spans = spark.createDataFrame([(2010, 2012), (2012, 2010), (None, 2010), (2010, None)], "YearStart int, YearEnd int")
    assert [r.disease_duration for r in FE.add_duration(spans).collect()] == [2, 0, None, None]
    feeds = column(spark, ["NVSS", None, "BRFSS"], "string", "DataSource")
    assert [r.is_mortality for r in FE.add_mortality_flag(feeds).collect()] == [1, 0, 0]
    assert FE.add_mortality_flag(feeds.drop("DataSource")).first().is_mortality == 0
    dummies = FE.add_topic_dummies(column(spark, ["A", None, "B"], "string", "Topic")).collect()
    assert [(r.topic_A, r.topic_B) for r in dummies] == [(1, 0), (0, 0), (0, 1)]


def test_label_codes_follow_code_points(spark):
    labels = column(spark, ["b", None, "B", "a", "b"], "string", "LocationAbbr")
    out = FE.encode_categoricals(labels)
    assert dict(out.dtypes)["LocationAbbr_enc"] == "int"
    assert {r.LocationAbbr: r.LocationAbbr_enc for r in out.collect()} == {"B": 0, "a": 1, "b": 2, None: 3}
    many = column(spark, [f"k{i % 37}" for i in range(500)] + [None], "string", "LocationAbbr")
    codes = {r[0]: r[1] for r in FE.encode_column(many, "LocationAbbr").select("LocationAbbr", "LocationAbbr_enc").collect()}
    assert codes == {k: i for i, k in enumerate(sorted((x for x in codes if x), key=str))} | {None: 37}


def test_plain_numbers_are_not_parsed_as_text(spark):
    from strata.functions.numeric import to_number
    values = [1.0, -0.0, 0.1, 1e300, 4.9e-324, float("inf"), float("-inf"), float("nan"), None, 123456789.0000000001]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "DataValueAlt double, DataValue long")
    typed = C.coerce_numeric(df)
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "string" not in plan
    by_text = df.select(to_number("DataValue").alias("DataValue"), to_number("DataValueAlt").alias("DataValueAlt"))
    assert sorted(map(str, typed.select("DataValue", "DataValueAlt").collect())) == sorted(map(str, by_text.collect()))
    years = spark.createDataFrame([(2010, 2012), (None, 2012), (2011, 2009)], "YearStart int, YearEnd int")
    found = FE.add_duration(years)
    assert "RLIKE" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(2010, 2012, 2), (None, 2012, None), (2011, 2009, 0)], key=str)


def test_small_dictionaries_are_broadcast(spark):
    """Units and label codes: the rows stay where they are, whatever their number."""
    from tests.fixtures import raw_extract
    rows = C.impute_unit(raw_extract(spark).repartition(3), written=True)
    out = FE.encode_categoricals(rows)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 5
    codes = FE.column_codes(out)
    assert codes._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    whole = {(c, str(r[c]), r[f"{c}_enc"]) for c in FE.ENCODE_COLUMNS for r in out.collect()}
    assert {tuple(r) for r in codes.collect()} == whole


def test_marts_for_export_read_their_columns_only(spark):
    from strata.operators import marts as M
    from strata.plans.cleaning import core_facts
    from tests.fixtures import raw_extract
    obs = core_facts(raw_extract(spark))
    some = obs.select(*M.MART_COLUMNS)
    for fn in M.MARTS.values():
        assert sorted(map(str, fn(some).collect())) == sorted(map(str, fn(obs).collect()))
