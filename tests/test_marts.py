"""Marts, priority, trend tests and questions against DuckDB on hand-made edge rows."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.operators import marts as M
from strata.operators import priority as P
from strata.operators import questions as Q
from strata.operators import trend as Z

OBS_DDL = ("LocationAbbr string, Topic string, YearStart int, DataValueAlt double, is_mortality int, "
           "Stratification1 string, StratificationCategory1 string, risk_level string, "
           "Latitude double, Longitude double")


def _obs(spark):
    rows = []
    # CA/Cancer: a year gap (2010, 2012, 2015) and a previous value of 0.
    for y, v in [(2010, 0.0), (2012, 10.0), (2012, 20.0), (2015, 30.0)]:
        rows.append(("CA", "Cancer", y, v, 1, "Male", "Gender", "Low", 34.0, -118.0))
    # TX/Asthma: single-year segment.
    rows.append(("TX", "Asthma", 2011, 500000.0, 0, "Female", "Gender", "High", 31.0, -99.0))
    # NY/null topic.
    rows.append(("NY", None, 2013, 250000.0, 1, None, None, "Moderate", 40.0, -74.0))
    # WA/Cancer ties with CA values.
    for y, v in [(2010, 10.0), (2011, 10.0), (2012, 10.0)]:
        rows.append(("WA", "Cancer", y, v, 0, "Overall", "Overall", "Low", 47.0, -120.0))
    return spark.createDataFrame(rows, OBS_DDL)


def _duck(df):
    con = duckdb.connect()
    con.register("obs", df.toPandas())
    return con


def _rows(df_rows):
    return sorted(tuple((x is None, x) if not isinstance(x, float) or not math.isnan(x) else (True, None)
                        for x in r) for r in df_rows)


#: Worked out by hand from the rows of ``_obs``: key, records, mean, mortality rate, change,
#: relative change, and sevenths of the burden, mortality and reliability ranks (eight rows).
PRIORITY_BY_HAND = [
    ("CA", "Cancer", 2010, 1, 0.0, 1.0, None, None, 0, 4, 0), ("CA", "Cancer", 2012, 2, 15.0, 1.0, 15.0, None, 4, 4, 7),
    ("CA", "Cancer", 2015, 1, 30.0, 1.0, 15.0, 1.0, 5, 4, 0), ("TX", "Asthma", 2011, 1, 500000.0, 0.0, None, None, 7, 0, 0),
    ("NY", None, 2013, 1, 250000.0, 1.0, None, None, 6, 4, 0), ("WA", "Cancer", 2010, 1, 10.0, 0.0, None, None, 1, 0, 0),
    ("WA", "Cancer", 2011, 1, 10.0, 0.0, 0.0, 0.0, 1, 0, 0), ("WA", "Cancer", 2012, 1, 10.0, 0.0, 0.0, 0.0, 1, 0, 0),
]


def test_priority_by_hand(spark):
    obs = _obs(spark)
    got = P.intervention_priority(obs, checkpoint=False, target_rows=2)
    cols = list(P.PRIORITY_COLUMNS[:-1])
    expected = [(*r[:8], *(sevenths / 7 for sevenths in r[8:])) for r in PRIORITY_BY_HAND]
    assert _rows(got.select(*cols).collect()) == _rows(expected)
    # yoy after a previous value of 0 is null; the gap year uses the previous available year
    ca = {r.year: r for r in got.filter("state = 'CA'").collect()}
    assert ca[2012].yoy_pct_change is None and ca[2012].yoy_absolute_change == 15.0
    assert ca[2015].yoy_absolute_change == 15.0
    tx = got.filter("state = 'TX'").first()
    assert tx.yoy_absolute_change is None
    assert tx.intervention_priority_score == pytest.approx(
        0.4 * tx.burden_score + 0.3 * tx.mortality_score + 0.2 * tx.reliability_score)


def test_marts_match_sql(spark):
    obs = _obs(spark)
    con = _duck(obs)
    dist = M.risk_distribution(obs).collect()
    exp = con.execute("SELECT risk_level, COUNT(*), CAST(COUNT(*) AS DOUBLE) * 100.0 / "
                      "CAST(SUM(COUNT(*)) OVER () AS DOUBLE) FROM obs GROUP BY 1").fetchall()
    assert _rows(dist) == _rows(exp)
    demo = M.demographic_risk(obs)
    assert demo.filter("Topic is null").count() == 0 and demo.count() == 3
    k = M.dashboard_kpis(obs).first()
    assert (k.total_records, k.state_count, k.topic_count, k.first_year, k.latest_year) == (9, 4, 2, 2010, 2015)
    growth = {r.Topic: r for r in Q.topic_growth(M.topic_year_trends(obs)).collect()}
    assert growth["Cancer"].first_year == 2010 and growth["Cancer"].record_change == -1
    assert growth[None].first_year_records is None  # null keys never match in the equi-join


def test_one_group_only(spark):
    obs = _obs(spark).filter("LocationAbbr = 'TX'")
    row = P.intervention_priority(obs, checkpoint=False).first()
    assert (row.burden_score, row.mortality_score, row.reliability_score) == (0.0, 0.0, 0.0)


def _series(spark, rows):
    return spark.createDataFrame(rows, "Topic string, YearStart int, v double")


def test_mann_kendall_cases(spark):
    rows = [("up", y, float(y)) for y in range(2000, 2010)]
    rows += [("flat", y, 5.0) for y in range(2000, 2006)]
    rows += [("two", 2000, 1.0), ("two", 2001, 2.0)]
    rows += [("tie", 2000, 1.0), ("tie", 2001, 1.0), ("tie", 2002, 2.0), ("tie", 2003, 3.0)]
    out = {r.Topic: r for r in Z.mann_kendall(_series(spark, rows)).collect()}
    up = out["up"]
    assert up.s_statistic == 45 and up.tau == 1.0 and up.trend == "increasing" and up.significant
    assert up.var_s == pytest.approx(10 * 9 * 25 / 18)
    assert up.p_value == pytest.approx(math.erfc(abs((45 - 1) / math.sqrt(125.0)) / math.sqrt(2)))
    flat = out["flat"]
    assert flat.s_statistic == 0 and flat.z_score == 0.0 and flat.trend == "no trend" and flat.p_value == 1.0
    assert out["two"].s_statistic == 1 and out["two"].var_s == 1.0
    # ties: t=2 group contributes 2*1*9 = 18
    assert out["tie"].var_s == pytest.approx((4 * 3 * 13 - 18) / 18)


def test_spearman_cases(spark):
    rows = [("up", y, float(y) ** 2) for y in range(2000, 2008)]
    rows += [("flat", y, 5.0) for y in range(2000, 2006)]
    rows += [("two", 2000, 1.0), ("two", 2001, 0.5)]
    rows += [("mix", 2000, 3.0), ("mix", 2001, 1.0), ("mix", 2002, 2.0), ("mix", 2003, 5.0), ("mix", 2004, 4.0)]
    out = {r.Topic: r for r in Z.spearman(_series(spark, rows)).collect()}
    assert out["up"].rho == pytest.approx(1.0) and out["up"].p_value == 0.0 and out["up"].trend == "increasing"
    assert out["flat"].rho is None and out["flat"].trend == "decreasing"
    assert out["two"].p_value is None and out["two"].trend == "decreasing"
    # rho = 0.6 for n = 5 -> two-sided p = 0.28475 (t = 1.299, 3 df)
    assert out["mix"].rho == pytest.approx(0.6)
    assert out["mix"].p_value == pytest.approx(0.2847570, abs=1e-6)


def test_student_t_tail(spark):
    # t = 2.0 with 10 df: two-sided p = 0.0733880347707
    rows = [(2.0 / math.sqrt(14.0), 12)] + [(r, n) for r in (-1.0, -0.7, 0.0, 0.3, 0.999) for n in (2, 3, 4, 5, 6, 9, 30, 61)]
    df = spark.createDataFrame(rows, "rho double, n long")
    found = {(r.rho, r.n): r.p for r in df.select("rho", "n", Z.spearman_p(F.col("rho"), F.col("n")).alias("p")).collect()}
    assert found[rows[0]] == pytest.approx(0.0733880347707, abs=1e-10)
    strips = 20_000
    for (rho, n), p in found.items():
        if n < 3:
            assert p is None
            continue
        a = math.asin(min(abs(rho), 1.0))  # the density in the angle is cos^(n - 3)
        total = sum(math.cos((i + 0.5) * math.pi / 2 / strips) ** (n - 3) for i in range(strips)) * math.pi / 2
        tail = sum(math.cos(a + (i + 0.5) * (math.pi / 2 - a) / strips) ** (n - 3) for i in range(strips)) * (math.pi / 2 - a)
        assert p == pytest.approx(tail / total, abs=1e-8)


def test_normal_tail(spark):
    zs = [-12.0, -3.0, -0.5, 0.0, 1e-9, 1.0, 1.959963984540054, 4.0, 6.0, 8.9, 9.1]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in df.select("z", Z.normal_two_sided_p(F.col("z")).alias("p")).collect():
        assert r.p == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)), abs=2e-15)
