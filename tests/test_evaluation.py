"""Rolling origins, matched cohorts, per-capita values and exact quantiles against plain Python."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from strata.operators import evaluation as EV
from strata.operators import quality as DQ
from strata.operators import selection

OBS = "LocationAbbr string, Topic string, Stratification1 string, YearStart int, DataValueAlt double, is_mortality int"


def rows(n=900, seed=3):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        state = rng.choice(["AL", "AK", "AZ", "CA", None])
        topic = rng.choice(["Asthma", "Cancer", "Diabetes"])
        out.append((state, topic, rng.choice(["Overall", "Male", None]), rng.choice([2010, 2011, 2013, 2014, None]),
                    rng.choice([None, round(rng.uniform(0, 1000), 3)]) if rng.random() < 0.2 else round(rng.uniform(0, 1000), 3),
                    rng.choice([None, 0, 0, 1]) if topic != "Cancer" else rng.choice([1, 1, 0])))
    return out


@pytest.fixture(scope="module")
def obs(spark):
    return spark.createDataFrame(rows(), OBS).cache()


def test_rolling_origin(obs):
    known = [r for r in rows() if r[3] is not None]
    found = {r.cutoff: r for r in EV.rolling_origin(obs).collect()}
    assert sorted(found) == [2011, 2013, 2014]
    for cutoff, r in found.items():
        train, test = ([x for x in known if (x[3] < cutoff) == early] for early in (True, False))
        score = {}
        for x in test:
            seen = [y for y in train if y[:2] == x[:2]]
            score[x[:2]] = (sum(y[5] == 1 for y in seen) + 1) / (len(seen) + 2)
        pos = [score[x[:2]] for x in test if x[5] == 1]
        neg = [score[x[:2]] for x in test if x[5] != 1]
        auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        positive = sum(x[5] == 1 for x in train)
        assert (r.train_rows, r.train_positive, r.test_rows, r.test_positive) == (len(train), positive, len(test), len(pos))
        assert r.baseline_auc == pytest.approx(auc)
        assert r.weight_positive == pytest.approx(len(train) / (2 * positive))
        assert r.weight_negative == pytest.approx(len(train) / (2 * (len(train) - positive)))


def test_rolling_origin_of_few_years(spark, obs):
    assert EV.rolling_origin(obs.filter("YearStart = 2010")).collect() == []
    assert EV.rolling_origin(obs.limit(0)).collect() == []


def test_rolling_models(spark):
    rng = random.Random(8)
    data = []
    for _ in range(600):
        year, x = rng.choice([2010, 2011, 2012, 2013]), rng.gauss(0, 1)
        died = int(x + rng.gauss(0, 0.5) > 0) if year < 2013 else 1
        data.append((year, x, died))
    df = spark.createDataFrame(data, "YearStart int, x double, is_mortality int")
    found = {r.cutoff: r for r in EV.rolling_models(df, features=("x", "absent")).collect()}
    assert sorted(found) == [2011, 2012, 2013]
    for cutoff, r in found.items():
        assert r.train_rows == sum(d[0] < cutoff for d in data) and r.train_rows + r.test_rows == 600
    assert found[2013].auc is None  # one class in the test period
    for cutoff in (2011, 2012):
        test = [(x, y) for year, x, y in data if year >= cutoff]
        pos, neg = ([x for x, y in test if y == k] for k in (1, 0))
        auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        assert found[cutoff].auc == pytest.approx(auc)  # one feature: the model keeps its order
        assert 0.5 < found[cutoff].accuracy <= 1 and 0 < found[cutoff].macro_f1 <= 1


def matched_by_hand(data, cutoff):
    """Weights, means and effect from the rows themselves."""
    strata = {}
    for x in data:
        if x[3] is not None and x[4] is not None:
            cell = ("t" if x[5] == 1 else "c", "post" if x[3] >= cutoff else "pre")
            strata.setdefault(x[:3], {}).setdefault(cell, []).append(x[4])
    full = {s: c for s, c in strata.items() if len(c) == 4}
    sums = {}
    for p in ("pre", "post"):
        sums["t", p] = [v for c in full.values() for v in c["t", p]]
        n = {k: sum(len(c[k, p]) for c in full.values()) for k in "tc"}
        weights = {s: len(c["t", p]) / len(c["c", p]) * n["c"] / n["t"] for s, c in full.items()}
        assert sum(weights[s] * len(c["c", p]) for s, c in full.items()) == pytest.approx(n["c"])
        sums["c", p] = sum(weights[s] * v for s, c in full.items() for v in c["c", p]) / n["c"]
        sums["t", p] = sum(sums["t", p]) / len(sums["t", p])
        sums["w", p] = weights
    return full, sums, (sums["t", "post"] - sums["t", "pre"]) - (sums["c", "post"] - sums["c", "pre"])


def test_matched_cohorts_and_jackknife(spark, obs):
    data, treated = rows(), F.col("is_mortality") == 1
    full, sums, did = matched_by_hand(data, 2012)
    strata = EV.matched_strata(obs, treated).collect()
    assert sum(r.matched for r in strata) == len(full)
    for r in strata:
        key = (r.LocationAbbr, r.Topic, r.Stratification1)
        assert r.matched == (key in full)
        for p in ("pre", "post"):
            assert r[f"weight_{p}"] == (pytest.approx(sums["w", p][key]) if r.matched else None)
    got = EV.matched_diff_in_diff(obs, treated).first()
    assert got.did == pytest.approx(did) and got.matched_strata == len(full)
    assert got.control_pre == pytest.approx(sums["c", "pre"]) and got.treated_post == pytest.approx(sums["t", "post"])
    clusters = {s[0] for s in full}
    thetas = [matched_by_hand([x for x in data if x[0] != g], 2012)[2] for g in clusters]
    mean = sum(thetas) / len(thetas)
    error = math.sqrt((len(thetas) - 1) / len(thetas) * sum((t - mean) ** 2 for t in thetas))
    assert got.jackknife_error == pytest.approx(error) and got.clusters == len(clusters)


def test_matching_one_cluster_has_no_error(spark, obs):
    got = EV.matched_diff_in_diff(obs.filter("LocationAbbr = 'AL'"), F.col("is_mortality") == 1).first()
    assert got.clusters == 1 and got.jackknife_error is None and got.did is not None


def test_per_capita_takes_the_population_of_the_year(spark, obs):
    population = spark.createDataFrame([("AL", 2011, 50), ("AL", 2013, 80), ("AK", 2009, 10), ("CA", 2014, 0), ("XX", 2000, 9)],
                                       "LocationAbbr string, year int, population long")
    found = DQ.per_capita(obs, population).collect()
    assert sum(r.record_count for r in found) == len(rows())
    held = {("AL", 2011): (50, 2011), ("AL", 2013): (80, 2013), ("AL", 2014): (80, 2013), ("CA", 2014): (0, 2014)}
    for r in found:
        want = held.get((r.LocationAbbr, r.YearStart), (None, None))
        if r.LocationAbbr == "AK" and r.YearStart is not None:
            want = (10, 2009)
        assert (r.population, r.population_year) == want
        alike = [x for x in rows() if (x[0], x[1], x[3]) == (r.LocationAbbr, r.Topic, r.YearStart)]
        assert (r.record_count, r.mortality_records) == (len(alike), sum(x[5] == 1 for x in alike))
        rate = 100_000 * len(alike) / want[0] if want[0] else None
        assert r.records_per_100k == (pytest.approx(rate) if rate is not None else None)


@pytest.mark.parametrize("bins, few", [(16, 20), (1024, 1000)])
def test_exact_quantiles(spark, bins, few):
    rng = random.Random(bins)
    data = {"a": [rng.gauss(0, 1) for _ in range(300)], "ties": [1.0, 2.0, 2.0, 2.0, 3.0] * 30, "one": [5.5],
            "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-3, 308) for _ in range(40)],
            "endless": [float("inf")] * 3 + [float("-inf")] * 4 + [0.0, 1.0], "all": [float("inf")] * 4, None: [1.0, 2.0, -0.0, 0.0]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in [*vs, None, float("nan")]], "g string, v double")
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    found = {(r.g, r.prob): (r.n, r.value) for r in selection.exact_quantiles(df, "g", "v", probs, bins, few).collect()}
    want = {(g, p): (len(vs), sorted(vs)[max(math.ceil(p * len(vs)), 1) - 1]) for g, vs in data.items() for p in probs}
    assert found == want


def test_thresholds_per_topic(spark, obs):
    found = {r.Topic: (r.p25, r.p50, r.p75) for r in DQ.risk_thresholds(obs).collect()}
    for topic, cuts in found.items():
        vs = sorted(x[4] for x in rows() if x[1] == topic and x[4] is not None)
        assert cuts == tuple(vs[math.ceil(p * len(vs)) - 1] for p in (0.25, 0.5, 0.75))
    assert DQ.risk_thresholds(obs.limit(0)).collect() == []


def plain_isotonic(levels):
    """Isotonic regression of ``(score, n, positives)`` by its max-min formula."""
    def share(a, b):
        return Fraction(sum(x[2] for x in levels[a:b + 1]), sum(x[1] for x in levels[a:b + 1]))

    return [max(min(share(a, b) for b in range(i, len(levels))) for a in range(i + 1)) for i in range(len(levels))]


def test_isotonic_blocks_on_tied_scores(spark):
    from strata.operators import isotonic
    rng = random.Random(12)
    data = [(s := rng.randint(0, 40) / 40, int(rng.random() < s * s)) for _ in range(900)] + [(0.5, None), (None, 1), (float("nan"), 1)]
    df = spark.createDataFrame(data, "score double, label int")
    blocks = isotonic.isotonic_blocks(df.repartition(5)).orderBy("low").collect()
    known = [(s, y) for s, y in data if s is not None and s == s]
    levels = [(s, sum(x == s for x, _ in known), sum(x == s and y == 1 for x, y in known)) for s in sorted({s for s, _ in known})]
    fit = plain_isotonic(levels)
    assert [r.calibrated for r in blocks] == [float(v) for v in sorted(set(fit))]
    assert sum(r.n for r in blocks) == len(known)
    value = {s: float(v) for (s, _, _), v in zip(levels, fit, strict=True)}
    table = isotonic.isotonic_blocks(df)
    for r in isotonic.calibrated(df.filter("score >= 0 AND NOT isnan(score)"), table).collect():
        assert r.calibrated == value[r.score]
    outside = spark.createDataFrame([(-1.0,), (2.0,), (0.0001,)], "score double")
    assert {r.score: r.calibrated for r in isotonic.calibrated(outside, table).collect()} == {
        -1.0: value[0.0], 2.0: value[1.0], 0.0001: value[0.0]}
    error = isotonic.expected_calibration_error(df.filter("score >= 0 AND NOT isnan(score)").fillna({"label": 0})).first()
    bins = {}
    for s, y in known:
        bins.setdefault(min(int(s * 10), 9), []).append((s, y or 0))
    want = sum(abs(sum(s for s, _ in b) - sum(y for _, y in b)) for b in bins.values()) / len(known)
    assert error.rows == len(known) and error.ece == pytest.approx(want)
    assert isotonic.isotonic_blocks(df.limit(0)).collect() == []


def test_kpis_from_cells(spark):
    """Filtered figures read the cells only; the sketch stays within its error."""
    from strata.operators import cells as CE
    rng = random.Random(2)
    data = [(rng.choice(["AL", "AK", None]), rng.choice(["Asthma", "Cancer"]), rng.choice(["Male", None]), rng.choice([2010, 2011, 2012]),
             1.0, rng.choice([0, 1, None]), f"q{rng.randrange(6000)}") for _ in range(9000)]
    df = spark.createDataFrame(data, OBS + ", Question string")
    cells = CE.kpi_cells(df)
    for filters in ({}, {"states": ["AL"]}, {"topics": ["Cancer"], "years": (2011, 2012)}, {"groups": ["Male"]}, {"states": ["XX"]}):
        got, kept = CE.filtered_kpis(cells, **filters).first(), DQ.dashboard_filter(df, **filters)
        rows = kept.collect()
        assert got.total_records == len(rows) and got.state_count == len({r.LocationAbbr for r in rows} - {None})
        assert got.first_year == min((r.YearStart for r in rows), default=None)
        if rows:
            assert got.mortality_source_rate == pytest.approx(sum(r.is_mortality == 1 for r in rows) / len(rows))
        exact = len({r.Question for r in rows})
        assert abs(got.question_count - exact) <= 0.05 * exact
