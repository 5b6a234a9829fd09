"""Independent DuckDB-dialect SQL for the correctness gate.

Each statement recomputes a registered query from the raw star-schema views
(region, nation, customer, supplier, part, orders, lineitem, ...), so it
shares no code path with the Spark implementation. Averages of indicator
values use exact decimal sums on both sides; percentages and rates are
computed in double with the same operation order.
"""

from __future__ import annotations

# Raw observations derived from the star schema (same mapping as the bridge).
OBS_RAW = r"""
obs_raw AS (
  SELECT
    CAST(year(o.o_orderdate) + 12 AS INTEGER) AS YearStart,
    CAST(year(l.l_shipdate) + 12 AS INTEGER) AS YearEnd,
    n.n_name AS LocationAbbr,
    CASE l.l_returnflag WHEN 'R' THEN 'NVSS, Mortality' WHEN 'A' THEN 'BRFSS' END AS DataSource,
    list_extract(['Alcohol', 'Arthritis', 'Asthma', 'Cancer', 'Cardiovascular Disease',
      'Chronic Kidney Disease', 'Diabetes', 'Disability', 'Mental Health',
      'Nutrition, Physical Activity, and Weight Status', 'Oral Health', 'Tobacco'],
      p.p_partkey % 12 + 1) AS Topic,
    p.p_brand AS Question,
    CASE WHEN l.l_linenumber = 1 THEN NULL
         WHEN l.l_linestatus = 'F' THEN '%' ELSE 'cases' END AS DataValueUnit,
    CASE WHEN p.p_partkey = 1 AND l.l_linenumber = 6 THEN 'Provisional' ELSE l.l_linestatus END
      AS DataValueType,
    CASE WHEN l.l_linenumber = 2 THEN 'not a number'
         ELSE CAST(l.l_quantity AS VARCHAR) END AS DataValue,
    CASE WHEN l.l_linenumber = 7 THEN NULL
         ELSE o.o_totalprice + l.l_extendedprice + l.l_quantity / 1024.0::DOUBLE END AS DataValueAlt,
    CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c.c_mktsegment END
      AS StratificationCategory1,
    CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'Overall' WHEN '2' THEN 'Male'
      WHEN '3' THEN 'Female' WHEN '4' THEN 'Hispanic' ELSE 'Asian, non-Hispanic' END AS Stratification1,
    CASE WHEN n.n_nationkey = 24 THEN NULL
         ELSE 'POINT (' || CAST(-70 - n.n_nationkey AS VARCHAR) || '.5 '
              || CAST(25 + n.n_nationkey AS VARCHAR) || '.25)' END AS GeoLocation,
    n.n_name AS LocationDesc, CAST(NULL AS VARCHAR) AS Notes
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

NUM_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Cleaned rows: numeric coercion, rows without value or location removed,
# coordinates parsed.
OBS_CLEAN = r"""
obs_typed AS (
  SELECT * REPLACE (
    CASE WHEN regexp_matches(trim(DataValue), '""" + NUM_RE + r"""')
         THEN TRY_CAST(trim(DataValue) AS DOUBLE) END AS DataValue)
  FROM obs_raw
),
obs_clean AS (
  SELECT * EXCLUDE (GeoLocation, LocationDesc, Notes),
    TRY_CAST(NULLIF(regexp_extract(GeoLocation, 'POINT \(([^ ]+) ([^ ]+)\)', 1), '') AS DOUBLE)
      AS Longitude,
    TRY_CAST(NULLIF(regexp_extract(GeoLocation, 'POINT \(([^ ]+) ([^ ]+)\)', 2), '') AS DOUBLE)
      AS Latitude
  FROM obs_typed
  WHERE DataValueAlt IS NOT NULL AND GeoLocation IS NOT NULL
)"""

# Unit mode per (Topic, Question): highest count, smallest unit on ties.
UNIT_MODE = r"""
unit_counts AS (
  SELECT Topic, Question, DataValueUnit AS unit, COUNT(*) AS n
  FROM obs_clean WHERE DataValueUnit IS NOT NULL
  GROUP BY Topic, Question, DataValueUnit
),
unit_mode AS (
  SELECT Topic, Question, unit AS mode_unit FROM (
    SELECT *, row_number() OVER (PARTITION BY Topic, Question ORDER BY n DESC, unit ASC) AS rn
    FROM unit_counts) WHERE rn = 1
)"""

OBS = r"""
obs AS (
  SELECT o.* REPLACE (COALESCE(o.DataValueUnit, m.mode_unit) AS DataValueUnit),
    CASE WHEN o.DataSource IN ('NVSS, Mortality', 'NVSS', 'Death Certificate')
         THEN 1 ELSE 0 END AS is_mortality,
    CASE WHEN o.YearEnd - o.YearStart IS NULL THEN NULL
         ELSE greatest(o.YearEnd - o.YearStart, 0) END AS disease_duration,
    o.DataValueAlt AS value_normalized,
    CASE WHEN o.DataValueAlt <= 100000 THEN 'Low'
         WHEN o.DataValueAlt <= 250000 THEN 'Moderate'
         WHEN o.DataValueAlt <= 500000 THEN 'High'
         WHEN o.DataValueAlt > 500000 THEN 'Very High' END AS risk_level
  FROM obs_clean o
  LEFT JOIN unit_mode m ON o.Topic = m.Topic AND o.Question = m.Question
)"""

BASE = "WITH" + OBS_RAW + "," + OBS_CLEAN + "," + UNIT_MODE + "," + OBS


def exact_avg(col: str) -> str:
    # Through text, so that neither the conversion of a value nor that of the
    # sum rounds in binary on the way.
    total = f"SUM(CAST(CAST({col} AS VARCHAR) AS DECIMAL(38,10)))"
    return f"CAST(CAST({total} AS VARCHAR) AS DOUBLE) / COUNT({col})"


def rate(flag: str = "is_mortality") -> str:
    return f"CAST(SUM(CASE WHEN {flag} = 1 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*)"


def with_base(*ctes: str) -> str:
    """BASE plus further named CTEs (each 'name AS (...)')."""
    return BASE + "".join("," + c for c in ctes)


STATE_TOPIC_YEAR = f"""
sty AS (
  SELECT LocationAbbr AS state, Topic AS disease_topic, YearStart AS year,
    COUNT(*) AS record_count,
    {exact_avg('DataValueAlt')} AS avg_indicator_value,
    {rate()} AS mortality_source_rate
  FROM obs WHERE DataValueAlt IS NOT NULL
  GROUP BY 1, 2, 3
)"""

def below(column: str) -> str:
    """Percent rank by counting the rows with a smaller value."""
    return (f"CAST((SELECT COUNT(*) FROM sty other WHERE other.{column} < own.{column}) AS DOUBLE)"
            " / greatest((SELECT COUNT(*) FROM sty) - 1, 1)")


PRIORITY = with_base(STATE_TOPIC_YEAR, f"""
ranks AS (
  SELECT own.*, {below('avg_indicator_value')} AS burden_score,
    {below('mortality_source_rate')} AS mortality_score, {below('record_count')} AS reliability_score,
    (SELECT arg_max(p.avg_indicator_value, p.year) FROM sty p
     WHERE p.state = own.state AND p.disease_topic = own.disease_topic AND p.year < own.year) AS before
  FROM sty own
)""") + """
SELECT * EXCLUDE (before), avg_indicator_value - before AS yoy_absolute_change,
  (avg_indicator_value - before) / nullif(before, 0) AS yoy_pct_change,
  CAST(0.40 AS DOUBLE) * burden_score + CAST(0.30 AS DOUBLE) * mortality_score
  + CAST(0.20 AS DOUBLE) * reliability_score
  + CAST(0.10 AS DOUBLE) * COALESCE((avg_indicator_value - before) / nullif(before, 0), 0)
    AS intervention_priority_score
FROM ranks
"""


def _q(ctes: list[str], select: str) -> str:
    return with_base(*ctes) + "\n" + select


RATE = rate()
AVG = exact_avg("DataValueAlt")

KPIS = _q([], f"""
SELECT COUNT(*) AS total_records, COUNT(DISTINCT LocationAbbr) AS state_count,
  COUNT(DISTINCT Topic) AS topic_count, MIN(YearStart) AS first_year,
  MAX(YearStart) AS latest_year, {RATE} AS mortality_source_rate
FROM obs""")

TRENDS_CTE = f"""
trends AS (
  SELECT YearStart, Topic, COUNT(*) AS record_count, {AVG} AS avg_indicator_value,
    {RATE} AS mortality_source_rate
  FROM obs GROUP BY YearStart, Topic
)"""

TOPIC_YEAR_TRENDS = _q([TRENDS_CTE], "SELECT * FROM trends")

STATE_TOPIC_CTE = f"""
sts AS (
  SELECT LocationAbbr, Topic, COUNT(*) AS record_count, {AVG} AS avg_indicator_value,
    {RATE} AS mortality_source_rate, MIN(Latitude) AS latitude, MIN(Longitude) AS longitude
  FROM obs GROUP BY LocationAbbr, Topic
)"""

STATE_TOPIC_SUMMARY = _q([STATE_TOPIC_CTE], "SELECT * FROM sts")

RISK_CTE = """
risk AS (
  SELECT risk_level, COUNT(*) AS record_count,
    CAST(COUNT(*) AS DOUBLE) * CAST(100.0 AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE)
      AS pct_of_records
  FROM obs GROUP BY risk_level
)"""

RISK_DISTRIBUTION = _q([RISK_CTE], "SELECT * FROM risk")

MORTALITY_BY_TOPIC = _q([], f"""
SELECT Topic, COUNT(*) AS record_count,
  CAST(SUM(CASE WHEN is_mortality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS mortality_source_records,
  {RATE} AS mortality_source_rate
FROM obs GROUP BY Topic""")

DEMO_CTE = f"""
demo AS (
  SELECT Topic, StratificationCategory1, Stratification1, COUNT(*) AS record_count,
    {AVG} AS avg_indicator_value, {RATE} AS mortality_source_rate
  FROM obs WHERE StratificationCategory1 IS NOT NULL AND Stratification1 IS NOT NULL
  GROUP BY Topic, StratificationCategory1, Stratification1
)"""

DEMOGRAPHIC_RISK = _q([DEMO_CTE], "SELECT * FROM demo")

STATE_TOPIC_YEAR_FULL = _q([], f"""
SELECT LocationAbbr AS state, Topic AS disease_topic, YearStart AS year, COUNT(*) AS record_count,
  {AVG} AS avg_indicator_value, {RATE} AS mortality_source_rate,
  COUNT(DISTINCT Stratification1) AS demographic_group_count
FROM obs WHERE DataValueAlt IS NOT NULL GROUP BY 1, 2, 3""")

FEATURE_BASE = _q([], """
SELECT YearStart, YearEnd, LocationAbbr, Topic, Question, DataValueType, StratificationCategory1,
  Stratification1, DataValueAlt, value_normalized, disease_duration, is_mortality, risk_level,
  Latitude, Longitude
FROM obs WHERE DataValueAlt IS NOT NULL""")

TOPIC_VOLUME = _q([TRENDS_CTE], """
SELECT Topic, CAST(SUM(record_count) AS BIGINT) AS total_records,
  list_reduce(list_sort(list(avg_indicator_value)), lambda a, b: a + b) / COUNT(avg_indicator_value)
    AS avg_indicator_value,
  list_reduce(list_sort(list(mortality_source_rate)), lambda a, b: a + b) / COUNT(mortality_source_rate)
    AS avg_mortality_source_rate
FROM trends GROUP BY Topic""")

TOPIC_GROWTH = _q([], """
SELECT Topic, MIN(YearStart) AS first_year, MAX(YearStart) AS latest_year,
  arg_min(n, YearStart) AS first_year_records, arg_max(n, YearStart) AS latest_year_records,
  arg_max(n, YearStart) - arg_min(n, YearStart) AS record_change
FROM (SELECT Topic, YearStart, COUNT(*) AS n FROM obs GROUP BY ALL)
GROUP BY Topic""")

TOP_STATE_TOPICS = _q([STATE_TOPIC_CTE], """
SELECT LocationAbbr, Topic, record_count, avg_indicator_value, mortality_source_rate
FROM sts WHERE record_count >= 100
ORDER BY avg_indicator_value DESC, LocationAbbr, Topic LIMIT 50""")

TOP_DEMOGRAPHIC = _q([DEMO_CTE], """
SELECT * FROM demo WHERE record_count >= 100
ORDER BY avg_indicator_value DESC, Topic, StratificationCategory1, Stratification1 LIMIT 100""")

FEATURE_BASE_SIZE = _q([], """
SELECT COUNT(*) AS feature_rows, COUNT(DISTINCT LocationAbbr) AS states,
  COUNT(DISTINCT Topic) AS topics, MIN(YearStart) AS first_year, MAX(YearStart) AS latest_year
FROM obs WHERE DataValueAlt IS NOT NULL""")

RECORDS_PER_TOPIC = _q([], "SELECT Topic, COUNT(*) AS record_count FROM obs GROUP BY Topic")

RECORDS_PER_YEAR_TOPIC = _q([], """
SELECT YearStart, Topic, COUNT(*) AS record_count FROM obs GROUP BY YearStart, Topic""")

STATE_TOPIC_AVERAGE = _q([], f"""
SELECT LocationAbbr, Topic, {AVG} AS avg_indicator_value, COUNT(*) AS record_count
FROM obs GROUP BY LocationAbbr, Topic HAVING COUNT(*) >= 100""")

MORTALITY_SHARE = _q([], """
SELECT Topic, AVG(is_mortality) AS mortality_source_rate, COUNT(*) AS record_count
FROM obs GROUP BY Topic""")

RISK_PERCENTAGES = _q([RISK_CTE], """
SELECT risk_level, record_count, ROUND(pct_of_records, 4) AS pct_of_total FROM risk""")

RISK_COUNTS = _q([], "SELECT risk_level, COUNT(*) AS record_count FROM obs GROUP BY risk_level")

FOCUS_GROUP_MEANS = _q([f"""
focus AS (SELECT * FROM (VALUES ('Overall', 0), ('Male', 1), ('Female', 2),
  ('Black, non-Hispanic', 3), ('White, non-Hispanic', 4), ('Hispanic', 5)) t(Stratification1, display_order))"""],
    f"""
SELECT f.Stratification1, {AVG.replace('DataValueAlt', 'o.DataValueAlt')} AS mean_value,
  CAST(f.display_order AS INTEGER) AS display_order
FROM obs o JOIN focus f ON o.Stratification1 = f.Stratification1
GROUP BY f.Stratification1, f.display_order""")

YEARLY_TOPIC_MEANS = _q([], f"""
SELECT Topic, YearStart, {AVG} AS mean_value FROM obs GROUP BY Topic, YearStart""")

TOP_TOPICS = _q([], """
SELECT Topic, COUNT(*) AS record_count FROM obs GROUP BY Topic
ORDER BY record_count DESC, Topic LIMIT 6""")

TOP_TOPIC_TREND = _q(["""
top AS (SELECT Topic FROM obs GROUP BY Topic ORDER BY COUNT(*) DESC, Topic LIMIT 6)"""], """
SELECT YearStart, Topic, COUNT(*) AS record_count FROM obs
WHERE Topic IN (SELECT Topic FROM top) GROUP BY YearStart, Topic""")

PREVIOUS_YEAR = _q([STATE_TOPIC_YEAR], """
SELECT state, disease_topic, year, avg_indicator_value,
  LAG(avg_indicator_value) OVER (PARTITION BY state, disease_topic ORDER BY year) AS previous_year_value
FROM sty""")


def score_sql(out: str, col: str) -> str:
    return _q([STATE_TOPIC_YEAR], f"""
SELECT state, disease_topic, year, {col}, PERCENT_RANK() OVER (ORDER BY {col} NULLS LAST) AS {out}
FROM sty""")


BURDEN_SCORE = score_sql("burden_score", "avg_indicator_value")
MORTALITY_SCORE = score_sql("mortality_score", "mortality_source_rate")
RELIABILITY_SCORE = score_sql("reliability_score", "record_count")

HEATMAP = _q([], "SELECT LocationAbbr, " + ", ".join(
    f'COUNT(*) FILTER (WHERE YearStart = {y}) AS "{y}"' for y in range(2010, 2014)) + """
FROM obs WHERE YearStart >= 2010 GROUP BY LocationAbbr""")

STATE_TOPIC_SHARES = _q(["""
st AS (SELECT LocationAbbr, Topic, COUNT(*) AS topic_records FROM obs WHERE Topic IS NOT NULL
       GROUP BY LocationAbbr, Topic)"""], """
SELECT LocationAbbr, Topic, topic_records,
  CAST(topic_records AS DOUBLE) / CAST(SUM(topic_records) OVER (PARTITION BY LocationAbbr) AS DOUBLE)
    AS share
FROM st""")

SERIES_CTE = f"""
series AS (
  SELECT Topic, YearStart, {AVG} AS v FROM obs
  WHERE Topic IS NOT NULL AND YearStart IS NOT NULL GROUP BY Topic, YearStart
)"""

MANN_KENDALL = _q([SERIES_CTE, """
pairs AS (SELECT a.Topic, SUM(sign(b.v - a.v)) AS s FROM series a JOIN series b
          ON a.Topic = b.Topic AND a.YearStart < b.YearStart GROUP BY a.Topic),
ties AS (SELECT Topic, SUM(t * (t - 1) * (2 * t + 5)) AS tie_term
         FROM (SELECT Topic, v, COUNT(*) AS t FROM series GROUP BY Topic, v) GROUP BY Topic),
cnt AS (SELECT Topic, COUNT(*) AS n FROM series GROUP BY Topic),
mk AS (
  SELECT c.Topic, c.n, CAST(COALESCE(p.s, 0) AS BIGINT) AS s,
    CAST(c.n * (c.n - 1) * (2 * c.n + 5) - t.tie_term AS DOUBLE) / 18.0 AS var_s
  FROM cnt c JOIN ties t ON c.Topic = t.Topic LEFT JOIN pairs p ON c.Topic = p.Topic
),
z AS (
  SELECT *, CASE WHEN s > 0 THEN CAST(s - 1 AS DOUBLE) / sqrt(var_s)
                 WHEN s < 0 THEN CAST(s + 1 AS DOUBLE) / sqrt(var_s) ELSE 0.0 END AS z_score
  FROM mk
)"""], """
SELECT Topic, n AS n_years, s AS s_statistic, var_s,
  CASE WHEN n > 1 THEN CAST(s AS DOUBLE) / (CAST(n * (n - 1) AS DOUBLE) / 2.0) END AS tau,
  z_score, abs(z_score) > 1.959963984540054 AS significant,
  CASE WHEN abs(z_score) > 1.959963984540054 AND z_score > 0 THEN 'increasing'
       WHEN abs(z_score) > 1.959963984540054 AND z_score < 0 THEN 'decreasing'
       ELSE 'no trend' END AS trend,
  'Mann-Kendall' AS method
FROM z""")

SPEARMAN = _q([SERIES_CTE, """
ranked AS (
  SELECT Topic,
    CAST(rank() OVER (PARTITION BY Topic ORDER BY YearStart) AS DOUBLE)
      + CAST(COUNT(*) OVER (PARTITION BY Topic, YearStart) - 1 AS DOUBLE) / 2.0 AS rx,
    CAST(rank() OVER (PARTITION BY Topic ORDER BY v) AS DOUBLE)
      + CAST(COUNT(*) OVER (PARTITION BY Topic, v) - 1 AS DOUBLE) / 2.0 AS ry
  FROM series
),
sums AS (
  SELECT Topic, COUNT(*) AS n_years, SUM(rx) AS sx, SUM(ry) AS sy, SUM(rx * ry) AS sxy,
    SUM(rx * rx) AS sxx, SUM(ry * ry) AS syy
  FROM ranked GROUP BY Topic
),
r AS (
  SELECT Topic, n_years,
    CASE WHEN (n_years * sxx - sx * sx) * (n_years * syy - sy * sy) = 0 THEN NULL
         ELSE (n_years * sxy - sx * sy) / sqrt((n_years * sxx - sx * sx) * (n_years * syy - sy * sy))
    END AS rho
  FROM sums
)"""], """
SELECT Topic, n_years, rho, CASE WHEN rho > 0 THEN 'increasing' ELSE 'decreasing' END AS trend,
  'Spearman' AS method
FROM r""")

# --- cleaning and feature layer ------------------------------------------------------

RAW_ONLY = "WITH" + OBS_RAW + "," + OBS_CLEAN

COERCE_NUMERIC = RAW_ONLY + """
SELECT DataValue, COUNT(*) AS n, COUNT(DataValueAlt) AS with_alt FROM obs_typed GROUP BY DataValue"""

CLEAN_REPORT = RAW_ONLY + """
SELECT COUNT(*) AS rows_in,
  COUNT(*) FILTER (WHERE DataValueAlt IS NULL) AS dropped_missing_value,
  COUNT(*) FILTER (WHERE DataValueAlt IS NOT NULL AND GeoLocation IS NULL) AS dropped_missing_location,
  COUNT(*) FILTER (WHERE DataValueAlt IS NOT NULL AND GeoLocation IS NOT NULL) AS rows_out,
  COUNT(*) FILTER (WHERE DataValueAlt IS NOT NULL AND GeoLocation IS NOT NULL) > 100 AS passes_gate
FROM obs_typed"""

RAW_COLUMNS = ("YearStart", "YearEnd", "LocationAbbr", "DataSource", "Topic", "Question",
               "DataValueUnit", "DataValueType", "DataValue", "DataValueAlt",
               "StratificationCategory1", "Stratification1", "GeoLocation", "Notes")

COLUMN_PROFILE = RAW_ONLY + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null FROM obs_typed "
    f"WHERE DataValueAlt IS NOT NULL AND GeoLocation IS NOT NULL" for c in RAW_COLUMNS)

PARSE_GEO = RAW_ONLY + """
SELECT LocationAbbr, Longitude, Latitude, COUNT(*) AS n FROM obs_clean
GROUP BY LocationAbbr, Longitude, Latitude"""

IMPUTE_UNIT = _q([], """
SELECT Topic, Question, DataValueUnit, COUNT(*) AS n FROM obs GROUP BY Topic, Question, DataValueUnit""")

GROUP_MODE = "WITH" + OBS_RAW + "," + OBS_CLEAN + "," + UNIT_MODE + """
SELECT Topic, Question, mode_unit FROM unit_mode"""

MORTALITY_FLAG = _q([], """
SELECT DataSource, is_mortality, COUNT(*) AS n FROM obs GROUP BY DataSource, is_mortality""")

DURATION = _q([], """
SELECT YearStart, YearEnd, disease_duration, COUNT(*) AS n FROM obs
GROUP BY YearStart, YearEnd, disease_duration""")

RISK_BINS = _q([], """
SELECT risk_level, COUNT(*) AS n, MIN(DataValueAlt) AS min_value, MAX(DataValueAlt) AS max_value
FROM obs GROUP BY risk_level""")

TOPIC_DUMMIES = _q([], """
SELECT 'topic_' || Topic AS column_name, COUNT(*) AS ones,
  (SELECT COUNT(*) FROM obs) - COUNT(*) AS zeros
FROM obs WHERE Topic IS NOT NULL GROUP BY Topic""")

ENCODE_COLUMNS_SQL = ("LocationAbbr", "DataValueType", "StratificationCategory1", "Stratification1")

LABEL_ENCODING = _q([], "\nUNION ALL\n".join(
    f"""SELECT DISTINCT '{c}' AS column_name, COALESCE({c}, 'nan') AS label,
  CAST(DENSE_RANK() OVER (ORDER BY COALESCE({c}, 'nan')) - 1 AS INTEGER) AS code FROM obs"""
    for c in ENCODE_COLUMNS_SQL))

CSV_ROUNDTRIP = RAW_ONLY + """
SELECT * EXCLUDE (DataValue, DataValueAlt), DataValue,
  CAST(DataValueAlt AS DOUBLE) AS DataValueAlt FROM obs_typed"""

PROCESSED_TABLE = _q([], """
SELECT *,
  """ + ",\n  ".join(
    f"CAST(DENSE_RANK() OVER (ORDER BY COALESCE({c}, 'nan')) - 1 AS INTEGER) AS {c}_enc"
    for c in ENCODE_COLUMNS_SQL) + """
FROM obs""")

EXPORT_MANIFEST = _q([TRENDS_CTE, STATE_TOPIC_CTE, RISK_CTE, DEMO_CTE], """
SELECT 'dashboard_kpis' AS extract, CAST(1 AS BIGINT) AS rows
UNION ALL SELECT 'topic_year_trends', COUNT(*) FROM trends
UNION ALL SELECT 'state_topic_summary', COUNT(*) FROM sts
UNION ALL SELECT 'risk_distribution', COUNT(*) FROM risk
UNION ALL SELECT 'mortality_by_topic', COUNT(DISTINCT Topic) + MAX(CASE WHEN Topic IS NULL THEN 1 ELSE 0 END) FROM obs
UNION ALL SELECT 'demographic_risk', COUNT(*) FROM demo""")

# --- modelling inputs -----------------------------------------------------------------

CLASS_WEIGHTS = _q([], """
SELECT risk_level AS label, COUNT(*) AS n,
  CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / CAST(COUNT(*) OVER () * COUNT(*) AS DOUBLE) AS weight
FROM obs WHERE risk_level IS NOT NULL GROUP BY risk_level""")

FOLD_SIZES = _q([], """
SELECT label, CAST(pos % 5 AS INTEGER) AS fold, COUNT(*) AS n FROM (
  SELECT risk_level AS label,
    row_number() OVER (PARTITION BY risk_level ORDER BY YearStart, LocationAbbr) - 1 AS pos
  FROM obs WHERE risk_level IS NOT NULL)
GROUP BY label, fold""")

POSITIVE_RATE = _q([], """
SELECT COUNT(*) AS rows, AVG(CAST(is_mortality AS DOUBLE)) AS positive_rate FROM obs""")

LABELLED_ROWS = _q([], "SELECT COUNT(*) AS n FROM obs WHERE StratificationCategory1 IS NOT NULL")

TINY_CLASSES = _q([], """
SELECT DataValueType AS label, COUNT(*) AS n FROM obs GROUP BY DataValueType HAVING COUNT(*) < 10""")

# --- documented-only analyses -------------------------------------------------------------

DISPARITY_CTE = f"""
disp AS (
  SELECT state, disease_topic, year, MAX(m) - MIN(m) AS demographic_disparity FROM (
    SELECT LocationAbbr AS state, Topic AS disease_topic, YearStart AS year, Stratification1, {AVG} AS m
    FROM obs WHERE DataValueAlt IS NOT NULL AND Stratification1 IS NOT NULL
    GROUP BY 1, 2, 3, 4)
  GROUP BY 1, 2, 3
)"""

DISPARITY = _q([DISPARITY_CTE], "SELECT * FROM disp")

def below_known(column: str) -> str:
    """:func:`below` over ``marks``, a missing value standing above all known ones."""
    return (f"CAST((SELECT COUNT(*) FROM marks other WHERE other.{column} < own.{column}"
            f" OR (own.{column} IS NULL AND other.{column} IS NOT NULL)) AS DOUBLE)"
            " / greatest((SELECT COUNT(*) FROM marks) - 1, 1)")


DOCUMENTED_PRIORITY = _q([STATE_TOPIC_YEAR, DISPARITY_CTE, """
marks AS (
  SELECT m.*, (SELECT any_value(demographic_disparity) FROM disp d
      WHERE (d.state, d.disease_topic, d.year) = (m.state, m.disease_topic, m.year)) AS demographic_disparity,
    (SELECT (m.avg_indicator_value - arg_max(p.avg_indicator_value, p.year)) / nullif(arg_max(p.avg_indicator_value, p.year), 0)
     FROM sty p WHERE p.state = m.state AND p.disease_topic = m.disease_topic AND p.year < m.year) AS yoy_pct_change
  FROM sty m
),
scores AS (
  SELECT own.*, """ + ", ".join(f"{below_known(c)} AS {n}_score" for n, c in (
    ("burden", "avg_indicator_value"), ("mortality", "mortality_source_rate"), ("growth", "yoy_pct_change"),
    ("disparity", "demographic_disparity"), ("reliability", "record_count"))) + """
  FROM marks own
)"""], """
SELECT *, CAST(0.35 AS DOUBLE) * burden_score + CAST(0.25 AS DOUBLE) * mortality_score + CAST(0.20 AS DOUBLE) * growth_score
  + CAST(0.10 AS DOUBLE) * disparity_score + CAST(0.10 AS DOUBLE) * reliability_score AS documented_priority_score
FROM scores""")

YEARLY_SEGMENT_CTE = f"""
yearly AS (
  SELECT LocationAbbr, Topic, YearStart, {AVG} AS v FROM obs WHERE DataValueAlt IS NOT NULL
  GROUP BY LocationAbbr, Topic, YearStart
)"""

DATA_QUALITY = _q([YEARLY_SEGMENT_CTE, """
yl AS (SELECT LocationAbbr, Topic, list_sort(list(v)) AS vs FROM yearly GROUP BY LocationAbbr, Topic),
ym AS (SELECT *, list_reduce(vs, lambda a, b: a + b) / len(vs) AS mean FROM yl),
vol AS (
  SELECT LocationAbbr, Topic,
    CASE WHEN len(vs) > 1 THEN sqrt(list_reduce(list_transform(vs, lambda x: (x - mean) * (x - mean)),
                                                lambda a, b: a + b) / (len(vs) - 1)) END
      / NULLIF(mean, 0) AS volatility
  FROM ym
),
base AS (
  SELECT LocationAbbr, Topic, COUNT(*) AS record_count,
    CAST(COUNT(DataValueAlt) AS DOUBLE) / COUNT(*) AS value_coverage,
    1.0 - CAST(COUNT(DataValueUnit) AS DOUBLE) / COUNT(*) AS unit_missing_rate,
    COUNT(DISTINCT Stratification1) AS strata_present,
    CAST(COUNT(DISTINCT Stratification1) AS DOUBLE)
      / NULLIF(CAST((SELECT COUNT(DISTINCT Stratification1) FROM obs) AS DOUBLE), 0) AS strata_coverage
  FROM obs GROUP BY LocationAbbr, Topic
)"""], """
SELECT b.*, v.volatility FROM base b
LEFT JOIN vol v ON b.LocationAbbr = v.LocationAbbr AND b.Topic = v.Topic""")

ROLLING_MEANS = _q([YEARLY_SEGMENT_CTE], """
SELECT LocationAbbr, Topic, YearStart, v AS yearly_mean,
  list_reduce(list_sort(list(v) OVER w), lambda a, b: a + b) / len(list(v) OVER w) AS rolling_mean
FROM yearly
WINDOW w AS (PARTITION BY LocationAbbr, Topic ORDER BY YearStart ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")

TIME_SPLIT = _q([], """
SELECT CASE WHEN YearStart < (SELECT MAX(YearStart) FROM obs) THEN 'train' ELSE 'test' END AS split,
  COUNT(*) AS rows, MIN(YearStart) AS first_year, MAX(YearStart) AS latest_year
FROM obs WHERE YearStart IS NOT NULL GROUP BY 1""")

DIFF_IN_DIFF = _q([f"""
cells AS (
  SELECT is_mortality = 1 AS treated,
    YearStart >= floor(((SELECT MIN(YearStart) FROM obs) + (SELECT MAX(YearStart) FROM obs)) / 2) AS post,
    {AVG} AS m
  FROM obs WHERE DataValueAlt IS NOT NULL AND YearStart IS NOT NULL GROUP BY 1, 2
),
wide AS (
  SELECT MAX(m) FILTER (WHERE treated AND post) AS treated_post,
    MAX(m) FILTER (WHERE treated AND NOT post) AS treated_pre,
    MAX(m) FILTER (WHERE NOT treated AND post) AS control_post,
    MAX(m) FILTER (WHERE NOT treated AND NOT post) AS control_pre
  FROM cells
)"""], """
SELECT *, (treated_post - treated_pre) - (control_post - control_pre) AS did FROM wide""")

FILTERED_TRENDS = _q([f"""
f AS (SELECT * FROM obs WHERE YearStart BETWEEN (SELECT MIN(YearStart) FROM obs)
                                        AND (SELECT MIN(YearStart) FROM obs) + 2)"""], f"""
SELECT YearStart, Topic, COUNT(*) AS record_count, {AVG} AS avg_indicator_value,
  {RATE} AS mortality_source_rate
FROM f GROUP BY YearStart, Topic""")

FEATURE_AVAILABILITY_COLUMNS = ("YearStart", "disease_duration", "value_normalized", "is_mortality",
                                "LocationAbbr_enc", "DataValueType_enc")

FEATURE_TOPICS = ("Alcohol", "Arthritis", "Asthma", "Cancer", "Cardiovascular Disease",
                  "Chronic Kidney Disease", "Diabetes", "Disability", "Mental Health",
                  "Nutrition, Physical Activity, and Weight Status", "Oral Health", "Tobacco")

# One-hot columns are never null, so every listed topic that occurs is available.
FEATURE_AVAILABILITY = PROCESSED_TABLE.replace("\nSELECT *,", "\n, p AS (SELECT *,", 1) + ")\n" + \
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST(COUNT({c}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS availability FROM p"
        for c in FEATURE_AVAILABILITY_COLUMNS) + f"""
UNION ALL
SELECT DISTINCT 'topic_' || Topic, CAST(1 AS DOUBLE) FROM p WHERE Topic IN {FEATURE_TOPICS}"""

MART_VIEWS = _q([TRENDS_CTE, STATE_TOPIC_CTE, RISK_CTE, DEMO_CTE, STATE_TOPIC_YEAR], """
SELECT 'vw_dashboard_kpis' AS view_name, CAST(1 AS BIGINT) AS rows
UNION ALL SELECT 'mart_topic_year_trends', COUNT(*) FROM trends
UNION ALL SELECT 'mart_state_topic_summary', COUNT(*) FROM sts
UNION ALL SELECT 'mart_risk_distribution', COUNT(*) FROM risk
UNION ALL SELECT 'mart_mortality_by_topic', (SELECT COUNT(*) FROM (SELECT Topic FROM obs GROUP BY Topic))
UNION ALL SELECT 'mart_demographic_risk', COUNT(*) FROM demo
UNION ALL SELECT 'ml_feature_base', COUNT(*) FROM obs WHERE DataValueAlt IS NOT NULL
UNION ALL SELECT 'mart_intervention_priority', COUNT(*) FROM sty""")


FACT_TABLE = _q([], """
SELECT LocationAbbr, DataValueType, COUNT(*) AS rows, MIN(DataValueAlt) AS least, MAX(DataValueAlt) AS most
FROM obs WHERE is_mortality = 1 GROUP BY LocationAbbr, DataValueType""")

REGION_FEATURES = _q([], f"""
SELECT r.r_name AS region, o.Topic, COUNT(*) AS record_count, COUNT(DISTINCT o.LocationAbbr) AS states,
  {AVG.replace('DataValueAlt', 'o.DataValueAlt')} AS avg_indicator_value,
  {RATE.replace('is_mortality', 'o.is_mortality')} AS mortality_source_rate
FROM obs o JOIN nation n ON o.LocationAbbr = n.n_name JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, o.Topic""")

RISK_THRESHOLDS = _q(["""
ranked AS (
  SELECT Topic, DataValueAlt AS v, row_number() OVER (PARTITION BY Topic ORDER BY DataValueAlt) AS place,
    COUNT(*) OVER (PARTITION BY Topic) AS n
  FROM obs WHERE DataValueAlt IS NOT NULL
)"""], """
SELECT Topic, MAX(v) FILTER (WHERE place = greatest(ceil(0.25 * n), 1)) AS p25,
  MAX(v) FILTER (WHERE place = greatest(ceil(0.5 * n), 1)) AS p50,
  MAX(v) FILTER (WHERE place = greatest(ceil(0.75 * n), 1)) AS p75
FROM ranked GROUP BY Topic""")

ROLLING_ORIGIN = _q(["""
cutoffs AS (
  SELECT DISTINCT YearStart AS cutoff FROM obs WHERE YearStart > (SELECT MIN(YearStart) FROM obs)
),
known AS (
  SELECT c.cutoff, o.LocationAbbr, o.Topic,
    COUNT(*) FILTER (WHERE o.YearStart < c.cutoff) AS n0,
    COUNT(*) FILTER (WHERE o.YearStart < c.cutoff AND o.is_mortality = 1) AS p0
  FROM obs o, cutoffs c WHERE o.YearStart IS NOT NULL GROUP BY 1, 2, 3
),
scored AS (
  SELECT k.cutoff, o.YearStart >= k.cutoff AS test, coalesce(o.is_mortality = 1, false) AS y,
    CAST(k.p0 + 1 AS DOUBLE) / CAST(k.n0 + 2 AS DOUBLE) AS score
  FROM obs o JOIN known k ON o.LocationAbbr IS NOT DISTINCT FROM k.LocationAbbr AND o.Topic IS NOT DISTINCT FROM k.Topic
  WHERE o.YearStart IS NOT NULL
),
places AS (
  SELECT cutoff, y, rank() OVER (PARTITION BY cutoff ORDER BY score)
    + (COUNT(*) OVER (PARTITION BY cutoff, score) - 1) / 2.0::DOUBLE AS place
  FROM scored WHERE test
),
auc AS (
  SELECT cutoff, (SUM(place) FILTER (WHERE y) - COUNT(*) FILTER (WHERE y) * (COUNT(*) FILTER (WHERE y) + 1) / 2.0::DOUBLE)
    / NULLIF(CAST(COUNT(*) FILTER (WHERE y) AS DOUBLE) * CAST(COUNT(*) FILTER (WHERE NOT y) AS DOUBLE), 0) AS baseline_auc
  FROM places GROUP BY cutoff
)"""], """
SELECT s.cutoff, COUNT(*) FILTER (WHERE NOT test) AS train_rows, COUNT(*) FILTER (WHERE NOT test AND y) AS train_positive,
  COUNT(*) FILTER (WHERE test) AS test_rows, COUNT(*) FILTER (WHERE test AND y) AS test_positive,
  CAST(COUNT(*) FILTER (WHERE NOT test) AS DOUBLE) / NULLIF(CAST(2 * COUNT(*) FILTER (WHERE NOT test AND NOT y) AS DOUBLE), 0) AS weight_negative,
  CAST(COUNT(*) FILTER (WHERE NOT test) AS DOUBLE) / NULLIF(CAST(2 * COUNT(*) FILTER (WHERE NOT test AND y) AS DOUBLE), 0) AS weight_positive,
  ANY_VALUE(a.baseline_auc) AS baseline_auc
FROM scored s JOIN auc a ON a.cutoff = s.cutoff GROUP BY s.cutoff""")

_MATCH_CELLS = ["""
arms AS (
  SELECT LocationAbbr, Topic, Stratification1, DataValueAlt, coalesce(is_mortality = 1, false) AS t,
    YearStart >= floor(((SELECT MIN(YearStart) FROM obs) + (SELECT MAX(YearStart) FROM obs)) / 2) AS p
  FROM obs WHERE DataValueAlt IS NOT NULL AND YearStart IS NOT NULL
),
alike AS (
  SELECT LocationAbbr, Topic, Stratification1,
    """ + ", ".join(
        f"COUNT(*) FILTER (WHERE {'' if t == 'treated' else 'NOT '}t AND {'' if p == 'post' else 'NOT '}p) AS n_{t}_{p}, "
        f"CAST(SUM(CAST(CAST(DataValueAlt AS VARCHAR) AS DECIMAL(38,10))) FILTER (WHERE {'' if t == 'treated' else 'NOT '}t AND "
        f"{'' if p == 'post' else 'NOT '}p) AS DOUBLE) AS sum_{t}_{p}"
        for t in ("treated", "control") for p in ("pre", "post")) + """
  FROM arms GROUP BY LocationAbbr, Topic, Stratification1
),
judged AS (
  SELECT *, least(n_treated_pre, n_treated_post, n_control_pre, n_control_post) > 0 AS matched FROM alike
),
whole AS (
  SELECT CAST(SUM(n_control_pre) AS DOUBLE) / CAST(SUM(n_treated_pre) AS DOUBLE) AS pre,
    CAST(SUM(n_control_post) AS DOUBLE) / CAST(SUM(n_treated_post) AS DOUBLE) AS post
  FROM judged WHERE matched
)"""]

MATCH_WEIGHTS = _q(_MATCH_CELLS, """
SELECT j.*,
  CASE WHEN matched THEN CAST(n_treated_pre AS DOUBLE) / CAST(n_control_pre AS DOUBLE) * w.pre END AS weight_pre,
  CASE WHEN matched THEN CAST(n_treated_post AS DOUBLE) / CAST(n_control_post AS DOUBLE) * w.post END AS weight_post
FROM judged j, whole w""")

_SORTED_SUM = "list_reduce(list_sort(list({0})), lambda a, b: a + b)"
MATCHED_DIFF_IN_DIFF = _q([*_MATCH_CELLS, f"""
clusters AS (
  SELECT LocationAbbr AS g, {_SORTED_SUM.format('sum_treated_pre')} AS tb, {_SORTED_SUM.format('sum_treated_post')} AS ta,
    {_SORTED_SUM.format('CAST(n_treated_pre AS DOUBLE) * (sum_control_pre / CAST(n_control_pre AS DOUBLE))')} AS cb,
    {_SORTED_SUM.format('CAST(n_treated_post AS DOUBLE) * (sum_control_post / CAST(n_control_post AS DOUBLE))')} AS ca,
    CAST(SUM(n_treated_pre) AS DOUBLE) AS nb, CAST(SUM(n_treated_post) AS DOUBLE) AS na,
    SUM(n_control_pre) AS mb, SUM(n_control_post) AS ma, COUNT(*) AS strata
  FROM judged WHERE matched GROUP BY LocationAbbr
),
sums AS (
  SELECT {', '.join(f"{_SORTED_SUM.format(c)} AS {c}" for c in ('tb', 'ta', 'cb', 'ca', 'nb', 'na'))},
    SUM(mb) AS mb, SUM(ma) AS ma, SUM(strata) AS strata, COUNT(*) AS n FROM clusters
),
left_out AS (
  SELECT ((s.ta - c.ta) / (s.na - c.na) - (s.tb - c.tb) / (s.nb - c.nb))
       - ((s.ca - c.ca) / (s.na - c.na) - (s.cb - c.cb) / (s.nb - c.nb)) AS theta
  FROM clusters c, sums s WHERE s.n > 1
),
center AS (SELECT {_SORTED_SUM.format('theta')} / COUNT(*) AS mean FROM left_out),
spread AS (SELECT {_SORTED_SUM.format('(theta - mean) * (theta - mean)')} AS squares FROM left_out, center)"""], """
SELECT CAST(strata AS BIGINT) AS matched_strata, n AS clusters, CAST(nb AS BIGINT) AS treated_pre_rows,
  CAST(na AS BIGINT) AS treated_post_rows, CAST(mb AS BIGINT) AS control_pre_rows, CAST(ma AS BIGINT) AS control_post_rows,
  tb / nb AS treated_pre, ta / na AS treated_post, cb / nb AS control_pre, ca / na AS control_post,
  (ta / na - tb / nb) - (ca / na - cb / nb) AS did,
  sqrt((CAST(n AS DOUBLE) - 1.0) / CAST(n AS DOUBLE) * squares) AS jackknife_error
FROM sums, spread WHERE n > 0""")

PER_CAPITA = _q(["""
firsts AS (SELECT o_custkey, MIN(year(o_orderdate)) AS first FROM orders GROUP BY o_custkey),
homes AS (
  SELECT n.n_name AS place, f.first + 12 AS year FROM firsts f
  JOIN customer c ON c.c_custkey = f.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
),
cells AS (
  SELECT LocationAbbr, Topic, YearStart, COUNT(*) AS record_count,
    COUNT(*) FILTER (WHERE is_mortality = 1) AS mortality_records
  FROM obs GROUP BY LocationAbbr, Topic, YearStart
),
known AS (
  SELECT c.*, (SELECT COUNT(*) FROM homes h WHERE h.place = c.LocationAbbr AND h.year <= c.YearStart) AS people,
    (SELECT MAX(year) FROM homes h WHERE h.place = c.LocationAbbr AND h.year <= c.YearStart) AS population_year
  FROM cells c
)"""], """
SELECT LocationAbbr, Topic, YearStart, record_count, mortality_records, NULLIF(people, 0) AS population,
  CAST(population_year AS INTEGER) AS population_year,
  100000.0::DOUBLE * CAST(record_count AS DOUBLE) / CAST(NULLIF(people, 0) AS DOUBLE) AS records_per_100k,
  100000.0::DOUBLE * CAST(mortality_records AS DOUBLE) / CAST(NULLIF(people, 0) AS DOUBLE) AS mortality_per_100k
FROM known""")

# p of the normal tail by a midpoint sum of the density over [|z|, |z| + 12]: 100,000 strips.
MANN_KENDALL_TEST = f"""
SELECT t.*, round(list_sum(list_transform(range(100000), lambda i:
    exp(-pow(abs(t.z_score) + (i + 0.5::DOUBLE) * 0.00012::DOUBLE, 2) / 2.0::DOUBLE)))
  * 0.00012::DOUBLE * 2.0::DOUBLE / sqrt(2.0::DOUBLE * pi()), 8) AS p_value
FROM ({MANN_KENDALL}) t"""

# p of Student's t: the density in the angle atan(t / sqrt(df)) is cos^(df - 1), added
# up by midpoints over the tail and over the whole quarter turn.
SPEARMAN_TEST = f"""
SELECT *, p_value < 0.05 AS significant FROM (
  SELECT t.*, CASE WHEN n_years >= 3 AND rho IS NOT NULL THEN round(
      list_sum(list_transform(range(200000), lambda i: pow(cos(asin(least(abs(t.rho), 1.0::DOUBLE))
        + (i + 0.5::DOUBLE) * (pi() / 2 - asin(least(abs(t.rho), 1.0::DOUBLE))) / 200000.0::DOUBLE), t.n_years - 3)))
        * (pi() / 2 - asin(least(abs(t.rho), 1.0::DOUBLE)))
    / (list_sum(list_transform(range(200000), lambda i: pow(cos((i + 0.5::DOUBLE) * (pi() / 2) / 200000.0::DOUBLE), t.n_years - 3)))
        * (pi() / 2)), 8) END AS p_value
  FROM ({SPEARMAN}) t)"""

_FIXED_SCORES = """
latest AS (SELECT MAX(YearStart) AS y FROM obs),
earlier AS (
  SELECT LocationAbbr, Topic, COUNT(*) AS n, COUNT(*) FILTER (WHERE is_mortality = 1) AS p
  FROM obs, latest WHERE YearStart < y GROUP BY LocationAbbr, Topic
),
fixed AS (
  SELECT coalesce(o.is_mortality = 1, false) AS label,
    CAST(coalesce(e.p, 0) + 1 AS DOUBLE) / CAST(coalesce(e.n, 0) + 2 AS DOUBLE) AS score
  FROM obs o JOIN latest ON o.YearStart = y LEFT JOIN earlier e
    ON e.LocationAbbr IS NOT DISTINCT FROM o.LocationAbbr AND e.Topic IS NOT DISTINCT FROM o.Topic
)"""

FIXED_SCORE_CALIBRATION = _q([_FIXED_SCORES, """
bins AS (
  SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, COUNT(*) AS n, AVG(score) AS mean_score,
    AVG(CAST(label AS INTEGER)) AS observed_rate
  FROM fixed GROUP BY 1
)"""], """
SELECT bin, n, round(mean_score, 8) AS mean_score, observed_rate,
  (SELECT CAST(COUNT(*) FILTER (WHERE score >= 0.5 AND NOT label) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE NOT label), 0)
   FROM fixed) AS false_positive_rate,
  (SELECT CAST(COUNT(*) FILTER (WHERE score < 0.5 AND label) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE label), 0)
   FROM fixed) AS false_negative_rate,
  (SELECT round(SUM(n * abs(mean_score - observed_rate)) / SUM(n), 8) FROM bins) AS expected_calibration_error
FROM bins""")

# Isotonic regression by its max-min formula over all ranges of levels.
ISOTONIC_BLOCKS = _q([_FIXED_SCORES, """
levels AS (
  SELECT score, row_number() OVER (ORDER BY score) AS i, SUM(COUNT(*)) OVER (ORDER BY score) AS n,
    SUM(COUNT(*) FILTER (WHERE label)) OVER (ORDER BY score) AS p, COUNT(*) AS own, COUNT(*) FILTER (WHERE label) AS hits
  FROM fixed GROUP BY score
),
ends AS (SELECT i, n, p FROM levels UNION ALL SELECT 0, 0, 0),
ranges AS (
  SELECT a.i + 1 AS a, b.i AS b, CAST(b.p - a.p AS DOUBLE) / CAST(b.n - a.n AS DOUBLE) AS share
  FROM ends a JOIN ends b ON a.i < b.i
),
least_from AS (
  SELECT a, b, MIN(share) OVER (PARTITION BY a ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS low FROM ranges
),
fit AS (SELECT b AS i, MAX(low) AS value FROM least_from GROUP BY b)"""], """
SELECT MIN(score) AS low, MAX(score) AS high, CAST(SUM(own) AS BIGINT) AS n, CAST(SUM(hits) AS BIGINT) AS positives,
  value AS calibrated
FROM levels JOIN fit USING (i) GROUP BY value""")

FILTERED_KPIS = _q(["""
chosen AS (
  SELECT *, false AS filtered FROM obs
  UNION ALL
  SELECT *, true FROM obs WHERE Topic IN ('Asthma', 'Cancer')
    AND YearStart BETWEEN (SELECT MIN(YearStart) FROM obs) AND (SELECT MIN(YearStart) FROM obs) + 2
)"""], f"""
SELECT filtered, COUNT(*) AS total_records, COUNT(DISTINCT LocationAbbr) AS state_count,
  COUNT(DISTINCT Topic) AS topic_count, MIN(YearStart) AS first_year, MAX(YearStart) AS latest_year,
  {RATE} AS mortality_source_rate, COUNT(DISTINCT Question) AS question_count
FROM chosen GROUP BY filtered""")

# The topics of the bridge's mapping, one column each.
_TOPIC_COLUMNS = ("Alcohol", "Arthritis", "Asthma", "Cancer", "Cardiovascular Disease", "Chronic Kidney Disease", "Diabetes",
                  "Disability", "Mental Health", "Nutrition, Physical Activity, and Weight Status", "Oral Health", "Tobacco")
TOPIC_MATRIX = _q([], "SELECT LocationAbbr, " + ", ".join(
    f"CAST(COUNT(*) FILTER (WHERE Topic = '{t}') AS DOUBLE) / NULLIF(CAST(COUNT(Topic) AS DOUBLE), 0) AS \"topic_{t}\""
    for t in _TOPIC_COLUMNS) + " FROM obs GROUP BY LocationAbbr")

FIXED_SCORE_AUC = _q([_FIXED_SCORES, """
placed AS (
  SELECT label, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS place FROM fixed
),
sides AS (SELECT COUNT(*) FILTER (WHERE label) AS p, COUNT(*) FILTER (WHERE NOT label) AS q FROM fixed)"""], """
SELECT CAST(p + q AS BIGINT) AS rows,
  ((SELECT SUM(place) FROM placed WHERE label) - p * (p + 1) / 2.0::DOUBLE) / (CAST(p AS DOUBLE) * CAST(q AS DOUBLE)) AS auc
FROM sides""")

FIXED_SCORE_REPORT = _q([_FIXED_SCORES, """
guesses AS (SELECT CAST(CAST(label AS INTEGER) AS VARCHAR) AS y, CASE WHEN score >= 0.5 THEN '1' ELSE '0' END AS g FROM fixed),
per AS (
  SELECT c.cls, (SELECT COUNT(*) FROM guesses WHERE y = cls) AS support, (SELECT COUNT(*) FROM guesses WHERE g = cls) AS guessed,
    (SELECT COUNT(*) FROM guesses WHERE y = cls AND g = cls) AS hits
  FROM (SELECT y AS cls FROM guesses UNION SELECT g FROM guesses) c
),
rates AS (
  SELECT cls, support, hits, coalesce(CAST(hits AS DOUBLE) / nullif(guessed, 0), 0) AS precision,
    coalesce(CAST(hits AS DOUBLE) / nullif(support, 0), 0) AS recall FROM per
),
scored AS (SELECT *, coalesce(2.0::DOUBLE * precision * recall / nullif(precision + recall, 0), 0) AS f1_score FROM rates),
n AS (SELECT SUM(support) AS n, SUM(hits) AS hits FROM scored)"""], """
SELECT cls, round(precision, 10) AS precision, round(recall, 10) AS recall, round(f1_score, 10) AS f1_score,
  CAST(support AS BIGINT) AS support
FROM (
  SELECT cls, precision, recall, f1_score, support FROM scored
  UNION ALL SELECT 'accuracy', hits / CAST(n AS DOUBLE), hits / CAST(n AS DOUBLE), hits / CAST(n AS DOUBLE), n FROM n
  UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1_score), SUM(support) FROM scored
  UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
    SUM(f1_score * support) / SUM(support), SUM(support) FROM scored)""")
