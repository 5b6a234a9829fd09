"""L2 — mart batch: fact table -> named views (S3, S4) -> extracts (S6) -> questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators import marts as M
from strata.operators import priority as P
from strata.operators import questions as Q
from strata.sources.export import export_marts
from strata.sources.parquet import load_processed, register_fact_table


# Names under which users query the marts.
VIEW_NAMES = {
    "dashboard_kpis": "vw_dashboard_kpis",
    "topic_year_trends": "mart_topic_year_trends",
    "state_topic_summary": "mart_state_topic_summary",
    "risk_distribution": "mart_risk_distribution",
    "mortality_by_topic": "mart_mortality_by_topic",
    "demographic_risk": "mart_demographic_risk",
}


def build_marts(obs: DataFrame) -> dict[str, DataFrame]:
    """The six reporting marts, the modelling base and the priority mart."""
    out = {name: fn(obs) for name, fn in M.MARTS.items()}
    out["ml_feature_base"] = M.feature_base(obs)
    out["mart_intervention_priority"] = P.intervention_priority(obs)
    return out


def register_views(marts: dict[str, DataFrame]) -> list[str]:
    """Expose every mart to SQL under its view name."""
    for name, df in marts.items():
        df.createOrReplaceTempView(VIEW_NAMES.get(name, name))
    return [VIEW_NAMES.get(name, name) for name in marts]


def analysis_questions(obs: DataFrame) -> dict[str, DataFrame]:
    """The eight analysis questions (Q1-Q8)."""
    trends = M.topic_year_trends(obs)
    return {
        "q1_overview": Q.overview(obs),
        "q2_topic_volume": Q.topic_volume(trends),
        "q3_topic_growth": Q.topic_growth(trends),
        "q4_top_state_topics": Q.top_state_topics(obs),
        "q5_mortality_ranking": Q.mortality_ranking(obs),
        "q6_risk_imbalance": Q.risk_imbalance(obs),
        "q7_top_demographic_groups": Q.top_demographic_groups(obs),
        "q8_feature_base_size": Q.feature_base_size(obs),
    }


def run(spark: SparkSession, processed_path: str, extracts_dir: str | None = None) -> dict:
    """Read the processed table (S2), register it (S3) and the marts (S4),
    export the six reporting marts (S6) and return marts and questions."""
    obs = register_fact_table(load_processed(spark, processed_path))
    marts = build_marts(obs)
    register_views(marts)
    paths = export_marts({k: marts[k] for k in M.MARTS}, extracts_dir) if extracts_dir else {}
    return {"marts": marts, "questions": analysis_questions(obs), "extracts": paths}
