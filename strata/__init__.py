"""strata — segment-indicator analytics on Spark.

Row-level cleaning and feature engineering, reporting marts, a priority
score built from distributed percent ranks, trend tests and MLlib
baselines, all expressed as Spark DataFrame / SQL jobs.
"""

__version__ = "0.1.0"
