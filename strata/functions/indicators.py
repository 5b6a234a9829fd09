"""Indicator-specific derived columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.constants import MORTALITY_SOURCES, RISK_LABELS, RISK_UPPER_EDGES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mortality_flag(source, sources=MORTALITY_SOURCES) -> Column:
    """1 when the data source is a mortality source, else 0 (null -> 0)."""
    return F.coalesce(_col(source).isin(list(sources)), F.lit(False)).cast("int")


def clipped_duration(start, end) -> Column:
    """max(end - start, 0); missing stays missing."""
    diff = _col(end) - _col(start)
    return F.when(diff.isNotNull(), F.greatest(diff, F.lit(0)))


def risk_level(value, edges=RISK_UPPER_EDGES, labels=RISK_LABELS) -> Column:
    """Right-closed bins: (-inf, e1] -> labels[0], ..., (e_k, inf] -> labels[k].

    Null, NaN and -inf are outside every bin and stay null.
    """
    v = _col(value)
    expr = None
    for edge, label in zip(edges, labels):
        expr = F.when(v <= edge, F.lit(label)) if expr is None else expr.when(v <= edge, F.lit(label))
    expr = expr.when(~F.isnan(v), F.lit(labels[-1]))
    return F.when(v > float("-inf"), expr)
