"""Well-known-text point parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.numeric import to_number

# Fixed value: the form of a point, longitude first.
POINT_PATTERN = r"POINT \(([^ ]+) ([^ ]+)\)"


def point_coordinate(c, index: int) -> Column:
    """Coordinate ``index`` (1 = longitude, 2 = latitude) of a WKT point.

    Text that is no such point, or holds no number there, gives null.
    """
    c = F.col(c) if isinstance(c, str) else c
    return to_number(F.regexp_extract(c, POINT_PATTERN, index))
