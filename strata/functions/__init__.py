"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from strata.functions.numeric import (  # noqa: F401
    exact_mean,
    exact_sum,
    flag_rate,
    relative_change,
    share_percent,
    to_number,
)
from strata.functions.geo import point_coordinate  # noqa: F401
from strata.functions.indicators import (  # noqa: F401
    clipped_duration,
    mortality_flag,
    risk_level,
)
