"""Column-expression helpers (JVM-side, whole-stage-codegen friendly)."""

from gridcast.functions.numeric import (  # noqa: F401
    clip, flag, nan_to_null, round_doubles, softplus,
)
from gridcast.functions.calendar import (  # noqa: F401
    dst_summer_day25, dst_flags_day25, dst_flags_month, season_train, season_serve,
    weekday, hour_floor,
)
