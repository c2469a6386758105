"""Column functions (no UDFs): every helper returns a ``pyspark.sql.Column``."""

from .timefns import (  # noqa: F401
    epoch_ntz, floor_time, format_zulu, interval_minutes, micros_between, plus_micros,
    safe_horizon, to_utc, utc_date,
)
from .codes import (  # noqa: F401
    energy_from_code, first_present, parse_tariff_code, state_key,
)
