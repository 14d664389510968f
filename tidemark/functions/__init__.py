"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from tidemark.functions.timefn import (  # noqa: F401
    epoch_millis_to_ts, epoch_seconds_to_ts, floor_hour, floor_hour_ntz, floor_hour_of,
    iso_utc_text, nan_to_null, parse_utc,
)
from tidemark.functions.nested import get_or, vote_counts  # noqa: F401
