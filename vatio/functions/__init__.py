"""Column -> Column helpers. Everything here stays inside whole-stage codegen."""

from .energy import classify_source, direct_fraction, kelvin_to_celsius, \
    per_hour_energy_to_power, fraction_to_pct, precision_category
from .geo import grid_snap, haversine_m, with_utm_latlon, wkt_point
from .numeric import round_half_away, safe_divide
from .text import decimal_comma, entity_name, leading_int, state_tag, strip_tags
from .time import cyclic, dt_part, local_hour_to_utc, local_midnight_utc, utc_now_ntz

__all__ = [
    "classify_source", "direct_fraction", "kelvin_to_celsius", "per_hour_energy_to_power",
    "fraction_to_pct", "precision_category", "grid_snap", "haversine_m", "with_utm_latlon",
    "wkt_point", "round_half_away", "safe_divide", "decimal_comma", "entity_name",
    "leading_int", "state_tag", "strip_tags", "cyclic", "dt_part", "local_hour_to_utc",
    "local_midnight_utc", "utc_now_ntz",
]
