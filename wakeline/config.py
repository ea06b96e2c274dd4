"""Thresholds and fixed values of the AIS pipeline.

Every threshold is a field of :class:`AisConfig` so callers can change it;
the defaults are the values the original pipeline uses.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the original pipeline's for equal results.
# ---------------------------------------------------------------------------

# Placeholder vessel ids that are rejected outright.
PLACEHOLDER_MMSI = (
    "123456789", "987654321", "111111111", "222222222", "333333333",
    "444444444", "555555555", "666666666", "777777777", "888888888", "999999999",
)

# Navigational status values rejected at load (compared lower-cased, after strip).
NAV_STATUS_REJECT_LOWER = ("unknown", "undefined", "not available")

# Navigational status values a stored row must not have to be counted (case-sensitive).
NAV_STATUS_STORED_REJECT = ("", "Unknown", "Undefined", "not available")

# CSV header name for each field, in the field order of the typed table.
AIS_HEADERS = (
    ("ts", "# Timestamp"),
    ("mobile_type", "Type of mobile"),
    ("mmsi", "MMSI"),
    ("lat", "Latitude"),
    ("lon", "Longitude"),
    ("nav_status", "Navigational status"),
    ("rot", "ROT"),
    ("sog", "SOG"),
    ("cog", "COG"),
    ("heading", "Heading"),
    ("imo", "IMO"),
    ("callsign", "Callsign"),
    ("name", "Name"),
    ("ship_type", "Ship type"),
    ("cargo_type", "Cargo type"),
    ("width", "Width"),
    ("length", "Length"),
    ("pos_fix_type", "Type of position fixing device"),
    ("draught", "Draught"),
    ("destination", "Destination"),
    ("eta", "ETA"),
    ("data_source_type", "Data source type"),
    ("a", "A"),
    ("b", "B"),
    ("c", "C"),
    ("d", "D"),
)

# Typed kind of every field: "ts" timestamp, "int" bigint, "float" double, "text" string.
FIELD_KINDS = {
    "ts": "ts", "mobile_type": "text", "mmsi": "int", "lat": "float", "lon": "float",
    "nav_status": "text", "rot": "float", "sog": "float", "cog": "float", "heading": "float",
    "imo": "int", "callsign": "text", "name": "text", "ship_type": "text", "cargo_type": "text",
    "width": "float", "length": "float", "pos_fix_type": "text", "draught": "float",
    "destination": "text", "eta": "text", "data_source_type": "text",
    "a": "float", "b": "float", "c": "float", "d": "float",
}

FIELDS = tuple(name for name, _ in AIS_HEADERS)


@dataclass(frozen=True)
class AisConfig:
    # reference point and radius of the position filter (nautical miles)
    centre_lat: float = 55.70
    centre_lon: float = 12.66
    max_distance_nm: float = 540.0
    earth_radius_nm: float = 3440.065
    # a vessel is kept when it has at least this many counted reports
    min_reports: int = 100
    # gap histogram: equal-width bins on [0, range_ms], last bin closed
    hist_bins: int = 50
    hist_range_ms: int = 1_000_000
    placeholder_mmsi: tuple = field(default=PLACEHOLDER_MMSI)


DEFAULT_CONFIG = AisConfig()
