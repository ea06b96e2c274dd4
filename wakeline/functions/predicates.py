"""Row predicates of the AIS load (P1-P11) and the stored-row match (P13).

Load checks run on the *string* row (field-named string columns); each returns a
non-null boolean Column that is true when the row passes.  The order of
``load_checks`` is the order the original loader tests them in, so the first
failing check is the reject reason.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.config import NAV_STATUS_REJECT_LOWER, NAV_STATUS_STORED_REJECT, AisConfig
from wakeline.functions.geo import distance_from_a, haversine_a
from wakeline.functions.nan import ge, gt, in_closed, lt

MMSI_RE = r"^[0-9]{9}$"
# lower(x) in {...} as one case-insensitive match (Spark's lower() is far slower than a regex)
NAV_REJECT_RE = "(?iu)^(" + "|".join(NAV_STATUS_REJECT_LOWER) + ")$"

REASONS = (
    "P1_coordinates", "P2_distance", "P3_mmsi_shape", "P4_mmsi_repeated", "P5_mmsi_placeholder",
    "P6_nav_status", "P7_rot", "P8_sog", "P9_cog", "P10_heading", "P11_unparsed_key",
)
OK = "ok"


def _safe(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


MMSI_TEXT = "_mmsi_text"


def load_checks(cfg: AisConfig) -> list[tuple[str, Column]]:
    """Ordered (reason, passes) pairs over a *parsed* row.

    The parsed row holds the typed fields (lat, lon, rot, ... as double, ts as
    timestamp, nav_status stripped) plus ``_mmsi_text``, the stripped MMSI text.
    """
    lat, lon = F.col("lat"), F.col("lon")
    a = haversine_a(lat, lon, F.lit(cfg.centre_lat), F.lit(cfg.centre_lon))
    mmsi = F.col(MMSI_TEXT)
    nav = F.col("nav_status")
    rot, sog, cog, hdg = F.col("rot"), F.col("sog"), F.col("cog"), F.col("heading")
    checks = [
        lat.isNotNull() & lon.isNotNull() & ~(lat == 0) & ~(lon == 0)
        & ~gt(F.abs(lat), 90) & ~gt(F.abs(lon), 180),
        # a > 1 is a math-domain error in the original (row rejected); NaN passes
        ~gt(distance_from_a(a, cfg.earth_radius_nm), cfg.max_distance_nm) & ~gt(a, 1),
        mmsi.rlike(MMSI_RE),
        mmsi != F.repeat(F.substring(mmsi, 1, 1), 9),
        ~mmsi.isin(*cfg.placeholder_mmsi),
        (nav != "") & ~nav.rlike(NAV_REJECT_RE),
        rot.isNotNull() & ~lt(rot, -127) & ~gt(rot, 127),
        sog.isNotNull() & ~lt(sog, 0) & ~ge(sog, 102.3),
        cog.isNotNull() & ~lt(cog, 0) & ~ge(cog, 360),
        hdg.isNotNull() & ~lt(hdg, 0) & ~gt(hdg, 359),
        F.col("ts").isNotNull() & F.col("mmsi").isNotNull() & lat.isNotNull() & lon.isNotNull(),
    ]
    return [(r, _safe(c)) for r, c in zip(REASONS, checks)]


def load_keep(cfg: AisConfig) -> Column:
    """True when the parsed row passes every load check."""
    cond = None
    for _, c in load_checks(cfg):
        cond = c if cond is None else cond & c
    return cond


def reject_reason(cfg: AisConfig) -> Column:
    """Name of the first failing load check, or 'ok'."""
    expr = None
    for reason, c in load_checks(cfg):
        expr = F.when(~c, F.lit(reason)) if expr is None else expr.when(~c, F.lit(reason))
    return expr.otherwise(F.lit(OK))


def stored_row_counts(cfg: AisConfig) -> Column:
    """Typed re-check before counting reports (P13): NaN and null fail every range."""
    return (
        F.col("mmsi").isNotNull()
        & in_closed(F.col("lat"), -90, 90)
        & in_closed(F.col("lon"), -180, 180)
        & F.coalesce(~F.col("nav_status").isin(*NAV_STATUS_STORED_REJECT), F.lit(False))
        & in_closed(F.col("rot"), -127, 127)
        & in_closed(F.col("sog"), 0, 102.3) & ~_safe(F.col("sog") >= 102.3)
        & in_closed(F.col("cog"), 0, 360) & ~_safe(F.col("cog") >= 360)
        & in_closed(F.col("heading"), 0, 359)
    )
