"""wakeline: vessel position (AIS) analytics expressed as Spark DataFrame plans.

Layout:
  functions/  column expressions (strip, number/time parsing, haversine, row predicates)
  sources/    CSV scan by header name, input positions, the events-derived fixture, table IO
  operators/  raw build, per-vessel validity, semi-join, skew-safe lag, histogram, profiles
  plans/      composite jobs (the whole pipeline) and the registered query set
  streaming/  incremental (file-stream) load of the raw table
"""

from wakeline.config import AisConfig, DEFAULT_CONFIG

__all__ = ["AisConfig", "DEFAULT_CONFIG"]
