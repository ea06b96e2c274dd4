"""The shuffled (non-broadcast) plans give the same results as the broadcast ones."""

from tests.conftest import SF001
from wakeline.plans.jobs import build_stages
from wakeline.operators.vessels import positions_clean
from wakeline.sources.fixture import ais_strings

COLS = ["row_id", "mmsi", "ts", "prev_ts", "delta_t_ms"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_clean_and_gaps_without_broadcast(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for s in settings:
            spark.conf.set(s, "-1")
        shuffled = build_stages(ais_strings(spark, SF001))
        plan = positions_clean(shuffled.raw)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        got = _rows(shuffled.dt)
    finally:
        for s in settings:
            spark.conf.unset(s)
    assert got == _rows(build_stages(ais_strings(spark, SF001)).dt)
