"""Property test: skew-safe previous time == plain window lag on random keyed series."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from wakeline.operators.sequence import with_previous_time

BASE = dt.datetime(2026, 4, 18)
ROW = st.tuples(st.integers(0, 3),                       # key (few keys -> hot keys)
                st.integers(0, 3 * 86400).map(lambda s: BASE + dt.timedelta(seconds=s)),
                st.integers(0, 3))                       # duplicate multiplier


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])
@given(st.lists(ROW, min_size=1, max_size=120), st.sampled_from([1, 7, 60, 10**7]))
def test_previous_time_matches_window(spark, rows, rows_per_range):
    data, rid = [], 0
    for k, t, dup in rows:
        for _ in range(dup + 1):  # copies at the same (key, time)
            data.append((rid, k, t))
            rid += 1
    df = spark.createDataFrame(data, "row_id bigint, k int, t timestamp_ntz")
    got = with_previous_time(df, key="k", ts="t", rows_per_range=rows_per_range)
    want = df.withColumn("prev_ts", F.lag("t").over(Window.partitionBy("k").orderBy("t", "row_id")))
    cols = ["row_id", "k", "t", "prev_ts"]
    a = sorted((tuple(r) for r in got.select(*cols).collect()), key=str)
    b = sorted((tuple(r) for r in want.select(*cols).collect()), key=str)
    assert a == b
