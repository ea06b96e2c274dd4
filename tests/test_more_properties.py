"""Property tests: histogram vs numpy.histogram, merges vs dict semantics,
all CSV rows with unique ids over random file and split sizes."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wakeline.operators.histogram import gap_histogram, gap_summary
from wakeline.sources.csv import read_ais_csv
from wakeline.sources.tables import merge_keep_existing, merge_replace

SLOW = dict(deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large,
                                                  HealthCheck.function_scoped_fixture])


@settings(max_examples=6, **SLOW)
@given(st.lists(st.one_of(st.integers(-10, 1_200_000), st.sampled_from([0, 19999, 20000, 999_999, 1_000_000])),
                min_size=1, max_size=300))
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "delta_t_ms bigint")
    got = [r.n for r in gap_histogram(df).orderBy("bin").collect()]
    nonneg = [v for v in values if v >= 0]  # the original selects delta >= 0 before binning
    want, _ = np.histogram(nonneg, bins=50, range=(0, 1_000_000))
    assert got == list(want)
    s = gap_summary(df).collect()[0]
    assert s.n_plotted == len(nonneg) and s.n_in_range == int(want.sum())


ROWS = st.dictionaries(st.integers(0, 30), st.sampled_from(["a", "b", "c"]), max_size=20)


@settings(max_examples=6, **SLOW)
@given(ROWS, ROWS)
def test_merges_match_dict_semantics(spark, target, new):
    schema = "row_id bigint, v string"
    t = spark.createDataFrame(list(target.items()), schema)
    n = spark.createDataFrame(list(new.items()), schema)
    keep = {**new, **target}     # existing keys keep their value
    replace = {**target, **new}  # new values win
    assert sorted(tuple(r) for r in merge_keep_existing(t, n).collect()) == sorted(keep.items())
    assert sorted(tuple(r) for r in merge_replace(t, n).collect()) == sorted(replace.items())


@settings(max_examples=3, **SLOW)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=5), st.sampled_from(["1024", "4096", "65536"]))
def test_every_line_once_with_an_id_of_its_own(spark, tmp_path_factory, sizes, split_bytes):
    d = tmp_path_factory.mktemp("pos")
    n = 0
    for f, size in enumerate(sizes):
        lines = ["MMSI,Name"] + [f"{n + i},row{n + i}" for i in range(size)]
        (d / f"part-{f:03d}.csv").write_text("\n".join(lines) + "\n")
        n += size
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = read_ais_csv(spark, str(d)).select("row_id", "mmsi").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(int(r.mmsi) for r in rows) == list(range(n))
    assert len({r.row_id for r in rows}) == n
