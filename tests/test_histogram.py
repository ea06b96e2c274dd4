from wakeline.operators.histogram import gap_histogram, gap_summary


def test_bin_edges(spark):
    vals = [0, 19999, 20000, 999999, 1000000, 1000001, -5]
    df = spark.createDataFrame([(v,) for v in vals], "delta_t_ms bigint")
    h = {r.bin: r.n for r in gap_histogram(df).collect()}
    assert len(h) == 50
    assert h[0] == 2 and h[1] == 1 and h[49] == 2
    assert sum(h.values()) == 5
    s = gap_summary(df).collect()[0]
    assert (s.n_plotted, s.n_in_range, s.n_above_range, s.n_zero) == (6, 5, 1, 1)
