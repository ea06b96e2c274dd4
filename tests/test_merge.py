"""Merge laws: upsert is idempotent, insert-if-absent never changes existing keys, keys stay unique."""

import datetime as dt

import pytest

from wakeline.session import scratch_path
from wakeline.sources.tables import merge_into_days, merge_keep_existing, merge_replace, write_by_day


def _frames(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "row_id bigint, v string")
    new = spark.createDataFrame([(2, "B"), (4, "D")], "row_id bigint, v string")
    return target, new


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keep_existing(spark):
    target, new = _frames(spark)
    out = merge_keep_existing(target, new)
    assert _rows(out) == [(1, "a"), (2, "b"), (3, "c"), (4, "D")]
    assert _rows(merge_keep_existing(out, new)) == _rows(out)


def test_replace_and_idempotence(spark):
    target, new = _frames(spark)
    out = merge_replace(target, new)
    assert _rows(out) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    assert _rows(merge_replace(out, new)) == _rows(out)


@pytest.mark.parametrize("merge,kept", [(merge_replace, "B2"), (merge_keep_existing, "b")])
def test_duplicate_new_keys_give_one_row(spark, merge, kept):
    target, _ = _frames(spark)
    new = spark.createDataFrame([(2, "B2", 2), (2, "B9", 1), (4, "D1", 1), (4, "D2", 5), (4, "D0", None)], "row_id bigint, v string, seq int")
    wide = target.selectExpr("row_id", "v", "0 AS seq")
    got = {r.row_id: r.v for r in merge(wide, new, order_by="seq").collect()}
    assert got == {1: "a", 2: kept, 3: "c", 4: "D2"}
    assert merge(wide, new).count() == 4  # without an order the largest row by all columns


def _day(n, hour=12):
    return dt.datetime(2026, 4, n, hour)


def _table(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, mmsi bigint, ts timestamp_ntz, v string")


@pytest.mark.parametrize("how,want", [
    ("replace", [(1, 18, "a"), (2, 20, "B"), (3, 19, "c"), (4, 20, "D"), (5, 21, "e")]),
    ("keep", [(1, 18, "a"), (2, 19, "b"), (3, 19, "c"), (4, 20, "D"), (5, 21, "e")])])
def test_merge_into_days_moves_rows_between_days(spark, how, want):
    path = scratch_path(spark, "merge-days")
    write_by_day(_table(spark, [(1, 7, _day(18), "a"), (2, 7, _day(19), "b"), (3, 8, _day(19), "c"), (5, 9, _day(21), "e")]), path)
    files = {f for f in spark.read.parquet(path).inputFiles() if "day=2026-04-18" in f or "day=2026-04-21" in f}
    out = merge_into_days(spark, path, _table(spark, [(2, 7, _day(20), "B"), (4, 7, _day(20), "D")]), when_matched=how)
    assert sorted((r.row_id, r.ts.day, r.v) for r in out.collect()) == want
    assert sorted((r.row_id, r.day.day) for r in spark.read.parquet(path).collect()) == [w[:2] for w in want]
    assert files <= set(out.inputFiles())  # untouched days keep their files


def test_merge_into_days_empties_a_day(spark):
    path = scratch_path(spark, "merge-empty")
    write_by_day(_table(spark, [(1, 7, _day(18), "a"), (2, 7, _day(19), "b")]), path)
    out = merge_into_days(spark, path, _table(spark, [(2, 7, _day(18, 13), "B")]))
    assert sorted((r.row_id, r.ts.day, r.v) for r in out.collect()) == [(1, 18, "a"), (2, 18, "B")]
    assert merge_into_days(spark, path, _table(spark, [])).count() == 2


def test_merge_into_days_without_a_time(spark):
    path = scratch_path(spark, "merge-null")
    write_by_day(_table(spark, [(1, 7, _day(18), "a"), (2, 7, None, "b"), (3, 7, None, "c")]), path)
    out = merge_into_days(spark, path, _table(spark, [(2, 7, None, "B"), (1, 7, None, "A")]))
    assert sorted((r.row_id, r.v) for r in out.collect()) == [(1, "A"), (2, "B"), (3, "c")]
    out = merge_into_days(spark, path, _table(spark, [(k, 7, _day(20), "z") for k in (1, 2, 3)]))
    assert sorted((r.row_id, r.day.day) for r in out.collect()) == [(1, 20), (2, 20), (3, 20)]
