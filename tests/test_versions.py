"""Versioned tables: merges as in the day layout, and a write that fails leaves the old table whole."""

import datetime as dt

import pytest

from wakeline.session import path_exists, scratch_path
from wakeline.sources import versions
from wakeline.sources.versions import current_version, drop_old_versions, merge_version, read_version, replace_version

SCHEMA = "row_id bigint, mmsi bigint, ts timestamp_ntz, v string"


def _day(n, hour=12):
    return dt.datetime(2026, 4, n, hour)


def _table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted((r.row_id, r.day and r.day.day, r.v) for r in df.collect())


BASE = [(1, 7, _day(18), "a"), (2, 7, _day(19), "b"), (3, 8, _day(19), "c"), (5, 9, _day(21), "e")]
NEW = [(2, 7, _day(20), "B"), (4, 7, _day(20), "D")]


@pytest.mark.parametrize("how,want", [
    ("replace", [(1, 18, "a"), (2, 20, "B"), (3, 19, "c"), (4, 20, "D"), (5, 21, "e")]),
    ("keep", [(1, 18, "a"), (2, 19, "b"), (3, 19, "c"), (4, 20, "D"), (5, 21, "e")])])
def test_merge_moves_rows_between_days(spark, how, want):
    path = scratch_path(spark, "versions")
    assert current_version(spark, path) is None and read_version(spark, path, SCHEMA).count() == 0
    assert replace_version(_table(spark, BASE), path) == 1
    old = read_version(spark, path, SCHEMA)
    files = {f for f in old.inputFiles() if "day=2026-04-18" in f or "day=2026-04-21" in f}
    assert merge_version(spark, path, _table(spark, NEW), when_matched=how) == 2
    now = read_version(spark, path, SCHEMA)
    assert _rows(now) == want and files <= set(now.inputFiles())
    assert _rows(old) == [(1, 18, "a"), (2, 19, "b"), (3, 19, "c"), (5, 21, "e")]  # an open reader keeps its version
    assert merge_version(spark, path, _table(spark, NEW), when_matched=how) == 3
    assert _rows(read_version(spark, path, SCHEMA)) == want


@pytest.mark.parametrize("lost_in", ["_commit", "_point_to"])
def test_a_failure_before_the_switch_leaves_the_old_table(spark, monkeypatch, lost_in):
    path = scratch_path(spark, "versions-fail")
    replace_version(_table(spark, BASE), path)
    before = _rows(read_version(spark, path, SCHEMA))

    def lost(*_):
        raise RuntimeError("driver lost")

    for write in (lambda: merge_version(spark, path, _table(spark, NEW)), lambda: replace_version(_table(spark, NEW), path)):
        with monkeypatch.context() as m:
            m.setattr(versions, lost_in, lost)
            with pytest.raises(RuntimeError):
                write()
        assert current_version(spark, path) == 1 and _rows(read_version(spark, path, SCHEMA)) == before
    merge_version(spark, path, _table(spark, NEW))  # the next write replaces what was left
    assert _rows(read_version(spark, path, SCHEMA)) == [(1, 18, "a"), (2, 20, "B"), (3, 19, "c"), (4, 20, "D"), (5, 21, "e")]


def test_days_that_empty_and_rows_without_a_time(spark):
    path = scratch_path(spark, "versions-null")
    replace_version(_table(spark, [(1, 7, _day(18), "a"), (2, 7, None, "b"), (3, 7, None, "c")]), path)
    merge_version(spark, path, _table(spark, [(2, 7, None, "B"), (1, 7, None, "A")]))
    assert _rows(read_version(spark, path, SCHEMA)) == [(1, None, "A"), (2, None, "B"), (3, None, "c")]
    merge_version(spark, path, _table(spark, [(k, 7, _day(20), "z") for k in (1, 2, 3)]))
    assert _rows(read_version(spark, path, SCHEMA)) == [(1, 20, "z"), (2, 20, "z"), (3, 20, "z")]
    merge_version(spark, path, _table(spark, []))
    assert read_version(spark, path, SCHEMA).count() == 3
    replace_version(_table(spark, []), path)
    assert read_version(spark, path, SCHEMA).count() == 0


def test_old_versions_are_dropped(spark):
    path = scratch_path(spark, "versions-drop")
    replace_version(_table(spark, BASE), path)
    merge_version(spark, path, _table(spark, NEW))
    want = _rows(read_version(spark, path, SCHEMA))
    assert drop_old_versions(spark, path) == 0  # version 1 still holds two days
    assert not path_exists(spark, f"{path}/data/version=1/day=2026-04-19") and path_exists(spark, f"{path}/data/version=1/day=2026-04-18")
    assert _rows(read_version(spark, path, SCHEMA)) == want
    replace_version(_table(spark, NEW), path)
    assert drop_old_versions(spark, path) == 2
    assert _rows(read_version(spark, path, SCHEMA)) == [(2, 20, "B"), (4, 20, "D")]


@pytest.mark.parametrize("how", ["replace", "keep"])
def test_a_merge_collapses_new_rows_once(spark, monkeypatch, how):
    """The stored new rows hold a key once: no second sort and shuffle of whole rows, and each is held once in the first."""
    from wakeline.sources import tables

    calls, latest = [], tables.latest
    monkeypatch.setattr(tables, "latest", lambda *a: calls.append(a) or latest(*a))
    monkeypatch.setattr(versions, "latest", tables.latest)
    path = scratch_path(spark, "versions-once")
    replace_version(_table(spark, BASE), path)
    twice = [*NEW, (2, 7, _day(20), "A"), (4, 7, _day(20), None)]
    merge_version(spark, path, _table(spark, twice), when_matched=how)
    assert len(calls) == 1
    assert _rows(read_version(spark, path, SCHEMA)) == [(1, 18, "a"), (2, 20, "B") if how == "replace" else (2, 19, "b"), (3, 19, "c"), (4, 20, "D"), (5, 21, "e")]
    plan = latest(_table(spark, twice), "row_id", "ts")._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan
