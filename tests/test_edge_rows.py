"""One fixture row per load-check arm (FIXTURES F3)."""

import datetime as dt

import pytest

from wakeline.config import FIELDS
from wakeline.operators.positions import positions_raw, reject_reasons

BASE = {"ts": "18/04/2026 00:00:05", "mmsi": "219000001", "lat": "55.50", "lon": "12.00",
        "nav_status": "Under way using engine", "rot": "0", "sog": "10.2", "cog": "90", "heading": "90"}

CASES = [
    ({}, True, "ok"),
    ({"lat": "0"}, False, "P1_coordinates"),
    ({"lon": "0"}, False, "P1_coordinates"),
    ({"lat": "-0.0"}, False, "P1_coordinates"),
    ({"lat": "90.01"}, False, "P1_coordinates"),
    ({"lon": "-180.5"}, False, "P1_coordinates"),
    ({"lat": "40.00"}, False, "P2_distance"),
    ({"lat": ""}, False, "P1_coordinates"),
    ({"lat": "abc"}, False, "P1_coordinates"),
    ({"lat": "nan"}, True, "ok"),
    ({"lat": "inf"}, False, "P1_coordinates"),
    ({"mmsi": "21900"}, False, "P3_mmsi_shape"),
    ({"mmsi": "2190000012"}, False, "P3_mmsi_shape"),
    ({"mmsi": "21900000a"}, False, "P3_mmsi_shape"),
    ({"mmsi": "000000000"}, False, "P4_mmsi_repeated"),
    ({"mmsi": "111111111"}, False, "P4_mmsi_repeated"),
    ({"mmsi": "123456789"}, False, "P5_mmsi_placeholder"),
    ({"mmsi": "987654321"}, False, "P5_mmsi_placeholder"),
    ({"mmsi": " 219000001 "}, True, "ok"),
    ({"mmsi": "\t219000001\n"}, True, "ok"),
    ({"mmsi": "002190001"}, True, "ok"),
    ({"nav_status": ""}, False, "P6_nav_status"),
    ({"nav_status": "Unknown"}, False, "P6_nav_status"),
    ({"nav_status": "UNDEFINED"}, False, "P6_nav_status"),
    ({"nav_status": "Not Available"}, False, "P6_nav_status"),
    ({"nav_status": "Unknown value"}, True, "ok"),
    ({"rot": ""}, False, "P7_rot"),
    ({"rot": "-128"}, False, "P7_rot"),
    ({"rot": "127.5"}, False, "P7_rot"),
    ({"rot": "-127"}, True, "ok"),
    ({"rot": "127"}, True, "ok"),
    ({"rot": "nan"}, True, "ok"),
    ({"rot": "-nan"}, True, "ok"),
    ({"rot": "-inf"}, False, "P7_rot"),
    ({"sog": "0"}, True, "ok"),
    ({"sog": "102.3"}, False, "P8_sog"),
    ({"sog": "-0.1"}, False, "P8_sog"),
    ({"sog": "1.0d"}, False, "P8_sog"),
    ({"sog": "1f"}, False, "P8_sog"),
    ({"sog": "0x1p3"}, False, "P8_sog"),
    ({"sog": "1e1"}, True, "ok"),
    ({"sog": "1_0"}, False, "P8_sog"),  # documented deviation: Python reads 10
    ({"cog": "0"}, True, "ok"),
    ({"cog": "359.9"}, True, "ok"),
    ({"cog": "360"}, False, "P9_cog"),
    ({"heading": "359"}, True, "ok"),
    ({"heading": "359.5"}, False, "P10_heading"),
    ({"heading": "511"}, False, "P10_heading"),
    ({"ts": "31/02/2026 00:00:00"}, False, "P11_unparsed_key"),
    ({"ts": "bad"}, False, "P11_unparsed_key"),
    ({"ts": "18/04/26 00:00:05"}, False, "P11_unparsed_key"),
    ({"ts": "18/04/2026 00:00:60"}, False, "P11_unparsed_key"),
    ({"ts": "007/04/2026 00:00:05"}, False, "P11_unparsed_key"),
    ({"ts": "8/4/2026 0:0:5"}, True, "ok"),
    ({"ts": " 18/04/2026 00:00:05 "}, True, "ok"),
    ({"ts": "18/04/2026  00:00:05"}, True, "ok"),
]


def _frame(spark, overrides):
    rows = []
    for i, o in enumerate(overrides):
        r = {f: "" for f in FIELDS}
        r.update(BASE)
        r.update(o)
        rows.append((i, *(r[f] for f in FIELDS)))
    return spark.createDataFrame(rows, "row_id bigint, " + ", ".join(f"{f} string" for f in FIELDS))


@pytest.fixture(scope="module")
def results(spark):
    df = _frame(spark, [c[0] for c in CASES])
    kept = {r.row_id: r for r in positions_raw(df).collect()}
    reasons = {}
    for i, c in enumerate(CASES):
        one = _frame(spark, [c[0]])
        reasons[i] = reject_reasons(one).collect()[0].reason
    return kept, reasons


@pytest.mark.parametrize("i", range(len(CASES)))
def test_keep_and_reason(results, i):
    kept, reasons = results
    change, keep, reason = CASES[i]
    assert (i in kept) == keep, change
    assert reasons[i] == reason, change


def test_typed_values(spark):
    df = _frame(spark, [{"mmsi": " 002190001 ", "ts": "8/4/2026 0:0:5", "imo": "Unknown", "width": "",
                         "length": " 2.5 ", "name": "\tNAME  "}])
    r = positions_raw(df).collect()[0]
    assert r.mmsi == 2190001
    assert r.ts == dt.datetime(2026, 4, 8, 0, 0, 5)
    assert r.imo is None and r.width is None and r.length == 2.5
    assert r.name == "NAME" and r.callsign == ""
