"""Reject reasons by construction: rows that break one rule, or two, of an otherwise valid row."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wakeline.config import DEFAULT_CONFIG as CFG
from wakeline.config import FIELDS
from wakeline.functions.predicates import OK, REASONS, reject_reason
from wakeline.operators.positions import parsed_rows

VALID = {"ts": "18/04/2026 00:00:05", "mmsi": "219000001", "lat": "55.50", "lon": "12.00",
         "nav_status": "Under way using engine", "rot": "0", "sog": "10.2", "cog": "90", "heading": "90"}

decimals = lambda lo, hi: st.floats(lo, hi).map(lambda x: f"{x:.3f}")
#: changes that keep every rule
HARMLESS = st.fixed_dictionaries({}, optional={
    "lat": decimals(50, 60), "lon": decimals(9, 16), "rot": st.one_of(decimals(-127, 127), st.just("nan")), "sog": decimals(0, 102),
    "cog": decimals(0, 359), "heading": decimals(0, 359), "nav_status": st.sampled_from(["Moored", " At anchor ", "Unknown value"]),
    "mmsi": st.integers(200000001, 219000000).map(str).filter(lambda m: len(set(m)) > 1 and m not in CFG.placeholder_mmsi),
    "name": st.text(max_size=5)})
text = st.sampled_from(["", "x", "--1", "1,5"])
#: by rule, changes that break it and none before it
BROKEN = {
    "P1_coordinates": st.one_of(st.tuples(st.sampled_from(["lat", "lon"]), st.one_of(text, st.sampled_from(["0", "-0.0", "inf"]))),
                                st.tuples(st.just("lat"), st.one_of(decimals(90.01, 400), decimals(-400, -90.01))),
                                st.tuples(st.just("lon"), st.one_of(decimals(180.01, 400), decimals(-400, -180.01)))),
    "P2_distance": st.tuples(st.just("lat"), st.one_of(decimals(-80, -1), decimals(1, 40), decimals(70, 89))),
    "P3_mmsi_shape": st.tuples(st.just("mmsi"), st.sampled_from(["", "21900", "2190000012", "21900000a", "2190 0001"])),
    "P4_mmsi_repeated": st.tuples(st.just("mmsi"), st.integers(0, 9).map(lambda d: str(d) * 9)),
    "P5_mmsi_placeholder": st.tuples(st.just("mmsi"), st.sampled_from(sorted(m for m in CFG.placeholder_mmsi if len(set(m)) > 1))),
    "P6_nav_status": st.tuples(st.just("nav_status"), st.sampled_from(["", " ", "Unknown", "UNDEFINED", "not available", " unknown"])),
    "P7_rot": st.tuples(st.just("rot"), st.one_of(text, decimals(127.01, 900), decimals(-900, -127.01), st.sampled_from(["-128", "-inf"]))),
    "P8_sog": st.tuples(st.just("sog"), st.one_of(text, decimals(102.3, 900), decimals(-900, -0.01))),
    "P9_cog": st.tuples(st.just("cog"), st.one_of(text, decimals(360, 900), decimals(-900, -0.01))),
    "P10_heading": st.tuples(st.just("heading"), st.one_of(text, decimals(359.01, 900), decimals(-900, -0.01), st.just("511"))),
    "P11_unparsed_key": st.tuples(st.just("ts"), st.sampled_from(["", "bad", "31/02/2026 00:00:00", "18/04/2026 24:00:00", "18/04/26 00:00:05"])),
}


def test_every_rule_has_its_broken_rows():
    assert list(BROKEN) == list(REASONS)


def _broken(rules):
    return st.tuples(*(st.tuples(st.just(r), BROKEN[r]) for r in rules))


CASE = st.tuples(HARMLESS, st.lists(st.sampled_from(REASONS), max_size=2, unique=True).flatmap(_broken))


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.large_base_example, HealthCheck.too_slow, HealthCheck.data_too_large])
@given(st.lists(CASE, min_size=20, max_size=120))
def test_first_broken_rule_is_the_reason(spark, cases):
    data, want = [], []
    for i, (harmless, broken) in enumerate(cases):
        changed = {field: value for _, (field, value) in broken}
        if len(changed) < len(broken):  # both changes hit one field
            broken, changed = broken[:1], dict([broken[0][1]])
        row = {**VALID, **harmless, **changed}
        data.append((i, *(row.get(f, "") for f in FIELDS)))
        want.append(min((rule for rule, _ in broken), key=REASONS.index, default=OK))
    df = spark.createDataFrame(data, "row_id bigint, " + ", ".join(f"{f} string" for f in FIELDS))
    got = {r.row_id: r.reason for r in parsed_rows(df).select("row_id", reject_reason(CFG).alias("reason")).collect()}
    for i, reason in enumerate(want):
        assert got[i] == reason, cases[i]
