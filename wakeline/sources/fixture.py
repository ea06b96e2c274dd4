"""AIS-shaped string rows derived from the driver's ``events`` table.

The driver data holds no AIS reports, so the test input is derived from
``events`` with portable SQL expressions: the same expression text runs in Spark
(``selectExpr``) and in DuckDB (the oracle), so both engines see identical input.

``e`` = event_id, ``v`` merges user pairs into one vessel so that about half of
the vessels hover around the 100-report threshold, and every fourth event shares
a second so that equal timestamps (ties) occur. Times run over up to nine days.  Edge values (bad time, bad
MMSI, zero / out-of-range coordinates, unknown status, NaN rate of turn, ...)
are injected at fixed event-id residues.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wakeline.config import AIS_HEADERS
from wakeline.sources.spread import spread, width

_V = "(CASE WHEN user_id % 3 = 0 THEN user_id ELSE user_id - user_id % 3 + 1 END)"
# seconds from 23:00 of the first day on, so that gaps across midnight occur at every size
_T = "(82800 + (event_id - event_id % 4) * 8)"
_DAY = f"(({_T} - {_T} % 86400) / 86400)"
_SEC = f"({_T} % 86400)"


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _pad2(x: str) -> str:
    return f"lpad({_s(x)}, 2, '0')"


_HH = f"CAST(({_SEC} - {_SEC} % 3600) / 3600 AS INT)"
_MI = f"CAST((({_SEC} % 3600) - ({_SEC} % 60)) / 60 AS INT)"
_SS = f"({_SEC} % 60)"

# field -> portable SQL expression over events(event_id, user_id, event_type)
FIXTURE_EXPRS = {
    "ts": (
        "CASE WHEN event_id % 101 = 0 THEN 'not a time' "
        "WHEN event_id % 103 = 0 THEN '31/02/2026 00:00:00' "
        f"ELSE {_s(f'CAST(18 + {_DAY} % 9 AS INT)')} || '/04/2026 ' || {_pad2(_HH)} || ':' || {_pad2(_MI)} || ':' || {_pad2(_SS)} END"
    ),
    "mobile_type": "'Class A'",
    "mmsi": (
        "CASE WHEN event_id % 97 = 0 THEN '111111111' "
        "WHEN event_id % 89 = 0 THEN '987654321' "
        "WHEN event_id % 83 = 0 THEN '21900' "
        f"WHEN event_id % 79 = 0 THEN ' ' || {_s(f'219000000 + {_V}')} || ' ' "
        f"ELSE {_s(f'219000000 + {_V}')} END"
    ),
    "lat": (
        "CASE WHEN event_id % 73 = 0 THEN '0' "
        "WHEN event_id % 71 = 0 THEN '91' "
        "WHEN event_id % 67 = 0 THEN '40.00' "
        "WHEN event_id % 61 = 0 THEN '' "
        f"ELSE {_s('54 + event_id % 4')} || '.' || {_pad2('event_id % 100')} END"
    ),
    "lon": (
        "CASE WHEN event_id % 59 = 0 THEN '181.0' "
        f"ELSE {_s('8 + event_id % 7')} || '.' || {_pad2(f'{_V} % 100')} END"
    ),
    "nav_status": (
        "CASE WHEN event_id % 53 = 0 THEN 'Unknown' "
        "WHEN event_id % 47 = 0 THEN '' "
        "WHEN event_id % 43 = 0 THEN 'Unknown value' "
        "WHEN event_id % 41 = 0 THEN ' Moored ' "
        "ELSE 'Under way using engine' END"
    ),
    "rot": (
        "CASE WHEN event_id % 37 = 0 THEN '' "
        "WHEN event_id % 109 = 0 THEN '-128' "
        "WHEN event_id % 113 = 0 THEN 'nan' "
        f"ELSE {_s('event_id % 255 - 127')} END"
    ),
    "sog": f"CASE WHEN event_id % 127 = 0 THEN '102.3' ELSE {_s('event_id % 102')} || '.2' END",
    "cog": f"CASE WHEN event_id % 131 = 0 THEN '360' ELSE {_s('event_id % 360')} END",
    "heading": f"CASE WHEN event_id % 137 = 0 THEN '511' ELSE {_s('event_id % 360')} END",
    "imo": "'Unknown'",
    "callsign": f"'OX' || {_s(_V)}",
    "name": "event_type",
    "ship_type": "'Cargo'",
    "cargo_type": "''",
    "width": _s("event_id % 40"),
    "length": f"{_s('user_id')} || '.5'",
    "pos_fix_type": "'GPS'",
    "draught": "''",
    "destination": "'COPENHAGEN'",
    "eta": "'18/04/2026 12:00:00'",
    "data_source_type": "'AIS'",
    "a": _s("event_id % 10"),
    "b": "''",
    "c": "'1e1'",
    "d": "CASE WHEN event_id % 2 = 0 THEN 'nan' ELSE ' 2.5 ' END",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type")
    return spread(ev)


def ais_strings(spark: SparkSession, sf_dir: str, in_order: bool = False, n_parts: int | None = None) -> DataFrame:
    """Field-named string rows plus ``row_id`` (= event_id, the input position).

    ``in_order`` puts them in ``row_id`` order, in ``n_parts`` ranges (as many as the scan has partitions by
    default). The events are ordered before the strings are made, so neither the sample that cuts the
    ranges nor the shuffle holds the 26 fields.
    """
    ev = events(spark, sf_dir)
    if in_order:
        ev = ev.repartitionByRange(n_parts or width(ev), "event_id").sortWithinPartitions("event_id")
    return ev.selectExpr("event_id AS row_id", *(f"{e} AS {f}" for f, e in FIXTURE_EXPRS.items()))


def ais_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture with the real CSV header names (for writing a CSV file set)."""
    ev = events(spark, sf_dir)
    headers = dict(AIS_HEADERS)
    return ev.selectExpr(
        "event_id AS row_id", *(f"{FIXTURE_EXPRS[f]} AS `{headers[f]}`" for f, _ in AIS_HEADERS)
    )


def duckdb_fixture_sql() -> str:
    """The same fixture as a DuckDB SELECT over the ``events`` view."""
    cols = ",\n  ".join(f'{e} AS "{f}"' for f, e in FIXTURE_EXPRS.items())
    return f"SELECT event_id AS row_id,\n  {cols}\nFROM events"
