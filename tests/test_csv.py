"""CSV scan: columns bound by each file's own header, odd records, ids that survive other splits."""

import gzip
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from wakeline.config import AIS_HEADERS, FIELDS
from wakeline.plans.jobs import observed
from wakeline.session import scratch_path
from wakeline.sources.csv import header_lines, literal_path, read_ais_csv, read_csv_strings, scanned_headers, write_ais_csv
from wakeline.sources.fixture import ais_strings
from wakeline.sources.tables import write_stage


def test_round_trip_keeps_text(spark):
    src = ais_strings(spark, SF001)
    path = scratch_path(spark, "csv-rt")
    write_ais_csv(src, path)
    back = read_ais_csv(spark, path)
    a = sorted(tuple(r) for r in src.select(*FIELDS).collect())
    assert a == sorted(tuple(r) for r in back.select(*FIELDS).collect())  # ' 219000079 ' style padding and '' cells too
    assert back.select("row_id").distinct().count() == len(a)
    assert not back.where("malformed").count()


def test_binding_by_header_name_not_position(spark, tmp_path):
    headers = dict(AIS_HEADERS)
    # columns in a different order, one header missing (Callsign), one extra column
    cols = [headers["mmsi"], "Extra", headers["ts"], headers["lat"], headers["lon"]]
    p = tmp_path / "a.csv"
    p.write_text(",".join(cols) + "\n" + "219000001,zzz,18/04/2026 00:00:05,55.5,12.0\n"
                 + "219000002,yyy,\"18/04/2026 00:00:06\",\"55.6\",12.1\n")
    rows = read_ais_csv(spark, str(p)).orderBy("row_id").collect()
    assert rows[0].mmsi == "219000001" and rows[0].ts == "18/04/2026 00:00:05" and rows[0].lat == "55.5"
    assert rows[1].lat == "55.6" and rows[0].callsign == "" and rows[0].heading == ""


def test_each_file_has_its_own_layout(spark, tmp_path):
    (tmp_path / "a.csv").write_text("MMSI,Latitude,Longitude\n219000001,55.5,12\n")
    (tmp_path / "b.csv").write_text("Latitude,MMSI,Longitude\n56.5,219000002,13\n")
    (tmp_path / "c.csv").write_text("\nLatitude,MMSI\n57.5,219000003\n")
    (tmp_path / "d.csv").write_text("﻿MMSI,Latitude,Longitude\n219000004,58.5,15\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("")
    rows = read_ais_csv(spark, str(tmp_path))
    assert sorted((r.mmsi, r.lat, r.lon, r.malformed) for r in rows.collect()) == [
        ("219000001", "55.5", "12", False), ("219000002", "56.5", "13", False),
        ("219000003", "57.5", "", False), ("219000004", "58.5", "15", False)]
    assert rows.select("row_id").distinct().count() == 4
    assert header_lines(spark, str(tmp_path)).count() == 4


def test_no_file_with_a_header(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert read_ais_csv(spark, str(tmp_path)).count() == 0


def test_all_rows_stay_when_splits_differ_between_plan_and_run(spark, tmp_path):
    """The number of cores, and with it the file splits, may change between building a scan and running it."""
    for f in range(2):
        lines = ["# Timestamp,MMSI"] + [f"18/04/2026 00:00:{i % 60:02d},{219000000 + 1000 * f + i}" for i in range(1000)]
        (tmp_path / f"part-{f}.csv").write_text("\n".join(lines) + "\n")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "8")
        rows = read_ais_csv(spark, str(tmp_path)).select("row_id", "mmsi")
        for n in ("8", "4", "3", "2"):
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", n)
            raw = write_stage(rows, "splits")
            assert sorted(int(r.mmsi) for r in raw.collect()) == [219000000 + i for i in range(2000)]
            assert raw.select("row_id").distinct().count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_quoting_and_crlf(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_bytes(("MMSI,Name,Destination,Latitude\r\n"
                   '219000001,"NORTH, STAR","SAY ""HI""",55.5\r\n'
                   "219000002,PLAIN,,56.0\r\n").encode("utf-8"))
    rows = sorted((r.mmsi, r.name, r.destination, r.lat) for r in read_ais_csv(spark, str(p)).collect())
    assert [(m, n, d, la.strip()) for m, n, d, la in rows] == [
        ("219000001", "NORTH, STAR", 'SAY "HI"', "55.5"), ("219000002", "PLAIN", "", "56.0")]


@pytest.mark.parametrize("multiline,names,malformed", [(True, ["NORTH\nSTAR", "PLAIN"], 0), (False, None, 2)])
def test_line_breaks_in_quotes(spark, tmp_path, multiline, names, malformed):
    (tmp_path / "m.csv").write_text('MMSI,Name,Latitude\n219000001,"NORTH\nSTAR",55.5\n219000002,PLAIN,56.0\n')
    counted, seen = observed(read_ais_csv(spark, str(tmp_path), multiline=multiline))
    rows = write_stage(counted, "lines").collect()
    assert seen.get == {"rows_read": 2 if multiline else 3, "rows_malformed": malformed}
    if names:
        assert sorted(r.name for r in rows) == names


def test_wrong_cell_counts_are_marked(spark, tmp_path):
    (tmp_path / "w.csv").write_text("MMSI,Latitude\n219000001,55.5\n219000002\n219000003,56,extra\n")
    got = {r.mmsi: r.malformed for r in read_csv_strings(spark, str(tmp_path)).collect()}
    assert got == {"219000001": False, "219000002": True, "219000003": True}


def test_gzip_files(spark, tmp_path):
    for f, base in enumerate((0, 3)):
        with gzip.open(tmp_path / f"day{f}.csv.gz", "wt") as fh:
            fh.write("MMSI,Latitude\n" + "".join(f"{219000000 + base + i},55.5\n" for i in range(3)))
    rows = read_ais_csv(spark, str(tmp_path))
    assert sorted(int(r.mmsi) for r in rows.collect()) == [219000000 + i for i in range(6)]
    assert rows.agg(F.count_distinct("row_id")).first()[0] == 6


def test_counting_reads_only_the_checked_columns(spark, tmp_path):
    from wakeline.operators.positions import CHECKED, positions_raw
    from wakeline.operators.vessels import vessel_counts

    path = write_stage(ais_strings(spark, SF001), "strings")
    plan = vessel_counts(positions_raw(path, fields=CHECKED))._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema"):]
    assert "callsign" not in read and "destination" not in read and "nav_status" in read
    few = positions_raw(path, fields=("mmsi", "name"))
    whole = positions_raw(path).select("row_id", "mmsi", "name")
    assert sorted(map(str, few.collect())) == sorted(map(str, whole.collect()))


ODD_NAMES = ["a b.csv", "c[1].csv", "d%20e{x}*?.csv", "e+f.csv", "plain.csv"]


def _odd_files(folder, lines=20):
    """Files of two layouts, whose names hold blanks and pattern characters."""
    folder.mkdir()
    for k, name in enumerate(ODD_NAMES):
        head = "MMSI,Latitude,Name" if k % 2 else "Name,Latitude,MMSI"
        row = (lambda i: f"{219000000 + i},55.5,{name[0]}") if k % 2 else (lambda i: f"{name[0]},55.5,{219000000 + i}")
        (folder / name).write_text("\n" * (k == 1) + head + "\n" + "".join(row(i) + "\n" for i in range(lines)))
    return str(folder)


def test_odd_file_names_in_several_layouts(spark, tmp_path):
    path = _odd_files(tmp_path / "in [x] y")
    rows = read_ais_csv(spark, literal_path(path))
    assert sorted((r.name, r.n) for r in rows.where("mmsi LIKE '2190%' AND NOT malformed").groupBy("name").agg(F.count("*").alias("n")).collect()) == [
        (c, 20) for c in "acdep"]
    assert sorted(r.file.rsplit("/")[-1] for r in header_lines(spark, literal_path(path)).collect()) == ODD_NAMES


SPILLING = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.shuffle.spill.numElementsForceSpillThreshold", "1000").getOrCreate())
from wakeline.sources.csv import header_lines, read_ais_csv, scanned_headers
for heads in (header_lines(spark, sys.argv[1]), scanned_headers(spark, sys.argv[1])):
    print("HEADS", sorted(r.header for r in heads.collect()))
print("ROWS", read_ais_csv(spark, sys.argv[1]).where("lat = '55.5' AND mmsi LIKE '2190%'").count())
"""


def test_headers_do_not_depend_on_a_sort(tmp_path):
    """Sorts that spill at every thousandth row (a setting of a whole process): every file keeps its own first line."""
    path = _odd_files(tmp_path / "big", lines=5_000)
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", SPILLING, path], cwd=home, capture_output=True, text=True, timeout=300)
    want = str(sorted("MMSI,Latitude,Name" if k % 2 else "Name,Latitude,MMSI" for k in range(5)))
    assert [line for line in run.stdout.splitlines() if line.startswith(("HEADS", "ROWS"))] == [f"HEADS {want}", f"HEADS {want}", "ROWS 25000"], run.stderr[-2000:]


def test_headers_read_a_head_of_each_file(tmp_path):
    """Bytes read for headers follow the number of files, not their size."""
    import pyarrow as pa

    from wakeline.sources.csv import _head_reader

    read, opened = _head_reader(), []
    path = tmp_path / "large.csv"
    path.write_text("\n\nMMSI,Latitude\r\n" + "219000001,55.5\n" * 1_000_000)
    (tmp_path / "blank.csv").write_text("\n \n")
    (tmp_path / "wide.csv").write_text("x" * 300_000)

    class Counted:
        def __init__(self, stream):
            self.stream = stream

        def read(self, n):
            opened.append(n)
            return self.stream.read(n)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

    from unittest import mock

    from pyarrow import fs

    class Store(fs.LocalFileSystem):
        def open_input_stream(self, *a, **k):
            return Counted(super().open_input_stream(*a, **k))

    names = [f"file:{tmp_path}/{n}" for n in ("large.csv", "blank.csv", "wide.csv", "missing.csv")] + ["odd://x/y.csv"]
    with mock.patch.object(fs, "LocalFileSystem", Store):
        out = next(read(iter([pa.record_batch({"file": pa.array(names[:1])})]))).to_pylist()
        assert out == [{"file": names[0], "header": "MMSI,Latitude"}] and sum(opened) <= 1 << 16
        rest = next(read(iter([pa.record_batch({"file": pa.array(names[1:])})]))).to_pylist()
    assert rest == [{"file": names[2], "header": "x" * 300_000}, {"file": names[3], "header": None}, {"file": names[4], "header": None}]


def test_a_store_that_arrow_cannot_open_is_scanned(spark, tmp_path, monkeypatch):
    from wakeline.sources import csv as module

    def closed():
        def read(batches):
            import pyarrow

            for b in batches:
                yield pyarrow.record_batch({"file": b.column("file"), "header": pyarrow.nulls(b.num_rows, pyarrow.string())})
        return read

    path = _odd_files(tmp_path / "closed")
    want = sorted(map(str, header_lines(spark, path).collect()))
    monkeypatch.setattr(module, "_head_reader", closed)
    assert sorted(map(str, header_lines(spark, path).collect())) == want
    assert read_ais_csv(spark, path).where("lat = '55.5'").count() == 100
