"""CSV files as they come: quoting, spaces, headers of their own, unknown types."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from auditlane.operators.staging import stage_trips
from auditlane.plans import bindings as b
from auditlane.plans import flow
from auditlane.plans.registry import order_suite
from auditlane.sources import csv

from .conftest import SF_SMALL


def _file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_legal_quoting_reads(spark, tmp_path):
    path = _file(tmp_path / "z", "a.csv", 'location_id,borough,zone\n1,"say ""hi"", x"," outer "\n2, a\\b ,""\n3,"a\\",\n')
    rows = sorted(tuple(r) for r in csv.read_zones_csv(spark, path).collect())
    assert rows == [("1", 'say "hi", x', " outer "), ("2", " a\\b ", ""), ("3", "a\\", "")]


def test_values_survive_a_round_trip(spark, tmp_path):
    texts = ['say "hi", x', " outer ", "a\\", '"', '""', "\\\"", ",", "", "  ", "tab\there", "é日本"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    csv.write_csv(df, str(tmp_path / "t"))
    assert [r["t"] for r in csv.read_csv(spark, str(tmp_path / "t")).orderBy(csv.F.col("k").cast("int")).collect()] == texts


def test_line_breaks_in_quotes_on_demand(spark, tmp_path):
    path = _file(tmp_path / "m", "a.csv", 'k,t\n1,"two\nlines"\n2,x\n')
    assert sorted(tuple(r) for r in csv.read_csv(spark, path, multi_line=True).collect()) == [("1", "two\nlines"), ("2", "x")]


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "z"
    _file(folder, "a.csv", "location_id,borough,zone\n1,B1,Z1\n")
    _file(folder, "b.csv", "\ufeffzone,location_id,borough\nZ2,2,B2\n")
    _file(folder, "empty.csv", "")
    path = _file(folder, "only_header.csv", "borough,zone,location_id\n")
    got = csv.read_zones_csv(spark, path)
    assert got.columns == ["location_id", "borough", "zone"]
    assert sorted(tuple(r) for r in got.collect()) == [("1", "B1", "Z1"), ("2", "B2", "Z2")]


ON_EXECUTORS = """
import sys
from auditlane.session import build_session
from auditlane.sources import csv
spark = build_session("local-cluster[2,2,1024]", "headers", 4, {
    "spark.executor.memory": "600m", "spark.driver.host": "127.0.0.1", "spark.sql.files.maxPartitionBytes": "8k",
    "spark.checkpoint.dir": sys.argv[2], "spark.sql.warehouse.dir": sys.argv[2] + "/warehouse"})
for _ in range(3):
    assert sorted(",".join(h) for h in csv.headers(spark, sys.argv[1]).values()) == ["a,k,b", "b,a,k", "k,a,b"]
assert csv.read_csv(spark, sys.argv[1], ("k", "a", "b")).count() == 6_000
spark.stop()
"""


def test_the_header_of_a_file_in_many_blocks_is_its_first_line(tmp_path):
    """Where executors are processes of their own, blocks of a file come in any order."""
    lines = "".join(f"{k},x{k},{'y' * 80}\n" for k in range(2_000))
    for k, header in enumerate(("k,a,b", "a,k,b", "b,a,k")):
        path = _file(tmp_path / "z", f"{k}.csv", f"{header}\n{lines}")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ran = subprocess.run([sys.executable, "-c", ON_EXECUTORS, path, str(tmp_path / "kept")], cwd=repo, capture_output=True, text=True, timeout=240,
                         env={k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")} | {"PYTHONPATH": repo, "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1"})
    assert ran.returncode == 0, ran.stderr[-2_000:]


def test_more_files_than_a_job_reads_headers_of(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv, "HEADERS_A_JOB", 3)
    for k in range(8):
        path = _file(tmp_path / "z", f"{k}.csv", f"k,v\n{k},x\n" if k % 2 else f"v,k\nx,{k}\n")
    assert sorted(tuple(r) for r in csv.read_csv(spark, path).collect()) == [(str(k), "x") if k % 2 else ("x", str(k)) for k in range(8)] or \
        sorted(tuple(r) for r in csv.read_csv(spark, path).select("k", "v").collect()) == [(str(k), "x") for k in range(8)]


def test_a_file_with_another_column_is_drift_and_named(spark, lake, tmp_path):
    whole = b.order_trips(spark, SF_SMALL)
    path = f"{lake.root}/in/trips"
    csv.write_csv(whole.where("trip_id % 2 = 0").coalesce(1), path)
    csv.write_csv(whole.where("trip_id % 2 = 1").coalesce(1).withColumnRenamed("trip_distance", "trip_distance_mi"), path, mode="append")
    with pytest.raises(csv.HeaderDriftError, match="trip_distance_mi") as info:
        csv.read_trips_csv(spark, path)
    assert info.value.file.endswith(".csv") and info.value.missing == ["trip_distance"] and info.value.extra == ["trip_distance_mi"]
    r = flow.run(spark, lambda: csv.read_trips_csv(spark, path), lambda: b.nation_zones(spark, SF_SMALL), suite=order_suite(), lake=lake)
    assert r.outcome == flow.Outcome.STRUCTURAL and info.value.file in r.error
    log = {x["stage"]: x["status"] for x in flow.stage_log(spark, lake).collect()}
    assert log == {"land": "failed", "build": "skipped", "gate": "skipped", "publish": "skipped"}


def test_typed_scan(spark, tmp_path):
    path = _file(tmp_path / "t", "a.csv", "a,b,c,d,e\n1,1.5,2024-01-02,x,NA\n-2,3,2024-01-02 03:04:05.678,1,\nNA,1e3,,2,null\n")
    got = csv.read_typed(spark, path)
    assert dict(got.dtypes) == {"a": "bigint", "b": "double", "c": "timestamp_ntz", "d": "string", "e": "string"}
    assert [r["a"] for r in got.collect()] == [1, -2, None]
    counts = {r["column"]: (r["n_values"], r["n_null_texts"], r["n_long"], r["n_double"], r["n_timestamp"]) for r in csv.inferred_types(csv.read_csv(spark, path)).collect()}
    assert counts == {"a": (2, 1, 2, 2, 0), "b": (3, 0, 1, 3, 0), "c": (2, 1, 0, 0, 2), "d": (3, 0, 2, 2, 0), "e": (0, 3, 0, 0, 0)}


def test_round_trip_through_staging(spark, lake):
    src = b.order_trips(spark, SF_SMALL)
    csv.write_csv(src, f"{lake.root}/trips")
    back = stage_trips(csv.read_trips_csv(spark, f"{lake.root}/trips"))
    assert back.exceptAll(stage_trips(src)).count() == 0


def test_odd_file_names(spark, tmp_path):
    folder = tmp_path / "odd names"
    for k, name in enumerate(["a b.csv", "c[1].csv", "d%20e.csv", "é.csv"]):
        path = _file(folder, name, f"k,v\n{k},x\n")
    assert sorted(r["k"] for r in csv.read_csv(spark, path).collect()) == ["0", "1", "2", "3"]
