"""Source-file gate on real folders, and logs/metrics/events as rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from contract_lake.operators import files, observe
from contract_lake.sinks.files import write_changeset, write_log_rows, write_metrics
from contract_lake.sources.manifest import scan_manifest
from contract_lake.sources.opslog import read_logs, read_metrics


def _write(path, size, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(b"x" * size)
    if mtime is not None:
        os.utime(path, (mtime.timestamp(), mtime.timestamp()))


def test_size_rounding_boundary(spark, tmp_path):
    # 2,042 bytes is 1.99 KB (fails), 2,043 bytes rounds to 2.00 (passes)
    _write(f"{tmp_path}/d/a.json", 2042)
    _write(f"{tmp_path}/d/b.json", 2043)
    m = scan_manifest(spark, f"{tmp_path}/d", "d")
    assert [r.name for r in files.small_files(m).collect()] == ["a.json"]


def test_age_truncates_to_whole_days(spark, tmp_path):
    # 5 d 23 h 59 m is 5 whole days (passes); 6 d fails
    now = dt.datetime(2024, 3, 10, 12, 0, 0, tzinfo=dt.timezone.utc)
    _write(f"{tmp_path}/d/young.json", 4000, now - dt.timedelta(days=5, hours=23, minutes=59))
    _write(f"{tmp_path}/d/old.json", 4000, now - dt.timedelta(days=6))
    m = scan_manifest(spark, f"{tmp_path}/d", "d")
    stale = files.stale_files(m, F.lit(now.replace(tzinfo=None)).cast("timestamp"))
    assert [r.name for r in stale.collect()] == ["old.json"]


def test_duplicate_names_and_content(spark, tmp_path):
    # T4: one name in two subfolders; one content under two names
    _write(f"{tmp_path}/d/x/a.json", 3000)
    _write(f"{tmp_path}/d/y/a.json", 3000)
    _write(f"{tmp_path}/d/y/b.json", 3000)
    m = scan_manifest(spark, f"{tmp_path}/d", "d", with_hash=True)
    assert [(r.name, r.n_copies) for r in files.duplicate_names(m).collect()] == [("a.json", 2)]
    assert files.duplicate_content(m).first().n_copies == 3


def test_unreachable_empty_and_gate(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_manifest(spark, f"{tmp_path}/missing", "m")                    # V2
    os.makedirs(f"{tmp_path}/empty")
    assert scan_manifest(spark, f"{tmp_path}/empty", "e").count() == 0     # V3
    _write(f"{tmp_path}/ok/a.json", 5000)
    m = scan_manifest(spark, f"{tmp_path}/ok", "ok")
    expected = spark.createDataFrame([("ok",), ("e",)], "dataset string")
    fails = files.validate_manifest(m, F.current_timestamp(), expected)
    with pytest.raises(files.GateError) as err:
        files.gate(fails)
    assert "empty_dataset" in str(err.value)
    assert files.gate(files.validate_manifest(m, F.current_timestamp()))


def test_file_counts_status(spark):
    m = spark.createDataFrame([("a", "p1", "n1", 1, None), ("b", "p2", "n2", 1, None), ("b", "p3", "n3", 1, None)],
                              "dataset string, path string, name string, size long, modified_at timestamp")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "dataset string")
    got = {r.dataset: (r.n_files, r.status) for r in files.file_counts(m, expected).collect()}
    assert got == {"a": (1, "success"), "b": (2, "failure"), "c": (0, "failure")}   # T5


def test_log_roundtrip_level_and_order(spark, tmp_path):
    base = spark.createDataFrame([("b", "ERROR", dt.datetime(2024, 1, 1, 0, 0, 1)),
                                  ("a", "info", dt.datetime(2024, 1, 1, 0, 0, 0, 250)),
                                  ("c", "nonsense", dt.datetime(2024, 1, 2))], "m string, l string, ts timestamp")
    rows = observe.log_rows(base, F.col("l"), F.col("m"), "lg", "nb", "ts",
                            run_id_col=observe.run_id(None, "r1"))
    write_log_rows(rows, f"{tmp_path}/logs")
    back = observe.sorted_by_time(read_logs(spark, f"{tmp_path}/logs")).collect()
    assert [r.timestamp for r in back] == ["2024-01-01T00:00:00.000250", "2024-01-01T00:00:01",
                                           "2024-01-02T00:00:00"]
    assert back[0].run_id == "r1"
    assert {r.message for r in observe.at_level(read_logs(spark, f"{tmp_path}/logs"), "bogus").collect()} == {"a", "b"}
    assert {r.message for r in observe.at_level(read_logs(spark, f"{tmp_path}/logs"), "ERROR").collect()} == {"b"}


def test_metrics_defaults_and_roundtrip(spark, tmp_path):
    base = spark.range(2)
    m = observe.metric_rows(base, "completeness", "files", F.col("id"), expected=1)
    write_metrics(m, f"{tmp_path}/metrics")
    back = read_metrics(spark, f"{tmp_path}/metrics").orderBy("value").collect()
    assert back[0].unit == "Count" and back[0].dimensions == {} and back[1].value == 1.0


def test_event_messages_only_progress(spark):
    ev = spark.createDataFrame([("update_progress", '{"update_progress": {"state": "RUNNING"}}'),
                                ("flow_progress", '{"flow_progress": {}}'),
                                ("update_progress", "{}")], "event_type string, details string")
    msgs = sorted(r.message for r in observe.event_messages(ev).collect())
    assert msgs == ["event type: update_progress state: ", "event type: update_progress state: RUNNING"]


def test_write_changeset_stamped_folder(spark, tmp_path):
    docs = spark.createDataFrame([(1,)], "a int")
    target = write_changeset(docs, str(tmp_path), "chg", dt.datetime(2024, 5, 17, 0, 32, 18))
    assert target.endswith("chg_20240517_003218_000000")
    assert spark.read.json(target).count() == 1
