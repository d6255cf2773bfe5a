"""Streaming ingest: stream = batch, replay, corrupt files, rate limit,
per-batch metrics and the gate in front of run_all."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from contract_lake.contract import Entry, Property, contract_from_dict
from contract_lake.operators import files
from contract_lake.plans import flows
from contract_lake.sources.documents import read_features
from contract_lake.contract import read_schema
from contract_lake.streaming import ingest

ENTRY = Entry(name="things", key="feature_id", folder="things", table_name="things",
              properties=(Property("feature_id", "feature.id", "string"),
                          Property("v", "feature.properties.v", "string"),
                          Property("n", "feature.properties.n", "integer"),
                          Property("seq", "feature.properties.seq", "long")),
              sequence_by="seq")


def _doc(features):
    return {"type": "FeatureCollection", "features": features}


def _feature(fid, seq, v, n=1):
    return {"id": fid, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]},
            "properties": {"v": v, "n": n, "seq": seq}}


def _write_docs(folder, docs, pretty=True):
    os.makedirs(folder, exist_ok=True)
    for i, d in enumerate(docs):
        with open(os.path.join(folder, f"doc_{i:03d}.json"), "w") as fh:
            json.dump(d, fh, indent=4 if pretty else None)


def _paths(tmp_path, src):
    return ingest.EntryPaths(source=src, landing=f"{tmp_path}/landing", checkpoint=f"{tmp_path}/ckpt")


def _history_rows(df):
    return sorted((r.feature_id, r.seq, r.v, r.valid_from, r.valid_to) for r in df.collect())


def test_stream_equals_batch_and_replay(spark, tmp_path):
    rng = random.Random(3)
    changes = [_feature(f"k{rng.randint(0, 5)}", s, rng.choice("ab")) for s in range(60)]
    cut = sorted(rng.sample(range(1, 60), 7))
    docs = [_doc(changes[a:b]) for a, b in zip([0] + cut, cut + [60])]
    src = f"{tmp_path}/src"
    _write_docs(src, docs)
    paths = _paths(tmp_path, src)
    q = ingest.run_entry(spark, ENTRY, paths, max_files=3)
    streamed = ingest.history_from_landing(spark, ENTRY, paths.landing, track=["v"])
    batch_docs = read_features(spark, src, read_schema(ENTRY.properties))
    batch, _ = flows.run_entry_batch(batch_docs, ENTRY, track=["v"])
    assert _history_rows(streamed) == _history_rows(batch)
    assert len(q.recentProgress) >= 3                        # several micro-batches
    n = ingest.read_landing(spark, paths.landing).count()
    # restart from the checkpoint: nothing is processed twice
    ingest.run_entry(spark, ENTRY, paths, max_files=3)
    assert ingest.read_landing(spark, paths.landing).count() == n == 60


def test_corrupt_document_goes_to_quarantine(spark, tmp_path):
    src = f"{tmp_path}/src"
    _write_docs(src, [_doc([_feature("a", 1, "x"), _feature("  ", 2, "y")])])
    with open(f"{src}/broken.json", "w") as fh:
        fh.write("{not json")
    paths = _paths(tmp_path, src)
    ingest.run_entry(spark, ENTRY, paths, max_files=None)
    bad = ingest.quarantine_from_landing(spark, paths.landing).collect()
    assert len(bad) == 2
    corrupt = [r for r in bad if r._corrupt_record is not None]
    assert len(corrupt) == 1 and corrupt[0]._source_file.endswith("broken.json")
    assert {r.validation_rule_name for r in bad} == {"valid_id,text_parsed,sequence_present"} | {"valid_id"}
    assert {r.validation_rule_failed for r in bad} >= {"feature_id IS NOT NULL AND TRIM(feature_id) != ''"}
    assert all(r.quarantine_timestamp is not None for r in bad)
    good = ingest.read_landing(spark, paths.landing, 1).collect()
    assert [r.feature_id for r in good] == ["a"]


def test_one_file_per_trigger_and_batch_metrics(spark, tmp_path):
    src = f"{tmp_path}/src"
    _write_docs(src, [_doc([_feature("a", i, "x"), _feature("", i, "y")]) for i in range(3)])
    paths = _paths(tmp_path, src)
    q = ingest.run_entry(spark, ENTRY, paths, max_files=1)
    assert sum(1 for p in q.recentProgress if p.numInputRows > 0) == 3
    m = ingest.batch_metrics(spark, paths.landing).collect()
    by_name = {}
    for r in m:
        by_name[r.metric_name] = by_name.get(r.metric_name, 0) + r.value
    assert by_name == {"rows_in": 6.0, "rows_passed": 3.0, "rows_failed": 3.0}


def test_run_all_gate_blocks_streams(spark, tmp_path):
    contract = contract_from_dict({"schema": [
        {"name": "things", "key": "feature_id", "folder": "things", "table_name": "things", "sequence_by": "seq",
         "properties": [{"name": p.name, "sourcePath": p.source_path, "physicalType": p.physical_type}
                        for p in ENTRY.properties]},
        {"name": "others", "key": "feature_id", "folder": "others", "table_name": "others",
         "properties": [{"name": "feature_id", "sourcePath": "feature.id"}]}]})
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    _write_docs(f"{root}/things", [_doc([_feature(f"k{i}", i, "x") for i in range(40)])])
    with pytest.raises(files.GateError) as err:                # "others" folder missing
        ingest.run_all(spark, contract, root, out)
    assert "unreachable" in str(err.value)
    assert not os.path.exists(f"{out}/things/landing")         # nothing started
    _write_docs(f"{root}/others", [_doc([_feature(f"o{i}", i, "x") for i in range(40)])])
    ingest.run_all(spark, contract, root, out)
    assert spark.read.parquet(f"{out}/things/landing").count() == 40
    assert spark.read.parquet(f"{out}/others/landing").count() == 40


def test_maintained_history_absorbs_late_rows(spark, tmp_path):
    src = f"{tmp_path}/src"
    first = [_doc([_feature(f"k{i % 4}", 10 * i, "ab"[i % 2]) for i in range(12)])]
    _write_docs(src, first)
    paths = _paths(tmp_path, src)
    hist_path, ckpt = f"{tmp_path}/history", f"{tmp_path}/upkeep"
    ingest.run_entry(spark, ENTRY, paths, max_files=1)
    ingest.maintain_history(spark, ENTRY, paths.landing, hist_path, ckpt, n_buckets=4,
                            track=["v"]).awaitTermination()
    # a late change (sequence between earlier ones) for one key, in a new file
    with open(f"{src}/late.json", "w") as fh:
        json.dump(_doc([_feature("k1", 15, "z")]), fh)
    ingest.run_entry(spark, ENTRY, paths, max_files=1)
    ingest.maintain_history(spark, ENTRY, paths.landing, hist_path, ckpt, n_buckets=4,
                            track=["v"]).awaitTermination()
    maintained = ingest.read_history(spark, hist_path)
    expected = ingest.history_from_landing(spark, ENTRY, paths.landing, track=["v"])
    assert _history_rows(maintained) == _history_rows(expected)
    assert ("k1", 15, "z", 15, 50) in {(r.feature_id, r.seq, r.v, r.valid_from, r.valid_to)
                                       for r in maintained.collect()}


def test_feature_lines_equal_collections(spark, tmp_path):
    # one Feature per line (split across tasks) gives the same history as
    # the same features delivered as FeatureCollection files
    rng = random.Random(5)
    feats = [_feature(f"k{rng.randint(0, 3)}", s, rng.choice("ab")) for s in range(30)]
    lines = f"{tmp_path}/lines"
    os.makedirs(lines)
    for i in range(3):
        with open(f"{lines}/part{i}.jsonl", "w") as fh:
            fh.write("\n".join(json.dumps(f) for f in feats[i * 10:(i + 1) * 10]) + "\n")
    coll = f"{tmp_path}/coll"
    _write_docs(coll, [_doc(feats[i * 10:(i + 1) * 10]) for i in range(3)])
    a = ingest.EntryPaths(lines, f"{tmp_path}/la", f"{tmp_path}/ca")
    b = ingest.EntryPaths(coll, f"{tmp_path}/lb", f"{tmp_path}/cb")
    ingest.run_entry(spark, ENTRY, a, max_files=1, feature_lines=True)
    ingest.run_entry(spark, ENTRY, b, max_files=1)
    ha = ingest.history_from_landing(spark, ENTRY, a.landing, track=["v"])
    hb = ingest.history_from_landing(spark, ENTRY, b.landing, track=["v"])
    assert _history_rows(ha) == _history_rows(hb) and ha.count() > 0
    # every row of one micro-batch carries the same processing time
    stamps = ingest.read_landing(spark, a.landing).groupBy("_source_file") \
        .agg(F.countDistinct("processing_timestamp").alias("n")).collect()
    assert all(r.n == 1 for r in stamps)


def test_batch_inference_reads_types(spark, tmp_path):
    # A batch read without a schema infers column types
    from contract_lake.sources.documents import infer_schema
    _write_docs(f"{tmp_path}/d", [_doc([_feature("a", 1, "x", n=3)])])
    schema = infer_schema(spark, f"{tmp_path}/d")
    props = schema["features"].dataType.elementType["properties"].dataType
    assert props["n"].dataType.typeName() == "long" and props["v"].dataType.typeName() == "string"


def test_run_all_writes_logs_and_metrics(spark, tmp_path):
    from contract_lake.plans.runlog import RunLog
    from contract_lake.sources.opslog import read_logs, read_metrics
    spec = {"name": "things", "key": "feature_id", "folder": "things", "table_name": "things",
            "sequence_by": "seq",
            "properties": [{"name": p.name, "sourcePath": p.source_path, "physicalType": p.physical_type}
                           for p in ENTRY.properties]}
    servers = {"development": {"log_name": "ops", "log_volume": f"{tmp_path}/logs",
                               "metric_volume": f"{tmp_path}/metrics", "log_level": "info"}}
    contract = contract_from_dict({"schema": [spec], "servers": servers})
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    # first delivery too small: the gate fails and says so in the log
    _write_docs(f"{root}/things", [_doc([_feature("a", 1, "x")])], pretty=False)
    with pytest.raises(files.GateError):
        ingest.run_all(spark, contract, root, out, log=RunLog.from_contract(spark, contract, "ingest"))
    errors = read_logs(spark, f"{tmp_path}/logs").filter("level = 'ERROR'").collect()
    assert len(errors) == 1 and "small_file" in errors[0].message and errors[0].logger == "ops"
    os.remove(f"{root}/things/doc_000.json")
    _write_docs(f"{root}/things", [_doc([_feature(f"k{i}", i, "x") for i in range(40)])])
    ingest.run_all(spark, contract, root, out, log=RunLog.from_contract(spark, contract, "ingest"))
    infos = [r.message for r in read_logs(spark, f"{tmp_path}/logs").filter("level = 'INFO'").collect()]
    assert any("stream for things finished" in m for m in infos)
    metrics = read_metrics(spark, f"{tmp_path}/metrics").collect()
    counts = [m for m in metrics if m.metric_name == "files_in_folder"]
    assert {(m.dimensions["dataset"], m.value, m.dimensions["status"]) for m in counts} >= {("things", 1.0, "success")}
    assert sum(m.value for m in metrics if m.metric_name == "rows_in") == 40.0


def test_collection_lines_equal_whole_collections(spark, tmp_path):
    # FeatureCollection files laid out one feature per line, streamed as
    # text lines (split across tasks), give the same history as the same
    # collections parsed whole
    rng = random.Random(9)
    feats = [_feature(f"k{rng.randint(0, 3)}", s, rng.choice("ab")) for s in range(30)]
    lines = f"{tmp_path}/lines"
    os.makedirs(lines)
    for i in range(3):
        body = ",\n".join(json.dumps(f) for f in feats[i * 10:(i + 1) * 10])
        with open(f"{lines}/part{i}.geojson", "w") as fh:
            fh.write('{\n"type": "FeatureCollection",\n"name": "things",\n"features": [\n' + body + "\n]\n}\n")
    coll = f"{tmp_path}/coll"
    _write_docs(coll, [_doc(feats[i * 10:(i + 1) * 10]) for i in range(3)])
    a = ingest.EntryPaths(lines, f"{tmp_path}/la", f"{tmp_path}/ca")
    b = ingest.EntryPaths(coll, f"{tmp_path}/lb", f"{tmp_path}/cb")
    ingest.run_entry(spark, ENTRY, a, max_files=1, collection_lines=True)
    ingest.run_entry(spark, ENTRY, b, max_files=1)
    ha = ingest.history_from_landing(spark, ENTRY, a.landing, track=["v"])
    hb = ingest.history_from_landing(spark, ENTRY, b.landing, track=["v"])
    assert _history_rows(ha) == _history_rows(hb) and ha.count() > 0
    assert ingest.quarantine_from_landing(spark, a.landing).count() == 0


def test_processing_time_sequence_with_hot_ties(spark, tmp_path):
    # no business sequence: every row of a micro-batch shares the processing
    # time, so one key's rows in one file are one tie group. With a tiny
    # segment limit those groups are collapsed before the shuffle; the
    # history equals the plain plan's, and per key and batch the last row
    # of the file (by position) wins.
    entry = Entry(name="things", key="feature_id", folder="things", table_name="things",
                  properties=ENTRY.properties)
    feats = [[_feature(f"k{i % 2}", s, "ab"[(s + b) % 2]) for i, s in enumerate(range(b * 10, b * 10 + 10))]
             for b in range(3)]
    src = f"{tmp_path}/src"
    _write_docs(src, [_doc(f) for f in feats])
    paths = _paths(tmp_path, src)
    ingest.run_entry(spark, entry, paths, max_files=1)
    rows = ingest.read_landing(spark, paths.landing, 1)
    plain = flows.history(rows, entry, track=["v"], max_rows_per_segment=0)
    tied = flows.history(rows, entry, track=["v"], max_rows_per_segment=2)
    cols = ["feature_id", "seq", "v", "valid_from", "valid_to", "is_current"]
    a = sorted(map(tuple, plain.select(*cols).collect()))
    b = sorted(map(tuple, tied.select(*cols).collect()))
    assert a == b and len(a) > 0
    # the last feature of each key in each file carries the version's values
    last_seq = {(b, f"k{i}"): max(f["properties"]["seq"] for f in feats[b] if f["id"] == f"k{i}")
                for b in range(3) for i in range(2)}
    assert {r[1] for r in a} <= set(last_seq.values())


def test_rebuilt_changes_copy_continues_the_upkeep(spark, tmp_path):
    # compaction: the changes copy is rebuilt from the landing log while
    # the upkeep is stopped; the upkeep then continues on the new copy
    src = f"{tmp_path}/src"
    _write_docs(src, [_doc([_feature(f"k{i % 4}", 10 * i + b, "ab"[(i + b) % 2]) for i in range(8)])
                      for b in range(3)])
    paths = _paths(tmp_path, src)
    hist_path, ckpt = f"{tmp_path}/history", f"{tmp_path}/upkeep"
    ingest.run_entry(spark, ENTRY, paths, max_files=1)
    ingest.maintain_history(spark, ENTRY, paths.landing, hist_path, ckpt, n_buckets=4, track=["v"],
                            max_files=1).awaitTermination()
    old_dirs = [d for d in os.listdir(f"{hist_path}_changes/_bucket=0") if d.startswith("_batch=")]
    assert len(old_dirs) > 1
    compact = ingest.rebuild_changes(spark, ENTRY, paths.landing, f"{tmp_path}/changes_v2", n_buckets=4)
    assert all(os.listdir(f"{compact}/{b}") == ["_batch=-1"] for b in os.listdir(compact) if b.startswith("_bucket="))
    with open(f"{src}/late.json", "w") as fh:
        json.dump(_doc([_feature("k1", 15, "z")]), fh)
    ingest.run_entry(spark, ENTRY, paths, max_files=1)
    ingest.maintain_history(spark, ENTRY, paths.landing, hist_path, ckpt, n_buckets=4, track=["v"],
                            changes=compact).awaitTermination()
    maintained = ingest.read_history(spark, hist_path)
    expected = ingest.history_from_landing(spark, ENTRY, paths.landing, track=["v"])
    assert _history_rows(maintained) == _history_rows(expected)


def test_a_failing_stream_stops_the_others(spark, tmp_path):
    def boom(batch, batch_id):
        raise ValueError("bad batch")

    failing = spark.readStream.format("rate").option("rowsPerSecond", 5).load() \
        .writeStream.foreachBatch(boom).option("checkpointLocation", f"{tmp_path}/a").start()
    endless = spark.readStream.format("rate").option("rowsPerSecond", 5).load() \
        .writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/b") \
        .trigger(processingTime="1 second").start()
    with pytest.raises(Exception, match="bad batch"):
        ingest.await_queries(spark, [failing, endless], poll_seconds=0.5)
    assert not endless.isActive and not failing.isActive


def test_a_changeset_comes_back_whole_with_the_defaults(spark, tmp_path):
    from contract_lake.operators.features import tag_changes
    from contract_lake.sinks.files import write_changeset
    docs = spark.createDataFrame([([_feature(f"k{i}", i, "x")],) for i in range(10)],
                                 "features array<struct<id:string,geometry:struct<type:string,coordinates:array<double>>,"
                                 "properties:struct<v:string,n:int,seq:long>>>").coalesce(1)
    src = write_changeset(tag_changes(docs, "UPDATE"), f"{tmp_path}/changes")
    paths = _paths(tmp_path, src)
    ingest.run_entry(spark, ENTRY, paths)
    assert ingest.read_landing(spark, paths.landing, 1).count() == 10
    assert ingest.read_landing(spark, paths.landing, 0).count() == 0


def test_counts_of_many_batches_are_exact(spark, tmp_path):
    src = f"{tmp_path}/src"
    _write_docs(src, [_doc([_feature(f"k{i}", i, "x")]) for i in range(130)], pretty=False)
    paths = _paths(tmp_path, src)
    query = ingest.run_entry(spark, ENTRY, paths, max_files=1, wait=False)
    query.awaitTermination()
    rows = [r for r in ingest.batch_metrics(spark, paths.landing).collect() if r.metric_name == "rows_in"]
    assert len(rows) == 130 and sum(r.value for r in rows) == 130


def _upkeep(spark, paths, **how):
    ingest.maintain_history(spark, ENTRY, paths.landing, paths.history, paths.history_checkpoint, **{"n_buckets": 4, "track": ["v"]} | how).awaitTermination()


def test_an_emptied_bucket_shows_nothing_and_others_keep_their_files(spark, tmp_path):
    src = f"{tmp_path}/src"
    _write_docs(src, [_doc([_feature(f"k{i}", 1, "a") for i in range(12)])])
    paths = ingest.EntryPaths(src, f"{tmp_path}/landing", f"{tmp_path}/c", f"{tmp_path}/history", f"{tmp_path}/hc")
    ingest.run_entry(spark, ENTRY, paths)
    _upkeep(spark, paths, delete_when="v = 'gone'")
    bucket = {r.feature_id: r.b for r in ingest.read_history(spark, paths.history).select("feature_id", ingest.key_bucket("feature_id", 4).alias("b")).collect()}
    gone = [k for k in bucket if bucket[k] == bucket["k0"]]
    before = set(ingest.read_history(spark, paths.history).inputFiles())
    _write_docs(src, [])
    with open(f"{src}/late.json", "w") as fh:
        json.dump(_doc([_feature(k, 1, "gone") for k in gone]), fh)
    ingest.run_entry(spark, ENTRY, paths)
    _upkeep(spark, paths, delete_when="v = 'gone'")
    after = ingest.read_history(spark, paths.history)
    assert {r.feature_id for r in after.collect()} == set(bucket) - set(gone)
    assert set(after.inputFiles()) < before
    with pytest.raises(ValueError, match="4 key buckets"):
        _upkeep(spark, paths, n_buckets=8)


def test_every_gate_failure_is_kept(spark, tmp_path):
    from pyspark.sql import functions as F
    failures = spark.range(50).select(F.lit("d").alias("dataset"), F.concat(F.lit("f"), F.col("id")).alias("name"), F.lit(None).cast("string").alias("path"),
                                      F.lit("small_file").alias("check"), F.lit("x").alias("detail"))
    with pytest.raises(files.GateError, match="50 failures") as err:
        files.gate(failures, f"{tmp_path}/report")
    assert err.value.n_failures == 50 and len(err.value.failures) == 20
    assert spark.read.json(f"{tmp_path}/report").count() == 50


def test_a_property_added_later_shows_in_the_landing_log(spark, tmp_path):
    from dataclasses import replace
    src = f"{tmp_path}/src"
    paths = _paths(tmp_path, src)
    _write_docs(src, [_doc([_feature("a", 1, "x")])])
    ingest.run_entry(spark, replace(ENTRY, properties=ENTRY.properties[:2] + ENTRY.properties[3:]), paths)
    with open(f"{src}/late.json", "w") as fh:
        json.dump(_doc([_feature("b", 2, "y", n=7)]), fh)
    ingest.run_entry(spark, ENTRY, paths)
    rows = ingest.read_landing(spark, paths.landing, 1, ENTRY).orderBy("feature_id").collect()
    assert [(r.feature_id, r.n) for r in rows] == [("a", None), ("b", 7)]
    hist = ingest.history_from_landing(spark, ENTRY, paths.landing)
    assert "n" in hist.columns and hist.count() == 2
