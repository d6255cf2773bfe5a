"""Delivered files: how large, how many, and that neither changes their rows."""

import json
import os

from pyspark.sql import functions as F

from contract_lake.contract import read_schema
from contract_lake.operators.features import tag_changes
from contract_lake.plans import fixtures as fx
from contract_lake.sinks.files import write_changeset
from contract_lake.sources import documents as d


def events(spark, n):
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") / 2).alias("value"), F.lit('{"k": 1}').alias("props"))


def parts(path):
    return [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]


def test_changeset_files_are_bounded(spark, tmp_path):
    docs = tag_changes(fx.event_documents(events(spark, 3000), per_doc=64, props_as_object=True).select("features").coalesce(1), "UPDATE")
    files = parts(write_changeset(docs, str(tmp_path), file_bytes=20_000))
    assert len(files) > 10 and max(map(os.path.getsize, files)) <= 20_000
    found = [f["id"] for name in files for line in open(name) for f in json.loads(line)["features"]]
    assert sorted(map(int, found)) == list(range(3000))
    one = parts(write_changeset(docs, str(tmp_path / "one"), file_bytes=1))
    assert len(one) == docs.count()


def test_a_larger_table_comes_in_larger_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "LAYOUT_FILES", 4)
    ev, schema = events(spark, 1000), read_schema(fx.EVENTS_ENTRY.properties)
    for layout in ("one_line", "lines", "indented"):
        path = fx.write_event_layouts(ev, str(tmp_path / layout), (layout,), per_doc=16)
        assert 4 <= len(parts(path)) <= 5
        rows = d.stream_features(spark, path, schema, streaming=False).select("_corrupt_record", F.explode("features.id").alias("id")).collect()
        assert sorted(int(r.id) for r in rows) == list(range(1000)) and not any(r._corrupt_record for r in rows)
    assert fx.blocks_per_file(ev, 16) == 16 and fx.blocks_per_file(ev, 1024) == 1


def test_mixed_layouts_by_block_whatever_the_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "LAYOUT_FILES", 4)
    path = fx.write_event_layouts(events(spark, 1000).coalesce(1), str(tmp_path / "m"), ("pairs", "inline", "one_line", "indented"), per_doc=16)
    assert len(parts(path)) < 63
    rows = d.stream_collection_lines(spark, path, read_schema(fx.EVENTS_ENTRY.properties, feature_lines=True), streaming=False)
    good = sorted(int(r.id) for r in rows.where("feature IS NOT NULL").select("feature.id").collect())
    assert good == [i for i in range(1000) if i // 16 % 4 != 3]
    line = F.regexp_extract("_corrupt_record", r'^"id"\s*:\s*"([^"]*)"$', 1)
    assert sorted(int(r.i) for r in rows.select(line.alias("i")).where("i <> ''").collect()) == [i for i in range(1000) if i // 16 % 4 == 3]


def test_texts_that_hold_no_object_are_not_parsed_but_kept(spark):
    schema = read_schema(fx.EVENTS_ENTRY.properties)
    texts = spark.createDataFrame([('{"features": [{"id": "1"}]}\n{"features": []}',), ("no json",), ('"{x}"',), ("{",), ("  7",)], "value string")
    made = d.documents_of_text(texts, schema)
    assert {r._corrupt_record for r in made.collect()} - {None} == {"no json", "{x}", "{", "7"}


def test_a_text_is_trimmed_once(spark):
    """The trimmed text is what later steps and the filter read."""
    schema = read_schema(fx.EVENTS_ENTRY.properties)
    texts = spark.createDataFrame([('\ufeff \n{"features": [{"id": "1"}]} \n\n',), (" \t\n",), ("\ufeff[ ]\n",), (None,), (" x \n",)], "value string")
    made = d.documents_of_text(texts, schema)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(regexp_replace(value") == 1
    assert [(r.features[0].id if r.features else None, r._corrupt_record) for r in made.collect()] == [("1", None), (None, "x")]
