"""FeatureCollection files read line by line, split across tasks."""

import json

from pyspark.sql import functions as F

from contract_lake.contract import Property, read_schema
from contract_lake.sources.documents import (CORRUPT, read_features, stream_collection_lines, stream_feature_lines,
                                              stream_features)

PROPS = (Property("feature_id", "feature.id", "string"), Property("a", "feature.properties.a", "long"))
SCHEMA = read_schema(PROPS, feature_lines=True)


def _feature(i):
    return {"type": "Feature", "id": str(i), "properties": {"a": i, "b": "x"},
            "geometry": {"type": "Point", "coordinates": [1.5, 2.5]}}


def _line_layout(features):
    body = ",\n".join(json.dumps(f) for f in features)
    return ('{\n"type": "FeatureCollection",\n"name": "t",\n'
            '"crs": { "type": "name", "properties": { "name": "urn:ogc:def:crs:OGC:1.3:CRS84" } },\n'
            '"bbox": [0, 0, 1, 1],\n"features": [\n' + body + "\n]\n}\n")


def _read(spark, path):
    df = stream_collection_lines(spark, str(path), SCHEMA, streaming=False)
    return df.select(F.col("feature.id").alias("id"), F.col("feature.properties.a").alias("a"), CORRUPT)


def test_layouts_give_every_feature_once(spark, tmp_path):
    (tmp_path / "gdal.geojson").write_text(_line_layout([_feature(i) for i in range(5)]))
    compact = '{"type": "FeatureCollection", "features": [\n' + \
        ",\n".join(json.dumps(_feature(i)) for i in range(5, 8)) + "\n]}\n"
    (tmp_path / "compact.geojson").write_text(compact)
    one_line = json.dumps({"type": "FeatureCollection", "features": [_feature(8), _feature(9)]})
    (tmp_path / "one_line.geojson").write_text(one_line + "\n")
    (tmp_path / "empty.geojson").write_text('{"type": "FeatureCollection", "features": []}\n')
    rows = _read(spark, tmp_path).collect()
    assert sorted(int(r["id"]) for r in rows) == list(range(10))
    assert all(r[CORRUPT] is None for r in rows)
    assert {r["id"]: r["a"] for r in rows}["7"] == "7"


def test_other_layouts_are_quarantined_not_dropped(spark, tmp_path):
    # a feature printed over several lines and a malformed feature line
    pretty = json.dumps({"type": "FeatureCollection", "features": [_feature(1)]}, indent=2)
    (tmp_path / "pretty.geojson").write_text(pretty + "\n")
    (tmp_path / "bad.geojson").write_text('{"type": "FeatureCollection", "features": [\n{"id": "2", bad},\n]}\n')
    rows = _read(spark, tmp_path).collect()
    assert rows and all(r["id"] is None for r in rows)
    corrupt = [r[CORRUPT] for r in rows]
    assert '{"id": "2", bad}' in corrupt
    assert any(c.startswith('"properties"') for c in corrupt)


def test_large_collection_splits_across_tasks(spark, tmp_path):
    (tmp_path / "big.geojson").write_text(_line_layout([_feature(i) for i in range(20000)]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        df = _read(spark, tmp_path)
        assert df.rdd.getNumPartitions() > 4
        got = sorted((int(r["id"]), r["a"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = read_features(spark, str(tmp_path), read_schema(PROPS), multi_line=True) \
        .select(F.explode("features").alias("f")).select(F.col("f.id").alias("id"), F.col("f.properties.a").alias("a"))
    assert got == sorted((int(r["id"]), r["a"]) for r in whole.collect())
    assert len(got) == 20000


def test_byte_order_mark_and_crlf(spark, tmp_path):
    text = _line_layout([_feature(i) for i in range(3)]).replace("\n", "\r\n")
    (tmp_path / "bom.geojson").write_bytes(b"\xef\xbb\xbf" + text.encode("utf-8"))
    rows = _read(spark, tmp_path).collect()
    assert sorted(int(r["id"]) for r in rows) == [0, 1, 2]
    assert all(r[CORRUPT] is None for r in rows)


def test_compact_headers_and_closers(spark, tmp_path):
    # first feature on the header line, last feature carrying the closers
    f = [json.dumps(_feature(i)) for i in range(6)]
    (tmp_path / "a.geojson").write_text(
        '{"type": "FeatureCollection", "features": [' + f[0] + ",\n" + f[1] + ",\n" + f[2] + "]}\n")
    (tmp_path / "b.geojson").write_text(
        '{"type": "FeatureCollection",\n"features": [' + f[3] + ",\n" + f[4] + "]\n}\n")
    (tmp_path / "c.geojson").write_text(
        '{"type": "FeatureCollection", "features": [' + f[5] + "]}\n")     # whole collection on a line
    rows = _read(spark, tmp_path).collect()
    assert sorted(int(r["id"]) for r in rows) == list(range(6))
    assert all(r[CORRUPT] is None for r in rows)


def _id_rows(spark, path):
    rows = _read(spark, path).collect()
    return sorted(r["id"] for r in rows if r["id"] is not None), [r[CORRUPT] for r in rows if r[CORRUPT] is not None]


def test_header_line_with_a_feature_that_ends_like_a_collection(spark, tmp_path):
    first = dict(_feature(0), bbox=[0, 0, 1, 1])
    (tmp_path / "d.geojson").write_text(
        '{"type": "FeatureCollection", "features": [' + json.dumps(first) + ",\n"
        + json.dumps(_feature(1)) + "\n]}\n")
    assert _id_rows(spark, tmp_path) == (["0", "1"], [])


def test_several_features_on_a_line(spark, tmp_path):
    f = [json.dumps(_feature(i)) for i in range(5)]
    (tmp_path / "a.geojson").write_text('{"type": "FeatureCollection",\n"features": [\n' + f[0] + ", " + f[1] + ",\n" + f[2] + "\n]}\n")
    (tmp_path / "b.geojson").write_text('{"type": "FeatureCollection",\n"features": [' + f[3] + ", " + f[4] + "]\n}\n")
    assert _id_rows(spark, tmp_path) == (list("01234"), [])


def test_a_feature_over_several_member_lines_is_quarantined(spark, tmp_path):
    one = '{\n"id": "1",\n"properties": {"a": 1},\n"geometry": null\n}'
    (tmp_path / "a.geojson").write_text('{"type": "FeatureCollection", "features": [\n' + one + ",\n" + one + "\n]}\n")
    ids, corrupt = _id_rows(spark, tmp_path)
    assert ids == [] and len(corrupt) == 6
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [_feature(1)]}, indent=4))
    ids, corrupt = _id_rows(spark, tmp_path)
    assert ids == [] and any('"id": "1"' in c for c in corrupt)


def test_what_follows_a_value_is_noticed(spark, tmp_path):
    whole = json.dumps({"type": "FeatureCollection", "features": [_feature(1)]})
    (tmp_path / "a.geojson").write_text(whole[:-1] + ', "extra": [1]}\n' + json.dumps(_feature(2)) + " junk\n" + whole + whole + "\n")
    ids, corrupt = _id_rows(spark, tmp_path)
    assert ids == [] and len(corrupt) == 3


def _documents(spark, path, multi_line):
    rows = stream_features(spark, str(path), read_schema(PROPS), multi_line=multi_line, streaming=False).collect()
    ids = sorted((r["_doc"], [f["id"] for f in r["features"]]) for r in rows if r[CORRUPT] is None and r["features"] is not None)
    return ids, [r[CORRUPT] for r in rows if r[CORRUPT] is not None]


def test_whole_files_hold_documents_in_any_layout(spark, tmp_path):
    doc = lambda *i: {"type": "FeatureCollection", "features": [_feature(k) for k in i]}
    layouts = {"indented": json.dumps(doc(1, 2), indent=4), "lines": "\n".join(json.dumps(doc(k)) for k in range(10)) + "\n",
               "array": json.dumps([doc(1), doc(2)], indent=1), "empty": json.dumps(doc()), "blank": " \n", "none": "[]"}
    expected = {"indented": [(0, ["1", "2"])], "lines": [(k, [str(k)]) for k in range(10)], "array": [(0, ["1"]), (1, ["2"])],
                "empty": [(0, [])], "blank": [], "none": []}
    for name, text in layouts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text("\ufeff" + text)
        assert _documents(spark, tmp_path / name, True) == (expected[name], []), name
    for name, text in {"junk": json.dumps(doc(1)) + " junk", "two": json.dumps(doc(1)) + json.dumps(doc(2)), "broken": "{oops",
                       "number": "17", "type": '{"features":5}'}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(text)
        assert _documents(spark, tmp_path / name, True) == ([], [text]), name
        assert _documents(spark, tmp_path / name, False) == ([], [text]), name
    assert _documents(spark, tmp_path / "lines", False) == ([(0, [str(k)]) for k in range(10)], [])


def test_lines_keep_their_order_across_splits(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(_feature(i)) for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        rows = stream_feature_lines(spark, str(tmp_path), SCHEMA, streaming=False) \
            .orderBy("_block_start", "_line", "_doc").select("feature.id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [int(r.id) for r in rows] == list(range(5000))
