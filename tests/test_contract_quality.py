"""Contract parsing, typed projection, validity rules and schema checks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract_lake.functions.columns import text_try_cast
from pyspark.sql import types as T

from contract_lake.contract import Property, load_contract, read_schema
from contract_lake.functions.columns import validity_rule
from contract_lake.operators import quality
from contract_lake.operators.features import explode_features, flatten_features, tag_changes
from contract_lake.operators.projection import project_by_contract

CONTRACT = """
servers:
  development: {log_name: ops, log_volume: /logs, metric_volume: /metrics, log_level: warning}
schema:
  - name: parcels
    key: feature_id
    folder: parcels
    table_name: parcels_history
    properties:
      - {name: feature_id, sourcePath: feature.id}
      - {name: area, sourcePath: feature.properties.area, physicalType: double}
      - {name: n, sourcePath: feature.properties.n, physicalType: LONG}
      - {name: when, sourcePath: feature.properties.when, physicalType: timestamp}
      - {name: kind, sourcePath: feature.properties.kind, physicalType: null}
      - {name: nothing, physicalType: integer}
"""


def test_load_contract_and_types():
    c = load_contract(CONTRACT)
    e = c.entry("parcels")
    types = {p.name: p.spark_type() for p in e.properties}
    assert types["feature_id"] == T.StringType()          # missing -> string
    assert types["n"] == T.LongType()                     # case-insensitive
    assert types["when"] == T.StringType()                # unknown -> string (T28)
    assert types["kind"] == T.StringType()                # null -> string (T14)
    assert e.properties[3].spark_type(extended_types=True) == T.TimestampType()
    assert c.server()["log_level"] == "warning"


def test_read_schema_is_string_leaves_and_parent_wins():
    props = [Property("a", "feature.properties.a", "double"),
             Property("g", "feature.geometry", "string"),
             Property("gt", "feature.geometry.type", "string"),
             Property("top", "source_name", "string")]
    s = read_schema(props)
    feat = s["features"].dataType.elementType
    assert feat["properties"].dataType["a"].dataType == T.StringType()
    assert feat["geometry"].dataType == T.StringType()    # parent read as text
    assert s["source_name"].dataType == T.StringType()  # top-level path


def _docs(spark, text):
    import json
    rows = [(json.dumps(d),) for d in text]
    raw = spark.createDataFrame(rows, "j string")
    schema = read_schema(load_contract(CONTRACT).entry("parcels").properties)
    return raw.select(F.from_json("j", schema).alias("d")).select("d.*")


def test_projection_text_leaves_casts_and_failures(spark):
    docs = _docs(spark, [{"features": [
        {"id": "1", "properties": {"area": "1.50", "n": "7.9", "kind": {"a": 1}}},
        {"id": "2", "properties": {"area": 2, "n": "12345678901234567890"}},
        {"id": "3", "properties": {"area": "abc", "n": 4}}]}])
    entry = load_contract(CONTRACT).entry("parcels")
    out = project_by_contract(explode_features(docs), entry.properties, with_cast_failures=True)
    rows = {r.feature_id: r for r in out.collect()}
    assert rows["1"].area == 1.5 and rows["1"].n is None and rows["1"]._cast_failures == ["n"]  # T27
    assert rows["1"].kind == '{"a":1}'                                                            # T10
    assert rows["2"].n is None and rows["2"]._cast_failures == ["n"]                              # overflow
    assert rows["3"].area is None and rows["3"]._cast_failures == ["area"]                        # T9
    assert rows["3"].nothing is None                                                              # P5
    assert out.schema["nothing"].dataType == T.IntegerType()


def test_raw_text_is_kept_for_string_properties(spark, tmp_path):
    # the file reader keeps a number's text as written when the leaf is a string
    from contract_lake.sources.documents import read_features
    (tmp_path / "a.json").write_text('{"features": [{"properties": {"x": 1.50, "y": 12345678901234567890}}]}')
    props = [Property("x", "feature.properties.x", "string"), Property("y", "feature.properties.y", "string")]
    docs = read_features(spark, str(tmp_path), read_schema(props))
    row = project_by_contract(explode_features(docs), props).first()
    assert (row.x, row.y) == ("1.50", "12345678901234567890")


def test_absent_source_path_is_null(spark):
    # A path absent from the data is NULL, not an analysis error
    docs = _docs(spark, [{"features": [{"id": "1", "properties": {}}]}])
    props = [Property("zz", "feature.properties.zz", "integer")]
    assert project_by_contract(explode_features(docs), props).first().zz is None


def test_explode_drops_empty_and_null_arrays(spark):
    docs = _docs(spark, [{"features": []}, {}, {"features": [{"id": "9"}]}])
    assert explode_features(docs).count() == 1
    assert explode_features(docs, outer=True).count() == 3


def test_flatten_and_tag(spark):
    raw = spark.createDataFrame([('{"features": [{"id": "1", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]},'
                                  ' "properties": {"a": 1, "b": "x"}}]}',)], "j string")
    docs = spark.read.json(raw.rdd.map(lambda r: r.j))
    flat = flatten_features(docs).first().asDict()
    assert flat["type"] == "Point" and flat["coordinates"] == [1.0, 2.0] and flat["b"] == "x"
    tagged = explode_features(tag_changes(docs, "INSERT")).select("feature.properties.__change__").first()[0]
    assert tagged == "INSERT"


def test_blank_key_rule(spark):
    # NULL, '' and spaces fail; a tab and a no-break space pass
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("\t",), (" ",), ("a",)], "feature_id string")
    rule = validity_rule("feature_id")
    passed = {r.feature_id for r in quality.expect_or_drop(df, "valid_id", rule).collect()}
    assert passed == {"\t", " ", "a"}
    bad = quality.quarantine_rows(df, rule, "valid_id").collect()
    assert len(bad) == 3 and bad[0].validation_rule_failed == rule and bad[0].validation_rule_name == "valid_id"


def test_split_is_exact_partition_with_null_rules(spark):
    # A rule evaluating to NULL lands in quarantine, not in neither branch
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, x int")
    rules = [quality.Rule("positive", "x > 0")]
    good, bad = quality.split(df, rules)
    assert {r.id for r in good.collect()} == {1}
    assert {r.id for r in bad.collect()} == {2, 3}
    counts = quality.split_counts(df, rules).first()
    assert (counts.n_in, counts.n_pass, counts.n_quarantine) == (3, 1, 2)


def test_contract_rules_and_check_rows(spark):
    props = [Property("c", "c", "integer"), Property("s", "s", "string")]
    spec = {"c": {"required": True, "min": 0, "max": 10, "check_type": True},
            "s": {"values": ["a", "b"], "pattern": "^[a-z]$", "criticality": "warn"}}
    rules = quality.contract_rules(props, spec)
    # rules run on typed contract columns; the type rule runs on the raw text
    df = spark.createDataFrame([(5, "a"), (None, "Z"), (11, None)], "c int, s string")
    out = {(r.c, r.s): (r._errors, r._warnings) for r in quality.check_rows(df, rules).collect()}
    assert out[(5, "a")] == ([], [])
    assert out[(None, "Z")] == (["c_required"], ["s_allowed", "s_pattern"])
    assert out[(11, None)] == (["c_range"], [])
    raw = spark.createDataFrame([("5",), ("x",)], "c string")
    typed = {r.c: r._errors for r in quality.check_rows(raw, [quality.castable("c", T.IntegerType())]).collect()}
    assert typed == {"5": [], "x": ["c_type"]}


def test_check_schema_reports_missing_extra_and_failures(spark):
    df = spark.createDataFrame([("1", "t"), ("x", "maybe")], "a string, extra string")
    props = [Property("a", "a", "long"), Property("b", "b", "string"), Property("extra2", "x", "decimal")]
    rows = {r.column: r for r in quality.check_schema(df, props).collect()}
    assert rows["a"].issue == "cast_failures" and rows["a"].n_cast_failed == 1
    assert rows["b"].issue == "missing"
    assert rows["extra"].issue == "extra"


def test_contract_errors_name_the_culprit():
    import pytest
    from contract_lake.contract import ContractError, contract_from_dict
    with pytest.raises(ContractError, match="parcels"):
        contract_from_dict({"schema": [{"name": "parcels", "properties": []}]})          # no key
    with pytest.raises(ContractError, match="parcels.*without a name"):
        contract_from_dict({"schema": [{"name": "parcels", "key": "k", "properties": [{"sourcePath": "x"}]}]})


def test_expect_or_drop_observes_counts(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([("a",), (None,), ("  ",), ("b",)], "feature_id string")
    obs = Observation("valid_id")
    kept = quality.expect_or_drop(df, "valid_id", validity_rule("feature_id"), observation=obs)
    assert kept.count() == 2
    assert obs.get == {"rows": 4, "passed": 2}


def test_unique_failures(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "id int, k string")
    assert sorted(r.id for r in quality.unique_failures(df, ["k"]).collect()) == [1, 2]


def test_text_try_cast_equals_try_cast(spark):
    # the exception-free guard answers exactly as try_cast does
    from hypothesis import given, settings, strategies as st, HealthCheck
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from contract_lake.functions.columns import text_try_cast
    fixed = ["7", " 7 ", "\t7\n", "+7", "-7", "1.0", "7e0", " 7", "　7", "99999999999",
             "9223372036854775808", "07", "", " ", "-", "+-1", "T", "yes", "O", " true ", " true",
             "TRUE", "1", "2", "on", "No", "f\x01", None]
    alphabet = st.sampled_from(list("0123456789+-. \t\x01 aeflnorstuyTFYN"))
    extra = st.lists(st.text(alphabet, max_size=6), min_size=1, max_size=40)

    @settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(extra)
    def check(more):
        df = spark.createDataFrame([(v,) for v in fixed + more], "s string")
        for target in (T.IntegerType(), T.LongType(), T.ShortType(), T.BooleanType()):
            plain = F.col("s").try_cast(target)
            if target != T.BooleanType():  # whole numbers in another form are read as well
                number = F.when(F.col("s").rlike("[.eE]") & ~F.col("s").rlike("[a-df-zA-DF-Z]"), F.col("s").try_cast("decimal(38,18)"))
                plain = F.coalesce(plain, F.when(number == number.try_cast(target), number.try_cast(target)))
            bad = df.filter(~text_try_cast(F.col("s"), target).eqNullSafe(plain))
            assert bad.count() == 0, (target, bad.collect())
    check()


def test_whole_and_truncated_numbers(spark):
    df = spark.createDataFrame([("7",), ("7.0",), ("7e2",), ("-7.9",), ("7.9",), (" 8.0 ",), ("1e30",), (".5",), ("x.0",), ("1.5e1",), ("",), (None,)], "s string")
    got = df.select(text_try_cast(F.col("s"), T.IntegerType()).alias("a"), text_try_cast(F.col("s"), T.IntegerType(), truncate=True).alias("b")).collect()
    assert [r.a for r in got] == [7, 7, 700, None, None, 8, None, None, None, 15, None, None]
    assert [r.b for r in got] == [7, 7, 700, -7, 7, 8, None, 0, None, 15, None, None]
