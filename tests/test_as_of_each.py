"""C7 for a table of times: the sweep against a loop over versions."""

import random

import pytest

from contract_lake.operators.cdc import as_of_each, plan_segments


def found_by_loop(versions, key, at):
    fits = [v for v in versions if key is not None and at is not None and v[0] == key and v[1] <= at and (v[2] is None or at < v[2])]
    return max(fits, key=lambda v: v[1])[3] if fits else None


@pytest.mark.parametrize("limit", [2_000_000, 20])
def test_probes_find_the_version_in_force(spark, limit):
    chance = random.Random(limit)
    versions = []
    for key in ("hot", "b", "c"):
        starts = sorted(chance.sample(range(1000), 150 if key == "hot" else 5))
        ends = [*starts[1:], None]
        # gaps after some, as deletes leave them
        versions += [(key, s, e if e is None or chance.random() < 0.7 else max(s + 1, e - 3), f"{key}{s}") for s, e in zip(starts, ends, strict=True)]
    probes = [(i, chance.choice(["hot", "hot", "b", "c", "unknown", None]), chance.choice([None, *range(-5, 1010)])) for i in range(400)]
    history = spark.createDataFrame(versions, "key string, valid_from long, valid_to long, name string")
    asked = spark.createDataFrame(probes, "probe int, key string, at long")
    out = as_of_each(history, asked, "key", "at", max_rows_per_segment=limit)
    assert out.columns == ["probe", "key", "at", "version_valid_from", "version_valid_to", "version_name"]
    got = {r.probe: (r.key, r["at"], r.version_name) for r in out.collect()}
    assert got == {i: (k, t, found_by_loop(versions, k, t)) for i, k, t in probes}


def test_segments_are_used(spark):
    rows = spark.range(400).selectExpr("'hot' AS key", "id AS _t")
    assert plan_segments(rows, ["key"], "_t", 20).hot_plan is not None


def test_no_versions_and_no_probes(spark):
    history = spark.createDataFrame([], "key string, valid_from long, valid_to long")
    probes = spark.createDataFrame([(1, "a", 5)], "probe int, key string, at long")
    assert [tuple(r) for r in as_of_each(history, probes, "key", "at").collect()] == [(1, "a", 5, None, None)]
    assert as_of_each(history, probes.limit(0), "key", "at").count() == 0
