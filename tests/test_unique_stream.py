"""Q5 ``unique`` in the stream against a plain count, over restarts and a
replayed batch."""

import os
from collections import defaultdict

from contract_lake.streaming import unique

SCHEMA = "k string, n long"


def deliver(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def follow(spark, root, keys=("k",)):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    unique.track_unique(stream, list(keys), "n", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return {r.k: (r.n_copies, r.first_seen) for r in unique.read_repeated(spark, list(keys), f"{root}/out").collect()}


def plain(rows):
    seen = defaultdict(list)
    for k, n in rows:
        if k is not None:
            seen[k].append(n)
    return {k: (len(v), min(v)) for k, v in seen.items() if len(v) > 1}


def test_over_batches_restarts_and_a_replay(spark, tmp_path):
    root = str(tmp_path)
    setting = spark.conf.get(unique.STATE_STORE, None)
    a = [("x", 5), ("y", 1), (None, 2), (None, 3), ("", 4)]
    b = [("x", 2), ("z", 6), ("z", 6)] + [("hot", 100 + i) for i in range(500)]
    deliver(spark, f"{root}/in", "a", a)
    assert follow(spark, root) == {}
    deliver(spark, f"{root}/in", "b", b)
    assert follow(spark, root) == plain(a + b)
    # the last batch's commit is lost: it runs again, from the state before it
    last = max(int(f) for f in os.listdir(f"{root}/checkpoint/commits") if f.isdigit())
    for f in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{root}/checkpoint/commits/{f}"):
            os.remove(f"{root}/checkpoint/commits/{f}")
    assert follow(spark, root) == plain(a + b)
    c = [("y", 0), ("", 9), ("x", 1)]
    deliver(spark, f"{root}/in", "c", c)
    repeated = follow(spark, root)
    assert repeated == plain(a + b + c)
    assert spark.conf.get(unique.STATE_STORE, None) == setting
    rows = spark.createDataFrame(a + b + c, SCHEMA)
    found = unique.repeated_rows(rows, unique.read_repeated(spark, ["k"], f"{root}/out"), ["k"], "n").collect()
    assert len(found) == sum(n for n, _ in repeated.values())
    assert sorted(r.k for r in found if r.is_first) == sorted(["x", "y", "", "hot", "z", "z"])


def test_empty_stream(spark, tmp_path):
    root = str(tmp_path)
    deliver(spark, f"{root}/in", "a", [])
    deliver(spark, f"{root}/in", "b", [(None, 1)])
    assert follow(spark, root) == {}
