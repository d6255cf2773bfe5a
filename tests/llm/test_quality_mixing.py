import tracemalloc

import numpy as np
import pytest

from contract_lake.llm import mixing, quality
from contract_lake.llm import queries as q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = q.op5_quality_pu(spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    bad, good = ([r.score for r in held if r.quality == k] for k in (0, 1))
    assert np.mean([b < g for b in bad for g in good]) > 0.98
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) for r in rows)


def test_held_out_labels_are_never_used(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    one, two = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(one.weights, two.weights) and one.prior == two.prior


def test_scores_of_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in (40, 41, 42, 43, 44, 45, 30)] + [(31, 0, 0, "x"), (None, 1, 0, "x"), (20, None, 0, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    scorer = quality.train(edge_docs, labels)
    rows = quality.scored(edge_docs, scorer).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 60}) == 1
    assert quality.accepted(edge_docs, scorer).columns == edge_docs.columns
    assert quality.scored(no_docs, scorer).count() == 0
    nothing = quality.train(no_docs, labels)
    assert [r.predicted for r in quality.scored(edge_docs, nothing).collect()] == [1] * edge_docs.count()
    assert quality.accepted(edge_docs, nothing).count() == edge_docs.count()


def test_training_sample_stays_off_the_driver(spark):
    chance = np.random.default_rng(5)
    rows = [(i, "".join(chance.choice(list("abc d\n" if i % 2 else "xyz 1,"), 60)), i % 2) for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(5)
    first = quality.train(docs.limit(10), docs)  # what is loaded once
    tracemalloc.start()
    scorer = quality.train(docs, docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert first.prior and peak < 4 << 20
    known = docs.where(~quality.held_out())
    p, u = (quality._features_of(docs, x.select("doc_id")) for x in (known.where("quality = 1"), known))
    want = quality.fit(p, u, quality.estimated_prior(p, u))
    assert scorer.mean.dtype == want.mean.dtype and np.allclose(scorer.mean, want.mean) and np.allclose(scorer.scale, want.scale)
    assert np.allclose(scorer.weights, want.weights) and np.isclose(scorer.bias, want.bias) and np.isclose(scorer.prior, want.prior)


def test_non_negative_risk_separates_from_positives_and_unlabelled_alone():
    chance = np.random.default_rng(1)
    good, bad = chance.normal(1, 1, (600, 5)), chance.normal(-1, 1, (300, 5))
    scorer = quality.fit(good[:200], np.concatenate([good[200:], bad]), prior=400 / 700)
    assert (scorer(good) >= 0.5).mean() > 0.9 and (scorer(bad) < 0.5).mean() > 0.9


@pytest.mark.parametrize("weights", [[1], [1, 1], [5, 3, 2], [0.7, 0.2, 0.05, 0.05], list(range(1, 30))])
def test_period_meets_windows_and_keeps_lag_under_one(weights):
    rate = mixing.rates([float(w) for w in weights], 300)
    assert sum(rate) == 300 and min(rate) >= 1
    assert all(abs(a - w / sum(weights) * 300) < 1 or a == 1 for a, w in zip(rate, weights, strict=True))
    slots = mixing.one_period(rate)
    assert sorted(s for at in slots for s in at) == list(range(300))
    for a, at in zip(rate, slots, strict=True):
        for t in range(301):
            assert abs(sum(s < t for s in at) - t * a / 300) < 1


def test_phases_use_every_block_once():
    blocks, weights = [50, 7, 120, 1], [1.0, 2.0, 1.0, 1.0]
    taken = {}
    for p in mixing.phases(blocks, weights, 60):
        for k in range(p["n"]):
            slot = p["start"] + k // p["rate"] * 60 + p["slots"][k % p["rate"]]
            assert slot not in taken
            taken[slot] = (p["source"], p["first"] + k)
    assert sorted(taken) == list(range(178))
    assert sorted(taken.values()) == [(s, k) for s, n in enumerate(blocks) for k in range(n)]
    for s in range(4):  # blocks of a source in their order
        assert [k for _, (x, k) in sorted(taken.items()) if x == s] == list(range(blocks[s]))


def test_every_row_gets_its_slot(edge_docs, no_docs):
    out = mixing.slots_of(edge_docs, block_bytes=500, period=30)
    rows = out.collect()
    assert len(rows) == edge_docs.count()
    assert all(r.release <= r.slot < r.deadline for r in rows)
    for source in {r.row.source for r in rows}:
        own = sorted((r for r in rows if r.row.source == source), key=lambda r: r.order_key.byte)
        at = 0
        for r in own:  # bytes counted without a gap, blocks by first byte, slots in order
            assert r.order_key.byte == at and r.block == at // 500
            at += r.n_bytes
        assert [r.slot for r in own] == sorted(r.slot for r in own)
    assert len({(r.slot, r.row.source) for r in rows}) == len({r.slot for r in rows})
    mixed = mixing.mixed(edge_docs, block_bytes=500)
    assert mixed.columns == edge_docs.columns and mixed.count() == edge_docs.count()
    assert mixing.mixed(no_docs).count() == 0 and mixing.schedule(no_docs).count() == 0
    assert set(edge_docs.columns) <= set(mixing.schedule(edge_docs).columns)


def test_weights_are_checked(edge_docs):
    with pytest.raises(ValueError, match="no positive weight"):
        mixing.slots_of(edge_docs, weights={"a": 1.0})
    with pytest.raises(ValueError, match="sources"):
        mixing.slots_of(edge_docs, max_sources=1)


def test_share_of_bytes_follows_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.slots_of(docs, block_bytes=4096).where("phase = 0").collect()
    names = sorted({r.row.source for r in rows})
    total = {r.source: r.b ** 0.5 for r in docs.groupBy("source").agg(mixing.F.sum(mixing.F.octet_length("text")).alias("b")).collect()}
    last = max(r.slot for r in rows)
    for n in names:
        own = [r for r in rows if r.row.source == n]  # a long document reaches into blocks in which none begins
        want = total[n] / sum(total.values()) * (last + 1)
        slack = 1 + 0.0005 * (last + 1)
        assert max(r.block for r in own) - slack <= want <= max((r.order_key.byte + r.n_bytes) // 4096 for r in own) + 1 + slack
