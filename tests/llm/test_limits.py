"""Values, words, languages and labels beyond what is usual."""

import numpy as np
import pytest

from contract_lake.llm import langcrf, mtree, neighbours, quality

SF = "/root/testdata/sf0.01"
BIG = [(1, [1e-200, 0.0]), (2, [1e-200, 1e-201]), (3, [1e200, 0.0]), (4, [1e7, 1e7]), (5, [-1e300, 0.0]), (6, [3.0, 1e15]), (7, [2.0, 1e15]),
       (8, [5e-324, 0.0]), (9, [1.5e7, -2.5e7])]


def test_extreme_components_link_and_score(spark):
    df = spark.createDataFrame(BIG, "vec_id long, embedding array<double>")
    links = {r.vec_id: r.n_links for r in neighbours.near_duplicates(df).collect()}
    assert links == {1: 3, 2: 3, 3: 3, 4: 0, 5: 0, 6: 1, 7: 1, 8: 3, 9: 0}
    end = np.iinfo(np.int64)
    whole = {i: [int(min(max(np.floor(1024 * x), -2.0 ** 63), 2.0 ** 63)) for x in v] for i, v in BIG}
    whole = {i: [min(max(x, end.min), end.max) for x in v] for i, v in whole.items()}
    got = mtree.top_k(df, mtree.F.lit(True), k=3).orderBy("query_id", "rank").collect()
    want = []
    for i, a in whole.items():
        best = sorted((-min(max(sum(x * y for x, y in zip(a, b, strict=True)), end.min), end.max), j) for j, b in whole.items() if j != i)[:3]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert [tuple(r) for r in got] == want


def test_every_letter_of_a_long_word_counts():
    words = ["a" * 30 + middle + "b" * 30 for middle in ("q" * 30, "z" * 30)]
    found = [langcrf.word_features(langcrf.WORD.findall(w))[0] for w in words]
    assert not np.array_equal(*found)
    assert "".join(langcrf.WORD.findall("語" * 1000)) == "語" * 1000
    assert not np.array_equal(langcrf.word_features([words[0]])[0], langcrf.word_features([words[1]])[0])


def test_transitions_expected_as_enumerated_pairs():
    chance = np.random.default_rng(2)
    emission, step = chance.random((7, 3)) + 0.1, chance.random((3, 3)) + 0.1
    _, expected = langcrf.forward_backward(emission, np.array([0, 4]), np.array([4, 3]), step, pairs=True)
    assert np.isclose(expected.sum(), 5)


def test_more_languages_than_two_hundred(spark):
    rows = [(4 * k, f"l{k % 230}", f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} " * 5) for k in range(460)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    tagger = langcrf.train(docs, per_language=1, windows=1, words=4)
    assert len(tagger.languages) > 200
    few = langcrf.train(docs, per_language=1, windows=1, words=4, max_languages=5)
    assert len(few.languages) == 5
    assert langcrf.predictions(docs, few).count() == 460


@pytest.mark.parametrize("share", [0.2, 0.5, 0.9])
def test_prior_from_positives_and_unlabelled(share):
    chance = np.random.default_rng(4)
    n = int(2000 * share)
    positive = chance.normal(2, 1, (1000, 3))
    unlabelled = np.concatenate([chance.normal(2, 1, (n, 3)), chance.normal(-2, 1, (2000 - n, 3))])
    assert abs(quality.estimated_prior(positive, unlabelled) - share) < 0.08


def test_positives_alone_do_not_accept_everything(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    scorer = quality.train(docs, labels.where("quality = 1"))
    both = quality.train(docs, labels)
    assert 0.7 < scorer.prior < 0.97 and np.array_equal(scorer.weights, both.weights)
    rows = quality.scored(docs, scorer).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_one_row_a_doc_id_is_learnt_from(spark):
    docs = spark.createDataFrame([(3, f"text number {k} of many") for k in range(500)] + [(6, None)], "doc_id long, text string")
    ids = spark.createDataFrame([(3,), (6,)], "doc_id long")
    found = quality._features_of(docs, ids)
    assert found.shape == (2, quality.N_FEATURES)
    assert np.array_equal(found[0], quality.features(np.frombuffer(b"text number 0 of many", np.uint8)))


def test_risk_and_slopes_against_a_plain_version():
    chance = np.random.default_rng(6)
    zp, zu = chance.normal(1, 1, 6), chance.normal(-3, 1, 9)
    s = lambda z: 1 / (1 + np.exp(-z))

    def plain(zp, zu, prior):
        positive = prior * sum(np.log(1 + np.exp(-z)) for z in zp) / len(zp)
        negative = sum(np.log(1 + np.exp(z)) for z in zu) / len(zu) - prior * sum(np.log(1 + np.exp(z)) for z in zp) / len(zp)
        return positive, negative

    for prior in (0.02, 0.9):
        value = plain(zp, zu, prior)
        assert np.allclose(quality.risk(s(zp), s(zu), prior), value)
        target = (lambda p, u: sum(plain(p, u, prior))) if value[1] >= 0 else (lambda p, u: -plain(p, u, prior)[1])  # noqa: B023
        dp, du = quality.risk_slopes(s(zp), s(zu), prior)
        for z, d, first in ((zp, dp, True), (zu, du, False)):
            for i in range(len(z)):
                up, down = z.copy(), z.copy()
                up[i] += 1e-6
                down[i] -= 1e-6
                slope = (target(up, zu) - target(down, zu)) if first else (target(zp, up) - target(zp, down))
                assert np.isclose(d[i], slope / 2e-6, atol=1e-7)
