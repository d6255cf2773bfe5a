"""op11: hard negatives against brute force in Python's whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contract_lake.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, anchor long, positive string, cell int, block string"


def brute(rows, is_anchor, k=5, n=3, scale=256):
    whole = sorted({(i, lab, tuple(math.floor(scale * x) for x in v)) for i, v, lab in rows
                    if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, lab, v in whole:
        if not is_anchor(i):
            continue
        score = lambda w: max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w, strict=True))))
        others = sorted((-score(w), j, other) for j, other, w in whole if j != i and len(w) == len(v))
        for p, j, other in [x for x in others if x[2] == lab][:k]:
            fits = [(s, q) for s, q, o in others if o != lab and 50 * -p <= 100 * -s <= 95 * -p]
            out += [(i, j, rank, q, -p, -s) for rank, (s, q) in enumerate(fits[:n], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_packed_products(seed):
    chance = random.Random(seed)
    size = [1, 300, 1 << 20, 1 << 40, 1 << 90, 7][seed]
    a, c = ([[chance.randint(-size, size) for _ in range(9)] for _ in range(n)] for n in (5, 131))
    kind = np.int64 if size < 1 << 60 else object
    found = negatives.packed_products(np.array(a, kind), np.array(c, kind))
    assert [[int(x) for x in row] for row in found] == [[sum(x * y for x, y in zip(p, q, strict=True)) for q in c] for p in a]


def test_packed_products_of_nothing():
    assert negatives.packed_products(np.zeros((0, 4), np.int64), np.ones((3, 4), np.int64)).shape == (0, 3)


def test_the_best_are_kept_with_ties():
    chance = random.Random(2)
    best, lists = negatives.Best(7, 4), [[] for _ in range(7)]
    for at in range(0, 600, 60):
        ids = np.array(chance.sample(range(10_000), 60))
        score = np.array([[chance.randint(-3, 3) for _ in ids] for _ in lists])
        allowed = np.array([[chance.random() < 0.5 for _ in ids] for _ in lists])
        best.add(score, allowed, ids)
        for k, row in enumerate(lists):
            row += [(-s, i) for s, i, ok in zip(score[k], ids, allowed[k], strict=True) if ok]
    at, score, ids = best.result()
    assert list(zip(at, -score, ids, strict=True)) == [(k, *x) for k, row in enumerate(lists) for x in sorted(row)[:4]]


def rows_of(seed):
    chance = random.Random(seed)
    centers = [[chance.gauss(0, 0.3) for _ in range(8)] for _ in range(4)]
    rows = [(i, [x + chance.gauss(0, 0.05) for x in centers[i % 4]], chance.randint(0, 3)) for i in range(400)]
    rows += [(400, rows[0][1], 2), (401, rows[0][1], 2), (402, rows[0][1], 1)]  # ties
    rows += [rows[50]] * 3 + [(50, rows[51][1], 1), (60, rows[60][1], None), (None, rows[1][1], 1)]
    rows += [(500, None, 1), (510, [], 1), (520, [0.1] * 7 + [None], 1), (530, [0.1] * 7 + [math.nan], 1), (540, [0.1] * 7 + [math.inf], 1)]
    rows += [(550, [0.2, 0.3], 1), (551, [0.2, 0.3], 1), (552, [0.2, 0.2], 0), (560, [0.0] * 8, 1)]
    rows += [(600, [1e7] * 8, 1), (601, [1e7] * 7 + [2e7], 1), (602, [8e6] * 8, 0), (610, [1e12] * 8, 2), (611, [9e11] * 8, 0), (612, [9e11] * 8, 2), (620, [1e300] * 8, 2)]
    return rows


@pytest.mark.parametrize("blocks", [{"anchor_block": 7, "chunk": 60}, {}])
def test_against_brute_force(spark, blocks):
    rows = rows_of(1)
    df = spark.createDataFrame([(i, v, lab, 1, "p", 2, "b") for i, v, lab in rows], SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    expected = brute([(i, v, (lab + 1) % 10 if lab is not None and i is not None and i % 7 == 0 else lab) for i, v, lab in rows], lambda i: i % 10 == 0)
    found = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, label, **blocks)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert expected and sorted(map(tuple, found.collect())) == expected


def test_no_vectors(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0
