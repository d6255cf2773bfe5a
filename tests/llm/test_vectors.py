import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from contract_lake.llm import mtree, neighbours
from contract_lake.llm import queries as q

SCHEMA = "vec_id long, embedding array<float>, label int, score string, page int, rep int, cell int, tree string, n_links string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "s", 1, 2, 3, "t", "n") for i, v in vectors], SCHEMA).repartition(3)


def edge_vectors():
    chance = np.random.default_rng(3)
    base = chance.normal(size=(60, 16))
    out = [(100 * k, b.astype(np.float32).tolist()) for k, b in enumerate(base)]
    out += [(100 * k + 7, (b + 0.05 * chance.normal(size=16)).astype(np.float32).tolist()) for k, b in enumerate(base[:25])]
    out += [(9000 + i, base[3].astype(np.float32).tolist()) for i in range(40)] + [(9100, base[4].astype(np.float32).tolist())] * 3
    out += [(9200, None), (9300, []), (9400, [0.0] * 16), (9500, [float("nan")] + [1.0] * 15), (9600, [float("inf")] + [1.0] * 15),
            (9700, [None] + [1.0] * 15), (9800, [1.0, 2.0]), (9801, [2.0, 4.0]), (9900, [-0.0] * 16), (None, base[5].astype(np.float32).tolist())]
    return out


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def test_links_of_edges_against_brute_force(spark):
    rows = edge_vectors()
    df = frame(spark, rows)
    ok = [k for k, (i, v) in enumerate(rows) if i is not None and usable(v) and any(v)]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(np.array(rows[k][1], float)) for k in ok}
    near = {k: [j for j in ok if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= 0.9] for k in ok}
    label = {k: rows[k][0] for k in ok}
    for _ in rows:
        label = {k: min([label[k], *(label[j] for j in near[k])]) for k in ok}
    expected = sorted(((i, len(near.get(k, ())), label.get(k, i), i is not None and label.get(k, i) == i) for k, (i, _) in enumerate(rows)), key=str)
    for cell in (1024, 3):
        got = neighbours.near_duplicates(df, threshold=0.9, recall=0.999999, cell=cell)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected


def test_recall_and_precision_against_brute_force(spark):
    """Random pairs right at the threshold, the hardest to find."""
    chance = np.random.default_rng(1)
    base = chance.normal(size=(800, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    side = chance.normal(size=base.shape)
    side -= (side * base).sum(axis=1)[:, None] * base
    side /= np.linalg.norm(side, axis=1)[:, None]
    x = np.concatenate([base, 0.91 * base + math.sqrt(1 - 0.91 ** 2) * side]).astype(np.float32)
    got = np.array([r.n_links for r in neighbours.near_duplicates(frame(spark, list(enumerate(x.tolist())))).orderBy("vec_id").collect()])
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    true = (u @ u.T >= 0.9).sum(axis=1) - 1
    assert (got <= true).all() and got.sum() >= 0.9 * true.sum()


def test_estimates_are_unbiased_and_bounded():
    chance = np.random.default_rng(2)
    errors = []
    for k in range(40):
        x, y = chance.normal(size=(2, 200, 64))
        x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
        turned = x @ neighbours.rotation(64, k)
        factor = np.abs(turned).sum(axis=1) / 8
        cosine, width = neighbours.estimate(np.where(turned > 0, 1.0, -1.0), factor, y @ neighbours.rotation(64, k))
        error = cosine - x @ y.T
        assert (np.abs(error) <= width[:, None]).mean() > 0.999
        errors.append(error.mean())
    assert abs(np.mean(errors)) < 0.002


def best(rows, k, scale=1024):
    ok = [(i, np.floor(scale * np.array(v, float)).astype(np.int64)) for i, v in rows if i is not None and usable(v)]
    out = set()
    for i, v in ok:
        if i % 100 == 0:
            scores = sorted((-int(v @ w), j) for j, w in ok if j != i and len(w) == len(v))
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize(("tree_rows", "page", "block"), [(1024, 32, 1024), (8, 3, 2)])
def test_top_k_of_edges_against_brute_force(spark, tree_rows, page, block):
    rows = edge_vectors()
    got = mtree.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, k=10, tree_rows=tree_rows, page=page, query_block=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = [tuple(r) for r in got.collect()]
    assert set(found) == best(rows, 10) and len(found) >= len(set(found))


def test_tree_leaves_nodes_out_but_no_result():
    chance = np.random.default_rng(4)
    centers = chance.integers(-800, 800, (12, 8))
    v = (centers[chance.integers(0, 12, 3000)] + chance.integers(-20, 20, (3000, 8))).astype(np.int64)
    longest = float((v * v).sum(axis=1).max())
    points = mtree.lifted(v, longest)
    pages = mtree.pages_of(points, points[0], 16, 1)
    assert sorted(i for p in pages if p[5] is not None for i in p[5].tolist()) == list(range(3000))
    import pyarrow as pa
    table = pa.Table.from_batches([mtree.batch_of(mtree.PAGE, *zip(*[
        (1, n, parent, c, r, d, m if m is not None else [], v[m].ravel() if m is not None else [], a if a is not None else []) for n, parent, c, r, d, m, a in pages],
        strict=True))])
    tree = mtree.Tree(table, 8)
    looked = []
    real = tree.members
    tree.members = type("Counted", (), {"__getitem__": lambda _, k: looked.append(k) or real[k]})()
    scores = v @ v[5]
    order = np.lexsort((np.arange(3000), -scores))
    assert tree.search(5, v[5], longest, 10, np.inf) == [(int(scores[i]), int(i)) for i in order if i != 5][:10]
    assert len(looked) < len(pages) / 4


def test_empty(spark):
    none = frame(spark, [(1, None)]).where("vec_id = 2")
    assert mtree.top_k(none, F.col("vec_id") % 100 == 0).count() == 0
    assert neighbours.near_duplicates(none).count() == 0


def test_sql_of_top_k(spark):
    from tests.oracle_harness import compare
    assert compare(spark, "/root/testdata/sf0.001", ["op2_mtree_top_k"], verbose=False)["op2_mtree_top_k"]["ok"]
    assert set(q.oracle_sql()) <= set(q.queries())
