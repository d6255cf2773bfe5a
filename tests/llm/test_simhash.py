import numpy as np
import pytest
import xxhash

from contract_lake.llm import simhash
from contract_lake.llm.common import connected_components, spanning_links
from tests.llm.conftest import edge_rows


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_words_are_lowered_and_split_as_ascii():
    assert simhash.fingerprint("A B\x0bC\x0cd É".encode()) == slow_fingerprint("a b c d É")
    assert simhash.fingerprint(b"a\xc2\xa0b c") == simhash.fingerprint(b"A\xc2\xa0b c")
    assert simhash.fingerprint(b" \n") == 0


def test_edges_against_brute_force(edge_docs):
    got = {(r.doc_id, r.row_key): r for r in simhash.near_duplicates(edge_docs, cell=2).collect()}
    rows = edge_rows()
    fps = [slow_fingerprint(t) for _, t, _, _ in rows]
    groups = components([(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4], range(len(rows)))
    found = simhash.near_duplicates(edge_docs).collect()
    assert len(found) == len(rows)
    ids = lambda g: [rows[k][0] for k in range(len(rows)) if groups[k] == g and rows[k][0] is not None]
    expected = sorted(((i, f"{f:016x}", min(ids(groups[k]), default=None)) for k, ((i, *_), f) in enumerate(zip(rows, fps, strict=True))), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == expected
    assert {(r.doc_id, r.row_key): r.component_id for r in found} == {k: r.component_id for k, r in got.items()}


def test_one_of_each_keeps_columns_and_every_group(edge_docs):
    kept = simhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [10, 20, 30, 31, 32, 33, 40, 41, 42, 43, 44, 45, 60]
    assert sum(r.doc_id is None for r in rows) == 1


@pytest.mark.parametrize("max_bits", [0, 3, 4, 7])
def test_links_of_random_fingerprints(spark, max_bits):
    chance = np.random.default_rng(max_bits)
    base = chance.integers(-(1 << 62), 1 << 62, 150, dtype=np.int64)
    flips = [int(sum(1 << int(b) for b in chance.choice(64, chance.integers(1, 9), replace=False))) for _ in base]
    fps = sorted({*base.tolist(), *((int(b) & (2 ** 64 - 1)) ^ f for b, f in zip(base, flips, strict=True))})
    fps = sorted({f - (1 << 64) if f >= 1 << 63 else f for f in fps})
    links = simhash.near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), max_bits, cell=4)
    got = components([(r.a, r.b) for r in links.collect()], fps)
    assert got == components([(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= max_bits], fps)


def test_golay_covers_every_point_once():
    point = np.random.default_rng(0).integers(0, 1 << 63, 500, dtype=np.uint64)
    row, key, home = simhash.anchors(point, 1)
    assert (np.bincount(row[home], minlength=500) == 3).all()
    block, word = key >> simhash.LENGTH, key & ((1 << simhash.LENGTH) - 1)
    shift = np.array([b[0] for b in simhash.BLOCKS], np.uint64)[block]
    size = np.array([b[1] for b in simhash.BLOCKS])[block]
    part = (point[row] >> shift).astype(np.int64) & ((1 << size) - 1)
    away = np.bitwise_count(part ^ word)
    assert (away[home] <= 3).all() and (away <= 4).all()


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.one_of_each(no_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_spanning_links_are_few():
    a, b = np.triu_indices(50, 1)
    x, y = spanning_links(a, b)
    assert len(x) == 49 and set(y.tolist()) == {0}
