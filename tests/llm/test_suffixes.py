import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contract_lake.llm import suffixes, windows
from tests.llm.conftest import edge_rows, prose


def slow(texts, window):
    octets = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + window] for b in octets for i in range(len(b) - window + 1))
    out = []
    for b in octets:
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                mask[i:i + window] = True
        spans = sum(1 for i in range(len(b)) if mask[i] and (i == 0 or not mask[i - 1]))
        out.append((len(b), int(mask.sum()), spans, hashlib.sha256(bytes(x for x, m in zip(b, mask, strict=True) if not m)).hexdigest()))
    return out


def report(df, window):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.dedup_report(df, window).collect()), key=str)


@pytest.mark.parametrize("window", [200, 60])
def test_edges_against_brute_force(edge_docs, window):
    rows = [r for r in edge_rows() if r[0] != 30]  # the very long text has a test of its own
    expected = sorted(((r[0], *x) for r, x in zip(rows, slow([r[1] for r in rows], window), strict=True)), key=str)
    assert report(edge_docs.where("doc_id IS NULL OR doc_id <> 30"), window) == expected


def test_very_long_texts_in_segments(spark, monkeypatch):
    chance = np.random.default_rng(5)
    unit = bytes(chance.integers(97, 123, 3000).astype(np.uint8)).decode()
    texts = [unit[:1500] + "#" * 700 + unit, unit[200:900] + "!", unit * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = sorted(((i, *x) for i, x in enumerate(slow(texts, 60))), key=str)
    assert report(df, 60) == expected
    views = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    monkeypatch.setattr(suffixes, "SEGMENT", 500)
    for digit, _, row, place in suffixes.anchor_runs(views, 60):
        first, back, count = suffixes.unpack(place)
        for d, r, f, b in zip(digit, row, first, back, strict=True):
            gram = windows.RangeHashes(views[r]).of(np.array([f + b]), np.array([f + b + suffixes.GRAM]))
            assert gram.view(np.int64)[0] == d


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=0, max_size=160), min_size=1, max_size=5))
def test_every_window_has_one_run_and_equal_windows_equal_anchors(texts):
    window = 60
    views = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    owner = {}
    for digit, _, row, place in suffixes.anchor_runs(views, window):
        for d, r, f, b, n in zip(digit.tolist(), row.tolist(), *(x.tolist() for x in suffixes.unpack(place)), strict=True):
            for k in range(n):
                assert (r, f + k) not in owner
                owner[r, f + k] = (d, b - k)
    assert set(owner) == {(r, i) for r, t in enumerate(texts) for i in range(len(t) - window + 1)}
    by_bytes = {}
    for (r, i), anchor in owner.items():
        assert by_bytes.setdefault(texts[r][i:i + window], anchor) == anchor


def test_texts_lose_their_passages_and_keep_columns(edge_docs):
    out = suffixes.dedup_texts(edge_docs)
    assert out.columns == edge_docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[10].text == rows[11].text == "" and rows[20].text is None and rows[21].text == ""
    assert rows[30].text and len(rows[30].text) > 100_000 and rows[10].key == "k"
    assert all(100 < len(rows[40 + i].text.encode()) < 500 for i in range(6))


def test_cut_characters_go_whole(spark):
    shared = "é" * 150
    df = spark.createDataFrame([(1, "aé" + shared + "ñ" * 30), (2, "b" + shared + "ß" * 30)], "doc_id long, text string")
    for r in suffixes.dedup_texts(df).collect():
        r.text.encode()
        assert "�" not in r.text


def test_empty(no_docs):
    assert suffixes.dedup_report(no_docs).count() == 0
    assert suffixes.dedup_texts(no_docs).count() == 0


def test_copies_are_one_text_with_bounded_places(spark):
    """Hundreds of copies give no place lists; a passage they share with
    another text is still found there."""
    passage = prose(1, 120)
    rows = [(i, prose(2, 60) + passage) for i in range(800)] + [(5000, prose(3, 90) + passage + prose(4, 80)), (5001, prose(5, 200))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    places, _, copied = suffixes.repeated_spans(df, 200)
    assert copied.count() == 1 and places.count() == 1
    found = {r.doc_id: r for r in suffixes.dedup_report(df, 200).collect()}
    assert len(found) == 802 and all(found[i].n_removed == found[i].n_bytes and found[i].n_spans == 1 for i in range(800))
    assert len(passage) <= found[5000].n_removed <= len(passage) + 9 and found[5001].n_removed == 0


def test_a_pass_over_texts_holds_one_python_worker_a_task(edge_docs, monkeypatch):
    """A pass fed by another one in the same task holds a Python worker for each."""
    fed, run = [], suffixes.arrow_map

    def seen(df, *rest):
        fed.append(df._jdf.queryExecution().executedPlan().toString())
        return run(df, *rest)

    monkeypatch.setattr(suffixes, "arrow_map", seen)
    assert suffixes.dedup_texts(edge_docs).count() == edge_docs.count()
    assert len(fed) > 5 and not any("MapInArrow" in plan for plan in fed)
