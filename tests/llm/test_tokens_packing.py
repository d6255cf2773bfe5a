import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contract_lake.llm import packing, tokens
from tests.llm.conftest import edge_rows

VOCABULARY = tokens.default_vocabulary()
LETTERS = st.sampled_from([*"abz'sŚéΣ  \n\t\x1c1;", "́", "日本", "<|startoftext|>", "<|endoftext|>", "'re", " word ", "Word.", "WORD!?", "Σας,", "İx;", "ǅ.", "e\u0301t.", "Ⅷ²."])


def library(text):
    return tokens.Encoder.of(VOCABULARY).library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(LETTERS, max_size=120).map("".join), st.integers(1, 40), st.integers(1, 6))
def test_splices_and_memo_equal_the_whole_encoding(text, chunk, overlap):
    encoder = tokens.Encoder.of(VOCABULARY)
    assert tokens.resynchronised(encoder, text, chunk, overlap) == library(text)
    assert np.frombuffer(next(encoder.ids([text])), "<u4").tolist() == library(text)


def test_memo_starts_over(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 12)
    encoder = tokens.Encoder(VOCABULARY)
    texts = ["one two three four five", "six seven eight nine ten eleven twelve thirteen", "one two " * 20]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.ids(texts)] == [library(t) for t in texts]
    assert len(encoder.memo) <= 25


def test_only_fitting_vocabularies_are_served():
    with pytest.raises(ValueError, match="lower case"):
        tokens.Encoder(tokens.default_vocabulary("byte_bpe_50k.json"))


@pytest.mark.parametrize("chunk", [1 << 16, 1000])
def test_counts_of_edges(edge_docs, no_docs, chunk):
    rows = tokens.token_counts(edge_docs, VOCABULARY, chunk=chunk, overlap=50).collect()
    expected = sorted(((i, len((t or "").encode()), len(library(t or "")), len(library(t or "")) > 2048) for i, t, _, _ in edge_rows()), key=str)
    assert sorted((tuple(r) for r in rows), key=str) == expected
    assert tokens.token_counts(no_docs, VOCABULARY).count() == 0


def check_packing(rows, texts, capacity):
    at = {}
    for r in rows:
        assert 0 < r.length <= capacity
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    expected = []
    for i, t in texts:
        ids = np.array([*library(t or ""), 0], "<u4")
        expected += [(i, k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(ids[k:k + capacity].tobytes())) for k in range(0, len(ids), capacity)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(expected, key=str)
    return len(at)


@pytest.mark.parametrize("island", [2048, 5])
def test_packing_of_edges(edge_docs, no_docs, island):
    rows = packing.packed(edge_docs, VOCABULARY, capacity=256, island=island, merge=2).collect()
    used = check_packing(rows, [(i, t) for i, t, _, _ in edge_rows()], 256)
    assert used <= -(-sum(r.length for r in rows) // 256) + 2
    assert packing.packed(no_docs, VOCABULARY).count() == 0


@pytest.mark.parametrize("merge", [2, 8])
def test_pieces_just_over_half_a_sequence_are_packed_once(spark, merge):
    """No two fit together, so levels free nothing: merging ends and every
    piece has one place."""
    texts = [(i, "a b c d " * (8 if i % 5 else 9)) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = packing.packed(docs, VOCABULARY, capacity=64, island=4, merge=merge).collect()
    assert len(rows) == len({(r.doc_id, r.piece) for r in rows})
    assert check_packing(rows, texts, 64) == 400


def test_many_levels_of_merging(spark):
    """Islands of few pieces, halved level by level."""
    chance = np.random.default_rng(3)
    texts = [(i, " ".join(["word"] * int(n))) for i, n in enumerate(chance.integers(1, 40, 900))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    rows = packing.packed(docs, VOCABULARY, capacity=64, island=8, epochs=1, merge=2).collect()
    used = check_packing(rows, texts, 64)
    assert used <= 1.05 * -(-sum(r.length for r in rows) // 64) + 1


def brute_fewest(lengths, capacity):
    best = len(lengths)

    def place(at, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if at == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[at] <= capacity:
                place(at + 1, [*bins[:k], bins[k] + lengths[at], *bins[k + 1:]])
        place(at + 1, [*bins, lengths[at]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(12))
def test_small_packings_against_the_fewest_sequences(seed):
    lengths = [int(x) for x in np.random.default_rng(seed).integers(5, 70, 9)]
    bins = packing.evolve(lengths, 100, seed)
    assert sorted(i for b in bins for i in b) == list(range(9))
    assert len(bins) <= brute_fewest(lengths, 100)


def test_a_run_without_spaces_is_encoded_a_few_times_over(monkeypatch):
    encoder, seen = tokens.Encoder(VOCABULARY), []
    whole = encoder.tokens
    monkeypatch.setattr(encoder, "tokens", lambda text, offset: seen.append(len(text)) or whole(text, offset))
    text = "ab," * 20_000
    assert tokens.resynchronised(encoder, text, chunk=500, overlap=20) == library(text)
    assert sum(seen) < 8 * len(text)


def test_long_texts_are_looked_up_in_runs(monkeypatch):
    cut = tokens.slices
    monkeypatch.setattr(tokens, "slices", lambda texts: cut(texts, 64))
    texts = [None, "", "one two  three " * 40, "x" * 300, "é ñ日本 " * 50, "short", "a  b\n c"]
    encoder = tokens.Encoder.of(VOCABULARY)
    assert [x.tolist() for x in encoder.encoded(tokens.pa.array(texts))] == [library(t or "") for t in texts]
    assert encoder.counts(tokens.pa.array(texts)).tolist() == [len(library(t or "")) for t in texts]


def test_packing_of_documents_is_near_the_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.packed(docs, VOCABULARY, island=300).collect()
    used = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert used <= 1.005 * -(-sum(r.length for r in rows) // 2048) + 1


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60), st.integers(0, 1000))
def test_evolution_keeps_every_piece_and_never_loses_to_best_fit(lengths, seed):
    plain = packing.best_fit(lengths, list(range(len(lengths))), [], 100)
    bins = packing.evolve(lengths, 100, seed, start=plain, patterns=[(60, 40), (50, 50), (1, 99)])
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 100 for b in bins) and len(bins) <= len(plain)


def test_crossover_injects_whole_sequences():
    lengths = [60, 40, 50, 50, 30, 70]
    child = packing.crossover(lengths, [[0, 4], [1, 2], [3], [5]], [[0, 1]], 100)
    assert [0, 1] in child and sorted(i for b in child for i in b) == list(range(6))
    assert packing.from_patterns(lengths, [(50, 50), (50, 50), (70, 30)]) == [[3, 2], [5, 4]]
