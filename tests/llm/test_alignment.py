"""op12: alignment of two tokenizers against a plain whole-text version."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from contract_lake.llm import alignment, words
from contract_lake.llm.tokens import default_vocabulary

A, B = default_vocabulary("byte_bpe_50k.json"), default_vocabulary("piece_bpe_32k.model")


def by_byte(tokens):
    """The number of the token that each byte belongs to."""
    return [k for k, (_, octets) in enumerate(tokens) for _ in octets]


def plain(aligner, text):
    """(n_a, n_b, n_groups, n_links, hash, links) from the whole text, byte by
    byte."""
    whole = " " + (text or "")
    a = [(i, aligner.a_bytes[i]) for i in aligner.a.encode(whole, add_special_tokens=False).ids]
    b = [(i, aligner.b_bytes[i]) for i in aligner.b.encode(text or "")]
    if not text or any(b"".join(x for _, x in t) != whole.encode() for t in (a, b)):
        return 0, 0, 0, 0, "", Counter()
    met = list(zip(by_byte(a), by_byte(b), strict=True))
    groups, last = [([], [])], (-1, -1)
    for k, pair in enumerate(met):
        for side, tokens in enumerate((a, b)):
            if pair[side] != last[side]:
                groups[-1][side].append(str(tokens[pair[side]][0]))
        last = pair
        after = met[k + 1] if k + 1 < len(met) else (len(a), len(b))
        if after[0] != pair[0] and after[1] != pair[1]:
            groups.append(([], []))
    said = ";".join(",".join(one) + "|" + ",".join(two) for one, two in groups[:-1])
    links = Counter((a[i][0], b[j][0]) for i, j in set(met))
    return len(a), len(b), len(groups) - 1, sum(links.values()), hashlib.sha256(said.encode()).hexdigest(), links


def odd_texts(seed, n):
    chance = random.Random(seed)
    signs = [" "] * 6 + list("abcdefghou'.,-12\n\t") + ["é", "ß", "\u00a0", "\u3000", "日", "😀", "<|endoftext|>", "<s>", "'s", "  ", "\r\n", "\x00", "\x1c", "\u0301", "ﬁ", "\u200b"]
    texts = ["".join(chance.choice(signs) for _ in range(chance.randint(1, 60))) for _ in range(n)]
    return texts + [" ", "   ", "a ", " a", "a▁b", "\n", "x" * 3000, "a b " * 500]


@pytest.mark.parametrize("size", [16, 200, words.TOGETHER])
def test_texts_aligned_by_words_as_whole(monkeypatch, size):
    aligner = alignment.Aligner.of(A, B)
    cut = words.slices
    monkeypatch.setattr(alignment, "slices", lambda texts: cut(texts, size))
    texts = odd_texts(size, 800)
    found = list(alignment.measured(aligner, pa.array(texts)))
    assert len(found) == len(texts)
    for text, (*numbers, pairs, times) in zip(texts, found, strict=True):
        *expected, links = plain(aligner, text)
        assert numbers == expected, text
        assert {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(pairs, times, strict=True)} == links, text


def test_memo_is_bounded_and_changes_nothing(monkeypatch):
    aligner = alignment.Aligner(A, B)
    texts = odd_texts(3, 300)
    expected = [plain(aligner, t)[:5] for t in texts]
    monkeypatch.setattr(alignment, "MEMO_WORDS", 50)
    assert [m[:5] for t in texts for m in alignment.measured(aligner, pa.array([t]))] == expected
    assert len(aligner.memo) <= 50 + 600


def test_documents(spark, edge_docs):
    aligner = alignment.Aligner.of(A, B)
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    count = Counter()
    for _, text in rows:
        count.update(plain(aligner, text)[5])
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    expected = []
    for doc_id, text in rows:
        n_a, n_b, n_groups, n_links, said, links = plain(aligner, text)
        best = sum(n for pair, n in links.items() if count[pair] == highest[pair[1]])
        expected.append((doc_id, n_a, n_b, n_groups, n_links, best, sum(n * count[p] for p, n in links.items()), said))
    key = lambda r: tuple((x is None, x) for x in r)
    found = alignment.alignments(edge_docs, A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)


def test_no_documents(no_docs):
    assert alignment.alignments(no_docs, A, B).count() == 0
