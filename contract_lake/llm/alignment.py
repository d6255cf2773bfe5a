"""Alignment of two tokenizers over whole texts, each distinct text once.

Texts are grouped by their full text (one shuffle), so each distinct text is
tokenised and aligned once and its multiplicity weights what it adds to the
corpus; the measures then go back to the doc_ids of all its copies.

Vocabulary A (byte-level BPE, ``tokenizers``) reads a space and the text,
vocabulary B (BPE with byte fallback, ``sentencepiece``) reads the text and
adds that space itself. Special strings inside a text are plain text. Both
give tokens with bytes; where they join to the same bytes, the places at which
a token of either ends cut them into groups, and every A and B token whose
byte ranges overlap are linked. A text that is null or empty, or whose tokens
do not join to the space and the text, has no tokens: counts of zero, an empty
hash.

Neither vocabulary lets a token cross the place before a space that has no
space before it and no white space behind it (A's pattern parts text
there, B holds no piece with a space after another character, which is checked
when the file is read).
So a text is aligned word by word, distinct words once a memo of bounded size,
and the parts are put together again.

A pair's count is its links over all documents. The pairs of each distinct
text are written once with its measures; counts are a combinable sum by pair,
joined back to the pairs and summed by text. Nothing is gathered by pair or by
text but numbers.

Repeated rows come back once each, a NULL doc_id as NULL; very long texts are
aligned in runs of words; an empty table gives an empty result. Columns other
than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, written
from contract_lake.llm.tokens import BYTE_LETTERS
from contract_lake.llm.words import gathered, numbered, row_sums, slices

MEMO_WORDS = 400_000
#: White space behind a space, or at either end of a text: its words are cut by CUT.
OTHER_SPACE = r"^[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]| [\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]| $"
CUT = re.compile(r"(?<=[^ ])(?= \S)")
SPACE_MARK = "▁"

_loaded: dict[tuple[str, str], Aligner] = {}


class Word:
    """What one word (with the space before it) adds to a text: numbers of
    tokens and groups, the groups as text, and its links as a_id << 32 | b_id."""

    __slots__ = ("n_a", "n_b", "n_groups", "said", "links")

    def __init__(self, n_a: int, n_b: int, n_groups: int, said: str, links: np.ndarray):
        self.n_a, self.n_b, self.n_groups, self.said, self.links = n_a, n_b, n_groups, said, links


def aligned(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray) -> list[Word]:
    """The alignments of many words at once: the ids of all words' tokens,
    their sizes in bytes (the same total in each word), and how many each word
    has. The words lie end to end on one line of bytes."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    # an A token meets the B tokens from the first that ends behind its start to the first that reaches its end
    low, high = np.searchsorted(b_ends, a_ends - a_sizes, side="right"), np.searchsorted(b_ends, a_ends, side="left")
    n = high - low + 1
    at = np.repeat(np.arange(len(a)), n)
    links = a[at] << 32 | b[low[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
    shared = np.flatnonzero(b_ends[high] == a_ends)  # A tokens that end a group
    a_edges, b_edges = [0, *(shared + 1).tolist()], [0, *(high[shared] + 1).tolist()]
    a_said, b_said = list(map(str, a.tolist())), list(map(str, b.tolist()))
    groups = [",".join(a_said[i:j]) + "|" + ",".join(b_said[k:m]) for i, j, k, m in zip(a_edges, a_edges[1:], b_edges, b_edges[1:])]
    last = np.cumsum(a_counts)
    link_edges = [0, *np.cumsum(n)[last - 1].tolist()]
    group_edges = [0, *np.searchsorted(shared, last, side="left").tolist()]
    return [Word(x, y, h - g, ";".join(groups[g:h]), links[i:j]) for x, y, g, h, i, j in zip(
        a_counts.tolist(), b_counts.tolist(), group_edges, group_edges[1:], link_edges, link_edges[1:])]


class Aligner:
    """The two vocabulary files, with a memo of words."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        byte_of = {letter: byte for byte, letter in BYTE_LETTERS.items()}
        self.a_bytes = {i: bytes(byte_of[c] for c in entry) for entry, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in byte_of for c in entry)}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in pieces):
            raise ValueError(f"{b_path} has pieces that cross words")
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, octets in self.a_bytes.items():
            self.a_sizes[i] = len(octets)
        self.b_sizes = np.array([len(octets) for octets in self.b_bytes], np.int64)
        self.memo: dict[str, Word | None] = {}
        self.old: dict[str, Word | None] = {}

    @staticmethod
    def of(a_path: str, b_path: str) -> Aligner:
        if (a_path, b_path) not in _loaded:
            _loaded[a_path, b_path] = Aligner(a_path, b_path)
        return _loaded[a_path, b_path]

    def fresh(self, words: list[str]) -> list[Word | None]:
        """Each of ``words`` (with its space) aligned, None where the bytes
        differ."""
        ones = self.a.encode_batch_fast(words, add_special_tokens=False)
        twos = self.b.encode([w[1:] for w in words], num_threads=1)
        sound, kept = [], []
        for k, (word, one, two) in enumerate(zip(words, ones, twos, strict=True)):
            octets, a = word.encode(), one.ids
            if b"".join([self.a_bytes[i] for i in a]) == octets and b"".join([self.b_bytes[i] for i in two]) == octets:
                sound.append(k)
                kept.append((a, two))
        out: list[Word | None] = [None] * len(words)
        if sound:
            a, b = (np.array([i for pair in kept for i in pair[side]], np.int64) for side in (0, 1))
            a_counts, b_counts = (np.array([len(pair[side]) for pair in kept], np.int64) for side in (0, 1))
            for k, word in zip(sound, aligned(a, b, self.a_sizes[a], self.b_sizes[b], a_counts, b_counts), strict=True):
                out[k] = word
        return out

    def words(self, words: list[str]) -> list[Word | None]:
        """Each of ``words``, from the memo or new. A full memo becomes the
        old one, from which words still in use return."""
        if len(self.memo) + len(words) > MEMO_WORDS:
            self.old, self.memo = self.memo, {}
        new = []
        for word in words:
            if word not in self.memo:
                if word in self.old:
                    self.memo[word] = self.old[word]
                else:
                    new.append(word)
        for at in range(0, len(new), 4096):
            some = new[at:at + 4096]
            self.memo.update(zip(some, self.fresh(some), strict=True))
        return [self.memo[w] for w in words]


def words_of(texts: pa.Array) -> pa.Array:
    """The words of each text, each without the space before it: a list
    column."""
    split = pc.split_pattern(texts, " ")
    odd = np.flatnonzero(pc.match_substring_regex(texts, OTHER_SPACE).to_numpy(zero_copy_only=False))
    if not len(odd):
        return split
    lists = split.to_pylist()
    for k in odd.tolist():
        lists[k] = [w[1:] for w in CUT.split(" " + texts[k].as_py())]
    return pa.array(lists, pa.list_(texts.type))


MEASURES = pa.schema([("key", pa.binary()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                      ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


class Text:
    """A text's alignment, put together run by run of its words."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.whole, self.hash = True, None
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, whole: bool, said: list[str], sizes: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> None:
        """A run of words: whether all are whole, their groups, the sums of
        their sizes, their distinct pairs and the times each is linked."""
        if not self.whole or not whole:
            self.whole = False
            return
        if self.hash is None:
            self.hash = hashlib.sha256(";".join(said).encode())
        else:
            self.hash.update((";" + ";".join(said)).encode())
        n_a, n_b, n_groups, n_links = sizes.tolist()
        self.n_a, self.n_b, self.n_groups, self.n_links = self.n_a + n_a, self.n_b + n_b, self.n_groups + n_groups, self.n_links + n_links
        if len(self.pairs):
            self.pairs, at = np.unique(np.concatenate([self.pairs, pairs]), return_inverse=True)
            self.times = np.bincount(at, np.concatenate([self.times, times])).astype(np.int64)
        else:
            self.pairs, self.times = pairs, times

    def row(self) -> tuple:
        if not self.whole or self.hash is None:
            return 0, 0, 0, 0, "", [], []
        return self.n_a, self.n_b, self.n_groups, self.n_links, self.hash.hexdigest(), self.pairs, self.times


def measured(aligner: Aligner, texts: pa.Array) -> Iterator[tuple]:
    """(n_a, n_b, n_groups, n_links, hash of the groups, distinct pairs, times
    each is linked) of each text, none null or empty."""
    row, text = 0, Text()
    for first, some in slices(texts):
        words, numbers, offsets = numbered(words_of(some))
        found = aligner.words([" " + w for w in words])
        broken = np.array([w is None for w in found])[numbers]
        said = [w.said if w else "" for w in found]
        sizes = np.array([(w.n_a, w.n_b, w.n_groups, len(w.links)) if w else (0, 0, 0, 0) for w in found], np.int64)[numbers]
        links = np.concatenate([np.zeros(0, np.int64), *[w.links for w in found if w]])
        # times each pair is linked in each text: sorted by (text, pair), the pair by its rank
        distinct, rank = np.unique(links, return_inverse=True)
        n, lengths = max(1, len(distinct)), np.array([len(w.links) if w else 0 for w in found], np.int64)
        owner = np.repeat(np.arange(len(some)), row_sums(sizes[:, 3], offsets))
        coded, times = np.unique(owner * n + gathered(rank, lengths, numbers), return_counts=True)
        edges = np.searchsorted(coded, np.arange(len(some) + 1) * n)
        pairs = distinct[coded % n] if len(distinct) else coded
        for k in range(len(some)):
            if first + k != row:
                yield text.row()
                row, text = first + k, Text()
            mine, part = slice(offsets[k], offsets[k + 1]), slice(edges[k], edges[k + 1])
            text.add(not broken[mine].any(), [said[w] for w in numbers[mine].tolist()], sizes[mine].sum(axis=0), pairs[part], times[part])
    if len(texts):
        yield text.row()


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256`` of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(a_path, b_path)
        for batch in batches:
            rows = list(measured(aligner, batch.column("text")))
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("copies"), *[pa.array(c, f.type) for c, f in zip(columns, list(MEASURES)[2:], strict=True)]],
                                                 schema=MEASURES)

    key = F.unhex(F.md5("text"))
    distinct = docs.select(F.col("text").cast("string")).where(F.octet_length("text") > 0).groupBy("text").agg(F.count("*").alias("copies"))
    # A text goes by a number: its rows lie side by side, and numbers pack far better than hashes.
    of_texts = written(arrow_map(distinct.select(key.alias("key"), "text", "copies"), run,
                                 "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>").withColumn("number", F.monotonically_increasing_id()),
                       "alignment-texts")
    linked = of_texts.select("number", "copies", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "number", "copies", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = written(linked.groupBy("pair").agg(F.sum(F.col("times") * F.col("copies")).alias("count")), "alignment-counts")
    counts = counts.withColumn("b_id", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    highest = counts.groupBy("b_id").agg(F.max("count").alias("highest"))  # one row an id of B
    counts = written(counts.join(highest, "b_id").select("pair", "count", (F.col("count") == F.col("highest")).alias("best")), "alignment-best")
    # By shuffle at every size: the table of pairs grows with the corpus, far beyond what could be broadcast.
    sums = written(linked.join(counts.hint("merge"), "pair").groupBy("number").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")), "alignment-sums")
    by_text = written(of_texts.drop("pairs", "times", "copies").join(sums, "number", "left").drop("number"), "alignment-measures")
    rows = docs.select(F.col("doc_id").cast("long"), F.unhex(F.md5(F.col("text").cast("string"))).alias("key"))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(by_text, "key", "left").select("doc_id", *map(number, ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                                                    F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
