"""Language of each word, and of each document, by a linear-chain conditional
random field.

A word is a run of letters, longer runs (scripts without spaces) are cut every
40 letters; all of it counts. A word's features are its affixes, its character n-grams and the word itself
(the lexicon), hashed into a weight table; transitions between the labels of
neighbouring words are learned as well. Training maximises the conditional
likelihood by forward-backward. Its sequences are runs of words from one to
three training documents of different languages in a row, so the transitions
learn what code-switched text looks like.

A document's words get their label probabilities by forward-backward over the
whole text; a word counts by its letters, and the language with the largest
share is the document's, the share its score. Many documents advance together,
one word a step; a text beyond ``SEGMENT_WORDS`` words passes in segments whose
edges are a fixed number of words of context, so memory stays bounded.

Training takes about ``per_language`` documents of each language (least
hashes of doc_id) and ``windows`` runs of words from each; languages come from
the data, the ``max_languages`` most frequent ones are learned. Rows without doc_id, text
or lang are never learnt from. Null texts and texts without a letter are
``und`` with score 0. Repeated rows are labelled alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, batch_of

WORD = re.compile(r"[^\W\d_]{1,40}")
BUCKETS = 1 << 16
MEMO_WORDS = 500_000
SEGMENT_WORDS, CONTEXT = 1 << 16, 64
#: Letters of text labelled together.
TOGETHER = 1 << 23


_CHANCE = np.random.default_rng(31)
#: Odd random factors for the places of an n-gram, and of the letters of a whole word.
PLACES = _CHANCE.integers(1, 1 << 62, (6, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of lower-case words: all buckets, word after word, and
    how many are each word's. An n-gram that holds the frame is an affix."""
    framed = [f"^{w}$" for w in words]
    codes = np.frombuffer("".join(framed).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, framed), np.int64, len(framed))
    end = np.cumsum(size)
    word = np.repeat(np.arange(len(framed)), size)
    inner = np.arange(len(codes)) - np.repeat(end - size, size)
    left = size[word] - inner  # letters from here to the end of the frame
    hashes, owners = [], []
    for n in (1, 2, 3, 4, 5):
        if n == 5:
            at = np.flatnonzero((left == n) | (left >= n) & (inner == 0))
        else:
            at = np.flatnonzero(left >= n) if n > 1 else np.flatnonzero((inner > 0) & (left > 1))
        total = np.zeros(len(at), np.uint64)
        for k in range(n):
            total += codes[at + k] * PLACES[n - 1, k]
        hashes.append(total)
        owners.append(word[at])
    place = PLACES[5, inner % 64] * np.power(PLACES[0, 1], (inner // 64).astype(np.uint64))
    hashes.append(np.add.reduceat(codes * place, end - size))
    owners.append(np.arange(len(framed)))
    total, owner = np.concatenate(hashes), np.concatenate(owners)
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(owner, kind="stable")
    return (total >> np.uint64(48)).astype(np.int64)[order], np.bincount(owner, minlength=len(framed))


@dataclass
class Tagger:
    """Weights of the field, with a bounded memo of word scores."""

    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    transitions: np.ndarray  # from x to, log scale
    memo: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Rows of ``table`` (exp of the words' scores) for the words."""
        missing = {w for w in words if w not in self.memo} if self.table is not None else set(words)
        if missing:
            if self.table is None or len(self.memo) + len(missing) > MEMO_WORDS:
                missing = set(words)  # starts over: holds these words, however many
                self.memo, self.table = {}, np.empty((0, len(self.languages)))
            parts, own = [self.table], list(missing)
            for at in range(0, len(own), 1 << 14):
                some = own[at:at + (1 << 14)]
                feats, n = word_features(some)
                fresh = np.add.reduceat(self.weights[feats], np.cumsum(n) - n, axis=0)
                parts.append(np.exp(fresh - fresh.max(axis=1, keepdims=True)))
            self.memo.update(zip(own, range(len(self.table), len(self.table) + len(own)), strict=True))
            self.table = np.concatenate(parts)
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def __getstate__(self) -> dict:
        return {"languages": self.languages, "weights": self.weights, "transitions": self.transitions, "memo": {}, "table": None}


def forward_backward(emission: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Label probabilities of every word of many sequences (rows of
    ``emission``, sequence s at starts[s] ... + lengths[s]), all advancing
    together; with ``pairs`` also the expected transitions. ``step``: exp of
    the transitions."""
    order = np.argsort(-lengths, kind="stable")
    first, n = starts[order], lengths[order]
    active = np.searchsorted(-n, -np.arange(1, n[0] + 1), side="right") if len(n) else []
    alpha, labels = np.empty_like(emission), emission.shape[1]
    state = None
    for t, k in enumerate(active):
        at = first[:k] + t
        state = emission[at] if state is None else (state[:k] @ step) * emission[at]
        state = state / state.sum(axis=1, keepdims=True)
        alpha[at] = state
    out = np.empty_like(emission)
    expected = np.zeros((labels, labels)) if pairs else None
    beta = np.ones((len(n), labels))
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        both = alpha[at] * beta[:k]
        out[at] = both / both.sum(axis=1, keepdims=True)
        back = emission[at] * beta[:k]
        if t:
            before = alpha[at - 1]
            if pairs:
                every = ((before @ step) * back).sum(axis=1, keepdims=True)
                expected += step * ((before / every).T @ back)
            beta[:k] = back @ step.T
            beta[:k] /= beta[:k].sum(axis=1, keepdims=True)
    return out, expected


def fit(languages: list[str], runs: list[tuple[int, list[str]]], epochs: int = 6, rate: float = 0.1, seed: int = 7) -> Tagger:
    """Train on (language number, words) runs by AdaGrad on the likelihood."""
    chance = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    coded = [(lang, np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words])) for lang, words in runs if words]
    flat, sizes = word_features(list(vocabulary))
    begins = np.cumsum(sizes) - sizes
    n_labels = len(languages)
    weights, transitions = np.zeros((BUCKETS, n_labels)), np.zeros((n_labels, n_labels))
    seen_w, seen_t = np.full((BUCKETS, n_labels), 1e-3), np.full((n_labels, n_labels), 1e-3)
    for _ in range(epochs):
        order = chance.permutation(len(coded))
        sequences, at = [], 0
        while at < len(order):  # one to three runs in a row
            k = int(chance.integers(1, 4))
            sequences.append([coded[i] for i in order[at:at + k]])
            at += k
        for begin in range(0, len(sequences), 64):
            batch = sequences[begin:begin + 64]
            words = np.concatenate([w for s in batch for _, w in s])
            truth = np.concatenate([np.full(len(w), lang) for s in batch for lang, w in s])
            lengths = np.array([sum(len(w) for _, w in s) for s in batch])
            starts = np.cumsum(lengths) - lengths
            own, back = np.unique(words, return_inverse=True)
            n = sizes[own]
            feats = flat[np.repeat(begins[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            scores = np.add.reduceat(weights[feats], np.cumsum(n) - n, axis=0)
            emission = np.exp(scores - scores.max(axis=1, keepdims=True))[back]
            marginal, expected = forward_backward(emission, starts, lengths, np.exp(transitions), pairs=True)
            marginal[np.arange(len(truth)), truth] -= 1
            by_word = np.stack([np.bincount(back, marginal[:, c], len(own)) for c in range(n_labels)], axis=1)
            used, where = np.unique(feats, return_inverse=True)
            grad = np.repeat(by_word, n, axis=0)
            grad = np.stack([np.bincount(where, grad[:, c], len(used)) for c in range(n_labels)], axis=1) / len(batch)
            inside = np.ones(len(truth), bool)
            inside[starts] = False
            to = np.flatnonzero(inside)
            observed = np.zeros((n_labels, n_labels))
            np.add.at(observed, (truth[to - 1], truth[to]), 1)
            grad_t = (expected - observed) / len(batch)
            seen_w[used] += grad ** 2
            weights[used] -= rate * grad / np.sqrt(seen_w[used])
            seen_t += grad_t ** 2
            transitions -= rate * grad_t / np.sqrt(seen_t)
    return Tagger(languages, weights, transitions)


def word_labels(tagger: Tagger, words: list[str]) -> np.ndarray:
    """Label probabilities (words x languages) of one code-switched text."""
    if not words:
        return np.empty((0, len(tagger.languages)))
    rows = tagger.word_rows([w.lower() for w in words])
    return forward_backward(tagger.table[rows], np.array([0]), np.array([len(words)]), np.exp(tagger.transitions))[0]


def shares(tagger: Tagger, texts: list[list[str]]) -> np.ndarray:
    """For each text (its words) the letters given to each language."""
    step = np.exp(tagger.transitions)
    out = np.zeros((len(texts), len(tagger.languages)))
    emissions, lengths, weights, owner = [], [], [], []
    sizes = [len(words) for words in texts]
    every = tagger.word_rows([w for words in texts for w in words])
    rows_of = np.split(every, np.cumsum(sizes)[:-1]) if texts else []
    for k, words in enumerate(texts):
        for at in range(0, len(words), SEGMENT_WORDS):
            low, high = max(0, at - CONTEXT), min(len(words), at + SEGMENT_WORDS + CONTEXT)
            part = words[low:high]
            emissions.append(tagger.table[rows_of[k][low:high]])
            letters = np.fromiter(map(len, part), np.float64, len(part))
            letters[:at - low] = 0
            letters[at - low + SEGMENT_WORDS:] = 0
            weights.append(letters)
            lengths.append(len(part))
            owner.append(k)
    if owner:
        n = np.array(lengths)
        label, _ = forward_backward(np.concatenate(emissions), np.cumsum(n) - n, n, step)
        np.add.at(out, np.array(owner), np.add.reduceat(label * np.concatenate(weights)[:, None], np.cumsum(n) - n, axis=0))
    return out


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is never learnt from (NULL doc_id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, per_language: int = 300, windows: int = 6, words: int = 40, max_languages: int = 1000) -> Tagger | None:
    """A tagger from the rows outside the held-out fold; None if there are none."""
    usable = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()}
    if not counts:
        return None
    # Rows by hash of doc_id, as many of each language as expected to be wanted; the limit is a hard bound.
    spark, rough = docs.sparkSession, 1 << 30
    parts = spark.createDataFrame([(lang, min(rough, -(-rough * per_language // n))) for lang, n in counts.items()], "lang string, part long")
    sample = (usable.select("doc_id", "lang", F.col("text").cast("string")).join(F.broadcast(parts), "lang")
              .where(F.pmod(F.xxhash64("doc_id"), F.lit(rough)) < F.col("part")))
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text")), strict=True):
                found = WORD.findall(text.lower())
                chance = np.random.default_rng(doc_id & 0xFFFFFFFF)
                for at in chance.integers(0, max(1, len(found) - words + 1), windows if len(found) > words else 1).tolist():
                    size = int(chance.integers(3, words + 1))
                    if found:
                        out.append((doc_id, lang, found[at:at + size]))
            if out:
                yield batch_of(schema, *zip(*out, strict=True))

    bound = 2 * per_language * len(counts) * windows
    found = (arrow_map(sample, run, "doc_id long, lang string, words array<string>")
             .orderBy(F.xxhash64("doc_id", "lang"), "doc_id", "lang", "words").limit(bound).collect())
    found.sort(key=lambda r: (r.doc_id, r.lang, r.words))
    languages = sorted(counts)
    number = {lang: i for i, lang in enumerate(languages)}
    return fit(languages, [(number[r.lang], r.words) for r in found]) if found else None


def predictions(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
    sent = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            langs, scores = [], []
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= TOGETHER):
                    size += len(texts[end])
                    end += 1
                words = [WORD.findall(t.lower()) for t in texts[at:end]]
                got = shares(model, words) if model else np.zeros((end - at, 0))
                for row, own in zip(got, words, strict=True):
                    total = row.sum()
                    langs.append(model.languages[int(row.argmax())] if own and total else "und")
                    scores.append(float(row.max() / total) if own and total else 0.0)
                at = end
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    return arrow_map(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")
