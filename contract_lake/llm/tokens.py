"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text longer than ``chunk`` characters is encoded in overlapping chunks with
character offsets. Neighbouring chunks are spliced at a boundary proven stable:
a place in the overlap where both encodings start a token, the character
before it is an ASCII space or line break (which no token, merge or
normalisation of these vocabularies crosses; the vocabulary's special strings
hold none) and both agree on every token from there to the next such place.
Without one, the overlap is doubled; when it has grown to the whole chunk, the
chunk itself is doubled, in the worst case to the whole text, so that a text
without such a place is encoded a few times over, not once for every chunk.

Texts up to ``chunk`` characters are encoded part by part (the parts the
library itself cuts a text into before it merges, or words between spaces):
a batch is lower-cased, parted and numbered by Arrow, distinct parts are looked
up or encoded once, and their ids are gathered by number. The memo is bounded
and forgets what is no longer in use, so it changes speed, never results.
``Encoder`` refuses a vocabulary that does not part text this way.

Null texts count as empty (no bytes, no tokens); repeated rows come back once
each; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map
from contract_lake.llm.words import gathered, numbered, row_sums, slices

CHUNK, OVERLAP = 1 << 16, 512
MEMO_WORDS = 250_000
BOUNDARY = " \n"

_loaded: dict[str, Encoder] = {}


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable ones for themselves, the others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()
# How these vocabularies part lower-cased text, written for
# texts of ASCII and the letters of Latin-1, which are the same in every
# normal form; and what lies outside of them.
LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
NOT_LETTERS = f"'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^ \t-\r0-9{LETTERS}]+"
PART = re.compile(f"[{LETTERS}]+|{NOT_LETTERS}")
OUTSIDE = "[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"


class Encoder:
    """One vocabulary file of the ``tokenizers`` library, with a memo of the
    ids of words and word parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.outside = "|".join([OUTSIDE, *map(re.escape, self.specials)])
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        for text in ("Ab\u00c9c, d\n e's 12 --x?", "str\u00e4nge \u00d0\u00ff it'll (A1)\t'tis"):
            if next(self.ids([text])) != np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes():
                raise ValueError(f"{path} does not read lower case and part text as this encoder does")

    @staticmethod
    def of(path: str) -> Encoder:
        if path not in _loaded:
            _loaded[path] = Encoder(path)
        return _loaded[path]

    def parts(self, texts: pa.Array) -> pa.Array:
        """Pieces of each text that the library encodes by themselves (and
        empty ones), as a list column: its own parts for plain texts, else
        words between spaces or line breaks."""
        odd = pc.match_substring_regex(texts, self.outside)
        if not pc.any(odd).as_py():
            return pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), f"({NOT_LETTERS})", r" \1 "))
        words = pc.split_pattern(pc.replace_substring(pc.if_else(odd, texts, ""), "\n", " "), " ")
        return pc.if_else(odd, words, self.parts(pc.if_else(odd, "", texts)))

    def learned(self, parts: list[str]) -> list[bytes]:
        """The ids of each of ``parts`` as little-endian 32-bit numbers, from
        the memo or new. A full memo becomes the old one, from which parts
        still in use return."""
        if len(self.memo) + len(parts) > MEMO_WORDS:
            self.old, self.memo = self.memo, {"": b""}
        self.memo.setdefault("", b"")
        rest = []
        bpe = self.library.model.tokenize
        for part in parts:
            if part in self.memo:
                continue
            if part in self.old:
                self.memo[part] = self.old[part]
            elif part == part.lower() and PART.fullmatch(part) and not re.search(self.outside, part):
                # normalised and parted already: straight to the library's merges
                name = part if part.isalnum() and part.isascii() else "".join(map(BYTE_LETTERS.__getitem__, part.encode()))
                self.memo[part] = b"".join([t.id.to_bytes(4, "little") for t in bpe(name)])
            else:
                rest.append(part)
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            for part, found in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.memo[part] = np.array(found.ids, "<u4").tobytes()
        return [self.memo[p] for p in parts]

    def _looked_up(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of the texts: row of the first, the ids of the distinct
        parts, how many each has, the part of each occurrence, offsets."""
        for first, some in slices(pc.fill_null(texts, "")):
            parts, which, offsets = numbered(self.parts(some))
            found = self.learned(parts)
            lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
            yield first, np.frombuffer(b"".join(found), "<u4"), lengths, which, offsets

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text (null: none)."""
        out = np.zeros(len(texts), np.int64)
        for first, _, lengths, which, offsets in self._looked_up(texts):
            out[first:first + len(offsets) - 1] += row_sums(lengths[which], offsets)
        return out

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (null: none), whole, as 32-bit numbers."""
        row, held = 0, []
        for first, values, lengths, which, offsets in self._looked_up(texts):
            ids = gathered(values, lengths, which)
            edges = np.concatenate([[0], np.cumsum(row_sums(lengths[which], offsets))])
            for k in range(len(offsets) - 1):
                if first + k != row:
                    yield np.concatenate(held)
                    row, held = first + k, []
                held.append(ids[edges[k]:edges[k + 1]])
        if len(texts):
            yield np.concatenate(held)

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        return (ids.astype("<u4").tobytes() for ids in self.encoded(pa.array(texts, pa.string())))

    def tokens(self, text: str, offset: int) -> list[tuple[int, int]]:
        """(start in the document, id) of each token of a chunk."""
        found = self.library.encode(text, add_special_tokens=False)
        return [(offset + a, i) for (a, _), i in zip(found.offsets, found.ids, strict=True)]


def splice(text: str, left: list[tuple[int, int]], right: list[tuple[int, int]], begin: int, end: int) -> int | None:
    """The first stable boundary in [begin, end), or None. ``left`` and
    ``right``: the tokens of the chunks that end at ``end``, start at ``begin``."""
    one = [t for t in left if begin <= t[0]]
    two = [t for t in right if t[0] < end]
    starts, others = {}, {}
    for where, tokens in ((starts, one), (others, two)):
        for k, (at, _) in enumerate(tokens):
            where.setdefault(at, k)
    edges = sorted(p for p in starts.keys() & others.keys() if p > begin and text[p - 1] in BOUNDARY)
    for p, q in zip(edges, edges[1:]):
        if one[starts[p]:starts[q]] == two[others[p]:others[q]]:
            return p
    return None


def resynchronised(encoder: Encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The ids of a huge text from overlapping chunks."""
    begin, end = 0, min(chunk, len(text))
    kept = encoder.tokens(text[begin:end], begin)
    out: list[int] = []
    while end < len(text):
        back = overlap
        while True:
            start = max(begin, end - back)
            stop = min(len(text), end + chunk)
            if start <= begin:  # nothing aligns in the whole chunk: double it
                stop = min(len(text), max(stop, 2 * end - begin))
                kept = encoder.tokens(text[begin:stop], begin)
                break
            more = encoder.tokens(text[start:stop], start)
            at = splice(text, kept, more, start, end)
            if at is not None:
                out += [i for p, i in kept if p < at]
                kept = [t for t in more if t[0] >= at]
                begin = at
                break
            back *= 2
        end = stop
    return out + [i for _, i in kept]


def default_vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row.
    ``vocabulary``: path of the file on every machine."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary)
        for batch in batches:
            texts = batch.column("text")
            huge = pc.fill_null(pc.greater(pc.utf8_length(texts), chunk), False)
            counts = encoder.counts(pc.if_else(huge, "", texts))
            for row in np.flatnonzero(huge.to_numpy(zero_copy_only=False)).tolist():
                counts[row] = len(resynchronised(encoder, texts[row].as_py(), chunk, overlap))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts), pa.array(counts > limit)],
                schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col("text").cast("string"))
    return arrow_map(rows, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
