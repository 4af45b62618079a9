"""Token counts by byte-pair merging with a heap and a linked list.

A text falls into pre-tokens (the public byte-level pattern). Each pre-token
starts as one symbol per byte; the adjacent pair of lowest rank is popped
from a heap and merged in a doubly linked list until no ranked pair is left.
The count is the initial symbols less the merges: no identifier is emitted.

The work is one pass without a shuffle. Repeated words are counted once per
worker through a table of bounded size; a very long text is read in blocks
cut where the pre-tokens on both sides cannot depend on each other.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pre-token pattern of the public byte-level vocabularies.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# A blank with white space before it and after it (or the end): only there
# does a pre-token reach over a blank.
_WIDE_BLANK = re.compile(r"\s (?:\s|\Z)")
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")

CACHE_WORDS = 400_000
BLOCK_CHARS = 1 << 20


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes stand for themselves, the others
    take the code points from 256 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in own}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(own))
    return out


class PairMerger:
    """Counts the tokens of texts under one byte-level pair vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.of_byte = [vocab[symbols[b]] for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault((vocab[left], vocab[right]), rank)
            self.made.append(vocab[left + right])
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def merged(self, raw: bytes) -> int:
        """Tokens of one pre-token: initial symbols minus merges."""
        symbol = [self.of_byte[b] for b in raw]
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, made = self.rank, self.made
        heap = []
        for i in range(n - 1):
            pair = (symbol[i], symbol[i + 1])
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        merges = 0
        while heap:
            r, i, (left, right) = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j == n or symbol[j] != right:
                continue  # one of the two is part of a later symbol by now
            symbol[i], symbol[j] = made[r], -1
            k = after[i] = after[j]
            merges += 1
            if k < n:
                before[k] = i
                pair = (symbol[i], symbol[k])
                if pair in rank:
                    heapq.heappush(heap, (rank[pair], i, pair))
            h = before[i]
            if h >= 0:
                pair = (symbol[h], symbol[i])
                if pair in rank:
                    heapq.heappush(heap, (rank[pair], h, pair))
        return n - merges

    def plain(self, text: str) -> int:
        """Tokens of a text by its pre-tokens."""
        total = 0
        for piece in PRE_TOKEN.findall(text):
            n = self.pieces.get(piece)
            if n is None:
                n = self.pieces[piece] = self.merged(piece.encode())
            total += n
        return total

    def _by_words(self, text: str) -> int:
        if _WIDE_BLANK.search(text):
            return self.plain(text)
        # every blank opens the pre-token to its right, so a word with the
        # blank before it counts the same wherever it stands
        words = text.split(" ")
        first, known = words[0], self.words
        counts = list(map(known.get, words[1:]))
        if None in counts:
            for i, n in enumerate(counts, 1):
                if n is None:
                    word = words[i]
                    if word not in known:
                        known[word] = self.plain(" " + word)
                    counts[i - 1] = known[word]
        return sum(counts) + (self.plain(first) if first else 0)

    def _blocks(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > BLOCK_CHARS and (m := _SAFE_CUT.search(text, at + BLOCK_CHARS)):
            yield text[at:m.start()]
            at = m.start()
        yield text[at:] if at else text

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings inside it are one token
        each, as the library's default has it."""
        parts = [text] if self.special is None else self.special.split(text)
        total = len(parts) - 1
        for part in parts:
            for block in self._blocks(part):
                total += self._by_words(block)
        if len(self.pieces) > CACHE_WORDS:
            self.pieces.clear()
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        return total


_MERGERS: dict[str, PairMerger] = {}


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = "byte_bpe_50k.json", limit: int = 512) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row of ``docs``.

    ``vocabulary`` is a public byte-level tokenizer file, by the name under
    which every worker finds it. A null text counts as empty (0 bytes, 0
    tokens, not over the limit); rows with equal or null ids each give their
    row; an empty table gives an empty result; columns besides the two
    named ones are ignored.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        merger = _MERGERS.get(vocabulary)
        if merger is None:
            merger = _MERGERS[vocabulary] = PairMerger(public_tokenizers.path(vocabulary))
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(merger.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
