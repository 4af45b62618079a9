"""Best-fit packing of documents into sequences, improved by local search.

Only a document longer than a sequence is cut, into full pieces and a rest.
Full pieces are sequences of their own. All other pieces are dealt by a hash
into groups of bounded size, each packed by one task: best fit, longest
first, and then a local search among the underfull bins that moves a
document, exchanges one for one or two for one, always increasing the sum of
squared fills, until no exchange of any two bins is left or no bin can run
empty.
"""

from __future__ import annotations

import heapq
import itertools
import re
import unicodedata
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatgate.llm.common import raw_texts, store, word_runs

CAPACITY = 2048
#: Pieces per packing group, about: the unit of work of one task.
GROUP_PIECES = 16_384
CACHE_WORDS = 400_000

# Fixed value: the word pattern of the public lower-case vocabulary.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# Words whose parts and lower case are beyond doubt; the library itself
# encodes all others.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+\Z")


class WordIds(dict):
    """Word -> its ids as little-endian 32-bit integers.

    The vocabulary drops white space, so a text's ids are those of its words
    one after another. Words are encoded by the tokenizers library; plain
    ones in one call per batch, through the same pair ranks in tiktoken.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        from flatgate.llm.token_counts import byte_symbols

        of_symbol = {s: bytes([b]) for b, s in byte_symbols().items()}
        end = model["end_of_word_suffix"]
        ranks = {}
        for token, i in model["vocab"].items():
            body, last = (token[:-len(end)], b"\n") if token.endswith(end) else (token, b"")
            if all(ch in of_symbol for ch in body):
                ranks[b"".join(of_symbol[ch] for ch in body) + last] = i
        # a word's end is written as a line feed, which no part contains
        ranks[b"\n"] = max(model["vocab"].values()) + 10
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        for token, i in ranks.items():
            self.ends[i] = token.endswith(b"\n")
        self.pairs = tiktoken.Encoding("words", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})

    def learn(self, words: Iterable[bytes]) -> None:
        plain, parts, counts = [], [], []
        for word in words:
            text = word.decode()
            if _PLAIN.match(text) and "<|" not in text:
                found = _PARTS.findall(unicodedata.normalize("NFC", text).lower())
                plain.append(word)
                parts += found
                counts.append(len(found))
            else:
                ids = self.library.encode(text, add_special_tokens=False).ids
                self[word] = np.array(ids, "<u4").tobytes()
        if plain:
            ids = np.array(self.pairs.encode_ordinary("\n".join(parts) + "\n"), "<u4")
            last = np.flatnonzero(self.ends[ids]) + 1  # one past each part
            stops = last[np.cumsum(counts) - 1]
            raw, at = ids.tobytes(), 0
            for word, stop in zip(plain, (4 * stops).tolist(), strict=True):
                self[word] = raw[at:stop]
                at = stop

    def ids(self, raw: bytes) -> bytes:
        """Ids of a whole text, 4 bytes each."""
        out = []
        for words in word_runs(raw):
            try:
                out.append(b"".join(map(self.__getitem__, words)))
            except KeyError:
                if len(self) > CACHE_WORDS:
                    # what came first is what comes often
                    for word in list(self)[CACHE_WORDS // 2:]:
                        del self[word]
                self.learn({w for w in words if w not in self})
                out.append(b"".join(map(self.__getitem__, words)))
        return b"".join(out)


_WORD_IDS: dict[str, WordIds] = {}


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "word_bpe_49k.json",
           capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: each document's ids
    with the closing id 0, cut into ``capacity`` at a time. A null or empty
    text is the closing id alone."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        words = _WORD_IDS.get(vocabulary)
        if words is None:
            words = _WORD_IDS[vocabulary] = WordIds(public_tokenizers.path(vocabulary))
        step = 4 * capacity
        for batch in batches:
            row, piece, length, crc = [], [], [], []
            for k, raw in enumerate(raw_texts(batch.column(1))):
                ids = words.ids(raw) + b"\0\0\0\0"
                for n, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    row.append(k)
                    piece.append(n)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            piece = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece), pa.array(piece.astype(np.int64) * capacity),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of positions in ``lengths``) by best fit, longest first:
    each piece goes to the bin that it leaves the least room in."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # rooms that some bin has, sorted
    for i in order:
        n = lengths[i]
        at = bisect_left(rooms, n)
        if at == len(rooms):
            b, left = len(bins), capacity - n
            bins.append([i])
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del rooms[at]
            left = room - n
            bins[b].append(i)
        if left:
            if not by_room[left]:
                insort(rooms, left)
            by_room[left].append(b)
    return bins


class LocalSearch:
    """Moves and exchanges among underfull bins that increase the sum of
    squared fills, so full bins fill up and the others run empty."""

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.n, self.capacity = lengths, capacity
        self.fill = {b: sum(lengths[i] for i in items) for b, items in enumerate(bins)}
        self.full = [items for b, items in enumerate(bins) if self.fill[b] == capacity]
        self.bins = {b: list(items) for b, items in enumerate(bins) if 0 < self.fill[b] < capacity}

    def _swap(self, a: int, out: tuple, b: int, back: tuple) -> None:
        """Take ``out`` from bin ``a`` into ``b`` and ``back`` the other way."""
        for i in out:
            self.bins[a].remove(i)
        for i in back:
            self.bins[b].remove(i)
        self.bins[a] += back
        self.bins[b] += out
        moved = sum(self.n[i] for i in out) - sum(self.n[i] for i in back)
        self.fill[a] -= moved
        self.fill[b] += moved

    def _totals(self, a: int) -> tuple[dict, dict]:
        """What bin ``a`` can give: one piece, or two, by their total."""
        by_size: dict[int, list[int]] = {}
        for i in self.bins[a]:
            by_size.setdefault(self.n[i], []).append(i)
        ones = {n: (items[0],) for n, items in by_size.items()}
        twos = {2 * n: tuple(items[:2]) for n, items in by_size.items() if len(items) > 1}
        for (n, x), (m, y) in itertools.combinations(by_size.items(), 2):
            twos.setdefault(n + m, (x[0], y[0]))
        return ones, twos

    def improve(self, a: int, b: int) -> bool:
        """The best move or exchange that gives ``b`` (the fuller bin) some
        of what ``a`` holds: for nothing, for one or (one of ``a`` only) for
        two of its pieces."""
        room = self.capacity - self.fill[b]
        gain, best = 0, None
        ones, twos = self._totals(b)
        for kind, offers in enumerate(self._totals(a)):
            totals = sorted(offers)
            for back_n, back in itertools.chain([(0, ())], ones.items(), twos.items() if kind == 0 else ()):
                at = bisect_right(totals, room + back_n) - 1
                if at >= 0 and totals[at] - back_n > gain:
                    gain, best = totals[at] - back_n, (offers[totals[at]], back)
        if best is None:
            return False
        # b is at least as full as a, so any gain of b raises the squares' sum
        self._swap(a, best[0], b, best[1])
        return True

    def _index(self, b: int) -> None:
        """Enter what bin ``b`` can give now; earlier entries of it are
        dropped when they come first."""
        self.stamp[b] = self.stamp.get(b, 0) + 1
        if b in self.bins:
            entry = (self.fill[b], b, self.stamp[b])
            for kind, totals in enumerate(self._totals(b)):
                for n in totals:
                    heapq.heappush(self.givers[kind][n], entry)
                    if entry[0] < self.least[kind, n]:
                        self.least[kind, n] = entry[0]

    def _clean(self, kind: int, n: int) -> list:
        heap = self.givers[kind][n]
        while heap and self.stamp[heap[0][1]] != heap[0][2]:
            heapq.heappop(heap)
        self.least[kind, n] = heap[0][0] if heap else self.capacity
        return heap

    def _reindex(self, b: int, before: tuple[dict, dict]) -> None:
        """``_index`` after a change; ``before`` is what ``b`` could give."""
        self._index(b)
        for kind, totals in enumerate(before):
            for n in totals:
                self._clean(kind, n)

    def _giver(self, b: int, own: tuple[dict, dict]) -> int | None:
        """The bin that gives ``b`` the most by one exchange, of all that
        are not fuller, or None: ``b`` can gain nothing."""
        room, fill = self.capacity - self.fill[b], self.fill[b]
        best, found = 0, None
        for kind in (0, 1):
            open_ = self.least[kind] <= fill
            aside = []
            for n in own[kind]:
                heap = self._clean(kind, n)
                if heap[0][1] == b:  # not from itself
                    entry = heapq.heappop(heap)
                    open_[n] = bool(self._clean(kind, n)) and heap[0][0] <= fill
                    aside.append((n, entry))
            totals = np.flatnonzero(open_)
            if len(totals):
                back = np.fromiter(itertools.chain((0,), own[0], own[1] if kind == 0 else ()), np.int64)
                at = np.searchsorted(totals, room + back, "right") - 1
                gain = np.where(at >= 0, totals[at] - back, 0)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, found = int(gain[k]), self.givers[kind][totals[at[k]]][0][1]
            for n, entry in aside:
                heapq.heappush(self.givers[kind][n], entry)
                self.least[kind, n] = entry[0]
        return found

    def run(self) -> list[list[int]]:
        """All bins after the search. It ends when a round over all bins
        changes nothing, or when so few underfull bins are left that none
        can run empty. Every exchange raises the squares' sum, so it ends."""
        least = -(-sum(self.fill[b] for b in self.bins) // self.capacity)
        full = len(self.full)
        self.stamp: dict[int, int] = {}
        # for one and for two pieces and each total: the bins that have it,
        # emptiest first, as (fill, bin, stamp), and the first one's fill
        self.givers = [[[] for _ in range(self.capacity)] for _ in range(2)]
        self.least = np.full((2, self.capacity), self.capacity, np.int64)
        if len(self.bins) > least:
            for b in self.bins:
                self._index(b)
        changed = True
        while changed and len(self.bins) + len(self.full) - full > least:
            changed = False
            # the fullest take first
            for b in sorted(self.bins, key=lambda b: -self.fill[b]):
                while b in self.bins:
                    own = self._totals(b)
                    a = self._giver(b, own)
                    if a is None:
                        break
                    given = self._totals(a)
                    if not self.improve(a, b):
                        break
                    changed = True
                    if not self.bins[a]:
                        del self.bins[a]
                    if self.fill[b] == self.capacity:
                        self.full.append(self.bins.pop(b))
                    self._reindex(a, given)
                    self._reindex(b, own)
        return self.full + [self.bins[b] for b in sorted(self.bins)]


def pack_group(lengths: list[int], capacity: int) -> list[list[int]]:
    return LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()


def pack(parts: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``.

    ``parts`` is a written table. Its short pieces are dealt to groups by a
    hash of the row's place in it, so equal rows spread as well, and the
    number of groups grows with the table: no task packs more than about
    ``group_pieces``."""
    full = parts.filter(F.col("length") == capacity)
    rest = parts.filter(F.col("length") < capacity)
    n_groups = max(1, round(rest.count() / group_pieces))
    columns = parts.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema)

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = group["length"].to_pylist()
        # even numbers: packed sequences; odd ones: full pieces
        first = 2 * (group["g"][0].as_py() << 32)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for b, items in enumerate(pack_group(lengths, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = first + 2 * b, at
                at += lengths[i]
        return group.select(columns).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    place = F.monotonically_increasing_id()
    dealt = rest.withColumn("g", F.pmod(F.xxhash64(place, "doc_id", "piece"), F.lit(n_groups)))
    short = dealt.groupBy("g").applyInArrow(packed, f"{schema}, sequence_id long, offset long")
    whole = full.withColumn("sequence_id", 2 * place + 1).withColumn("offset", F.lit(0).cast("long"))
    return short.unionByName(whole)


def best_fit_packing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "word_bpe_49k.json",
                     capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``:
    every piece of every row of ``docs`` and its place.

    Sequences are numbered freely; offsets in one start at 0 without gaps.
    Null and empty texts take one place (the closing id); null ids and
    repeated rows are packed like any other; other columns are ignored; an
    empty table gives an empty result. Texts are encoded once; the pieces
    are written to the shared folder before they are dealt, so a lost task
    repeats its group alone and sees the same rows.
    """
    parts, _ = store(pieces(docs, id_col, text_col, vocabulary, capacity), "pieces")
    return pack(parts, capacity)
