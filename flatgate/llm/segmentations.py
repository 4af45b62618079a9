"""Sampled SentencePiece segmentations: Gumbel top-k without replacement.

A text's segmentations are the paths of a lattice whose edges are pieces.
Pieces do not reach over the blank that opens a word, so the lattice is a
chain of small word lattices; each distinct word's is built once, with the
exact chance of every edge (backward sums).

The k segmentations of largest Gumbel-perturbed log probability, which are k
samples without replacement, come from an A-star search over sets of paths:
a queue holds disjoint sets with the perturbed maximum of each as its bound.
The bound of a set is exact (a Gumbel around the set's log probability,
truncated at the bound of the set it was split from), so the first path
drawn from the best set is the next sample; the set is then split along that
path. The value next in the queue is the threshold of the samples' inclusion
scores.

Random numbers are a hash of the row's key, so a row gives the same samples
in whatever batch it comes.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
CACHE_WORDS = 240_000
BLOCK_WORDS = 150_000
_RUNS = re.compile("\n+[^ \n]*| +[^ \n]*|[^ \n]+")
_U64 = np.uint64
_MASK = (1 << 64) - 1
_SPREAD = 0x9E3779B97F4A7C15
NO_ARC = _U64(_MASK)


def mix(x):
    """Splitmix64 finalizer, for numbers and arrays."""
    if isinstance(x, int):
        x = (x + 0x9E3779B97F4A7C15) & _MASK
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & _MASK
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & _MASK
        return x ^ x >> 31
    x = x + _U64(0x9E3779B97F4A7C15)
    y = x >> _U64(30)
    y ^= x
    y *= _U64(0xBF58476D1CE4E5B9)
    np.right_shift(y, _U64(27), out=x)
    x ^= y
    x *= _U64(0x94D049BB133111EB)
    np.right_shift(x, _U64(31), out=y)
    y ^= x
    return y


_MIXED = [mix(n) for n in range(64)]


class Chance:
    """Uniform numbers in (0, 1) of one row, in order."""

    def __init__(self, key: int):
        self.key, self.n = key, 0

    def __call__(self) -> float:
        self.n += 1
        n = self.n
        return ((mix(self.key ^ (_MIXED[n] if n < len(_MIXED) else mix(n))) >> 11) + 0.5) / (1 << 53)


def split_words(text: str) -> list[str]:
    """Parts of a text in which no piece crosses a bound: words with the
    blank before them (at the start it is implied), and line feeds with what
    follows them. The first blank of a word is left out."""
    text = text.replace(BLANK, " ")
    if not text:
        return []
    if "  " in text or " \n" in text or "\n\n" in text or text[0] in " \n" or text[-1] == " ":
        return [w[1:] if w[0] == " " else w for w in _RUNS.findall(" " + text)]
    # a line feed opens a part of its own, told by being its first character
    return text.replace("\n", " \n").split(" ")


def _spelled(word: str) -> str:
    return word if word[:1] == "\n" else " " + word


class Grown:
    """An array that is added to at its end."""

    def __init__(self, dtype):
        self.store, self.n = np.empty(1 << 16, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.store):
            self.store = np.concatenate([self.store[:self.n], np.empty(max(need, 2 * self.n) - self.n, self.store.dtype)])
        self.store[self.n:need] = values
        self.n = need

    def view(self) -> np.ndarray:
        return self.store[:self.n]


class Lattices:
    """Word lattices of one vocabulary, with the chance of each edge.

    Weights: a unigram model's scores are log probabilities. A pair-merge
    model's scores are negative merge ranks; a piece of rank r then weighs
    1 / (r + 2), as word frequencies do by rank. ``alpha`` flattens or
    sharpens the distribution.
    """

    WIDEST = 48  # longer words are built one by one

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        scores = [sp.get_score(i) for i in range(size)]
        ranked = all(s == round(s) for s in scores)
        worst = min((s for s in scores if s > -1e8), default=0.0)
        self.byte_weight = alpha * (-math.log(2 - worst) if ranked else worst)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        self.raw: list[bytes] = []  # what each id decodes to
        for i, s in enumerate(scores):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.bytes[value] = i
                self.raw.append(bytes([value]))
                continue
            self.raw.append(b"" if sp.is_control(i) or sp.is_unknown(i) else piece.replace(BLANK, " ").encode())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if BLANK in piece.lstrip(BLANK) or "\n" in piece:
                    raise ValueError(f"piece {piece!r} reaches over the bound of a word")
                weight = -math.log(2 - max(s, worst)) if ranked else max(s, worst)
                self.pieces[piece.replace(BLANK, " ")] = (i, alpha * weight)
        self.spelled = pa.array(self.raw, pa.large_binary())
        # an unknown character is spelled in bytes; in ASCII that is one edge
        self.unknown = sp.unk_id()
        for value in range(128):
            self.pieces.setdefault(chr(value), (self.bytes.get(value, self.unknown), self.byte_weight))
        self.letters = frozenset(p for p in self.pieces if len(p) == 1)
        self.longest = max(map(len, self.pieces))
        self._index_prefixes()
        self.clear()

    def _index_prefixes(self) -> None:
        """Trie of the pieces: a state for each prefix, with its piece (or
        -1) and weight. Arcs stand in an open hash table by state and code
        point, less than a quarter full."""
        number = {"": 0}
        for piece in self.pieces:
            for n in range(1, len(piece) + 1):
                number.setdefault(piece[:n], len(number))
        self.state_piece, self.state_weight = np.full(len(number), -1, np.int32), np.zeros(len(number))
        for piece, (i, weight) in self.pieces.items():
            self.state_piece[number[piece]], self.state_weight[number[piece]] = i, weight
        bits = (4 * len(number)).bit_length()
        self.arc_shift, self.arc_mask = _U64(64 - bits), _U64((1 << bits) - 1)
        self.arc_key, self.arc_to = np.full(1 << bits, NO_ARC), np.zeros(1 << bits, np.uint64)
        for prefix, state in number.items():
            if prefix:
                key = number[prefix[:-1]] << 21 | ord(prefix[-1])
                slot = (key * _SPREAD & _MASK) >> (64 - bits)
                while self.arc_key[slot] != NO_ARC:
                    slot = (slot + 1) % (1 << bits)
                self.arc_key[slot], self.arc_to[slot] = key, state

    def _step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the states have an arc of their character, and the states
        that these lead to."""
        key = state << _U64(21)
        key |= code
        slot = key * _U64(_SPREAD)
        slot >>= self.arc_shift
        got = self.arc_key[slot]
        same = got == key
        unsure = np.flatnonzero(~same & (got != NO_ARC))
        while len(unsure):
            slot[unsure] = (slot[unsure] + _U64(1)) & self.arc_mask
            got = self.arc_key[slot[unsure]]
            same[unsure] = found = got == key[unsure]
            unsure = unsure[~found & (got != NO_ARC)]
        same = np.flatnonzero(same)
        return same, self.arc_to[slot[same]]

    def clear(self) -> None:
        self.known: dict[str, int] = {}  # word -> its first node
        self.first = Grown(np.int32)  # node -> its first edge; -1 at a word's end
        self.cum, self.to, self.piece, self.logp = Grown(np.float64), Grown(np.int32), Grown(np.int32), Grown(np.float64)
        self.go = Grown(np.int32)  # first edge of the node that an edge leads to
        self.first.extend(np.array([-1], np.int32))  # node 0 ends every word
        self.kept: tuple[int, int, int] | None = None

    def trim(self) -> None:
        """Forget the words learned last, down to half of the bound: what
        came first is what comes often."""
        if self.kept is None:
            self.clear()
            return
        words, nodes, edges = self.kept
        self.known = dict(itertools.islice(self.known.items(), words))
        self.first.n = nodes
        for store in (self.cum, self.to, self.piece, self.logp, self.go):
            store.n = edges

    def _extend(self, first, cum, to, piece, logp) -> None:
        for store, values in ((self.first, first), (self.cum, cum), (self.to, to), (self.piece, piece), (self.logp, logp)):
            store.extend(np.asarray(values))
        self.go.extend(self.first.view()[np.asarray(to)])

    def _add_all(self, words: list[str]) -> None:
        """Lattices of many words at once: the nodes at one distance from
        the end of their words are built together, nearest first."""
        words = sorted(words, key=len, reverse=True)
        spelled = [_spelled(w) for w in words]
        lengths = np.array([len(w) for w in spelled])
        order = np.argsort(-lengths, kind="stable")  # a line feed adds no blank
        words, spelled, lengths = [words[i] for i in order], [spelled[i] for i in order], lengths[order]
        width = int(lengths[0])
        codes = np.frombuffer("".join(w.rjust(width, "\0") for w in spelled).encode("utf-32-le"), np.uint32).reshape(-1, width)
        columns = np.ascontiguousarray(codes.T).astype(np.uint64)
        base, edge_base = self.first.n, self.cum.n
        alive = [int(np.searchsorted(-lengths, -d, side="right")) for d in range(width + 1)]  # words of d characters or more
        node_of = [0] * (width + 1)  # first node at each distance
        ahead = [np.zeros(len(words))]
        firsts, cums, tos, pieces, logps = [], [], [], [], []
        n_edges = 0
        for d in range(1, width + 1):
            n = alive[d]
            node_of[d] = base + sum(alive[1:d])
            rows, state = np.arange(n), np.zeros(n, np.uint64)
            hit_rows, hit_len, hit_piece, hit_weight = [], [], [], []
            for length in range(1, min(d, self.longest) + 1):
                column = columns[width - d + length - 1]
                same, state = self._step(state, column[:n] if length == 1 else column[rows])
                if not len(same):
                    break
                rows = rows[same]
                piece = self.state_piece[state]
                whole = np.flatnonzero(piece >= 0)
                hit_rows.append(rows[whole])
                hit_len.append(np.full(len(whole), length))
                hit_piece.append(piece[whole])
                hit_weight.append(self.state_weight[state[whole]])
            # longer pieces first: they are mostly the likelier ones
            row = np.concatenate(hit_rows[::-1])
            by_row = np.argsort(row, kind="stable")
            row = row[by_row]
            length = np.concatenate(hit_len[::-1])[by_row]
            piece = np.concatenate(hit_piece[::-1])[by_row]
            weight = np.concatenate(hit_weight[::-1])[by_row]
            rest = np.empty(len(row))
            to = np.zeros(len(row), np.int64)
            for length_now in np.unique(length):
                m = length == length_now
                rest[m] = ahead[d - length_now][row[m]]
                to[m] = node_of[d - length_now] + row[m] if length_now < d else 0
            value = weight + rest
            cuts = np.flatnonzero(np.diff(row, prepend=-1))
            top = np.maximum.reduceat(value, cuts)
            counts = np.diff(np.append(cuts, len(row)))
            part = np.exp(value - np.repeat(top, counts))
            total = np.add.reduceat(part, cuts)
            ahead.append(top + np.log(total))
            share = part / np.repeat(total, counts)
            run = np.cumsum(share)
            run -= np.repeat(run[cuts] - share[cuts], counts)
            last = cuts + counts - 1
            run[last] = 2.0  # rounding must not lead past the last edge
            logp = value - np.repeat(ahead[-1], counts)
            logp[cuts[counts == 1]] = 0.0
            firsts.append(edge_base + n_edges + cuts)
            n_edges += len(row)
            for out, values in ((cums, run), (tos, to), (pieces, piece), (logps, logp)):
                out.append(values)
        self._extend(*map(np.concatenate, (firsts, cums, tos, pieces, logps)))
        nodes = np.array(node_of)[lengths] + np.arange(len(words))
        self.known.update(zip(words, nodes.tolist(), strict=True))

    def _add_one(self, word: str) -> None:
        """Lattice of a word that is very long or has characters spelled in
        several bytes."""
        text = _spelled(word)
        n = len(text)
        nodes, ahead = [0] * (n + 1), [0.0] * (n + 1)
        get = self.pieces.get

        def node(edges: list[tuple[float, int, int]]) -> tuple[int, float]:
            top = max(e[0] for e in edges)
            parts = np.exp([e[0] - top for e in edges])
            norm = top + math.log(parts.sum())
            cum = np.cumsum(parts / parts.sum())
            cum[-1] = 2.0
            logp = [e[0] - norm for e in edges] if len(edges) > 1 else [0.0]
            self._extend(np.array([self.cum.n], np.int32), cum, [e[1] for e in edges], [e[2] for e in edges], logp)
            return self.first.n - 1, norm

        for i in range(n - 1, -1, -1):
            edges = []
            for j in range(min(n, i + self.longest), i, -1):
                hit = get(text[i:j])
                if hit is not None:
                    edges.append((hit[1] + ahead[j], nodes[j], hit[0]))
            if get(text[i]) is None:
                to, rest = nodes[i + 1], ahead[i + 1]
                spelled = [self.bytes.get(b, self.unknown) for b in text[i].encode()]
                for b in reversed(spelled[1:]):
                    to, rest = node([(self.byte_weight + rest, to, b)])
                edges.append((self.byte_weight + rest, to, spelled[0]))
            nodes[i], ahead[i] = node(edges)
        self.known[word] = nodes[0]

    def learn(self, words: Iterable[str]) -> None:
        quick, slow = [], []
        spelled = self.letters.issuperset
        for w in words:
            (quick if len(w) < self.WIDEST and (w.isascii() or spelled(w)) else slow).append(w)
        quick.sort(key=len)  # words of one length share a narrow matrix
        for at in range(0, len(quick), 20_000):
            self._add_all(quick[at:at + 20_000])
        for w in slow:
            self._add_one(w)
        if self.kept is None and len(self.known) >= CACHE_WORDS // 2:
            self.kept = len(self.known), self.first.n, self.cum.n

    def starts(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def starts_of(self, texts: list[list[str]]) -> list[np.ndarray]:
        """First nodes of each text's words; unknown words are learned, those
        of all texts together."""
        found, gaps, unknown = [], [], set()
        get = self.known.get
        for words in texts:
            nodes = list(map(get, words))
            found.append(nodes)
            if None in nodes:
                holes = [i for i, node in enumerate(nodes) if node is None]
                unknown.update([words[i] for i in holes])
                gaps.append((words, nodes, holes))
        self.learn(unknown)
        for words, nodes, holes in gaps:
            for i in holes:
                nodes[i] = self.known[words[i]]
        return [np.array(nodes, np.int64) for nodes in found]

    def views(self) -> tuple[np.ndarray, ...]:
        return tuple(a.view() for a in (self.first, self.cum, self.to, self.piece, self.logp))

    def decode(self, ids: list[int]) -> bytes:
        """Text of a segmentation: pieces joined, the implied blank dropped."""
        joined = b"".join(map(self.raw.__getitem__, ids))
        return joined[1:] if joined[:1] == b" " else joined


def walk(lattices: Lattices, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draw a path from each node to its word's end, all at once: edges in
    order, and the number of them for each start."""
    cum, go = lattices.cum.view(), lattices.go.view()
    who, edge, key, step = np.arange(len(nodes), dtype=np.int32), lattices.first.view()[nodes], keys, 0
    whos, taken = [], []
    while True:
        alive = np.flatnonzero(edge >= 0)
        if len(alive) < len(edge):
            who, key, edge = who[alive], key[alive], edge[alive]
        if not len(who):
            break
        u = mix(key ^ _U64(mix(step)))
        u >>= _U64(11)
        u = u * (1.0 / (1 << 53))
        behind = np.flatnonzero(u >= cum[edge])
        if len(behind):
            at, left = edge[behind] + 1, u[behind]
            while True:
                edge[behind] = at
                more = np.flatnonzero(left >= cum[at])
                if not len(more):
                    break
                behind, at, left = behind[more], at[more] + 1, left[more]
        whos.append(who)
        taken.append(edge)
        edge = go[edge]
        step += 1
    if not whos:
        return np.empty(0, np.int32), np.zeros(len(nodes), np.int64)
    # place of each edge: after its word's earlier ones
    counts = np.bincount(np.concatenate(whos), minlength=len(nodes))
    place = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int32)
    for step, (who, edge) in enumerate(zip(whos, taken, strict=True)):
        out[place[who] + step] = edge
    return out, counts


class Sample:
    """One segmentation: its edges, its log probability and its perturbed
    log probability. Past edge ``start`` the words from ``word`` on have
    ``counts`` edges each; up to there it follows ``parent``."""

    def __init__(self, edges: np.ndarray, logp: float, value: float, word: int, counts: np.ndarray, parent=None, start: int = 0):
        self.edges, self.logp, self.value = edges, logp, value
        self.word, self.counts, self.parent, self.start = word, counts, parent, start
        self._costs = np.zeros(1)

    def word_at(self, place: int) -> int:
        """Number of the word that an edge is in."""
        sample = self
        while place < sample.start:
            sample = sample.parent
        return sample.word + int(np.searchsorted(np.cumsum(sample.counts), place - sample.start, side="right"))

    def costs(self, logp: np.ndarray, n: int) -> np.ndarray:
        """Negative log probability of each prefix, of those up to ``n``
        edges at least (all, where there are fewer)."""
        have = len(self._costs)
        if n >= have and have <= len(self.edges):
            more = -logp[self.edges[have - 1:max(n, 2 * have)]]
            self._costs = np.concatenate([self._costs[:-1], np.cumsum(np.concatenate([self._costs[-1:], more]))])
        return self._costs

    def cost(self, logp: np.ndarray, n: int) -> float:
        return float(self.costs(logp, n)[n])

    def first_above(self, logp: np.ndarray, a: int, b: int, cost: float) -> int:
        """First edge from ``a`` to ``b`` by whose end the path has cost more
        than ``cost`` since ``a``; else the last that costs anything."""
        ahead, cost = 64, cost + self.cost(logp, a)
        while True:
            upto = self.costs(logp, min(a + ahead, b))[a + 1:b + 1]
            t = int(np.searchsorted(upto, cost, side="right"))
            if t < len(upto):
                return a + t
            if len(upto) == b - a:
                return a + int(np.flatnonzero(logp[self.edges[a:b]] < 0)[-1])
            ahead *= 4


def truncated_gumbel(location: float, bound: float, u: float) -> float:
    """Largest of a set's perturbed log probabilities, given that it is at
    most ``bound``."""
    return location - math.log(math.exp(min(700.0, location - bound)) - math.log(u))


class Search:
    """The queue of one text: sets of paths, by perturbed maximum.

    A set is ``("after", sample, from, done, spans)``: paths that follow the
    sample up to some edge from ``from`` on, not in ``done``, and leave it
    there, with the spans between those done; or ``("at", sample, place,
    taken, None)``: paths that follow the sample up to ``place`` and take no
    edge of ``taken`` there.
    """

    def __init__(self, key: int):
        self.chance, self.queue, self.samples = Chance(key), [], []
        self.pushed = itertools.count()  # decides between equal bounds

    def _push(self, location: float, bound: float, region: tuple) -> None:
        value = truncated_gumbel(location, bound, self.chance())
        heapq.heappush(self.queue, (-value, next(self.pushed), region))

    def _spans(self, logp, sample: Sample, start: int, done: tuple) -> list[tuple[int, int, float, float]]:
        """Spans ``(a, b)`` of edges between those done, each with the chance
        to reach it and to leave the sample in it, given its prefix up to
        ``start``. The chances to leave at the single edges of a span add up
        to one less the chance to follow it to its end."""
        spans, a = [], start
        for b in (*sorted(done), len(sample.edges)):
            if a < b:
                # to follow 41 nats to the end is nothing beside one
                far = b == len(sample.edges) and sample.logp + sample.cost(logp, a) < -41
                leave = 1.0 if far else -math.expm1(float(logp[sample.edges[a:b]].sum()))
                if leave > 0:
                    reach = math.exp(sample.cost(logp, start) - sample.cost(logp, a))
                    spans.append((a, b, reach, reach * leave))
            a = b + 1
        return spans

    def _push_after(self, tables, sample: Sample, start: int, done: tuple, bound: float) -> None:
        spans = self._spans(tables[4], sample, start, done)
        mass = sum(s[3] for s in spans)
        if mass > 0:
            self._push(math.log(mass) - sample.cost(tables[4], start), bound, ("after", sample, start, done, spans))

    def _push_at(self, tables, sample: Sample, place: int, taken: tuple, bound: float) -> None:
        logp = tables[4]
        left = [e for e in _siblings(tables, int(sample.edges[place])) if e not in taken]
        mass = sum(math.exp(logp[e]) for e in left)
        if mass > 0:
            self._push(math.log(mass) - sample.cost(logp, place), bound, ("at", sample, place, taken, None))

    def first(self, tables, sample: Sample) -> None:
        sample.value = -math.log(-math.log(self.chance()))
        self.samples.append(sample)
        if len(sample.edges):
            self._push_after(tables, sample, 0, (), sample.value)

    def next_branch(self, tables) -> tuple | None:
        """Take the best set: ``(sample, place, taken, edge, value)`` of the
        edge by which the next sample leaves a known one."""
        if not self.queue:
            return None
        value, _, (kind, sample, place, rest, spans) = heapq.heappop(self.queue)
        value, logp = -value, tables[4]
        taken = rest
        if kind == "after":
            u = self.chance() * sum(s[3] for s in spans)
            for first, last, reach, chance in spans:
                if u < chance:
                    break
                u -= chance
            t = sample.first_above(logp, first, last, -math.log1p(-min(u / reach, 1 - 2.0 ** -53)))
            self._push_after(tables, sample, place, (*rest, t), value)
            place, taken = t, (int(sample.edges[t]),)
        left = [e for e in _siblings(tables, int(sample.edges[place])) if e not in taken]
        weights = [math.exp(logp[e]) for e in left]
        u = self.chance() * sum(weights)
        edge = left[-1]
        for e, w in zip(left, weights, strict=True):
            if u < w:
                edge = e
                break
            u -= w
        return sample, place, (*taken, edge), edge, value

    def add(self, tables, branch: tuple, new: Sample) -> None:
        sample, place, taken, _, value = branch
        self.samples.append(new)
        self._push_at(tables, sample, place, taken, value)
        if place + 1 < len(new.edges):
            self._push_after(tables, new, place + 1, (), value)

    def log_inclusion(self, sample: Sample) -> float:
        """Log of the chance that the sample's perturbed value exceeds the
        threshold, the largest value left in the queue."""
        if not self.queue:
            return 0.0
        x = sample.logp + self.queue[0][0]
        return x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 30.0))))


def _siblings(tables, edge: int) -> range:
    """All edges of the node that ``edge`` leaves: they stand together, the
    last one marked by a cumulative chance above 1."""
    cum = tables[1]
    lo, hi = edge, edge
    while lo > 0 and cum[lo - 1] < 1.5:
        lo -= 1
    while cum[hi] < 1.5:
        hi += 1
    return range(lo, hi + 1)


def sample_block(lattices: Lattices, keys: list[int], texts: list[str], k: int) -> list[Search]:
    """``k`` distinct segmentations (all, where there are fewer) of each
    text; the texts' paths are drawn together, one round for each sample."""
    words = lattices.starts_of([split_words(t) for t in texts])
    tables = lattices.views()
    logp, to = tables[4], tables[2]
    searches = [Search(mix(key)) for key in keys]

    def draw(rows: list[int], round_no: int, branches: list[tuple | None]) -> None:
        """New paths for the rows: whole ones, or what follows a branch: the
        rest of its word, which draws by a number behind those of the text's
        words, and the words after it."""
        at = [0 if b is None else b[0].word_at(b[1]) for b in branches]
        nodes = [words[row][w:] for row, w in zip(rows, at, strict=True)]
        sizes = np.array([len(n) for n in nodes])
        items = np.append(0, np.cumsum(sizes))
        nodes = np.concatenate(nodes)
        number = np.arange(items[-1]) + np.repeat(np.array(at) - items[:-1], sizes)
        heads = [i for i, b in enumerate(branches) if b is not None]
        nodes[items[heads]] = [to[branches[i][3]] for i in heads]
        number[items[heads]] = [len(words[rows[i]]) for i in heads]
        seeds = np.repeat(np.array([mix(keys[row] ^ mix(round_no)) for row in rows], np.uint64), sizes)
        seeds ^= number.astype(np.uint64)
        edges, counts = walk(lattices, nodes, mix(seeds))
        ends = np.append(0, np.cumsum(counts))[items].tolist()
        gain = logp[edges]
        for i, (row, branch) in enumerate(zip(rows, branches, strict=True)):
            mine, own = edges[ends[i]:ends[i + 1]], counts[items[i]:items[i + 1]]
            total = float(gain[ends[i]:ends[i + 1]].sum())
            if branch is None:
                searches[row].first(tables, Sample(mine, total, 0.0, 0, own))
            else:
                sample, place, _, edge, value = branch
                total += float(logp[edge]) - sample.cost(logp, place)
                mine = np.concatenate([sample.edges[:place], np.array([edge], np.int32), mine])
                searches[row].add(tables, branch, Sample(mine, total, value, at[i], own, sample, place + 1))

    if texts:
        draw(list(range(len(texts))), 0, [None] * len(texts))
    for round_no in range(1, k):
        open_rows = [(row, branch) for row, s in enumerate(searches) if (branch := s.next_branch(tables)) is not None]
        if not open_rows:
            break
        draw([r for r, _ in open_rows], round_no, [b for _, b in open_rows])
    return searches


def describe(lattices: Lattices, ids: list, texts: list[str], searches: list[Search], fields: tuple[str, ...]) -> pa.RecordBatch:
    """The samples' rows. All samples of a block are spelled at once, into
    one buffer of bytes, and each compared with its text."""
    samples = [s for search in searches for s in search.samples]
    sizes = [len(s.edges) for s in samples]
    found = lattices.piece.view()[np.concatenate([s.edges for s in samples])].astype("<i4", copy=False)
    ends = np.append(0, np.cumsum(sizes))
    cuts = list(itertools.pairwise(ends.tolist()))
    out = {
        "doc_id": pa.array([i for i, s in zip(ids, searches, strict=True) for _ in s.samples], pa.int64()),
        "sample": pa.array([n for s in searches for n in range(len(s.samples))], pa.int32()),
    }
    for name in fields:
        if name == "n_pieces":
            values = sizes
        elif name == "ids_crc32":
            values = [zlib.crc32(found[a:z]) for a, z in cuts]
        elif name == "log_prob":
            values = [s.logp for s in samples]
        elif name == "log_inclusion":
            values = [search.log_inclusion(s) for search in searches for s in search.samples]
        elif name == "round_trip":
            values = _round_trips(lattices, found, ends, searches, texts)
        else:
            values = [found[a:z] for a, z in cuts]
        out[name] = pa.array(values, _ARROW[name])
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _round_trips(lattices: Lattices, found: np.ndarray, ends: np.ndarray, searches: list[Search], texts: list[str]) -> list[bool]:
    """Whether each sample's pieces, joined and without the implied blank,
    are its text."""
    spelled = lattices.spelled.take(pa.array(found))
    _, offsets, data = spelled.buffers()
    data = memoryview(data if data is not None else b"")
    bounds = itertools.pairwise(np.frombuffer(offsets, np.int64, len(spelled) + 1, 8 * spelled.offset)[ends].tolist())
    out = []
    for search, text in zip(searches, texts, strict=True):
        plain = text.replace(BLANK, " ").encode()
        for _, (a, z) in zip(search.samples, bounds, strict=False):
            got = bytes(data[a:z])
            out.append((got[1:] if got[:1] == b" " else got) == plain)
    return out


_LATTICES: dict[tuple[str, float], Lattices] = {}

FIELDS = {"n_pieces": "long", "ids_crc32": "long", "log_prob": "double", "log_inclusion": "double", "round_trip": "boolean",
          "ids": "array<int>"}
_ARROW = {"n_pieces": pa.int64(), "ids_crc32": pa.int64(), "log_prob": pa.float64(), "log_inclusion": pa.float64(),
          "round_trip": pa.bool_(), "ids": pa.list_(pa.int32())}


def sampled_segmentations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, alpha: float = 0.8,
                          seed: int = 0, vocabulary: str = "piece_bpe_32k.model",
                          fields: tuple[str, ...] = ("n_pieces", "log_prob", "log_inclusion", "ids")) -> DataFrame:
    """``(doc_id, sample, ...)``: up to ``k`` distinct segmentations of every
    whole text, numbered from 0 in order of their perturbed probability.

    ``fields``: ``ids`` (the pieces), ``n_pieces``, ``ids_crc32`` (of the ids
    as little-endian 32-bit integers), ``log_prob`` (natural log),
    ``log_inclusion`` (log of the inclusion score) and ``round_trip``
    (whether decoding gives the text back; a lower one-eighth block stands
    for a blank in these vocabularies). A null or empty text has one empty
    segmentation. Rows with one id draw alike; null ids share a key; other
    columns are ignored; an empty table gives an empty result.
    """
    if k < 1 or alpha <= 0:
        raise ValueError("k must be at least 1 and alpha above 0")

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        lattices = _LATTICES.get((vocabulary, alpha))
        if lattices is None:
            lattices = _LATTICES[vocabulary, alpha] = Lattices(public_tokenizers.path(vocabulary), alpha)

        def emit(ids, keys, texts) -> pa.RecordBatch:
            if len(lattices.known) > CACHE_WORDS:
                lattices.trim()
            return describe(lattices, ids, texts, sample_block(lattices, keys, texts, k), fields)

        for batch in batches:
            ids, keys, texts, size = [], [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                ids.append(doc_id)
                keys.append(mix((seed << 1 | (doc_id is None)) & _MASK) ^ mix((doc_id or 0) & _MASK))
                texts.append(text)
                size += len(text) // 6 + 1
                if size >= BLOCK_WORDS:
                    yield emit(ids, keys, texts)
                    ids, keys, texts, size = [], [], [], 0
            if ids:
                yield emit(ids, keys, texts)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sample, "doc_id long, sample int, " + ", ".join(f"{f} {FIELDS[f]}" for f in fields))


def decode_segmentations(encoded: DataFrame, ids_col: str = "ids", vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text that the ids stand
    for; null ids give null."""

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        import public_tokenizers

        lattices = _LATTICES.get((vocabulary, 1.0))
        if lattices is None:
            lattices = _LATTICES[vocabulary, 1.0] = Lattices(public_tokenizers.path(vocabulary), 1.0)
        return pa.array([None if v is None else lattices.decode(v).decode("utf-8", "replace") for v in column.to_pylist()], pa.string())

    return encoded.withColumn("decoded", decode(F.col(ids_col)))
