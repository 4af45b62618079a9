"""Toxicity by a convolutional text classifier.

Each word is the sum of hashed embeddings, of the word and of its first
letters (so the forms of one stem are alike). Filters of several widths run over the whole text; every filter
keeps its largest response (max pooling) and a logistic layer weighs them.
The classifier learns from all labelled rows: each Spark task runs gradient
descent over its part of them from the common weights, and the tasks' changes
are averaged, round by round. Its output is calibrated on all labelled rows
held back from training, and each language gets its own decision threshold
there (the language is no input of the score).
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatgate.llm.common import forget, id_remainder, raw_texts, store, word_runs

BUCKETS = 1 << 15
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (4, 5, 7)  # letters; the whole word comes first
_SHIFT = BUCKETS.bit_length() - 1
CACHE_WORDS = 300_000
BLOCK_WORDS = 100_000
# The descent starts near its goal from so many short rows of each class;
# then every labelled row takes part in every round.
START_ROWS, START_BYTES = 1000, 32_000
ROUNDS = 2
MINIBATCH = 64
# Text that one task trains on before its changes are averaged with those of
# others; a task sends a few MB.
SHARD_BYTES = 64 << 20
SLICE = 1 << 12  # rows of an array that are added up together
# Held-back scores are counted in so many steps of 0 to 1; thresholds lie
# between the scores of different steps. Outputs before calibration are
# counted in so many steps a unit, those beyond the range in one step.
SCORE_STEPS = 1 << 12
LOGIT_STEPS, LOGIT_RANGE = 1 << 8, 64
_STRIP = b".,;:!?\"'()[]"


class WordHash(dict):
    """Word -> packed bucket numbers of the word and of its first letters;
    emptied when it grows beyond its bound."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(_STRIP).lower() or word
        bare = bare.decode("utf-8", "replace").lower()
        found = zlib.crc32(bare.encode()) % BUCKETS
        for n in PREFIXES:
            found = found << _SHIFT | zlib.crc32(b"%d^" % n + bare[:n].encode()) % BUCKETS
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found
        return found


def bucket(packed: np.ndarray, part: int) -> np.ndarray:
    """Bucket numbers of one part: 0 the word, then the prefixes."""
    return packed >> _SHIFT * (len(PREFIXES) - part) & (BUCKETS - 1)


def text_ids(raw: bytes, known: WordHash) -> Iterator[np.ndarray]:
    """Packed buckets of a text's words, in blocks; blocks overlap by the
    widest filter less one, so no window is lost between them."""
    tail, any_words = [], False
    for words in word_runs(raw):
        if not words:
            continue
        words = tail + words
        yield np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        tail, any_words = words[1 - max(WIDTHS):], True
    if not any_words:
        yield np.empty(0, np.int64)


@dataclass
class TextConv:
    """Weights of the network and of its calibration."""

    tables: list[np.ndarray]  # per part of a word: BUCKETS + 1 (the last row pads) x DIM
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    bias: np.ndarray  # of all filters
    out: np.ndarray
    out_bias: float
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None  # the score where the labels have one class only

    def layout(self, blocks: list[np.ndarray]):
        """The blocks one after another, padded so no window reaches the
        next one: packed buckets, first position and length of each."""
        gap = max(WIDTHS) - 1
        lengths = np.array([max(1, len(b)) for b in blocks])
        starts = np.concatenate([[0], np.cumsum(lengths + gap)[:-1]])
        packed = np.full(int((lengths + gap).sum()), -1, np.int64)
        for s, b in zip(starts, blocks, strict=True):
            packed[s:s + len(b)] = b
        return packed, starts, lengths

    def buckets(self, packed: np.ndarray) -> list[np.ndarray]:
        return [np.where(packed < 0, BUCKETS, bucket(packed, k)) for k in range(len(self.tables))]

    def embedded(self, rows: list[np.ndarray]) -> np.ndarray:
        x = self.tables[0][rows[0]]
        for emb, row in zip(self.tables[1:], rows[1:], strict=True):
            x += emb[row]
        return x

    def responses(self, x: np.ndarray) -> Iterator[np.ndarray]:
        n = len(x) - max(WIDTHS) + 1
        for w, f in zip(WIDTHS, self.filters, strict=True):
            r = x[:n] @ f[0]
            for j in range(1, w):
                r += x[j:n + j] @ f[j]
            yield r

    def pooled(self, blocks: list[np.ndarray]) -> np.ndarray:
        """Largest response of each filter in each block."""
        packed, starts, lengths = self.layout(blocks)
        x = self.embedded(self.buckets(packed))
        cuts = np.stack([starts, starts + lengths], 1).ravel()
        if cuts[-1] >= len(x) - max(WIDTHS) + 1:
            cuts = cuts[:-1]
        parts = [np.maximum.reduceat(r, cuts, axis=0)[::2] for r in self.responses(x)]
        return np.maximum(np.concatenate(parts, 1) + self.bias, 0)

    def logits(self, features: np.ndarray) -> np.ndarray:
        return features @ self.out + self.out_bias

    def texts(self, raws: Iterable[bytes], known: WordHash) -> Iterator[np.ndarray]:
        """Pooled features of whole texts, in order."""
        return self.features(text_ids(raw, known) for raw in raws)

    def features(self, docs: Iterable[Iterable[np.ndarray]]) -> Iterator[np.ndarray]:
        """Pooled features of texts given as blocks of packed buckets."""
        blocks: list[np.ndarray] = []
        owner: list[int] = []
        waiting, size, k = 0, 0, -1
        for k, doc in enumerate(docs):  # noqa: B007
            for b in doc:
                blocks.append(b)
                owner.append(k - waiting)
                size += len(b)
            if size >= BLOCK_WORDS:
                yield self._of_texts(blocks, owner, k + 1 - waiting)
                blocks, owner, size, waiting = [], [], 0, k + 1
        if blocks:
            yield self._of_texts(blocks, owner, k + 1 - waiting)

    def _of_texts(self, blocks, owner, n) -> np.ndarray:
        best = np.zeros((n, len(self.bias)), np.float32)
        for lo, hi in _spans(blocks):
            np.maximum.at(best, owner[lo:hi], self.pooled(blocks[lo:hi]))
        return best

    def scores(self, raws: Iterable[bytes], known: WordHash) -> np.ndarray:
        if self.constant is not None:
            return np.array([self.constant for _ in raws])
        z = np.concatenate([np.zeros(0), *(self.logits(f) for f in self.texts(raws, known))])
        return _sigmoid(self.slope * z + self.offset)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _spans(blocks: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Blocks that go together: bounded memory for a text of many blocks."""
    lo = 0
    while lo < len(blocks):
        hi, size = lo, 0
        while hi < len(blocks) and (hi == lo or size + len(blocks[hi]) <= 2 * BLOCK_WORDS):
            size += len(blocks[hi])
            hi += 1
        yield lo, hi
        lo = hi


def _count_texts(docs: list[list[np.ndarray]], labels: np.ndarray, counts: np.ndarray) -> None:
    """Adds the texts of each label that have a bucket: part, bucket, label."""
    words = np.concatenate([b for d in docs for b in d])
    owner = np.repeat(np.arange(len(docs)), [sum(map(len, d)) for d in docs])
    for part in range(len(counts)):
        once = np.unique(owner << _SHIFT | bucket(words, part))
        np.add.at(counts[part], (once & (BUCKETS - 1), labels[once >> _SHIFT]), 1)


def _no_counts() -> np.ndarray:
    return np.zeros((1 + len(PREFIXES), BUCKETS + 1, 2))


def _log_odds(with_it: np.ndarray, negative: int, positive: int) -> np.ndarray:
    """Log odds of the label by bucket, over the documents that have it,
    shrunk towards zero where few do."""
    n = max(1, negative), max(1, positive)
    odds = np.log((with_it[..., 1] + 0.5) / (n[1] + 1)) - np.log((with_it[..., 0] + 0.5) / (n[0] + 1))
    seen = with_it.sum(-1)
    odds = (odds * seen / (seen + 5)).astype(np.float32)
    odds[:, BUCKETS] = 0
    return odds


class Descent:
    """Minibatch gradient descent (Adagrad) on the weights of a network. A
    response's gradient flows to the one window that gave the maximum."""

    def __init__(self, net: TextConv, negative: int, positive: int, rate: float = 0.05):
        self.net, self.rate = net, rate
        self.params = [*net.filters, net.bias, net.out]
        self.squares, self.table_squares = ([np.full(p.shape, 1e-2, np.float32) for p in ps] for ps in (self.params, net.tables))
        self.out_square = 1e-2
        self.hits = [np.zeros(len(t), np.float32) for t in net.tables]  # steps that changed a row
        n = negative + positive
        self.weight = np.array([0.5 * n / max(1, negative), 0.5 * n / max(1, positive)], np.float32)

    def windows(self, docs: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Packed buckets of the window of the largest response, per width:
        document, filter, place."""
        net = self.net
        blocks, owner = [b for d in docs for b in d], np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        best = [np.full((len(docs), FILTERS), -np.inf, np.float32) for _ in WIDTHS]
        found = [np.full((len(docs), FILTERS, w), -1, np.int64) for w in WIDTHS]
        for lo, hi in _spans(blocks):
            packed, starts, lengths = net.layout(blocks[lo:hi])
            x = net.embedded(net.buckets(packed))
            for k, (w, r) in enumerate(zip(WIDTHS, net.responses(x), strict=True)):
                for i, s, n in zip(owner[lo:hi].tolist(), starts.tolist(), lengths.tolist(), strict=True):
                    t = s + r[s:s + n].argmax(0)
                    top = r[t, np.arange(FILTERS)]
                    more = top > best[k][i]
                    best[k][i, more] = top[more]
                    found[k][i, more] = packed[t[more, None] + np.arange(w)]
        return found

    def step(self, docs: list[list[np.ndarray]], y: np.ndarray) -> None:
        net, rate = self.net, self.rate
        ids = self.windows(docs)
        flat = net.buckets(np.concatenate([t.ravel() for t in ids]))
        cuts = np.cumsum([t.size for t in ids])[:-1]
        wins = [part.reshape(*t.shape, DIM) for part, t in zip(np.split(net.embedded(flat), cuts), ids, strict=True)]
        feats = [np.einsum("bfjd,jdf->bf", win, f) for win, f in zip(wins, net.filters, strict=True)]
        h = np.maximum(np.concatenate(feats, 1) + net.bias, 0)
        dz = ((_sigmoid(h @ net.out + net.out_bias) - y) * self.weight[y] / len(docs)).astype(np.float32)
        dh = dz[:, None] * net.out * (h > 0)
        per_width = [dh[:, k * FILTERS:(k + 1) * FILTERS] for k in range(len(WIDTHS))]
        grads = [np.einsum("bf,bfjd->jdf", d, win) for d, win in zip(per_width, wins, strict=True)]
        grads += [dh.sum(0), h.T @ dz + 1e-4 * net.out]
        drows = np.concatenate([np.einsum("bf,jdf->bfjd", d, f).reshape(-1, DIM) for d, f in zip(per_width, net.filters, strict=True)])
        for emb, square, hits, rows in zip(net.tables, self.table_squares, self.hits, flat, strict=True):
            order = np.argsort(rows, kind="stable")
            hit, first = np.unique(rows[order], return_index=True)
            g = np.add.reduceat(drows[order], first, axis=0)
            square[hit] += g * g
            emb[hit] -= rate * g / np.sqrt(square[hit])
            emb[BUCKETS] = 0
            hits[hit] += 1
        for p, s, g in zip(self.params, self.squares, grads, strict=True):
            s += g * g
            p -= rate * g / np.sqrt(s)
        self.out_square += float(dz.sum()) ** 2
        net.out_bias -= rate * float(dz.sum()) / self.out_square ** 0.5


def train(raws: list[bytes] | list[list[np.ndarray]], labels: list[int], odds: np.ndarray | None = None, seed: int = 7, epochs: int = 6, rate: float = 0.05) -> TextConv:
    """Fit a network from nothing. The first embedding dimension starts from
    the log odds of its bucket, by default those of ``raws`` (texts, or
    their blocks of packed buckets)."""
    y = np.array(labels, np.int64)
    rng = np.random.default_rng(seed)
    known = WordHash()
    docs = [list(text_ids(raw, known)) if isinstance(raw, bytes) else raw for raw in raws]
    net = TextConv(
        [rng.normal(0, 0.05, (BUCKETS + 1, DIM)).astype(np.float32) for _ in (0, *PREFIXES)],
        [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS], np.zeros(len(WIDTHS) * FILTERS, np.float32),
        np.full(len(WIDTHS) * FILTERS, 0.1, np.float32), -1.0)
    negative, positive = int((y == 0).sum()), int((y == 1).sum())
    if odds is None:
        counts = _no_counts()
        if docs:
            _count_texts(docs, y, counts)
        odds = _log_odds(counts, negative, positive)
    for of_part, emb in zip(odds, net.tables, strict=True):
        emb[:, 0] = of_part / len(net.tables)
        emb[BUCKETS] = 0
    for f in net.filters:
        f[:, 0, :] += 1.0 / len(f)
    descent = Descent(net, negative, positive, rate)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(docs), MINIBATCH):
            pick = order[at:at + MINIBATCH]
            descent.step([docs[i] for i in pick], y[pick])
    return net


_SLICE = pa.schema([("array", pa.int32()), ("at", pa.int32()), ("task", pa.int32()), ("data", pa.binary())])


def added_up(rows: DataFrame, work: Callable[[Iterable[pa.RecordBatch]], list[np.ndarray]], shapes: list[tuple]) -> list[np.ndarray]:
    """Sums over the tasks that read ``rows`` of the arrays that ``work``
    makes in each. Spark adds them up slice by slice; the driver gets the
    sums, in single precision."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, values in enumerate(work(batches)):
            for at in range(0, len(values), SLICE):
                row = {"array": k, "at": at, "task": task, "data": values[at:at + SLICE].astype("<f4").tobytes()}
                yield pa.RecordBatch.from_pylist([row], schema=_SLICE)

    def add(group: pa.Table) -> pa.Table:
        group = group.sort_by("task")  # the same rounding in every run
        total = sum(np.frombuffer(d.as_py(), "<f4").astype("<f8") for d in group["data"])
        return pa.Table.from_pylist([{**group.slice(0, 1).to_pylist()[0], "data": total.astype("<f4").tobytes()}], schema=_SLICE).drop(["task"])

    sums = [np.zeros(shape) for shape in shapes]
    parts = rows.mapInArrow(each, "array int, at int, task int, data binary").groupBy("array", "at").applyInArrow(add, "array int, at int, data binary")
    for r in parts.collect():
        values = sums[r["array"]][r["at"]:r["at"] + SLICE]
        values += np.frombuffer(r["data"], "<f4").reshape(values.shape)
    return sums


def ids_column(text_col: str) -> Column:
    """Column of a text's blocks of packed buckets: each pass over the
    labelled rows reads those instead of cutting the texts into words."""
    known = WordHash()

    @F.arrow_udf("array<binary>")
    def ids(texts: pa.Array) -> pa.Array:
        return pa.array([[b.astype("<i8").tobytes() for b in text_ids(raw, known)] for raw in raw_texts(texts)], pa.list_(pa.binary()))

    return ids(F.col(text_col))


def _blocks(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """Blocks of each row of a column of texts or of their ``ids_column``."""
    if pa.types.is_list(column.type):
        for row in column:
            yield [np.frombuffer(b, "<i8") for b in row.as_py()]
    else:
        known = WordHash()
        for raw in raw_texts(column):
            yield list(text_ids(raw, known))


def _minibatches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[list[np.ndarray]], np.ndarray]]:
    """Blocks and labels of the rows ``(y, text or ids)``, a bounded number
    of texts and, but for the last of them, of words at a time."""
    docs, labels, size = [], [], 0
    for batch in batches:
        for y, blocks in zip(batch.column(0).to_pylist(), _blocks(batch.column(1)), strict=True):
            docs.append(blocks)
            labels.append(y)
            size += sum(map(len, docs[-1]))
            if len(docs) >= MINIBATCH or size >= 2 * BLOCK_WORDS:
                yield docs, np.array(labels)
                docs, labels, size = [], [], 0
    if docs:
        yield docs, np.array(labels)


def counts_of(rows: DataFrame) -> np.ndarray:
    """Rows of each label by part and bucket."""

    def count(batches: Iterable[pa.RecordBatch]) -> list[np.ndarray]:
        counts, any_docs = _no_counts(), False
        for docs, labels in _minibatches(batches):
            _count_texts(docs, labels, counts)
            any_docs = True
        return list(counts) if any_docs else []

    return np.stack(added_up(rows, count, [(BUCKETS + 1, 2)] * (1 + len(PREFIXES))))


def log_odds_of(rows: DataFrame, negative: int, positive: int) -> np.ndarray:
    """Log odds by part and bucket over all ``rows``."""
    return _log_odds(counts_of(rows), negative, positive)


def round_of_descent(net: TextConv, rows: DataFrame, negative: int, positive: int) -> TextConv:
    """One pass over all ``rows``: every task descends from ``net`` over its
    own. An embedding is moved by the mean of the tasks' changes, each
    counting by the steps that changed it, the other weights by the mean
    over rows."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def dense(of: TextConv) -> np.ndarray:
        return np.concatenate([*(p.ravel() for p in (*of.filters, of.bias, of.out)), [of.out_bias]])

    def descend(batches: Iterable[pa.RecordBatch]) -> list[np.ndarray]:
        start = shared.value
        own = TextConv([t.copy() for t in start.tables], [f.copy() for f in start.filters], start.bias.copy(), start.out.copy(), start.out_bias)
        descent, n = Descent(own, negative, positive), 0
        for docs, labels in _minibatches(batches):
            descent.step(docs, labels)
            n += len(docs)
        if not n:
            return []
        changes = [np.column_stack([(a - b) * h[:, None], h]) for a, b, h in zip(own.tables, start.tables, descent.hits, strict=True)]
        return [*changes, np.append((dense(own) - dense(start)) * n, n)]

    shapes = [(BUCKETS + 1, DIM + 1)] * len(net.tables)
    *tables, rest = added_up(rows, descend, [*shapes, (len(dense(net)) + 1,)])
    shared.destroy()
    moved = [t + (c[:, :-1] / np.maximum(c[:, -1:], 1)).astype(np.float32) for t, c in zip(net.tables, tables, strict=True)]
    new = dense(net) + rest[:-1] / rest[-1]
    at, parts = 0, []
    for p in (*net.filters, net.bias, net.out):
        parts.append(new[at:at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return TextConv(moved, parts[:len(net.filters)], parts[-2], parts[-1], float(new[-1]))


def calibrate(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through held-back rows; an
    entry stands for ``w`` of them."""
    # two weak pseudo-rows keep the curve finite where the classes separate
    z = np.concatenate([z, [np.average(z[y == v], weights=w[y == v]) for v in (1, 0)]])
    w = np.concatenate([w, [1.0, 1.0]])
    y = np.concatenate([y, [0.5, 0.5]])
    a, b = 1.0, 0.0
    for _ in range(200):
        p = _sigmoid(a * z + b)
        g = np.array([((p - y) * w * z).sum() + 1e-3 * (a - 1), ((p - y) * w).sum()])
        v = p * (1 - p) * w
        hess = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum()]]) + 1e-6 * np.eye(2)
        step = np.clip(np.linalg.solve(hess, g), -1, 1)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


def calibration_of(held: DataFrame) -> tuple[float, float]:
    """``calibrate`` over all held-back rows ``(y, z)``. The driver gets
    their counts and means by label and step of the output."""
    step = F.floor(F.greatest(F.least("z", F.lit(float(LOGIT_RANGE))), F.lit(-float(LOGIT_RANGE))) * LOGIT_STEPS)
    steps = held.groupBy("y", step.alias("step")).agg(F.avg("z").alias("z"), F.count(F.lit(1)).alias("n")).toArrow().sort_by([("y", "ascending"), ("step", "ascending")])
    z, y, n = (steps[c].to_numpy().astype(float) for c in ("z", "y", "n"))
    return calibrate(z, y, n)


def language_thresholds(score: np.ndarray, y: np.ndarray, lang: list, w: np.ndarray, default: float, high: np.ndarray | None = None) -> dict[str, float]:
    """Per language the threshold of least error on held-back rows (midway
    between the rows it parts), drawn towards ``default`` as by ten rows of
    it. An entry stands for ``w`` rows, with scores of ``score`` to ``high``;
    entries of one ``score`` are never parted."""
    out = {}
    high = score if high is None else high
    for name in sorted({x for x in lang if x is not None}):
        mine = np.array([x == name for x in lang])
        t, v = y[mine], w[mine]
        n = float((v * t).sum())
        if v.sum() < 20 or n == 0 or n == v.sum():
            continue
        low, at = np.unique(score[mine], return_inverse=True)
        top = np.zeros(len(low))
        np.maximum.at(top, at, high[mine])
        missed, wrong = np.bincount(at, v * t), np.bincount(at, v * (1 - t))
        errors = np.append(0, np.cumsum(missed)) + np.append(np.cumsum(wrong[::-1])[::-1], 0)
        below, above = np.append(0.0, top), np.append(low, 1.0)
        cuts, errors = ((below + above) / 2)[above > below], errors[above > below]
        least = cuts[np.isclose(errors, errors.min())]
        best = float(least[np.argmin(abs(least - default))])
        out[name] = float(best * n + 10 * default) / float(n + 10)
    return out


def thresholds_of(held: DataFrame, slope: float, offset: float, default: float) -> dict[str, float]:
    """``language_thresholds`` over all held-back rows ``(y, lang, z)``. The
    driver gets their counts by language and step of the score."""
    score = 1 / (1 + F.exp(-F.greatest(F.least(F.lit(slope) * F.col("z") + F.lit(offset), F.lit(40.0)), F.lit(-40.0))))
    scored = held.filter("lang IS NOT NULL").select("lang", "y", score.alias("score"))
    both = scored.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).filter("n >= 20 AND p > 0 AND p < n")
    steps = (
        scored.join(both.select("lang"), "lang", "left_semi").groupBy("lang", F.floor(F.col("score") * SCORE_STEPS).alias("step"))
        .agg(F.min("score").alias("low"), F.max("score").alias("high"), F.sum(1 - F.col("y")).alias("n0"), F.sum("y").alias("n1"))
        .toArrow()
    )
    low, high, n0, n1 = (steps[c].to_numpy() for c in ("low", "high", "n0", "n1"))
    y = np.repeat([0, 1], len(low))
    return language_thresholds(np.tile(low, 2), y, steps["lang"].to_pylist() * 2, np.concatenate([n0, n1]).astype(float), default, np.tile(high, 2))


def learned(rows: DataFrame, counts: np.ndarray, negative: int, positive: int) -> TextConv:
    """Network from all ``rows (id, y, ids, size)``: the log odds of all of
    them, by ``counts``, and a start trained on at most ``START_ROWS`` short
    rows of each class give the first weights, then all rows take part in
    every one of ``ROUNDS`` rounds."""
    short = rows.filter(F.col("size") <= START_BYTES)
    first = [short.filter(F.col("y") == v).select("id").orderBy(F.xxhash64("id"), "id").limit(START_ROWS) for v in (0, 1)]
    start = short.join(F.broadcast(first[0].unionByName(first[1])), "id").select("id", "y", "ids").toArrow().sort_by("id")
    net = train(list(_blocks(start["ids"].combine_chunks())), start["y"].to_pylist(), _log_odds(counts, negative, positive))
    for _ in range(ROUNDS):
        net = round_of_descent(net, rows.select("y", "ids"), negative, positive)
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
        label_col: str = "toxic", held_out: int = 1, folds: int = 3, default: float = 0.7) -> tuple[TextConv, dict[str, float]]:
    """Network and language thresholds from all labelled rows outside fold
    ``held_out``, their whole texts. A fifth of the rows, by id, calibrates
    and gives the thresholds; the others train.

    Ids labelled twice count as toxic if any label says so; of the texts
    under one id the one of the smallest hash teaches; null ids and labels
    teach nothing. Without both classes the score is the constant
    share of toxic rows, at most one half."""
    teaches = F.col(id_col).isNotNull() & (id_remainder(id_col, folds) != held_out)
    marked = (
        labels.filter(teaches & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    )
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    texts = docs.filter(teaches).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), lang.alias("lang"))
    size = texts.select("id", F.octet_length("text").alias("size")).join(marked, "id").agg(F.sum("size")).first()[0]
    shards = 1 + (size or 0) // SHARD_BYTES
    each = (
        texts.repartition(shards, "id").join(marked.repartition(shards, "id"), "id")
        .groupBy("id").agg(F.max("y").alias("y"), F.min(F.struct(F.xxhash64("text"), "text", "lang")).alias("row"))
    )
    back = F.crc32(F.concat(F.lit("calibrate"), F.col("id").cast("string")).cast("binary")) % 5 == 0
    each = each.select("id", "y", "row.text", "row.lang", back.alias("back")).sortWithinPartitions(F.xxhash64("id"), "id")
    rows, rows_path = store(each.select("id", "y", "lang", "back", F.octet_length("text").alias("size"), ids_column("text").alias("ids")), "toxicity-rows")

    n = {(r["y"], r["back"]): r["n"] for r in rows.groupBy("y", "back").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not (any(y == 0 for y, _ in n) and any(y == 1 for y, _ in n)):
        forget(docs.sparkSession, rows_path)
        totals = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(totals) > 1:
            warnings.warn(f"labels have both classes ({totals}), the usable documents do not: the score is constant", RuntimeWarning, stacklevel=2)
        return TextConv([], [], np.zeros(0), np.zeros(0), 0.0, constant=0.5 if any(y == 1 for y, _ in n) else 0.0), {}

    split = len(n) == 4  # both classes train and calibrate; else all rows do both
    taught, held = (rows.filter("NOT back"), rows.filter("back")) if split else (rows, rows)
    negative, positive = (sum(k for (y, b), k in n.items() if y == v and not (split and b)) for v in (0, 1))
    net = learned(taught, counts_of(taught.select("y", "ids")), negative, positive)
    scored, held_path = store(held.select("y", "lang", logit_column(net, docs, "ids").alias("z")), "toxicity-held")
    net.slope, net.offset = calibration_of(scored)
    thresholds = thresholds_of(scored, net.slope, net.offset, default)
    forget(docs.sparkSession, rows_path, held_path)
    return net, thresholds


def logit_column(net: TextConv, docs: DataFrame, ids_col: str = "ids") -> Column:
    """Column of the network's outputs before calibration, of a column of
    texts or of their ``ids_column``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def logit(column: pa.Array) -> pa.Array:
        found = [shared.value.logits(f) for f in shared.value.features(_blocks(column))]
        return pa.array(np.concatenate([np.zeros(0), *found]), pa.float64())

    return logit(F.col(ids_col))


def toxicity_score(net: TextConv, docs: DataFrame, text_col: str = "text") -> Column:
    """Column of scores of whole texts (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few MB, whatever the corpus
    known = WordHash()

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(raw_texts(texts), known), pa.float64())

    return score(F.col(text_col))


def threshold_column(thresholds: dict[str, float], lang_col: str, default: float) -> Column:
    out = F.lit(default)
    for name, value in sorted(thresholds.items()):
        out = F.when(F.col(lang_col).cast("string") == name, F.lit(value)).otherwise(out)
    return out


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             threshold: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted, lang_threshold,
    lang_predicted)`` of every row of ``docs``.

    ``predicted`` compares with ``threshold``, ``lang_predicted`` with the
    threshold of the row's language (``threshold`` where the labels are too
    few). Null and empty texts get the network's score of no words; null
    ids are in the fold of the empty text; repeated rows each give their
    row; other columns are ignored.
    """
    net, thresholds = fit(docs, labels, id_col, text_col, lang_col, default=threshold)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (id_remainder(id_col, 3) == 1).alias("held_out"),
        toxicity_score(net, docs, text_col).alias("score"), threshold_column(thresholds, lang_col, threshold).alias("lang_threshold"))
    return rows.select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
        "lang_threshold", (F.col("score") >= F.col("lang_threshold")).alias("lang_predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows that reach their language's threshold."""
    net, thresholds = fit(docs, labels, id_col, text_col, lang_col, default=threshold)
    return docs.filter(toxicity_score(net, docs, text_col) < threshold_column(thresholds, lang_col, threshold))
