"""Language-model scoring by a hidden Markov model.

A text is the sequence of its words and one end. A state emits a word class
(by spelling: short words are classes of their own, longer ones share a
class with words of the same beginning and ending), and a class emits its
words by their corpus counts:

    P(word | state) = P(class | state) * (c(word) + 1) / Z(class)

where Z sums c + 1 over the class's training words and adds one for all
unseen ones. The class emissions and the transitions are learned by
Baum-Welch; the expected counts of each task are added up by Spark. The
scaled forward recursion gives the exact likelihood of a whole text.

Words become numbers chunk by chunk: a chunk is a bounded run of documents
with its own word list. The lists are counted by a shuffle of words, and the
counts go back to the chunks by a join; no word list of the corpus is ever
held in one place.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatgate.llm.common import id_remainder, raw_texts, store, word_runs

STATES = 8
CLASSES = 1 << 14
#: Tokens of a chunk, about; a longer document is a chunk of its own.
CHUNK_TOKENS = 1 << 20
#: Rounds of Baum-Welch, each over all training documents: until one raises
#: the log likelihood by less than SETTLED nats a token, or so many.
SETTLED, MAX_ROUNDS = 1e-3, 50
#: Weight, in tokens, of the corpus's class shares in each state's emissions.
PRIOR_TOKENS = 50.0
#: The E-step takes longer documents in blocks of so many tokens, each with
#: the forward and backward values at its ends.
BLOCK = 1 << 12
GROUP_TOKENS = 800_000
COUNT_TOKENS = 1 << 16
#: Tokens whose sequences a task runs side by side, at most a chunk more.
STEP_TOKENS = 1 << 22
#: A round's task takes so many chunks (about a minute) before there are more
#: tasks than two a core: each task shuffles a row per class.
TASK_CHUNKS = 64
#: Forward values are scaled once in so many steps: a class that occurs has a
#: chance far above 1e-50 in some state, so four of them do not underflow.
SCALE_STEPS = 4


def word_class(word: bytes) -> int:
    """1 to CLASSES - 1 by spelling; the end (the empty word) is class 0."""
    if not word:
        return 0
    return 1 + zlib.crc32(word if len(word) <= 5 else word[:3] + b"~" + word[-3:]) % (CLASSES - 1)


@dataclass
class Model:
    start: np.ndarray  # STATES
    move: np.ndarray  # STATES x STATES
    emit: np.ndarray  # CLASSES x STATES


def _groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Sequences, longest first, in groups of bounded total length."""
    order = np.argsort(-lengths, kind="stable")
    total = np.cumsum(lengths[order]) // GROUP_TOKENS
    for cut in np.split(order, np.flatnonzero(np.diff(total)) + 1):
        if len(cut):
            yield cut


def _alive(lengths: np.ndarray) -> np.ndarray:
    """Number of sequences longer than t, for each t; lengths descend."""
    return np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")


def log_likelihood(model: Model, obs: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log likelihood of each sequence of classes, by the scaled
    forward recursion; sequences run side by side."""
    out = np.zeros(len(lengths))
    one = np.ones(len(model.start))
    for group in _groups(lengths):
        at, n = starts[group], _alive(lengths[group])
        alpha = model.start
        total = np.zeros(len(group))
        for t, live in enumerate(n.tolist()):
            emit = model.emit.take(obs[at[:live] + t], axis=0, mode="clip")
            alpha = (alpha[:live] @ model.move if t else alpha) * emit
            ended = int(n[t + 1]) if t + 1 < len(n) else 0
            if t % SCALE_STEPS == SCALE_STEPS - 1:
                scale = alpha @ one
                alpha /= scale[:, None]
                total[:live] += np.log(scale)
            if ended < live:
                total[ended:live] += np.log(alpha[ended:] @ one)
        out[group] = total
    return out


def _in_blocks(model: Model, obs: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """The sequences with long ones in blocks of ``BLOCK``: starts, lengths,
    whether a block begins its sequence, the forward value before it, the
    chances of its first state, and the backward value after it."""
    k = len(model.start)
    n_blocks = -(-lengths // BLOCK)
    at = np.arange(n_blocks.sum()) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    starts = np.repeat(starts, n_blocks) + at * BLOCK
    sizes = np.minimum(BLOCK, np.repeat(lengths, n_blocks) - at * BLOCK)
    before, begin, end = np.zeros((len(at), k)), np.tile(model.start, (len(at), 1)), np.ones((len(at), k))
    cut = np.flatnonzero(np.repeat(n_blocks, n_blocks) > 1)
    cut = cut[np.argsort(-sizes[cut], kind="stable")]
    if len(cut):
        # what each block does to a forward value: a product of matrices
        done = {}
        product = np.where((at[cut] == 0)[:, None, None], np.eye(k), model.move)
        n = _alive(sizes[cut])
        for t, live in enumerate(n.tolist()):
            emit = model.emit.take(obs[starts[cut[:live]] + t], axis=0, mode="clip")
            product = ((product[:live].reshape(-1, k) @ model.move).reshape(-1, k, k) if t else product) * emit[:, None, :]
            ended = int(n[t + 1]) if t + 1 < len(n) else 0
            if t % SCALE_STEPS == SCALE_STEPS - 1 or ended < live:
                product /= product.sum((1, 2), keepdims=True)
            if ended < live:
                done.update(zip(cut[ended:live].tolist(), product[ended:live].copy(), strict=True))
        for i in sorted(done):
            if at[i]:
                before[i], begin[i] = alpha, alpha @ model.move
            alpha = (before[i] if at[i] else model.start) @ done[i]
            alpha /= alpha.sum()
        for i in sorted(done, reverse=True):
            if at[i]:
                beta = done[i] @ end[i]
                end[i - 1] = beta / beta.sum()
    return starts, sizes, at == 0, before, begin, end


def expected_counts(model: Model, obs: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Baum-Welch counts of the sequences: starts, moves, class emissions."""
    return counts_and_likelihood(model, obs, starts, lengths)[:3]


def counts_and_likelihood(model: Model, obs: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """``expected_counts`` and the log likelihood of all sequences."""
    k = len(model.start)
    first, moves, emitted, likelihood = np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k)), 0.0
    one, back = np.ones(k), np.ascontiguousarray(model.move.T)
    starts, lengths, whole, before, begin, end = _in_blocks(model, obs, starts, lengths)
    groups = list(_groups(lengths))
    room = max((int(lengths[g].sum()) for g in groups), default=0)
    every_alpha, every_seen = np.empty((room, k)), np.empty(room, np.intp)
    every_emit = np.empty((max(map(len, groups), default=0), k))
    for group in groups:
        at, n = starts[group], _alive(lengths[group])
        # time-major copy: position of (t, sequence) is offset[t] + sequence
        offset = np.concatenate([[0], np.cumsum(n)])
        alpha, seen = every_alpha[:offset[-1]], every_seen[:offset[-1]]
        scales = {}
        a = begin[group]
        for t, live in enumerate(n.tolist()):
            s = slice(offset[t], offset[t + 1])
            now, emit = alpha[s], every_emit[:live]
            seen[s] = obs[at[:live] + t]
            model.emit.take(seen[s], axis=0, out=emit, mode="clip")
            np.multiply(a[:live] @ model.move if t else a, emit, out=now)
            if t % SCALE_STEPS == SCALE_STEPS - 1:
                scales[t] = now @ one
                now /= scales[t][:, None]
                likelihood += float(np.log(scales[t]).sum())
            a = now
        gamma = alpha  # becomes alpha * beta from the end on
        beta = np.ones((0, k))
        for t in range(len(n) - 1, -1, -1):
            live = int(n[t])
            s = slice(offset[t], offset[t + 1])
            if live > len(beta):
                last, late = alpha[offset[t] + len(beta):offset[t + 1]], end[group[len(beta):live]]
                likelihood += float(np.log(last @ one).sum())
                beta = np.concatenate([beta, late / (last * late).sum(1, keepdims=True)])
            ahead = every_emit[:live]  # emission times backward value, scaled
            model.emit.take(seen[s], axis=0, out=ahead, mode="clip")
            ahead *= beta
            if t in scales:
                ahead /= scales[t][:, None]
            if t:
                p = slice(offset[t - 1], offset[t - 1] + live)
                moves += alpha[p].T @ ahead
            gamma[s] *= beta
            beta = ahead @ back
        begins = whole[group]
        first += gamma[:len(group)][begins].sum(0)
        if not begins.all():  # the moves into blocks
            later = group[~begins]
            moves += before[later].T @ (gamma[:len(group)][~begins] / begin[later])
        for part in range(0, len(seen), COUNT_TOKENS):  # what the processor's cache holds
            s = slice(part, part + COUNT_TOKENS)
            for j in range(k):
                emitted[:, j] += np.bincount(seen[s], weights=gamma[s, j], minlength=CLASSES)
    return first, moves * model.move, emitted, likelihood


def maximised(first: np.ndarray, moves: np.ndarray, emitted: np.ndarray, share: np.ndarray) -> Model:
    """Model from expected counts, with ``PRIOR_TOKENS`` tokens of the
    corpus's class shares in every state."""
    k = len(first)
    emit = emitted + PRIOR_TOKENS * share[:, None]
    return Model((first + 0.1) / (first.sum() + 0.1 * k), (moves + 0.1) / (moves.sum(1, keepdims=True) + 0.1 * k), emit / emit.sum(0))


def first_model(share: np.ndarray, _=(), seed: int = 11) -> Model:
    """Seeded start near the class shares."""
    rng = np.random.default_rng(seed)
    emit = share[:, None] * np.exp(rng.normal(0, 0.5, (CLASSES, STATES)))
    return Model(np.full(STATES, 1 / STATES), np.full((STATES, STATES), 0.1 / (STATES - 1)) + np.eye(STATES) * (0.9 - 0.1 / (STATES - 1)),
                 emit / emit.sum(0))


_CHUNK = "chunk long, doc_ids array<long>, held array<boolean>, sizes array<int>, tokens binary, words array<string>, classes binary, counts array<int>"


def chunked(docs: DataFrame, id_col: str, text_col: str, modulus: int, held_out: int) -> DataFrame:
    """One row per chunk: its documents, their tokens as places in the
    chunk's word list, and per word its class and count in training
    documents."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        ids: list = []
        held: list[bool] = []
        tokens: list[np.ndarray] = []
        places: defaultdict = defaultdict(itertools.count().__next__)

        def close() -> pa.RecordBatch:
            words = list(places)
            sizes = np.array([len(t) for t in tokens], np.int32)
            every = np.concatenate(tokens)
            train = np.repeat(~np.array(held, bool), sizes)
            counts = np.bincount(every[train], minlength=len(words)).astype(np.int32)
            classes = np.array([word_class(w) for w in words], "<u2")
            row = [next(number), ids, held, sizes, pack_numbers(every), [w.decode() for w in words], classes.tobytes(), counts]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.string()),
                     pa.binary(), pa.list_(pa.int32())]
            names = ["chunk", "doc_ids", "held", "sizes", "tokens", "words", "classes", "counts"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

        waiting = 0
        for batch in batches:
            for doc_id, out, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw_texts(batch.column(2)), strict=True):
                parts = [np.fromiter(map(places.__getitem__, words), np.int32, len(words)) for words in word_runs(raw.lower())]
                ids.append(doc_id)
                held.append(out)
                tokens.append(np.concatenate([*parts, np.array([places[b""]], np.int32)]))
                waiting += len(tokens[-1])
                if waiting >= CHUNK_TOKENS:
                    yield close()
                    ids, held, tokens, waiting = [], [], [], 0
                    places = defaultdict(itertools.count().__next__)
        if ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (id_remainder(id_col, modulus) == held_out).alias("held"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, _CHUNK)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed byte plane by byte plane: the high
    bytes of word places are nearly constant."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _sequences(classes: bytes, token: np.ndarray, sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every token of a chunk, and where its documents start."""
    sizes = np.asarray(sizes, np.int64)
    return np.frombuffer(classes, "<u2")[token], np.cumsum(sizes) - sizes, sizes


def joined_sequences(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequences of several chunks as those of one."""
    at = np.cumsum([0, *(len(obs) for obs, _, _ in parts)])
    return (np.concatenate([obs for obs, _, _ in parts]), np.concatenate([starts + a for (_, starts, _), a in zip(parts, at, strict=False)]),
            np.concatenate([lengths for _, _, lengths in parts]))


def corpus_counts(chunks: DataFrame, model: Model):
    """Expected counts over the training documents of all chunks, and their
    log likelihood: each task adds up its own, Spark adds up the tasks'. The
    driver gets one row per class and state that occurs, at most CLASSES +
    STATES + 2."""
    shared = chunks.sparkSession.sparkContext.broadcast(model)
    k = len(model.start)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        sums = np.zeros((CLASSES + k + 2, k))
        waiting: list = []  # long sequences run better beside those of other chunks

        def add_up() -> None:
            obs, starts, lengths = joined_sequences(waiting)
            waiting.clear()
            if len(lengths):
                first, moves, emitted, likelihood = counts_and_likelihood(model, obs, starts, lengths)
                sums[:CLASSES] += emitted
                sums[CLASSES:CLASSES + k] += moves
                sums[-2] += first
                sums[-1, 0] += likelihood

        for batch in batches:
            for sizes, held, tokens, classes in zip(*(batch.column(c) for c in range(4)), strict=True):
                obs, starts, lengths = _sequences(classes.as_py(), unpack_numbers(tokens.as_py()), sizes.as_py())
                train = ~np.array(held.as_py(), bool)
                waiting.append((obs, starts[train], lengths[train]))
                if sum(len(w[0]) for w in waiting) >= STEP_TOKENS:
                    add_up()
        if waiting:
            add_up()
        rows = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *[pa.array(sums[rows, j]) for j in range(k)]],
                                         names=["row", *[f"k{j}" for j in range(k)]])

    partial = chunks.select("sizes", "held", "tokens", "classes").mapInArrow(count, "row int, " + ", ".join(f"k{j} double" for j in range(k)))
    total = np.zeros((CLASSES + k + 2, k))
    for row, *values in partial.groupBy("row").agg(*[F.sum(f"k{j}") for j in range(k)]).collect():
        total[row] = values
    return total[-2], total[CLASSES:-2], total[:CLASSES], float(total[-1, 0])


def word_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held_out: int = 2) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score)`` of every row of ``docs``; the model learns from the rows whose
    crc32 of the id as text leaves another remainder than ``held_out``.

    ``base_score`` sums add-one unigram log10 probabilities, ``score`` is
    the hidden Markov model's log10 probability of the text. A null or empty
    text is the end alone; null ids are in the fold of the empty text;
    repeated rows each count and give their row; other columns are ignored;
    an empty table gives an empty result. Without training rows all words
    are unseen and the model stays at its start.
    """
    chunks, _ = store(chunked(docs, id_col, text_col, modulus, held_out), "chunks")
    each = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).select(
        "chunk", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counts, _ = store(each.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0"), "word-counts")

    # the class sums: at most CLASSES rows
    sums = np.zeros((CLASSES, 2))
    klass = class_column("word")
    for row in counts.groupBy(klass.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        sums[row["k"]] = row["c"], row["v"]
    n, v = (int(x) for x in sums.sum(0))
    z = sums.sum(1) + 1.0
    share = z / z.sum()

    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, chunks.count() // TASK_CHUNKS)
    model, last = first_model(share), -np.inf
    for _ in range(MAX_ROUNDS if n else 0):
        *sums_of_round, likelihood = corpus_counts(chunks.coalesce(tasks), model)
        model = maximised(*sums_of_round, share)
        if likelihood - last < SETTLED * n:
            break
        last = likelihood

    # each chunk's word list with the corpus counts, back in its order
    back = each.select("chunk", "place", "word").join(counts, "word").groupBy("chunk").agg(
        F.collect_list(F.struct("place", "c")).alias("known"))
    joined = chunks.select("chunk", "doc_ids", "held", "sizes", "tokens", "classes", F.size("words").alias("n_words")).join(back, "chunk", "left")
    return _scored(joined.select("doc_ids", "held", "sizes", "tokens", "classes", "n_words", F.col("known.place").alias("places"),
                                   F.col("known.c").alias("c")), model, z, n, v)


def class_column(word: str):
    """``word_class`` as an expression."""
    raw = F.col(word).cast("binary")
    size = F.octet_length(raw)
    spelled = F.when(size <= 5, raw).otherwise(F.concat(F.substring(raw, 1, 3), F.lit("~").cast("binary"), F.expr(f"substring(cast({word} AS binary), -3, 3)")))
    return F.when(size == 0, F.lit(0).cast("long")).otherwise(1 + F.pmod(F.crc32(spelled), F.lit(CLASSES - 1)))


def _scored(joined: DataFrame, model: Model, z: np.ndarray, n: int, v: int) -> DataFrame:
    shared = joined.sparkSession.sparkContext.broadcast((model, np.log10(z)))

    def finished(waiting: list, rest: list) -> Iterator[pa.RecordBatch]:
        likelihood = log_likelihood(shared.value[0], *joined_sequences(waiting)) / np.log(10)
        at = 0
        for (_, _, lengths), (ids, held, n_known, base, in_words) in zip(waiting, rest, strict=True):
            k = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [ids, held, pa.array(lengths), pa.array(n_known), pa.array(np.full(k, n, np.int64)), pa.array(base),
                 pa.array(in_words + likelihood[at:at + k])],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
            at += k

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_z = shared.value[1]
        for batch in batches:
            waiting, rest = [], []
            for ids, held, sizes, tokens, classes, n_words, places, known in zip(*batch.columns, strict=True):
                c = np.zeros(n_words.as_py(), np.int64)
                if places.is_valid:
                    c[places.values.to_numpy(zero_copy_only=False)] = known.values.to_numpy(zero_copy_only=False)
                token = unpack_numbers(tokens.as_py())
                obs, starts, lengths = _sequences(classes.as_py(), token, sizes.as_py())
                in_class = np.add.reduceat(np.log10(c + 1.0)[token], starts)
                base = in_class - lengths * np.log10(float(n + v + 1))
                waiting.append((obs, starts, lengths))
                rest.append((ids.values, held.values, np.add.reduceat((c > 0)[token], starts, dtype=np.int64), base,
                             in_class - np.add.reduceat(log_z[obs], starts)))
                if sum(len(w[0]) for w in waiting) >= STEP_TOKENS:
                    yield from finished(waiting, rest)
                    waiting, rest = [], []
            if waiting:
                yield from finished(waiting, rest)

    return joined.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
