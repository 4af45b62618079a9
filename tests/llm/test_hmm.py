import collections
import itertools
import math

import numpy as np

from flatgate.llm import hmm as H
from tests.llm.helpers import EDGE, LOWER, SF, frame, remainder, words


def tiny_model(seed=0):
    rng = np.random.default_rng(seed)
    emit = np.zeros((H.CLASSES, 3))
    emit[:5] = rng.random((5, 3))
    move = rng.random((3, 3))
    start = rng.random(3)
    return H.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def brute_likelihood(m, obs):
    total = 0.0
    for path in itertools.product(range(3), repeat=len(obs)):
        p = m.start[path[0]] * m.emit[obs[0], path[0]]
        for a, b, o in zip(path, path[1:], obs[1:], strict=False):
            p *= m.move[a, b] * m.emit[o, b]
        total += p
    return math.log(total)


def layout(seqs):
    lengths = np.array([len(s) for s in seqs])
    return np.concatenate(seqs), np.cumsum(lengths) - lengths, lengths


def test_likelihood_is_exact():
    m = tiny_model()
    rng = np.random.default_rng(1)
    seqs = [rng.integers(0, 5, n) for n in (1, 6, 3, 7, 1, 4)]
    got = H.log_likelihood(m, *layout(seqs))
    assert np.allclose(got, [brute_likelihood(m, s) for s in seqs])


def test_expected_counts_match_enumeration():
    m = tiny_model()
    seqs = [np.array(s) for s in ([0, 1, 2, 1], [4], [3, 3, 0])]
    first, moves, emitted = np.zeros(3), np.zeros((3, 3)), np.zeros((H.CLASSES, 3))
    for obs in seqs:
        every = []
        for path in itertools.product(range(3), repeat=len(obs)):
            p = m.start[path[0]] * m.emit[obs[0], path[0]]
            for a, b, o in zip(path, path[1:], obs[1:], strict=False):
                p *= m.move[a, b] * m.emit[o, b]
            every.append((p, path))
        z = sum(p for p, _ in every)
        for p, path in every:
            first[path[0]] += p / z
            for a, b in zip(path, path[1:], strict=False):
                moves[a, b] += p / z
            for s, o in zip(path, obs, strict=True):
                emitted[o, s] += p / z
    got = H.expected_counts(m, *layout(seqs))
    for g, w in zip(got, (first, moves, emitted), strict=True):
        assert np.allclose(g, w)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(2)
    seqs = [np.where(rng.random(40) < 0.9, rng.integers(0, 3, 40) + 3 * (k % 2), 0) for k in range(30)]
    share = np.full(H.CLASSES, 1e-9)
    share[:6] = 1 / 6
    share /= share.sum()
    m = H.first_model(share, [])
    last = -np.inf
    for _ in range(6):
        m = H.maximised(*H.expected_counts(m, *layout(seqs)), share)
        now = H.log_likelihood(m, *layout(seqs)).sum()
        assert now > last - 5  # the prior may cost a little near the end
        last = now
    assert abs(m.emit.sum(0) - 1).max() < 1e-9 and abs(m.move.sum(1) - 1).max() < 1e-9


def test_class_expression_equals_the_function(spark):
    w = ["", "a", "abcde", "abcdef", "über", "日本語の長い", "x" * 1000, "\U0001F600\U0001F600"]
    rows = spark.createDataFrame([(x,) for x in w], "w string").select("w", H.class_column("w").alias("k")).collect()
    assert {r.w: r.k for r in rows} == {x: H.word_class(x.encode()) for x in w}


def check(got, rows):
    tokens = [[*words((t or "").translate(LOWER)), ""] for _, t, *_ in rows]
    train = [remainder(d, 7) != 2 for d, *_ in rows]
    counts = collections.Counter(w for ws, t in zip(tokens, train, strict=True) if t for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted(((d, not t, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
                   for (d, *_), ws, t in zip(rows, tokens, train, strict=True)), key=lambda r: (str(r[0]), r[2], r[5]))
    have = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got),
                  key=lambda r: (str(r[0]), r[2], r[5]))
    assert [r[:5] for r in have] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in have], [r[5] for r in want])


def test_edge_rows(spark):
    got = H.word_scores(frame(spark)).collect()
    check(got, EDGE)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    same = [r.score for r in got if r.doc_id == 2]
    assert len(same) == 2 and same[0] == same[1]
    assert H.word_scores(frame(spark, [])).collect() == []


def test_small_chunks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(H, "CHUNK_TOKENS", 50)
    check(H.word_scores(frame(spark).coalesce(1)).collect(), EDGE)


def test_model_beats_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = [r for r in H.word_scores(docs).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.98 * sum(r.base_score for r in got)
    assert sum(r.score > r.base_score for r in got) > 0.8 * len(got)


def test_word_probabilities_sum_to_one():
    """Over the words of a class and its unseen word, and over classes."""
    c = np.array([3, 1, 7])
    z = (c + 1).sum() + 1
    assert math.isclose(((c + 1) / z).sum() + 1 / z, 1)
    share = np.ones(H.CLASSES) / H.CLASSES
    assert np.allclose(H.first_model(share, []).emit.sum(0), 1)


def test_every_round_goes_over_all_training_documents(spark, monkeypatch):
    """The likelihood has settled, and documents of any length, one of them
    over the 16,000 bytes of the former sample, count in every round."""
    words_of = ["aa bb cc dd", "zz yy xx ww"]
    rows = [(i, " ".join([words_of[i % 2]] * (5000 if i == 1 else 30)), "en", "a") for i in range(40)]
    seen = []
    real = H.corpus_counts

    def counted(chunks, model):
        out = real(chunks, model)
        seen.append((out[0].sum(), out[2].sum(), out[3]))
        return out

    monkeypatch.setattr(H, "corpus_counts", counted)
    got = H.word_scores(frame(spark, rows)).collect()
    train = [r for r in got if not r.held_out]
    assert len(seen) > 2
    for texts, tokens, _ in seen:
        assert math.isclose(texts, len(train)) and math.isclose(tokens, sum(r.n_tokens for r in train))
    assert seen[-1][2] - seen[-2][2] < H.SETTLED * train[0].train_tokens < seen[-2][2] - seen[-3][2]


def test_counts_do_not_depend_on_blocks(monkeypatch):
    m = tiny_model()
    rng = np.random.default_rng(4)
    seqs = [rng.integers(0, 5, n) for n in (1, 50, 7, 14, 8, 23, 3)]
    want = H.counts_and_likelihood(m, *layout(seqs))
    for block in (1, 2, 7):
        monkeypatch.setattr(H, "BLOCK", block)
        for g, w in zip(H.counts_and_likelihood(m, *layout(seqs)), want, strict=True):
            assert np.allclose(g, w)


def test_counts_of_a_very_long_document_are_exact(spark, monkeypatch):
    rng = np.random.default_rng(5)
    long = " ".join(rng.choice(["a", "b", "c", "d"], H.BLOCK + 2000))
    rows = [(1, long, "en", "a"), (3, "a b c", "en", "a")]
    share = np.full(H.CLASSES, 1 / H.CLASSES)
    model = H.first_model(share, [])
    chunks, _ = H.store(H.chunked(frame(spark, rows), "doc_id", "text", 7, 9), "chunks")
    got = H.corpus_counts(chunks, model)
    seqs = [np.array([H.word_class(w) for w in t.encode().split()] + [0]) for _, t, *_ in rows]
    monkeypatch.setattr(H, "BLOCK", 1 << 40)
    for g, w in zip(got, H.counts_and_likelihood(model, *layout(seqs)), strict=True):
        assert np.allclose(g, w)
    assert math.isclose(got[0].sum(), 2)  # two texts, two starts
