import collections
import itertools
import math

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from flatgate.llm import segmentations as G
from flatgate.llm.queries import op9_segmentations
from tests.llm.helpers import EDGE, SF, SMALL, canon, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattices():
    return G.Lattices(PATH, 0.8)


def every_path(lattices, text):
    """All segmentations of a text with their log probabilities."""
    parts = G.split_words(text)
    lattices.learn({w for w in parts if w not in lattices.known})
    first, cum, to, piece, logp = lattices.views()

    def paths(node):
        if node == 0:
            return [((), 0.0)]
        return [((int(piece[e]), *p), l + logp[e]) for e in G._siblings(lattices.views(), int(first[node])) for p, l in paths(int(to[e]))]

    out = [((), 0.0)]
    for start in lattices.starts(parts):
        out = [(p + q, l + m) for p, l in out for q, m in paths(int(start))]
    return dict(out)


def brute_weights(lattices, text):
    """All segmentations by recursion over the vocabulary, normalised."""
    text = " " + text.replace(G.BLANK, " ")
    found = {}

    def go(at, ids, w):
        if at == len(text):
            found[ids] = w
        for j in range(at + 1, len(text) + 1):
            if text[at:j] in lattices.pieces:
                i, v = lattices.pieces[text[at:j]]
                go(j, (*ids, i), w + v)
        if at < len(text) and text[at] not in lattices.pieces:
            raw = text[at].encode()
            go(at + 1, (*ids, *(lattices.bytes[b] for b in raw)), w + len(raw) * lattices.byte_weight)

    go(0, (), 0.0)
    z = math.log(sum(math.exp(v) for v in found.values()))
    return {k: v - z for k, v in found.items()}


@pytest.mark.parametrize("text", ["the cat", "a  b", " x", "é\nab", "to 😀 ", "日▁b", "\n\n"])
def test_lattice_has_every_segmentation(lattices, text):
    got, want = every_path(lattices, text), brute_weights(lattices, text)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert len({lattices.decode(list(k)) for k in got}) == 1


def test_samples_follow_the_distribution(lattices):
    text, n, k = "the cat", 6000, 3
    chance = every_path(lattices, text)
    searches = G.sample_block(lattices, [G.mix(i) for i in range(n)], [text] * n, k)
    piece = lattices.piece.view()
    first, second, estimate = collections.Counter(), collections.Counter(), 0.0
    for s in searches:
        ids = [tuple(piece[x.edges].tolist()) for x in s.samples]
        assert len(set(ids)) == k
        assert [x.value for x in s.samples] == sorted((x.value for x in s.samples), reverse=True)
        first[ids[0]] += 1
        second[ids[0], ids[1]] += 1
        # inclusion scores make sums over the samples unbiased
        estimate += sum(math.exp(x.logp - s.log_inclusion(x)) * len(i) for x, i in zip(s.samples, ids, strict=True))
    likely = sorted(chance, key=chance.get, reverse=True)[:4]
    for a in likely:
        assert abs(first[a] / n - math.exp(chance[a])) < 0.03
    for a, b in itertools.permutations(likely, 2):
        assert abs(second[a, b] / n - math.exp(chance[a] + chance[b]) / (1 - math.exp(chance[a]))) < 0.03
    mean = sum(math.exp(v) * len(p) for p, v in chance.items())
    assert abs(estimate / n - mean) < 0.05 * mean


def test_fewer_segmentations_than_asked(lattices):
    for text in ("", "a", "é"):
        every = every_path(lattices, text)
        s = G.sample_block(lattices, [5], [text], 1000)[0]
        ids = {tuple(lattices.piece.view()[x.edges].tolist()) for x in s.samples}
        assert ids == set(every) and len(s.samples) == len(every)
        assert all(s.log_inclusion(x) == 0 for x in s.samples)


def test_edge_rows(spark):
    got = G.sampled_segmentations(frame(spark), k=3, fields=("ids", "n_pieces", "log_prob", "log_inclusion", "round_trip"))
    rows = G.decode_segmentations(got).collect()
    texts = collections.defaultdict(set)
    for d, t, *_ in EDGE:
        texts[d].add((t or "").replace(G.BLANK, " "))
    assert all(r.round_trip and r.decoded in texts[r.doc_id] and len(r.ids) == r.n_pieces for r in rows)
    assert {r.doc_id for r in rows} == set(texts)
    assert all(r.log_prob <= 1e-9 and r.log_inclusion <= 0 for r in rows)
    assert [(r.sample, r.n_pieces) for r in rows if r.doc_id == 4] == [(0, 0)]
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for r in rows:
        if r.ids and r.doc_id not in (None, 5, 8):
            assert sp.decode(r.ids) == r.decoded
    assert G.sampled_segmentations(frame(spark, [])).collect() == []
    with pytest.raises(ValueError, match="k must"):
        G.sampled_segmentations(frame(spark), k=0)


def test_rows_draw_alike_in_any_batch(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    fields = ("n_pieces", "ids_crc32", "log_prob", "log_inclusion")
    rounded = [F.round(c, 6).alias(c) if c.startswith("log") else c for c in ("doc_id", "sample", *fields)]
    a = canon(G.sampled_segmentations(docs, fields=fields).select(rounded).collect())
    b = canon(G.sampled_segmentations(docs.orderBy(F.desc("doc_id")).repartition(5), fields=fields).select(rounded).collect())
    assert a == b and len(a) == 3 * docs.count()
    c = canon(G.sampled_segmentations(docs, fields=fields, seed=1).select(rounded).collect())
    assert a != c


def test_quick_and_slow_lattices_agree():
    a, b = G.Lattices(PATH, 0.8), G.Lattices(PATH, 0.8)
    words = ["the", "internationalisation", "x", "", "Über", "\nfoo", "a" * 40, "#%&", "naïve"]
    a._add_all(words)
    for w in words:
        b._add_one(w)
    for w in words:
        va, vb = a.views(), b.views()
        stack = [(a.known[w], b.known[w])]
        while stack:
            x, y = stack.pop()
            if x == 0 or y == 0:
                assert x == y
                continue
            ea, eb = (sorted((int(v[3][e]), round(float(v[4][e]), 9), int(v[2][e])) for e in G._siblings(v, int(v[0][n])))
                      for v, n in ((va, x), (vb, y)))
            assert [(p, l) for p, l, _ in ea] == [(p, l) for p, l, _ in eb]
            if len(stack) < 50:
                stack += [(p[2], q[2]) for p, q in zip(ea, eb, strict=True)][:3]
    assert np.isfinite(a.logp.view()).all()


def test_the_query_draws_three_segmentations(spark):
    rows = op9_segmentations(spark, SMALL).groupBy("doc_id").count().collect()
    assert {r["count"] for r in rows} == {3}
