import zlib

import numpy as np
import pytest

from flatgate.llm import quality_classifier as Q
from flatgate.llm import toxicity as X
from tests.llm.helpers import EDGE, SF, canon, frame, labels, remainder

SF01 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    marks = spark.read.parquet(f"{SF01}/labels.parquet")
    return docs, marks


def held_out(scored, marks, column):
    truth = {r.doc_id: r[column] for r in marks.collect()}
    return [(r, truth[r.doc_id]) for r in scored.collect() if r.held_out and r.doc_id in truth]


def test_toxicity_on_held_out_documents(labelled):
    docs, marks = labelled
    rows = held_out(X.toxicity(docs, marks), marks, "toxic")
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r, _ in rows)
    bad, fine = ([r for r, t in rows if t == v] for v in (1, 0))
    assert np.mean([r.predicted for r in bad]) > 0.75
    assert np.mean([r.predicted for r in fine]) < 0.01
    assert np.mean([r.lang_predicted for r in bad]) > 0.8
    assert np.mean([r.lang_predicted for r in fine]) < 0.02


def test_toxicity_edges(spark):
    marks = labels(spark, [(1, 1, 0), (2, 1, 0), (None, 0, 1), (8, None, None)])
    got = X.toxicity(frame(spark), marks).collect()
    assert len(got) == len(EDGE) and not any(r.predicted for r in got)
    assert canon((r.doc_id, r.held_out) for r in got) == canon((d, remainder(d, 3) == 1) for d, *_ in EDGE)
    assert X.toxicity(frame(spark, []), marks).collect() == []
    assert X.drop_toxic(frame(spark), marks).count() == len(EDGE)
    assert len(X.toxicity(frame(spark), labels(spark)).collect()) == len(EDGE)


def small_set(n=400, seed=0):
    rng = np.random.default_rng(seed)
    plain = [b"w%d" % i for i in range(300)]
    texts, y = [], []
    for k in range(n):
        words = [plain[i] for i in rng.integers(0, 300, 30)]
        if k % 4 == 0:
            words[int(rng.integers(0, 30))] = b"awful" + bytes([97 + int(rng.integers(0, 26))])
        texts.append(b" ".join(words))
        y.append(int(k % 4 == 0))
    return texts, y


def test_network_learns_a_stem_and_reads_whole_texts(monkeypatch):
    texts, y = small_set()
    net = X.train(texts, y)
    z = np.concatenate([net.logits(f) for f in net.texts(texts, X.WordHash())])
    assert min(z[np.array(y) == 1]) > max(z[np.array(y) == 0])
    # the same features, however the text is cut into blocks
    long = b" ".join(texts * 40) + b" awfulx " + texts[1]
    whole = np.concatenate(list(net.texts([long, b"", texts[0]], X.WordHash())))
    monkeypatch.setattr(X, "BLOCK_WORDS", 50)
    real = X.word_runs
    monkeypatch.setattr(X, "word_runs", lambda raw: real(raw, 100))
    cut = np.concatenate(list(net.texts([long, b"", texts[0]], X.WordHash())))
    assert np.allclose(whole, cut, atol=1e-5)
    assert net.scores([], X.WordHash()).shape == (0,)


def test_gradient_reaches_only_words_that_matter():
    texts, y = small_set(seed=3)
    a, b = X.train(texts, y), X.train(texts, y)
    assert all(np.array_equal(p, q) for p, q in zip(a.tables, b.tables, strict=True))  # seeded


def test_thresholds_by_language():
    score = np.array([0.1] * 30 + [0.4] * 10 + [0.1] * 30 + [0.9] * 10)
    y = np.array(([0] * 30 + [1] * 10) * 2)
    t = X.language_thresholds(score, y, ["de"] * 40 + ["en"] * 40, np.ones(80), 0.7)
    assert 0.1 < t["de"] < 0.5 < t["en"] < 0.9


def test_quality_on_held_out_documents(labelled):
    docs, marks = labelled
    rows = held_out(Q.quality(docs, marks), marks, "quality")
    assert np.mean([r.kept for r, t in rows if t == 1]) > 0.99
    assert np.mean([r.kept for r, t in rows if t == 0]) < 0.03


def test_quality_edges(spark):
    marks = labels(spark, [(1, 1, 0), (9, 0, 0), (None, 0, 1), (2, 1, None)])
    got = Q.quality(frame(spark), marks).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert Q.quality(frame(spark, []), marks).collect() == []
    none = Q.quality(frame(spark), labels(spark)).collect()
    assert all(r.kept for r in none)
    kept = Q.drop_low_quality(frame(spark), marks)
    assert kept.columns == frame(spark).columns
    want = [r.doc_id for r in got if r.kept]
    assert canon((r.doc_id,) for r in kept.collect()) == canon((d,) for d in want)


def test_sites_shrink(spark):
    rows = [("big", "x", 0.9)] * 400 + [("big", "y", 0.1)] * 400 + [("small", "x", 0.0)] + [("other", "z", 0.8)] * 300 + [(None, None, 0.7)] * 5
    sites = {(r.host, r.path): r for r in Q.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert abs(sites["big", "x"].host_rate - 0.5) < 0.05
    assert sites["small", "x"].host_rate > 0.1  # one document does not decide
    assert sites[None, None].n == 5

    def rate(site, p):
        s = sites[site]
        return (s.s - p + s.strength * s.host_rate) / (s.n - 1 + s.strength)

    assert rate(("big", "x"), 0.9) > 0.8 and rate(("big", "y"), 0.1) < 0.2
    # without its own share, a lone document has its host's rate
    assert abs(rate(("small", "x"), 0.0) - sites["small", "x"].host_rate) < 1e-9


def test_features_are_finite():
    for raw in (b"", b" ", b"a", b"###", "日本 語".encode(), b"x " * 100_000):
        f = Q.features(raw)
        assert np.isfinite(f).all() and len(f) == len(Q.features(b"a"))
    assert zlib.crc32(b"") == 0  # a null id's fold


@pytest.mark.parametrize("module", [X, Q])
def test_long_texts_do_not_use_up_the_sample(spark, monkeypatch, module):
    """Both classes have many labelled texts over the bound and three each
    that can be used."""
    for bound in ("MAX_POSITIVE", "MAX_NEGATIVE", "MAX_GOOD", "MAX_BAD"):
        if hasattr(module, bound):
            monkeypatch.setattr(module, bound, 3)
    ids = [i for i in range(400) if remainder(i, 3) != 1][:120]
    rows = [(i, ("good words here " if i % 2 else "vile slur there ") * (1 if k >= 110 else 3000), "en", "a") for k, i in enumerate(ids)]
    marks = labels(spark, [(i, i % 2, i % 2) for i in ids])
    taught = []
    real = module.train
    monkeypatch.setattr(module, "train", lambda raws, *rest: taught.extend(raws) or real(raws, *rest))
    fitted = module.fit(frame(spark, rows), marks)
    model = fitted[0] if module is X else fitted
    assert model.constant is None and taught


@pytest.mark.parametrize("module", [X, Q])
def test_a_class_without_usable_documents_is_reported(spark, module):
    ids = [i for i in range(40) if remainder(i, 3) != 1]
    rows = [(i, "some words", "en", "a") for i in ids if i % 2]
    with pytest.warns(RuntimeWarning, match="both classes"):
        module.fit(frame(spark, rows), labels(spark, [(i, i % 2, i % 2) for i in ids]))


def test_scores_equal_a_plain_forward_pass(spark):
    """Whole table: embeddings added up word by word, every window of every
    filter, largest response, logistic layer."""
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    net, _ = X.fit(docs, marks)
    known = X.WordHash()

    def score(text):
        rows = []
        for word in (text or "").encode().split():
            packed = np.array([known[word]])
            rows.append(sum(table[X.bucket(packed, k)[0]].astype(float) for k, table in enumerate(net.tables)))
        rows = rows or [np.zeros(X.DIM)]
        pooled = []
        for w, f in zip(X.WIDTHS, net.filters, strict=True):
            responses = [sum(rows[i + j] @ f[j] for j in range(w) if i + j < len(rows)) for i in range(len(rows))]
            pooled.append(np.max(responses, axis=0))
        h = np.maximum(np.concatenate(pooled) + net.bias, 0)
        z = sum(float(a) * float(b) for a, b in zip(h, net.out, strict=True)) + net.out_bias
        return 1 / (1 + np.exp(-(net.slope * z + net.offset)))

    texts = {r.doc_id: r.text for r in docs.collect()}
    got = X.toxicity(docs, marks).collect()
    assert len(got) == len(texts)
    assert max(abs(r.score - score(texts[r.doc_id])) for r in got) < 1e-4


def test_posteriors_equal_a_version_in_dictionaries(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.fit(docs, marks)
    rows = docs.collect()
    p = dict(zip([r.doc_id for r in rows], model.probability([(r.text or "").encode() for r in rows]), strict=True))
    hosts, sites = {}, {}
    for r in rows:
        hosts.setdefault(r.source, {}).setdefault(r.lang, []).append(p[r.doc_id])
    total_n = len(rows)
    mean = sum(p.values()) / total_n
    noise = max(mean * (1 - mean), 1e-6)

    def strength(spread, groups, room):
        between = (spread - groups * noise) / room if room > 0 else 0
        return min(max(noise / between - 1, 1.0), 1e4) if between > 0 else 1e4

    def moments(groups):
        """Spread of the rates about the common one, and the room it had."""
        n, s = [len(g) for g in groups], [sum(g) for g in groups]
        return sum(b * b / a for a, b in zip(n, s, strict=True)) - sum(s) ** 2 / sum(n), len(groups) - 1, sum(n) - sum(a * a for a in n) / sum(n)

    of_host = strength(*moments([[x for g in paths.values() for x in g] for paths in hosts.values()]))
    of_path = strength(*map(sum, zip(*[moments(list(paths.values())) for paths in hosts.values()], strict=True)))
    for host, paths in hosts.items():
        n, s = sum(map(len, paths.values())), sum(map(sum, paths.values()))
        host_rate = (s + of_host * mean) / (n + of_host)
        for path, g in paths.items():
            sites[host, path] = (len(g), sum(g), host_rate)

    def logit(x):
        x = min(max(x, 1e-6), 1 - 1e-6)
        return np.log(x / (1 - x))

    got = Q.quality(docs, marks).collect()
    assert len(got) == total_n
    for r in got:
        n, s, host_rate = sites[r.host, r.path]
        path_rate = (s - p[r.doc_id] + of_path * host_rate) / (n - 1 + of_path)
        score = 1 / (1 + np.exp(-(logit(p[r.doc_id]) - logit(model.base) + logit(path_rate))))
        assert np.allclose([r.evidence, r.host_rate, r.path_rate, r.score], [p[r.doc_id], host_rate, path_rate, score], atol=1e-9)
        assert r.kept == (r.score >= 0.5)


@pytest.mark.parametrize("module", [X, Q])
def test_ids_of_several_texts_teach_alike_in_any_order(spark, module):
    ids = [i for i in range(90) if remainder(i, 3) != 1][:40]
    rows = [(i, f"text {k} of {i} " + ("vile slur" if (i + k) % 2 else "calm talk"), "en", "a") for i in ids for k in range(2)]
    marks = labels(spark, [(i, i % 2, i % 2) for i in ids])

    def weights(df):
        model = module.fit(df, marks)
        return model[0].tables[0] if module is X else model.weights

    first = weights(frame(spark, rows).repartition(1))
    for n in (3, 7):
        assert np.array_equal(first, weights(frame(spark, rows[::-1]).repartition(n)))


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """The start sees two rows of each class, all of them short and alike;
    what tells the classes apart stands in long rows of several shards."""
    monkeypatch.setattr(X, "START_ROWS", 2)
    monkeypatch.setattr(X, "SHARD_BYTES", 1 << 20)
    ids = [i for i in range(400) if remainder(i, 3) != 1][:100]
    rows = [(i, ("calm talk " * 4000 + ("slur" if i % 2 else "bread")) if k >= 10 else "calm talk", "en", "a") for k, i in enumerate(ids)]
    net, _ = X.fit(frame(spark, rows), labels(spark, [(i, i % 2, i % 2) for i in ids]))
    slur, bread = net.scores([b"calm talk slur", b"calm talk bread"], X.WordHash())
    assert net.constant is None and slur > 0.6 > 0.4 > bread


def test_log_odds_count_every_row(spark):
    texts, y = small_set()
    rows = spark.createDataFrame([(int(v), t.decode()) for v, t in zip(y, texts, strict=True)], "y int, text string")
    counts = X._no_counts()
    for t, v in zip(texts, y, strict=True):
        for block in X.text_ids(t, X.WordHash()):
            for part in range(1 + len(X.PREFIXES)):
                counts[part, sorted(set(X.bucket(block, part).tolist())), int(v)] += 1
    n = sum(v == 0 for v in y), sum(v == 1 for v in y)
    assert np.allclose(X.log_odds_of(rows.repartition(5), *n), X._log_odds(counts, *n), atol=1e-6)


def test_thresholds_count_every_held_back_row(spark):
    """As of the rows one by one, where no two scores share a step."""
    rng = np.random.default_rng(5)
    z = rng.permutation(np.linspace(-4, 4, 300))
    y = (z + rng.normal(0, 1.5, 300) > 0).astype(int)
    lang = [["de", "en", None][i % 3] for i in range(300)]
    held = spark.createDataFrame([(int(a), b, float(c)) for a, b, c in zip(y, lang, z, strict=True)], "y int, lang string, z double").repartition(4)
    slope, offset = X.calibration_of(held)
    assert np.allclose([slope, offset], X.calibrate(z, y, np.ones(300)), atol=1e-4)
    score = 1 / (1 + np.exp(-(slope * z + offset)))
    got, want = X.thresholds_of(held, slope, offset, 0.7), X.language_thresholds(score, y, lang, np.ones(300), 0.7)
    assert set(got) == {"de", "en"} and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_long_texts_have_a_say_in_their_languages_threshold(spark):
    ids = [i for i in range(900) if remainder(i, 3) != 1][:400]
    rows = [(i, ("vile slur " if i % 2 else "good words ") * (1 if k % 2 else 3500), "en" if k % 2 else "de", "a") for k, i in enumerate(ids)]
    _, thresholds = X.fit(frame(spark, rows), labels(spark, [(i, i % 2, i % 2) for i in ids]))
    assert set(thresholds) == {"en", "de"}


def test_quality_learns_from_every_labelled_row(spark):
    """Bad documents are long ones only; nothing bounds those that teach."""
    ids = [i for i in range(200) if remainder(i, 3) != 1][:80]
    rows = [(i, "some good words here" if i % 2 else "### *** " * 5000, "en", "a") for i in ids]
    model = Q.fit(frame(spark, rows), labels(spark, [(i, i % 2, i % 2) for i in ids]))
    good, bad = model.probability([b"some good words here", b"### *** " * 5000])
    assert model.constant is None and good > 0.9 > 0.1 > bad


def test_newton_sums_equal_those_of_one_task(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(2, 3, (90, 4)), rng.integers(0, 2, 90)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(y, x, strict=True)], "y int, x array<double>").repartition(5)
    mean, scale = Q.moments_of(rows, 4)
    assert np.allclose(mean, x.mean(0)) and np.allclose(scale, x.std(0))
    beta, weight = rng.normal(0, 1, 5), np.array([0.5, 2.0])
    a = np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((90, 1))])
    p, w = 1 / (1 + np.exp(-a @ beta)), weight[y]
    grad, hess = Q.newton_sums(rows, weight)(mean, scale, beta)
    assert np.allclose(grad, a.T @ (w * (p - y))) and np.allclose(hess, (a * (w * p * (1 - p))[:, None]).T @ a)
