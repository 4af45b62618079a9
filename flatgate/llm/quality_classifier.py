"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic model on surface features of the whole text (fitted on all
labelled rows by Newton steps over sums from Spark's tasks) gives each
document's evidence. Grouped
sums of it over hosts and over paths within hosts give their rates: a host
is shrunk towards the corpus, a path towards its host, by beta priors whose
strengths are fitted to the rates themselves. A document's posterior sets
its evidence against the prior of its own site, without the document's own
share, so a sparse site falls back to its host and to the corpus.
"""

from __future__ import annotations

import math
import warnings
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatgate.llm.common import forget, free_name, id_remainder, raw_texts, store, word_runs
from flatgate.operators.flatten import col_of

PART_ROWS = 100_000  # labelled rows, of some 200 bytes, that one task sums up

_SYMBOLS = b"#*$%&|<>!@^~={}[]\\_"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_DIGITS = b"0123456789"
_ENDS = tuple(bytes([b]) for b in _SYMBOLS)


def features(raw: bytes) -> list[float]:
    """Surface features of a whole text, each bounded; a text without words
    has its own flag and zeros."""
    n_bytes = max(1, len(raw))
    n = adjacent = marked = shouted = chars = bare = 0
    seen: Counter = Counter()
    last = b""
    for words in word_runs(raw):
        if not words:
            continue
        n += len(words)
        adjacent += (words[0] == last) + sum(map(eq, words, words[1:]))
        last = words[-1]
        seen.update(words)
    for word, k in seen.items():
        chars += k * len(word)
        if word.endswith(_ENDS):
            marked += k
        if len(word) > 2 and word.isupper():
            shouted += k
        if not word.strip(_SYMBOLS):
            bare += k
    lines = raw.split(b"\n")
    upper = n_bytes - len(raw.translate(None, _UPPER))
    letters = upper + n_bytes - len(raw.translate(None, _LOWER))
    symbols = n_bytes - len(raw.translate(None, _SYMBOLS))
    digits = n_bytes - len(raw.translate(None, _DIGITS))
    m = max(1, n)
    shares = [symbols / n_bytes, marked / m, shouted / m, bare / m, adjacent / m, upper / max(1, letters), digits / n_bytes,
              max(seen.values(), default=0) / m, 1 - len(set(lines)) / len(lines)]
    # shares as they are and on a log scale, where small ones tell apart
    out = shares + [math.log1p(200 * s) for s in shares]
    out += [math.log1p(n), len(seen) / m, chars / m / 20, len(lines) / (len(lines) + m), float(n == 0)]
    return out


@dataclass
class Evidence:
    """Logistic weights; ``constant`` is set where the labels have one class
    only."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    base: float  # share of good rows that the bias stands for
    constant: float | None = None

    def probability(self, raws: Iterable[bytes]) -> np.ndarray:
        x = np.array([features(r) for r in raws], np.float64)
        if self.constant is not None or not len(x):
            return np.full(len(x), self.constant or 0.0)
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(moments: np.ndarray, sums: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], base: float,
          ridge: float = 1.0) -> Evidence:
    """Weighted ridge logistic regression by Newton steps. ``moments`` holds
    mean and spread of the features; ``sums`` gives the gradient and the
    curvature at given weights, summed over all rows."""
    mean, scale = moments
    beta = np.zeros(len(mean) + 1)
    penalty = np.full(len(beta), ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        grad, hess = sums(mean, scale, beta)
        step = np.linalg.solve(hess + np.diag(penalty) + 1e-9 * np.eye(len(beta)), grad + penalty * beta)
        beta -= step * min(1.0, 4.0 / max(1e-9, abs(step).max()))
        if abs(step).max() < 1e-7:
            break
    return Evidence(mean, scale, beta[:-1], float(beta[-1]), base)


def _numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Labels and features of the rows ``(y, x)``."""
    for batch in batches:
        if batch.num_rows:
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            yield y, batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)


def _summed(rows: DataFrame, work: Callable[[Iterable[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """Sum of what ``work`` makes of the rows of each task, a few KB for
    ``PART_ROWS`` rows; in the same order in every run."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = {"task": TaskContext.get().partitionId(), "data": work(batches).tolist()}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("task", pa.int32()), ("data", pa.list_(pa.float64()))]))

    parts = rows.mapInArrow(each, "task int, data array<double>").toArrow().sort_by("task")
    return np.stack([np.array(d.as_py()) for d in parts["data"]]).sum(0)


def moments_of(rows: DataFrame, width: int) -> np.ndarray:
    """Mean and spread of each feature over all ``rows (y, x)``."""

    def first(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        return sum((np.append(x.sum(0), len(x)) for _, x in _numbers(batches)), np.zeros(width + 1))

    sums = _summed(rows, first)
    mean = sums[:-1] / sums[-1]

    def second(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        return sum((((x - mean) ** 2).sum(0) for _, x in _numbers(batches)), np.zeros(width))

    spread = np.sqrt(_summed(rows, second) / sums[-1])
    return np.stack([mean, np.maximum(spread, 1e-3)])


def newton_sums(rows: DataFrame, weight: np.ndarray) -> Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Gradient and curvature of the fit over all ``rows (y, x)``, a row of
    label y counting as ``weight[y]``; Spark adds up those of its tasks."""

    def sums(mean: np.ndarray, scale: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def work(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
            grad, hess = np.zeros(len(beta)), np.zeros((len(beta), len(beta)))
            for y, x in _numbers(batches):
                a = np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
                w = weight[y.astype(int)]
                p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
                grad += a.T @ (w * (p - y))
                hess += (a * (w * p * (1 - p))[:, None]).T @ a
            return np.append(grad, hess)

        found = _summed(rows, work)
        return found[:len(beta)], found[len(beta):].reshape(len(beta), -1)

    return sums


def features_column(text_col: str) -> Column:
    @F.arrow_udf("array<double>")
    def numbers(texts: pa.Array) -> pa.Array:
        return pa.array([features(raw) for raw in raw_texts(texts)], pa.list_(pa.float64()))

    return numbers(F.col(text_col))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        held_out: int = 1, folds: int = 3) -> Evidence:
    """Evidence model from all labelled rows outside fold ``held_out``, their
    whole texts, weighted to the classes' shares of all labels.
    Ids labelled twice count as bad if any label says so; of the texts under
    one id the one of the smallest hash teaches; null ids and labels teach
    nothing; without both classes the evidence is constant.

    Only features, some 200 bytes a document, are shuffled and written; each
    Newton step reads them once, and the driver gets sums."""
    teaches = F.col(id_col).isNotNull() & (id_remainder(id_col, folds) != held_out)
    marked = (
        labels.filter(teaches & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("y")).filter("y IN (0, 1)")
    )
    totals = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = 1 + sum(totals.values()) // PART_ROWS
    texts = docs.filter(teaches).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.select("id", F.xxhash64("text").alias("hash"), features_column("text").alias("x"))
    each = (
        found.repartition(parts, "id").join(marked.repartition(parts, "id"), "id")
        .groupBy("id").agg(F.max("y").alias("y"), F.min(F.struct("hash", "x")).alias("row"))
    )
    rows, path = store(each.select("id", "y", "row.x").sortWithinPartitions(F.xxhash64("id"), "id"), "quality-rows")
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        forget(docs.sparkSession, path)
        if len(totals) > 1:
            warnings.warn(f"labels have both classes ({totals}), the usable documents do not: the score is constant", RuntimeWarning, stacklevel=2)
        share = float(next(iter(n), 1))
        return Evidence(*[np.zeros(0)] * 3, 0.0, share, constant=share)
    weight = np.array([totals[v] / n[v] for v in (0, 1)]) * sum(n.values()) / sum(totals.values())
    numbers = rows.select("y", "x")
    model = train(moments_of(numbers, len(features(b""))), newton_sums(numbers, weight), totals[1] / sum(totals.values()))
    forget(docs.sparkSession, path)
    return model


def evidence_column(model: Evidence, docs: DataFrame, text_col: str) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few numbers

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.probability(raw_texts(texts)), pa.float64())

    return probability(F.col(text_col))


def _strength(spread: Column, groups: Column, room: Column, noise: Column) -> Column:
    """How many documents the beta prior weighs as: what the rates vary
    beyond the binomial noise, by moments. From 1 (they differ freely) to
    10,000 (they do not differ)."""
    between = F.when(room > 0, (spread - groups * noise) / room)
    return F.when(between > 0, F.least(F.greatest(noise / between - 1, F.lit(1.0)), F.lit(1e4))).otherwise(F.lit(1e4))


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """``(host, path, n, s, host_rate, host_n, strength)`` per site, from
    ``evidence`` (host, path, p): documents and summed evidence of the path,
    its host's shrunk rate, and the prior's weight at path level."""
    sites = evidence.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"))
    hosts = sites.groupBy("host").agg(
        F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.count(F.lit(1)).alias("paths"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("ss"), F.sum(F.col("n") * F.col("n").cast("double")).alias("nn"))
    rate = F.col("host_s") / F.col("host_n")
    total = hosts.agg(
        F.sum("host_s").alias("s"), F.sum("host_n").alias("n"), F.count(F.lit(1)).alias("h"),
        F.sum(F.col("host_s") * rate).alias("ss"), F.sum(F.col("host_n") * F.col("host_n").cast("double")).alias("nn"),
        # paths within hosts
        F.sum(F.col("ss") - F.col("host_s") * rate).alias("in_spread"), F.sum(F.col("paths") - 1).alias("in_groups"),
        F.sum(F.col("host_n") - F.col("nn") / F.col("host_n")).alias("in_room"))
    mean = F.col("s") / F.col("n")
    noise = F.greatest(mean * (1 - mean), F.lit(1e-6))
    total = total.select(F.struct(
        mean.alias("mean"),
        _strength(F.col("ss") - F.col("s") * mean, F.col("h") - 1, F.col("n") - F.col("nn") / F.col("n"), noise).alias("of_host"),
        _strength(F.col("in_spread"), F.col("in_groups"), F.col("in_room"), noise).alias("of_path")))
    hosts = hosts.withColumn("g", total.scalar())
    hosts = hosts.select(
        F.col("host").alias("h_host"), "host_n", F.col("g.of_path").alias("strength"), F.col("g.mean").alias("mean"),
        ((F.col("host_s") + F.col("g.of_host") * F.col("g.mean")) / (F.col("host_n") + F.col("g.of_host"))).alias("host_rate"))
    return sites.join(hosts, F.col("host").eqNullSafe(F.col("h_host"))).drop("h_host")


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def posterior(p: Column, n: Column, s: Column, host_rate: Column, strength: Column, base: float) -> tuple[Column, Column]:
    """Rate of the site without the document itself, and the document's
    posterior: its evidence with the site's rate in the place of ``base``,
    the rate that the evidence was fitted under."""
    rate = (s - p + strength * host_rate) / (n - 1 + strength)
    z = _logit(p) - _logit(F.lit(base)) + _logit(rate)
    return rate, 1 / (1 + F.exp(-z))


def _site(docs: DataFrame, host_col: str, path_col: str | None) -> list[Column]:
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    return [F.col(host_col).cast("string").alias("host"), path.alias("path")]


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            path_col: str | None = "lang", threshold: float = 0.5) -> DataFrame:
    """``(doc_id, held_out, host, path, evidence, host_rate, path_rate,
    score, kept)`` of every row of ``docs``.

    ``evidence`` is the classifier's probability that the document is good,
    ``score`` the posterior. Null texts count as empty; null hosts and paths
    are sites of their own; null ids are in the fold of the empty text and
    repeated rows each give their row; other columns are ignored; an empty
    table gives an empty result. The evidence is written to the shared
    folder (a number per document) and summed map-side, so a host that holds
    a third of the rows meets as partial sums only.
    """
    model = fit(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (id_remainder(id_col, 3) == 1).alias("held_out"),
                       *_site(docs, host_col, path_col), evidence_column(model, docs, text_col).alias("p"))
    rows, _ = store(rows, "evidence")
    sites, _ = store(site_posteriors(rows), "sites")
    at = sites.select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), "n", "s", "host_rate", "strength")
    joined = rows.join(at, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    rate, score = posterior(F.col("p"), F.col("n"), F.col("s"), F.col("host_rate"), F.col("strength"), model.base)
    return joined.select(
        "doc_id", "held_out", "host", "path", F.col("p").alias("evidence"), "host_rate", rate.alias("path_rate"),
        score.alias("score"), (score >= threshold).alias("kept"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     host_col: str = "source", path_col: str | None = "lang", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose posterior is below ``threshold``.

    The evidence is computed twice, for the sites' sums and for the rows,
    rather than shuffling whole documents: the table of sites is written
    first, so the planner knows its size when it chooses the join."""
    model = fit(docs, labels, id_col, text_col)
    p, host, path = (free_name(docs.columns, c) for c in ("evidence", "site_host", "site_path"))
    evidence = evidence_column(model, docs, text_col)
    sites, _ = store(site_posteriors(docs.select(*_site(docs, host_col, path_col), evidence.alias("p"))), "sites")
    at = sites.select(F.struct("n", "s", "host_rate", "strength").alias(free_name(docs.columns, "site")),
                      F.col("host").alias(host), F.col("path").alias(path))
    site = F.col(at.columns[0])
    path_value = F.col(path_col).cast("string") if path_col else F.lit("")
    marked = docs.withColumn(p, evidence).join(
        at, F.col(host_col).cast("string").eqNullSafe(F.col(host)) & path_value.eqNullSafe(F.col(path)))
    _, score = posterior(F.col(p), site["n"], site["s"], site["host_rate"], site["strength"], model.base)
    return marked.filter(score >= threshold).select(*[col_of(c) for c in docs.columns])
