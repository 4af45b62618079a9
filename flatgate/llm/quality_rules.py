"""Host-level quality rules, in DataFrame expressions only.

``rule_counts`` measures every whole text inside its own row (array
functions, no shuffle). ``host_verdicts`` adds the failures up by domain and
shrinks each domain's failure rate towards all others with a beta prior
fitted to the rates themselves. ``quality_rules`` joins the verdicts back:
a document is kept unless it fails a rule itself or its domain's shrunk
failure rate is too high.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatgate.llm.common import WORD_CUT, store

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A domain's documents go where its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed)``.

    Repeated words: each word is hashed, each three-word window is the hash
    of its three word hashes, and the windows are sorted by hash with their
    place, so equal windows stand side by side. The places of the repeated
    ones, in order, give the words that they cover. All of it stays in the
    document's row; nothing is exploded.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), text.alias("t"))
    rows = rows.select(
        "doc_id", "host",
        F.length(F.translate("t", " \t\n\u000b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: F.translate(x, " \t\u000b\f\r", "") != "").alias("lines"),
        F.transform(F.filter(F.split("t", WORD_CUT), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("w"),
    )
    n = F.size("w")
    rows = rows.select(
        "doc_id", "host", n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.expr("array_sort(transform(sequence(0, size(w) - 3),"
                              " i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, i AS i)))")).alias("s"),
    )
    # a window is repeated if the one before or after it in hash order is equal
    rows = rows.withColumn("at", F.expr(
        "array_sort(transform(filter(transform(s, (x, k) -> struct(x.i AS i,"
        " (k > 0 AND s[k - 1].h = x.h) OR (k + 1 < size(s) AND s[k + 1].h = x.h) AS twice)), y -> y.twice), y -> y.i))"))
    # each repeated window covers three words, less what the next one covers too
    rows = rows.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(F.expr("aggregate(at, struct(0L AS n, -3 AS last), (a, i) -> struct("
                          "a.n + least(3, i - a.last) AS n, i AS last), a -> a.n)"), F.lit(0)).cast("long").alias("n_repeat_words"))
    return rows.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def beta_prior(hosts: DataFrame, n: str = "n_docs", k: str = "n_failed") -> DataFrame:
    """One row ``(alpha, beta)``: the beta distribution whose mean and
    variance match the domains' failure rates, by moments. The variance
    among rates is what remains beyond the binomial noise; at none of it
    (or a single domain) the prior weighs as much as all documents of an
    average domain, so rates shrink to the mean."""
    m = hosts.agg(
        F.sum(k).alias("k"), F.sum(n).alias("n"), F.count(F.lit(1)).alias("h"),
        F.sum(F.col(n).cast("double") * F.col(n)).alias("nn"),
        F.sum(F.col(k) * F.col(k) / F.col(n).cast("double")).alias("kk"))
    mean = F.col("k") / F.col("n")
    m = m.withColumn("mu", F.least(F.greatest(mean, F.lit(1e-6)), F.lit(1 - 1e-6)))
    # between = (weighted square deviation - binomial part) / effective number of documents
    spread = F.col("kk") - F.col("n") * mean * mean
    room = F.col("n") - F.col("nn") / F.col("n")
    between = F.when(room > 0, (spread - (F.col("h") - 1) * F.col("mu") * (1 - F.col("mu"))) / room)
    weight = F.col("mu") * (1 - F.col("mu")) / between - 1
    strength = F.when((between > 0) & (weight > 0), weight).otherwise(F.col("n") / F.col("h"))
    strength = F.least(F.greatest(strength, F.lit(1.0)), F.col("n") / F.col("h") + 1.0)
    return m.select((F.col("mu") * strength).alias("alpha"), ((1 - F.col("mu")) * strength).alias("beta"))


def host_verdicts(counts: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``(host, n_docs, n_failed, failure_rate, host_rejected)``: one row
    per domain; documents without one form a domain of their own (null)."""
    hosts = counts.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    prior = beta_prior(hosts).select(F.struct("alpha", "beta")).scalar()  # one row: a scalar subquery
    hosts = hosts.withColumn("prior", prior)
    rate = (F.col("n_failed") + F.col("prior.alpha")) / (F.col("n_docs") + F.col("prior.alpha") + F.col("prior.beta"))
    return hosts.select(
        "host", "n_docs", "n_failed", rate.alias("failure_rate"), (rate > max_rate).alias("host_rejected"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Counts, ``base_failed``, the domain's shrunk ``host_failure_rate``
    and ``kept`` for every row of ``docs``.

    The counts are written once to the shared scratch folder (a few numbers
    per document), then summed by domain and joined back on the domain. A
    domain that holds a third of the rows meets in its sums only after
    map-side addition, and its rows are split among tasks in the join by
    the planner (the verdict side has one row per domain). Null texts have
    no words and fail; null domains are judged together; repeated rows and
    ids each give their row; an empty table gives an empty result.
    """
    counts, _ = store(rule_counts(docs, id_col, text_col, host_col), "quality-rules")
    return join_verdicts(counts, host_verdicts(counts, max_rate))


def join_verdicts(counts: DataFrame, verdicts: DataFrame) -> DataFrame:
    v = verdicts.select(F.col("host").alias("v_host"), F.col("failure_rate").alias("host_failure_rate"), "host_rejected")
    joined = counts.join(v, F.col("host").eqNullSafe(F.col("v_host")), "left")
    kept: Column = ~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "host_failure_rate", kept.alias("kept"))
