"""URL filters: a trie over reversed host labels and path segments.

Rules are ``host/path-prefix`` strings marked allow or block. The trie is
keyed by the host's labels from the right and then by the path's segments;
a walk down both finds every fitting rule, and the longest one decides.

The rule list is configuration: it comes as a Python sequence, its size is
checked (``MAX_RULE_BYTES``) and it is broadcast as one trie. A longer list
is matched by equality joins instead (``url_verdicts_joined``): a host's
suffixes find the lengths that rules of theirs have, and a url emits its
path's beginnings of those lengths, so no rule list has to fit a worker and
a long url costs what rules could fit it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULE_BYTES = 32 << 20

Rule = tuple[str, str, str]  # host, path, verdict


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a null url or one without ``://``."""
    return F.translate(
        F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def build_trie(rules: Sequence[Rule]) -> dict:
    """Nested nodes: ``h`` host labels from the right, ``p`` path segments,
    ``r`` the rules that end at the node as ``(partial segment, length,
    rule, verdict)``. A rule whose path stops inside a segment keeps that
    part and is compared by prefix there."""
    root: dict = {}
    for host, path, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault("h", {}).setdefault(label, {})
        *whole, part = path.split("/")
        for segment in whole:
            node = node.setdefault("p", {}).setdefault(segment, {})
        node.setdefault("r", []).append((part, len(host) + len(path), host + path, verdict))
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """``(rule, verdict)`` of the longest fitting rule. Of two rules with
    the same text but both verdicts, block wins; of two of one length but
    different text, the one with the longer host."""
    best = None
    segments = path.split("/")
    node, depth = trie, 0
    for label in reversed(host.split(".")):
        node = node.get("h", {}).get(label)
        if node is None:
            break
        depth += 1
        inner, at = node, 0
        while inner is not None:
            for part, length, rule, verdict in inner.get("r", ()):
                if segments[at].startswith(part):
                    rank = (length, depth, verdict == "block")
                    if best is None or rank > best[0]:
                        best = (rank, rule, verdict)
            if at + 1 == len(segments):
                break
            inner, at = inner.get("p", {}).get(segments[at]), at + 1
    return best and best[1:]


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every row of ``pages``.

    A url that no rule fits gets ``default`` and a null rule; so do null
    urls and those without ``://`` (host and path empty). Repeated rows and
    null ids each give their row; other columns of ``pages`` are ignored.
    """
    size = sum(len(h) + len(p) for h, p, _ in rules)
    if size > MAX_RULE_BYTES:
        raise ValueError(f"{size} bytes of rules are too many to broadcast; use url_verdicts_joined")
    shared = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in batches:
            found = [longest_match(trie, h, p) or (None, default)
                     for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    url = F.col(url_col)
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    return parts.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string")


def url_verdicts_joined(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                        default: str = "allow") -> DataFrame:
    """The same verdicts with ``rules`` as a table ``(host, path, verdict)``
    of any size: urls are made distinct, each emits the keys of all rules
    that could fit it, and an equality join finds those that exist. A rule
    with a null host or path fits nothing."""
    url = F.col(url_col)
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    wanted = rules.select(F.col("host").alias("k_host"), F.col("path").alias("k_path"), F.col("verdict").alias("r_verdict"))
    rank = F.struct(F.length("k_host") + F.length("k_path"), F.length("k_host"), F.col("r_verdict") == "block")
    best = (
        rule_keys(parts, wanted).join(wanted, ["k_host", "k_path"]).groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("k_host", "k_path").alias("rule"), "r_verdict"), rank).alias("b"))
    )
    return parts.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("b.rule").alias("rule"),
        F.coalesce("b.r_verdict", F.lit(default)).alias("verdict"))


def rule_keys(parts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(host, path, k_host, k_path)``: of every distinct url the host
    suffixes that have rules, with the path's beginnings of the lengths that
    these rules' paths have. Only hosts meet the rules' lengths, so a suffix
    that a third of the urls share is one row per host there."""
    lengths = wanted.select("k_host", F.length("k_path").alias("k_len")).filter("k_len IS NOT NULL").distinct()
    labels = F.split("host", r"\.")
    suffixes = parts.select("host").distinct().select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("k_host"))
    by_host = suffixes.join(lengths, "k_host").groupBy("host").agg(F.collect_list(F.struct("k_host", "k_len")).alias("could_fit"))
    urls = parts.select("host", "path").distinct().join(by_host, "host")
    fitting = F.filter("could_fit", lambda c: c["k_len"] <= F.length("path"))
    return urls.select("host", "path", F.explode(fitting).alias("c")).select(
        "host", "path", F.col("c.k_host").alias("k_host"), F.expr("left(path, c.k_len)").alias("k_path"))
