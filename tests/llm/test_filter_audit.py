import itertools
import math
import random
import re
from collections import defaultdict

from flatgate.llm import filter_audit as A
from tests.llm.helpers import EDGE, SF, frame, labels, words


def text_flags(text):
    t = text or ""
    w = words(t)
    return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t))}


def brute(rows, marks):
    """Every order run filter by filter over the rows."""
    good = {d for d, q, _ in marks if d is not None and q == 1}
    toxic = {d for d, _, x in marks if d is not None and x == 1}
    least = {}
    for d, t, *_ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    docs = defaultdict(list)
    for d, t, lang, *_ in rows:
        m = least.get(t or "")
        fails = text_flags(t) | {"E": m is not None and (d is None or m < d)}
        docs[lang or ""].append((fails, d in good, d in toxic))
    out = []
    for part, members in docs.items():
        summed, steps = defaultdict(int), []
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[0][f]]
                left = [m for m in left if not m[0][f]]
                summed[f] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), sum(m[0][f] for m in members) - len(gone),
                              sum(m[0][f] and sum(m[0].values()) == 1 for m in members), sum(m[1] for m in gone), sum(m[2] for m in gone)))
        out += [(*s, summed[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


MARKS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (6, 1, None), (9, None, 1), (77, 1, 1)]
LOUD = " ".join(f"WORD{i} #tag" for i in range(150))
MORE = [*EDGE, (50, LOUD, "en", "a"), (51, LOUD, "en", "a"), (49, LOUD, None, "a"), (52, "calm words " * 150, "en", "a"),
        (53, " ".join(f"w{i}" for i in range(250)), "en", "a"), (54, "A" * 3 + "b" * 97, "", "a"), (55, "A" * 4 + "b" * 96, "", "a")]


def test_edge_rows(spark):
    got = A.filter_audit(frame(spark, MORE), labels(spark, MARKS))
    assert got.dtypes == [("part", "string"), ("filter_order", "string"), ("step", "int"), *[(c, "bigint") for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]]
    assert sorted(map(tuple, got.collect())) == brute(MORE, MARKS)
    assert A.filter_audit(frame(spark, []), labels(spark, MARKS)).collect() == []


def test_no_labels_and_texts_of_one_hash(spark):
    from pyspark.sql import functions as F

    got = A.filter_audit(frame(spark, MORE), labels(spark), content_hash=lambda t: F.lit(b"x"))
    assert sorted(map(tuple, got.collect())) == brute(MORE, [])


def test_documents(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = A.filter_audit(docs, marks).collect()
    assert sorted(map(tuple, got)) == brute([(r.doc_id, r.text, r.lang) for r in docs.collect()],
                                            [(r.doc_id, r.quality, r.toxic) for r in marks.collect()])
    # each filter's steps over all orders add up to its value
    for part in {r.part for r in got}:
        own = [r for r in got if r.part == part]
        for f in "ABCDE":
            assert {r.shapley for r in own if r.filter_order[r.step - 1] == f} == {sum(r.removed for r in own if r.filter_order[r.step - 1] == f)}


def test_least_squares_is_the_shapley_value_of_any_game():
    for n in range(1, 7):
        worth = [0, *[random.Random(n * 100 + i).randrange(10**12) for i in range((1 << n) - 1)]]
        summed = [0] * n
        for order in itertools.permutations(range(n)):
            seen = 0
            for i in order:
                summed[i] += worth[seen | 1 << i] - worth[seen]
                seen |= 1 << i
        assert [v * math.factorial(n) for v in A.shapley_values(worth, n)] == summed


def test_other_filters(spark):
    rows = [("p", True, False, True, False), ("p", True, True, False, True), ("p", None, False, None, None), (None, False, True, True, False)]
    flagged = spark.createDataFrame(rows, "part string, X boolean, Y boolean, good boolean, toxic boolean")
    got = {(r.part, r.filter_order, r.step): r for r in A.audit(flagged, "XY").collect()}
    assert len(got) == 8
    assert tuple(got["p", "XY", 1])[3:] == (1, 2, 0, 1, 1, 1, 3) and tuple(got["p", "XY", 2])[3:] == (1, 0, 1, 0, 0, 0, 1)
    assert tuple(got["", "YX", 1])[3:] == (0, 1, 0, 1, 1, 0, 2)
