import hashlib
import re

from xxhash import xxh64

from flatgate.llm import merkle as M
from tests.llm.helpers import EDGE, SF, frame


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute_tree(text):
    blocks = []
    for p in re.findall(r"[^\n]*\n+|[^\n]+", text):
        n = M.SHORT_BLOCK if len(p) <= M.SHORT_PARAGRAPH else M.BLOCK_CHARS
        blocks.append([signed(xxh64(p[i:i + n].encode(), seed=42).intdigest()) for i in range(0, len(p), n)])
    paragraphs = [hashlib.sha256(p.encode()).hexdigest() for p in re.findall(r"[^\n]*\n+|[^\n]+", text)]
    sections = [hashlib.sha256("".join(paragraphs[i:i + M.SECTION]).encode()).hexdigest() for i in range(0, max(1, len(paragraphs)), M.SECTION)]
    root = hashlib.sha256(".".join(sections).encode()).hexdigest()
    return root, sections, [x for b in blocks for x in b]


def brute_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    most = max(len(set(a[2])), len(set(b[2])), 1)
    return min(len(set(a[2]) & set(b[2])) / most, most / (most + 1))


def expected(rows):
    """For rows of which every id has one text."""
    ordered = sorted(dict.fromkeys((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    following = {ordered[i][0]: ordered[(i + 1) % len(ordered)][1] for i in range(len(ordered))}
    out = []
    for d, t, *_ in rows:
        t = t or ""
        k = len(t) // 4
        edited = t[:len(t) - k] + following[d][:k]
        a, b, c = brute_tree(t), brute_tree(edited), brute_tree(following[d])
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a[0]}:{'.'.join(a[1])}", f"{b[0]}:{'.'.join(b[1])}",
                    round(brute_likeness(a, b), 9), round(brute_likeness(a, c), 9)))
    return sorted(out, key=repr)


def rounded(rows):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
                   for r in rows), key=repr)


def test_edge_rows(spark):
    rows = [r for r in EDGE if not (r[0] == 7 and r[1] == "one") and not (r[0] is None and r[1] is None)]
    assert rounded(M.document_fingerprints(frame(spark, rows)).collect()) == expected(rows)


def test_an_id_of_several_texts_keeps_its_rows(spark):
    got = M.document_fingerprints(frame(spark)).collect()
    assert len(got) == len(EDGE)
    # the successor of 6 is one of the texts under 7
    assert len({r.edited_sha256 for r in got if r.doc_id == 6}) == 1


def test_one_document_and_none(spark):
    rows = [(4, "abcdefgh" * 10, "en", "a")]
    assert rounded(M.document_fingerprints(frame(spark, rows)).collect()) == expected(rows)
    assert M.document_fingerprints(frame(spark, [])).collect() == []


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = M.document_fingerprints(docs).collect()
    assert rounded(got) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r.near_edited > r.near_next for r in got) > 0.97 * len(got)


def test_differing_sections_locate_an_edit(spark):
    lines = [f"paragraph number {i} of the text" for i in range(40)]
    edited = list(lines)
    edited[21] = "something else"
    trees = M.merkle_trees(frame(spark, [(1, "\n".join(lines), "en", "a"), (2, "\n".join(edited), "en", "a")]))
    a, b = (trees.filter(f"doc_id = {i}").select(F_tree.alias(f"t{i}")) for i, F_tree in ((1, trees["tree"]), (2, trees["tree"])))
    row = a.crossJoin(b).select(M.differing_sections(a["t1"], b["t2"]).alias("d"), M.likeness(a["t1"], b["t2"]).alias("l")).first()
    assert row.d == [21 // M.SECTION] and row.l > 0.9


def test_plan_has_no_python(spark):
    plan = M.document_fingerprints(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_heads_and_leaves_are_shuffled_once(spark):
    """One exchange of texts, which the heads' branch uses again, and one of
    heads behind the join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = M.document_fingerprints(spark.read.parquet(f"{SF}/documents.parquet"))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning(p#" in x]
    texts = [x for x in plan.splitlines() if "Exchange hashpartitioning(key#" in x]
    assert len(texts) == 2 and sum("ReusedExchange" in x for x in texts) == 1
    assert len(exchanges) == 1 and "ring#" not in plan.split("SortMergeJoin", 1)[0]


def test_section_numbers_and_roots(spark):
    lines = [f"paragraph number {i} of the text\n" for i in range(32)]
    got = M.document_fingerprints(frame(spark, [(1, "".join(lines), "en", "a"), (2, "other words", "en", "a")])).orderBy("doc_id").collect()
    assert got[0].edited_section_numbers == [3] or got[0].edited_section_numbers[0] >= 2
    assert got[0].edited_sections == len(got[0].edited_section_numbers)
    root, sections = got[0].fingerprint.split(":")
    assert root == hashlib.sha256(sections.encode()).hexdigest()


def test_leaves_that_agree_in_half_of_the_hash_only_are_different(spark):
    seen = {}
    for i in range(400_000):
        text = f"{i:08d}"
        other = seen.setdefault(xxh64(text.encode(), seed=42).intdigest() >> 32, text)
        if other != text:
            break
    assert other != text
    got = M.document_fingerprints(frame(spark, [(1, text, "en", "a"), (2, other, "en", "a")])).collect()
    assert [r.near_next for r in got] == [0.0, 0.0]
