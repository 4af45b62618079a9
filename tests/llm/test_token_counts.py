import random

import public_tokenizers
import tokenizers

from flatgate.llm import token_counts as C
from tests.llm.helpers import EDGE, SF, canon, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def expected(rows):
    out = []
    for d, t, *_ in rows:
        n = len(LIBRARY.encode(t or "", add_special_tokens=False).ids)
        out.append((d, len((t or "").encode()), n, n > 512))
    return canon(out)


def test_edge_rows(spark):
    assert canon(C.token_counts(frame(spark)).collect()) == expected(EDGE)
    assert C.token_counts(frame(spark, [])).collect() == []


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert canon(C.token_counts(docs).collect()) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_mixed_strings(monkeypatch):
    monkeypatch.setattr(C, "BLOCK_CHARS", 20)
    m = C.PairMerger(PATH)
    rnd = random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "\t", " \n", "é", "<|endoftext|>", "'s", "12", "!!", "the", " ther", "日本", "😀", "\r\n", "\u3000", "\u00a0"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))
        assert m.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids), repr(text)


def test_count_is_symbols_less_merges():
    m = C.PairMerger(PATH)
    assert m.merged(b"") == 0
    assert m.merged(b"a") == 1
    assert m.merged(b" the") == 1
    assert m.merged(b"x" * 5000) == len(LIBRARY.encode("x" * 5000, add_special_tokens=False).ids)
