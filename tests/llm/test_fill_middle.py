"""Fill-in-the-middle texts against plain regular expressions."""

import hashlib
import random
import re

import numpy as np
import pytest

from loomwork.llm import fill_middle
from loomwork.llm.fill_middle import Chunking, Memo, borders, count_units, locate

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def slow(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, len(units))))
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = ["", None, "a", "é", "\0", "<P>", "a<S>b", "<", "<<P", "<M", "a<", "abcDEF" * 3000, "x" * 20_000, "é" * 9_000,
       "a b\nc\td", "日本語 text 語", "𝄞x𝄞", " " * 5_000, "<P" * 500]


def texts(n, seed=3):
    r = random.Random(seed)
    shared = ["".join(r.choice("abc XYZ,.é日\n𝄞<") for _ in range(r.randrange(1, 3000))) for _ in range(5)]
    return [r.choice(shared) + "".join(r.choice("ab cd é<>P") for _ in range(r.randrange(300))) + r.choice(shared) for _ in range(n)]


@pytest.mark.parametrize("chunking", [Chunking(), Chunking(bits=3, least=1, most=16), Chunking(bits=1, least=1, most=1)])
def test_counts_and_cuts(chunking):
    memo = Memo(chunking)
    for text in [t or "" for t in ODD[:11]] + texts(12):
        data, units = text.encode(), UNITS.findall(text)
        counted = count_units(data, memo)
        assert counted.n == len(units) and counted.chars[-1] == len(text)
        for cut in {0, 1, len(units) // 3, len(units) // 2, max(0, len(units) - 1), len(units)}:
            cut = min(cut, len(units))
            before = "".join(units[:cut])
            assert locate(data, counted, cut) == (len(before.encode()), len(before))


def test_chunks_follow_content():
    r = random.Random(5)
    body = bytes(r.randrange(256) for _ in range(40_000))
    ends = lambda t: set(borders(np.frombuffer(t, np.uint8), Chunking()))
    one, other = ends(body), {e - 7 for e in ends(b"1234567" + body)}
    assert len(one & other) > 0.9 * len(one)
    memo = Memo(Chunking())
    count_units(body, memo)
    before = memo.misses
    count_units(b"1234567" + body, memo)
    assert memo.misses - before <= 5 and memo.hits > 20


def test_equal_hash_of_other_content(monkeypatch):
    memo = Memo(Chunking())
    monkeypatch.setattr(fill_middle.xxhash, "xxh3_64_intdigest", lambda _: 1)
    assert [memo.summary(b"ab c").units, memo.summary(b"....").units, memo.summary(b"ab c").units] == [3, 4, 3]


def test_memory_is_bounded():
    memo = Memo(Chunking(remember_bytes=10_000))
    for text in texts(40):
        count_units(text.encode(), memo)
        assert memo.held < 10_000 + Chunking().most + 200


def test_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD + texts(300))] + [(None, "a b c d e"), (None, None), (7, "more words"), (7, "more words")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, form string")
    got = fill_middle.fill_in_middle(docs).collect()
    want = [slow(*r) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {"plain", "psm", "spm"} == {r.form for r in got}


def test_restored(spark):
    rows = [(i, t) for i, t in enumerate(ODD + texts(200))]
    out = fill_middle.digests(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in rows}
    assert {r.doc_id: r.restored_sha256 for r in out.collect()} == want
    made = {r[0]: hashlib.sha256(r[5].encode()).hexdigest() for r in (slow(*x) for x in rows)}
    assert {r.doc_id: r.output_sha256 for r in out.collect()} == made


def test_empty_table_and_other_names(spark):
    assert fill_middle.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([("k", "a b c")], "id string, body string")
    assert fill_middle.fill_in_middle(docs, "id", "body").first().n == 5
