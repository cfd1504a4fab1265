"""Line rules and base measures against plain counting."""

import re
from collections import Counter

from loomwork.llm import quality_rules
from loomwork.llm.texts import SPACED, words_of

CLEAN = "A plain sentence of some words stands here, and it ends well. Another one follows it with more words.\n"
JUNK = "Here### stands&&& a*** line$$$ of### marked&&& words*** that$$$ nobody%%% reads### at&&& all***\n"
ROWS = [
    (1, CLEAN * 1, "x"),
    (2, CLEAN + JUNK * 3, None),
    (3, None, "x"),
    (4, "", "x"),
    (5, CLEAN.strip() + "\nHome | News | Sport | Shop\nAll rights reserved.", "x"),
    (5, CLEAN.strip() + "\nHome | News | Sport | Shop\nAll rights reserved.", "x"),
    (None, "one two three four five six seven eight nine ten " * 3, "x"),
    (7, "go go go go go go go go\n" + CLEAN, "x"),
    (8, "w" * 200_000 + " " + CLEAN * 300, "x"),
]
SCHEMA = "doc_id long, text string, kept string"


def slow_repeat(words, window=8):
    runs = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    n = Counter(runs)
    return len({i + k for i, r in enumerate(runs) if n[r] > 1 for k in range(window)})


def test_measures(spark):
    got = quality_rules.measure(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text, _ in ROWS:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = (text or "").split("\n")
        r = by_id[doc_id]
        assert r.n_words == len(words)
        assert r.word_chars == sum(map(len, words))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert r.n_repeat_words == slow_repeat(words)
        assert r.n_dup_lines == sum(bool(re.search(r"[^\x20\x09-\x0D]", s)) and s in lines[:i] for i, s in enumerate(lines))
        assert r.base_failed == (len(words) < 20 or 100 * slow_repeat(words) > 30 * len(words))
    assert [by_id[i].kept for i in (1, 2, 3, 4, 5, None, 7)] == [False, False, False, False, True, False, True]
    assert (by_id[5].n_navigation_lines, by_id[5].n_boilerplate_lines) == (1, 1)
    assert by_id[7].n_boilerplate_lines == 1


def test_repeats_of_many_texts():
    texts = [b"a b c d e f g h i j", b"a b a b a b a b a b a b", b"", b"x " * 50, b"a b c d e f g h z a b c d e f g h"]
    assert quality_rules.repeated(words_of(texts, SPACED), 8).tolist() == [slow_repeat(t.split()) for t in texts]


def test_clean_removes_lines_and_documents(spark):
    df = spark.createDataFrame([(*r, 7) for r in ROWS], SCHEMA + ", n_chars long")
    kept = quality_rules.clean(df)
    assert kept.schema == df.schema
    rows = kept.collect()
    assert Counter(r.doc_id for r in rows) == {5: 2, 7: 1}
    assert {r.text for r in rows if r.doc_id == 5} == {CLEAN.strip()}
    assert all(r.n_chars == len(r.text) for r in rows)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert quality_rules.measure(df).count() == 0 and quality_rules.clean(df, length_col=None).count() == 0


def test_labelled_documents(spark):
    """On the labelled rows long enough for the base rules, the verdict is the label."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_rules.measure(docs).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.99 * len(rows)
