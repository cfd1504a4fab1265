"""The pipeline, stage by stage, against plain Python over the same rows."""

import re
import string
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import slow
from test_mixing import slow_targets
from test_near_copies import slow as slow_kept
from tokenizers import Tokenizer

import corpus_pipeline
from loomwork.llm import mixing, quality_rules


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The rows of every stage's result, with those of the table first."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def texts(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def test_columns(stages):
    for rows in stages[1:5]:
        assert rows and set(rows[0].__fields__) == {"doc_id", "text", "lang", "source", "n_chars"}
        assert all(r.n_chars == len(r.text) for r in rows)


def bad_line(line):
    """The rules as the documentation of ``Rules`` has them, with its default limits."""
    solid = re.sub(r"[ \t\n\x0b\f\r]", "", line)
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", line) if w]
    marks = sum(c in string.punctuation for c in line)
    if marks >= 4 and marks / len(solid) > 0.12:
        return True
    if line.count("|") >= 3 and line.count("|") / len(words) > 0.25:
        return True
    if len(words) <= 25 and any(re.search(p, line.lower()) for p in quality_rules.BOILERPLATE.split("|") if "(" not in p and ")" not in p):
        return True
    if len(words) <= 25 and re.search("terms of (use|service)|accept (all )?cookies", line.lower()):
        return True
    again = sum(a == b for a, b in zip(words, words[1:]))
    return again >= 6 and again * 2 > len(words)


def slow_clean(text):
    """What is left of a document, or None if it goes."""
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    if len(words) < 20 or len(inside) / len(words) > 0.3:
        return None
    lines = text.split("\n")
    size = lambda some: sum(len(re.sub(r"[ \t\n\x0b\f\r]", "", x)) for x in some)
    good = [x for x in lines if not bad_line(x)]
    return None if size(lines) - size(good) > 0.5 * size(lines) else "\n".join(good)


def test_quality(stages):
    want = Counter((r.doc_id, slow_clean(r.text)) for r in stages[0] if slow_clean(r.text) is not None)
    assert texts(stages[1]) == want


def test_near_copies(stages):
    kept = set(slow_kept([(r.doc_id, r.text) for r in stages[1]]))
    assert texts(stages[2]) == texts(r for r in stages[1] if r.doc_id in kept)


def test_decontaminate(stages, spark, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert texts(stages[3]) == texts(r for r in stages[2] if not slow(r.text, items, 13)[4])


def test_mix(stages):
    size = lambda rows: sum((Counter({r.source: len(r.text.encode().split())}) for r in rows), Counter())
    want = slow_targets(dict(size(stages[3])), mixing.Mix())
    got = size(stages[4])
    assert all(abs(got[s] - want[s]) <= 0.5 + 1e-6 for s in want)
    assert {r.doc_id for r in stages[4]} <= {r.doc_id for r in stages[3]}


def test_tokens(stages):
    plain, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = sorted(stages[5], key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in stages[4])
    sums = Counter()
    for r in stages[4]:
        ids = [*plain.encode(r.text, add_special_tokens=False).ids, 0]
        sums[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sums
    for r in got:
        assert r.start == start
        start += r.n_tokens


def test_run(spark, sf_dir, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, stages[5]))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, label string, keys array<long>"


def test_odd_tables(spark, tmp_path):
    """No documents; then null ids, texts and sources, repeated rows, a very long text and columns with clashing names."""
    import random

    r = random.Random(4)
    text = lambda n: "\n".join(" ".join(f"word{r.randrange(9000)}" for _ in range(12)) + "." for _ in range(n))
    long, some, other = text(8000), text(9), text(9)
    rows = [
        (1, long, "en", "web", 0, 7, "x", [1]), (None, some, None, None, None, None, None, None), (None, None, "en", "web", 0, 1, "y", []),
        (3, some, "en", "web", 0, 2, "z", [3]), (3, some, "en", "web", 0, 2, "z", [3]), (4, other, None, "books", 1, 3, "", None),
        (5, "", "en", "web", 0, 1, "y", []), (None, text(9), "en", None, 0, 5, "k", []),
    ]
    items = spark.createDataFrame([(1, "a benchmark item of some words that nothing here holds"), (2, None)], "item_id long, text string")
    for name, data in (("empty", []), ("odd", rows)):
        folder = str(tmp_path / name)
        spark.createDataFrame(data, SCHEMA).write.parquet(f"{folder}/documents.parquet")
        items.write.parquet(f"{folder}/benchmark.parquet")
        docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
            kept.append(sorted((x.doc_id or 0, len(x.text)) for x in docs.collect()))
        got = corpus_pipeline.run(spark, folder).collect()
        assert sorted(x.doc_id or 0 for x in got) == [i for i, _ in kept[3]]
        if name == "empty":
            assert got == [] and kept == [[]] * 4
        else:
            assert [i for i, _ in kept[0]] == [0, 0, 1, 3, 3, 4] and [i for i, _ in kept[1]] == [0, 1, 3, 4] == [i for i, _ in kept[2]]
