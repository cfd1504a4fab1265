"""Losses of both models against counting in dictionaries."""

import math
import random
import re
from collections import Counter

import pytest

from loomwork.llm import lm_scoring as lm


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(rows, target, s):
    one, pair = (Counter(), Counter()), (Counter(), Counter())
    for doc_id, text in rows:
        ws = words(text)
        for c in range(2):
            if c or doc_id in target:
                one[c].update(ws)
                pair[c].update(zip(["", *ws], ws))
                one[c][""] += bool(ws)
    n = [sum(v for w, v in o.items() if w) for o in one]
    out = []
    for doc_id, text in rows:
        ws, loss = words(text), [0.0, 0.0]
        for v, w in zip(["", *ws], ws):
            p_b = one[1][w] / n[1]
            p = (one[0][w] + s.unigram_prior * p_b) / (n[0] + s.unigram_prior), p_b
            for c in range(2):
                loss[c] -= math.log((pair[c][v, w] + s.prior * p[c]) / (one[c][v] + s.prior))
        out.append((doc_id, len(ws), *(x / max(1, len(ws)) for x in loss)))
    return out


@pytest.mark.parametrize("chunk_bytes", [100, 1 << 24])
def test_difference(spark, chunk_bytes):
    r = random.Random(1)
    vocabulary = [f"W{i}é" for i in range(40)] + ["the", "The", "a"] * 5
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 3, 50])))) for i in range(60)]
    rows += [(None, "the null id"), (None, None), (7, "the repeated id"), (7, "the repeated id"), (90, " \t\n"), (91, "long " * 30_000)]
    target = {i for i in range(0, 60, 3)} | {7, 91}
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    ids = spark.createDataFrame([(i,) for i in [*target, 7, 1000, None]], "doc_id long")
    s = lm.Settings(chunk_bytes=chunk_bytes)
    got = sorted(map(tuple, lm.difference(docs, ids, settings=s).collect()), key=lambda x: (str(x[0]), x[1:]))
    want = sorted(slow(rows, target, s), key=lambda x: (str(x[0]), x[1:]))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2:] == pytest.approx((w[2], w[3], w[2] - w[3]), abs=1e-9)


def test_no_target_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    none = docs.select("doc_id").limit(0)
    rows = {r.doc_id: r for r in lm.difference(docs, none).collect()}
    assert rows[1].n_tokens == 2 and rows[1].target_loss > 0 and rows[2].score == 0
    assert lm.difference(docs.limit(0), none).count() == 0
    assert lm.difference(spark.createDataFrame([(None, None)], docs.schema), none).first().n_tokens == 0


def test_good_text_is_nearer_to_the_target(spark):
    from loomwork.llm.queries import op5_lm_scoring

    sf_dir = "/root/testdata/sf0.01"
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in op5_lm_scoring(spark, sf_dir).collect() if r.doc_id in quality and r.n_tokens]
    mean = lambda q: sum(r.score for r in rows if quality[r.doc_id] == q) / sum(quality[r.doc_id] == q for r in rows)
    assert mean(1) < mean(0)
