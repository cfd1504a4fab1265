"""Benchmark matches against plain search."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from loomwork.llm import decontaminate as dc
from loomwork.llm.texts import words_of


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def slow(text, items, window):
    """Hit words, items, and the longest run of hits from windows that follow each other."""
    ws, found, starts = words(text), set(), {}
    for item, t in items:
        iw = words(t)
        k = min(len(iw), window)
        for j in range(len(iw) - k + 1 if k else 0):
            for i in range(len(ws) - k + 1):
                if ws[i : i + k] == iw[j : j + k]:
                    starts[i] = max(starts.get(i, 0), k)
                    found.add(item)
    hit = {i + j for i, k in starts.items() for j in range(k)}
    runs = []
    for i in sorted(starts):
        if runs and runs[-1][1] == i - 1:
            runs[-1] = (runs[-1][0], i, max(runs[-1][2], i + starts[i]))
        else:
            runs.append((i, i, i + starts[i]))
    longest, at = max(((e - s, -s) for s, _, e in runs), default=(0, 1))
    known = sorted(str(i) for i in found if i is not None)
    return (
        len(ws), len(hit), len(found), hashlib.sha256(",".join(known).encode()).hexdigest(),
        len(hit) > 0 and 20 * len(hit) >= len(ws), longest, -at,
    )


@pytest.mark.parametrize("depth", [1, 5, 13])
@pytest.mark.parametrize("top", [2, 5, 3000, 10**6])
def test_suffix_array(depth, top):
    r = random.Random(depth)
    codes = np.array([r.choice([0, r.randrange(top), 1]) for _ in range(400)], np.int64)
    order = dc.suffix_array(codes, depth)

    def key(i):
        out = []
        for c in codes[i : i + depth].tolist():
            if c == 0:
                break
            out.append(c)
        return out

    assert sorted(order.tolist()) == np.flatnonzero(codes).tolist()
    keys = [key(i) for i in order]
    assert keys == sorted(keys)


@pytest.mark.parametrize("window", [3, 13])
@pytest.mark.parametrize("block_bytes", [60, 1 << 20])
def test_inspect(spark, window, block_bytes):
    r = random.Random(window)
    say = lambda n, v: " ".join(r.choice(v) for _ in range(n))
    few, many = list("abcd"), [f"w{i}é" for i in range(300)]
    items = [(i, say(r.choice([1, 2, 5, 12, 13, 14, 30]), r.choice([few, many]))) for i in range(20)]
    items += [(3, "Repeated item WITH one id, here"), (None, "null item id stands here now"), (50, None), (51, " .,! "), (9, items[4][1])]
    docs = [(i, say(r.choice([0, 3, 40, 200]), r.choice([few, many]))) for i in range(30)]
    docs += [(i + 100, say(30, many) + ". " + items[i % len(items)][1].upper().replace(" ", "--") * 2 if items[i % len(items)][1] else "x") for i in range(60)]
    docs += [(None, items[0][1]), (7, None), (8, "\x00 \t"), (9, items[0][1]), (9, items[0][1])]
    d = spark.createDataFrame([(a, b, 5) for a, b in docs], "doc_id long, text string, n_items int")
    b = spark.createDataFrame(items, "item_id long, text string")
    rule = dc.Rule(window=window)
    got = dc.inspect(d, b, rule=rule, block_bytes=block_bytes).collect()
    if block_bytes == 60:  # runs of windows from different blocks are not put together
        cut = slice(1, 6)
    else:
        cut = slice(1, 8)
    want = [(a, *slow(t, items, window)) for a, t in docs]
    assert sorted((r[0:1] + r[cut] for r in map(tuple, got)), key=str) == sorted((w[0:1] + w[cut] for w in want), key=str)
    kept = dc.drop_contaminated(d, b, rule=rule, block_bytes=block_bytes)
    assert kept.schema == d.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if not w[5])


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "some words of an item")], "doc_id long, text string")
    assert dc.inspect(none, items).count() == 0
    row = dc.inspect(docs, items.limit(0)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (5, 0, False)
    assert dc.inspect(docs, items).first().contaminated


def test_matches_stay_within_documents():
    assert words_of([b"A1-b C", b"", b"\xc3\xa9[x"], dc.WORDS).types.to_pylist() == [b"a1", b"b", b"c", "é".encode(), b"x"]


def test_shards_are_bounded_in_bytes(spark, monkeypatch):
    items = spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")
    index = dc.Index(items, "item_id", "text", dc.Rule(), 4 << 20)
    list(index.blocks())
    of, sizes = dc.words_of, []
    monkeypatch.setattr(dc, "words_of", lambda texts, table: sizes.append(sum(map(len, texts))) or of(texts, table))
    texts = ["some words of an item", None, "other word " * 9_000] * 20 + ["long " * 400_000, "Some words of an item."]
    n_words, n_hit, *_ = dc._inspect(pa.array(texts), index)
    assert n_words == [5, 0, 18_000] * 20 + [400_000, 5] and n_hit == [5, 0, 0] * 20 + [0, 5]
    assert sum(sizes) == sum(len(t or "") for t in texts)
    assert sorted(sizes)[-1] == 2_000_000 and sorted(sizes)[-2] <= dc.SHARD_BYTES
