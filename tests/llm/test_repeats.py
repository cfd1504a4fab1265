"""Repeated strings against all windows of all texts."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from loomwork.llm import repeats
from loomwork.llm.repeats import Repeats, SuffixArray, cut_segments, intervals, maximal_repeats


def covered(texts, window):
    """For each text the bytes that are in a window found elsewhere too."""
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                hit[i : i + window] = b"\1" * window
        out.append(hit)
    return out


def slow(rows, window=200):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), t, hit in zip(rows, texts, covered(texts, window)):
        kept = bytes(b for b, h in zip(t, hit) if not h)
        spans = sum(1 for a, b in zip(b"\0" + hit, hit) if b and not a)
        out.append((i, len(t), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=120, letters="abcdefgh ", length=1500):
    r = random.Random(seed)
    make = lambda k: "".join(r.choice(letters) for _ in range(k))
    passages = [make(r.choice([150, 199, 200, 201, 260, 700])) for _ in range(12)]
    rows = []
    for _ in range(n):
        parts = [make(r.randrange(length))]
        for _ in range(r.randrange(4)):
            parts += [r.choice(passages), make(r.randrange(300))]
        rows.append("".join(parts))
    rows += [rows[0], rows[0], rows[1][:-1] + "é", "x" + rows[2]]
    return rows


ODD = [None, "", "short", "a" * 199, "a" * 200, "b" * 201, "ab" * 300, "z" * 1000, "é" * 100, "é" * 150, "日本" * 90, "q" * 450 + "r" + "q" * 450]


def check(spark, texts, rule=Repeats()):
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, n long, kept string").repartition(3)
    got = repeats.digests(df, rule=rule).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == slow(rows, rule.window)


def test_random_texts(spark):
    check(spark, corpus(1))


def test_odd_texts(spark):
    check(spark, ODD + corpus(2, 10))


@pytest.mark.parametrize("key_bytes", [0, 2000])
def test_large_keys_are_cut_again(spark, key_bytes):
    """A common passage in texts that differ around it, and many near copies."""
    r = random.Random(4)
    make = lambda k: "".join(r.choice("abcdef") for _ in range(k))
    line, base = make(120), make(1200)
    texts = [make(r.randrange(300)) + line + make(r.randrange(300)) for _ in range(60)]
    texts += [base[:i] + "#" + base[i + 1 :] for i in r.sample(range(1200), 30)] + [base] * 3
    check(spark, texts, Repeats(key_bytes=key_bytes, shard_bytes=5000))


def test_small_windows(spark):
    check(spark, corpus(6, 60, "ab", 120) + ODD, Repeats(window=20, anchors=(6, 13, 20), key_bytes=300, shard_bytes=1000))


def test_very_long_text(spark):
    r = random.Random(7)
    body = "".join(r.choice("abcdefghijklmnop ") for _ in range(300_000))
    text = body + body[1000:1500] + "!" + "".join(r.choice("klmno") for _ in range(700_000))
    rows = [(1, text), (2, body[5000:5400]), (3, "other")]
    got = {x.doc_id: x for x in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.lo, s.hi) for s in got[1].spans] == [(1000, 1500), (5000, 5400), (300_000, 300_500)]
    assert got[2].kept == b"" and got[3].kept == b"other" and got[1].n_bytes == len(text)


def test_long_texts_are_cut_in_parts(monkeypatch):
    import pyarrow as pa
    rule = Repeats(window=20, anchors=(6, 13, 20))
    texts = [t.encode() for t in corpus(3, 5, "abc", 400)] + [b"", b"x" * 19]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([1] * len(texts)), pa.array(texts)], ["g", "n", "data"])
    seen = defaultdict(list)
    for part, data, cut, row, off in repeats._cuts(batch, 6, rule, size=50):
        for a, b, r, o in zip(cut.begin.tolist(), cut.end.tolist(), row.tolist(), off.tolist()):
            text = part.column(2)[r].as_py()
            assert text[o : o + b - a] == bytes(data[a:b])
            seen[text] += range(o, o + b - a - 19)
    assert all(sorted(seen[t]) == sorted(i for other in texts if other == t for i in range(len(t) - 19)) for t in texts)


def test_null_and_repeated_ids(spark):
    base = corpus(8, 3)[0] + "x" * 30
    base = (base * 3)[:900]
    rows = [(None, base), (None, base), (3, "tail " + base), (3, None), (3, "tail " + base)]
    got = repeats.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(slow(rows))


def test_empty_table(spark):
    assert repeats.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert repeats.repeat_groups(spark.createDataFrame([(1, "few words")], "doc_id long, text string")).count() == 0


def test_groups_have_all_occurrences(spark):
    r = random.Random(9)
    make = lambda k: "".join(r.choice("abcdefgh") for _ in range(k))
    passage = make(215)
    rows = [(i, make(50 + i) + "<" + passage + ">" + make(40)) for i in range(9)] + [(9, make(500))]
    # no byte around the passage is the same in all
    rows = [(i, t.replace("<", "ABCDEFGHI"[i] if i < 9 else "<").replace(">", "IHGFEDCBA"[i] if i < 9 else ">")) for i, t in rows]
    groups = defaultdict(set)
    for x in repeats.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        text = rows[x.doc_id][1]
        groups[x.repeat].add((x.doc_id, x.lo, x.hi, text[x.lo : x.hi]))
    assert groups
    for found in groups.values():
        strings = {s for *_, s in found}
        assert len(strings) == 1
        string = strings.pop()
        places = {(i, at) for i, t in rows for at in range(len(t)) if t.startswith(string, at)}
        assert {(i, lo) for i, lo, _, _ in found} == places and len(places) == 9


def slow_maximal(segments, least):
    """Maximal repeats by their definition: no byte before or after is the same at all places."""
    places = defaultdict(list)
    for n, s in enumerate(segments):
        for a in range(len(s)):
            for b in range(a + least, len(s) + 1):
                places[s[a:b]].append((n, a))
    out = {}
    for string, at in places.items():
        before = {segments[n][a - 1 : a] if a else (n, "start") for n, a in at}
        after = {segments[n][a + len(string) : a + len(string) + 1] or (n, "end") for n, a in at}
        if len(at) > 1 and len(before) > 1 and len(after) > 1:
            out[string] = sorted(at)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_interval_tree(seed):
    r = random.Random(seed)
    letters = "ab" if seed % 2 else "abc"
    segments = [bytes(r.choice(letters.encode()) for _ in range(r.randrange(4, 40))) for _ in range(6)] + [b"a" * 12, b"\0" * 9, b"\0\0\1" * 3]
    segments = sorted(set(segments))
    got = defaultdict(list)
    tree = maximal_repeats(segments, 4)
    for number, (length, owner, at) in enumerate(tree.occurrences()):
        got[number] += [(n, a, segments[n][a : a + length]) for n, a in zip(owner.tolist(), at.tolist())]
    spans = [bytearray(len(s)) for s in segments]
    for n, a, b in zip(*(x.tolist() for x in tree.spans())):
        assert not any(spans[n][a:b]) and a < b
        spans[n][a:b] = b"\1" * (b - a)
    assert spans == covered(segments, 4)
    mine = {}
    for rows in got.values():
        assert len({s for _, _, s in rows}) == 1
        mine[rows[0][2]] = sorted((n, a) for n, a, _ in rows)
    assert mine == slow_maximal(segments, 4)


def test_suffix_array():
    r = random.Random(11)
    segments = [bytes(r.choice(b"ab\0\xff") for _ in range(r.randrange(1, 60))) for _ in range(20)]
    array = SuffixArray(segments)
    suffixes = [s[i:] for s in segments for i in range(len(s))]
    order = sorted(range(array.n), key=lambda i: (array.ranks[-1][i], i))
    assert [suffixes[i] for i in order] == sorted(suffixes)
    import numpy as np
    import os
    a, b = np.array(order[:-1]), np.array(order[1:])
    assert array.common(a, b).tolist() == [len(os.path.commonprefix([suffixes[i], suffixes[j]])) for i, j in zip(a, b)]


def test_intervals():
    # the tree of "abracadabra": common prefixes of its sorted suffixes
    assert sorted(intervals([1, 4, 1, 1, 0, 3, 0, 0, 0, 2], 1)) == sorted([(4, 1, 2), (1, 0, 4), (3, 5, 6), (2, 9, 10)])


def test_segments_hold_every_window():
    rule = Repeats(window=20, anchors=(6, 13, 20))
    for k in rule.anchors:
        texts = [t.encode() for t in corpus(3, 20, "ab", 80)] + [b"", b"a" * 19, b"a" * 60]
        data, cut = cut_segments(texts, k, rule)
        starts, keys, seen = [sum(map(len, texts[:i])) for i in range(len(texts))], defaultdict(set), []
        for a, b, o, key in zip(*(x.tolist() for x in cut)):
            for i in range(a, b - 19):
                seen.append(i)
                keys[bytes(data[i : i + 20])].add(key)
                assert starts[o] <= i and i + 20 <= starts[o] + len(texts[o])
        assert seen == [s + i for s, t in zip(starts, texts) for i in range(len(t) - 19)]
        assert all(len(k) == 1 for k in keys.values())
