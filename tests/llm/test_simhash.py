"""Near-duplicates against all pairs compared one by one."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from loomwork.llm import simhash
from loomwork.llm.components import components


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(fps):
    group = list(range(len(fps)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            a, b = top(i), top(j)
            group[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def clustered(n, seed):
    r, out = random.Random(seed), []
    while len(out) < n:
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 1, 2, 5, 30])):
            out.append(x)
            for _ in range(r.choice([0, 1, 2, 3, 4])):
                x ^= 1 << r.randrange(64)
    return out[:n]


@pytest.mark.parametrize("blocks", [1, 2, 4])
@pytest.mark.parametrize("shard_rows", [64, 100_000])
def test_close_links(spark, blocks, shard_rows):
    fps = sorted(set(clustered(1500, blocks)))
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    links = simhash.close_links(df, blocks=blocks, shard_rows=shard_rows, sample_per_shard=16)
    root = {r.a: r.root for r in components(links).collect()}
    signed = [int(np.uint64(x).view(np.int64)) for x in fps]
    ours, theirs = {}, {}
    for s, g in zip(signed, slow_groups(fps)):
        ours.setdefault(root.get(s, s), set()).add(s)
        theirs.setdefault(g, set()).add(s)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_dense_shard():
    x = np.uint64(7) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    a, b = simhash.shard_links(x, np.ones(64, bool), simhash.metrics(2, 3)[0], 3, small=8)
    assert len(a) == 63 and len(set(a)) == 63  # a tree, not all pairs


ROWS = [
    (5, "The cat sat on the mat and looked at the dog", "x"),
    (3, "the cat SAT on the mat and looked at the dog", "y"),
    (9, None, None),
    (8, "", "z"),
    (7, " \t\n", "z"),
    (1, "one", "a"),
    (1, "one", "a"),
    (None, "one", "a"),
    (None, "quite other words stand here and nothing else at all", "b"),
    (4, "two words with Ünicode", None),
]


def test_groups_on_odd_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, fp string")
    got = sorted(
        ((r.doc_id, r.fp, r.component_id) for r in simhash.near_groups(df).select("doc_id", "fp", "component_id").collect()),
        key=str,
    )
    fps = [slow_fingerprint(t) for _, t, _ in ROWS]
    groups = slow_groups(fps)
    ids = lambda g: [d for (d, _, _), h in zip(ROWS, groups) if h == g and d is not None]
    want = [
        (d, int(np.uint64(f).view(np.int64)), min(ids(g), default=None))
        for (d, _, _), f, g in zip(ROWS, fps, groups)
    ]
    assert got == sorted(want, key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(df).count() == 0


def test_query(spark, sf_dir):
    from loomwork.llm.queries import op7_simhash

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(docs)
    fps = [slow_fingerprint(docs[i]) for i in ids]
    want = {(i, f"{f:016x}", ids[g]) for i, f, g in zip(ids, fps, slow_groups(fps))}
    assert {tuple(r) for r in op7_simhash(spark, sf_dir).collect()} == want
