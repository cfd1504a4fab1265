"""Near copies against the similarity of all pairs."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from loomwork.llm import near_copies, quality_rules


def runs(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return a == b or bool(a | b) and len(a & b) >= 0.8 * len(a | b) - 1e-9


def slow(rows):
    """The smallest id of each group that near copies, of all pairs, connect."""
    sets = [runs(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            label[i] = i = label[label[i]]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                label[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return sorted(map(min, groups.values()))


def edited(words, n, r):
    words = list(words)
    for i in r.sample(range(len(words)), n):
        words[i] = f"new{r.random()}"
    return " ".join(words)


def test_against_all_pairs(spark):
    r, rows = random.Random(1), []
    for _ in range(30):
        words = [f"w{r.randrange(3000)}" for _ in range(400)]
        rows += [edited(words, n, r) for n in (0, 0, 1, 4, 8, 8, 12, 30)]
    rows += ["", " ", "too short", "Too  short", "other words", "a b c d e"]
    r.shuffle(rows)
    rows = list(enumerate(rows))
    got = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(x.doc_id for x in got.collect()) == slow(rows)


def chain(n, r):
    """Texts of which only neighbours are near copies."""
    words = [f"c{r.random()}" for _ in range(100)]
    out = []
    for _ in range(n):
        out.append(" ".join(words))
        words = words[9:] + [f"c{r.random()}" for _ in range(9)]
    return out


def jobs_of(spark, run):
    """Numbers of Spark jobs that a call starts."""
    group = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_chains_take_no_more_rounds(spark):
    r, found = random.Random(3), {}
    for n in (10, 200):
        rows = list(enumerate(chain(n, r)))
        r.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got, found[n] = jobs_of(spark, lambda: near_copies.drop_near_copies(df).collect())
        assert sorted(x.doc_id for x in got) == slow(rows) == [0]
    assert found[200] <= 3 * found[10]


def test_recall_at_the_border(spark):
    """Pairs at 0.8 to 0.85 that nothing else connects."""
    r, rows = random.Random(5), []
    while len(rows) < 400:
        words = [f"p{r.random()}" for _ in range(300)]
        other = edited(words, 7, r)
        if 0.8 <= near_copies.jaccard(runs(" ".join(words)), runs(other)) < 0.85:
            rows += [" ".join(words), other]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    left = near_copies.drop_near_copies(df).count()
    assert left <= 202  # of 200 pairs, 199 or more


def test_pairs_that_no_band_retrieves(spark):
    """Near copies that share no band and whose fingerprints are far apart."""
    like, missed = near_copies.Likeness(), []
    sketch = near_copies.Sketcher(like)
    for seed in (902, 1464):
        r = random.Random(seed)
        words = [f"m{r.random()}" for _ in range(49)]
        missed += [" ".join(words), edited(words, 1, r)]
        (_, a, f), (_, b, g) = map(sketch, sketch.hashes([t.encode() for t in missed[-2:]]))
        assert alike(*map(runs, missed[-2:])) and not (a == b).any() and (f ^ g).bit_count() > like.max_bits
    df = spark.createDataFrame(list(enumerate(missed)), "doc_id long, text string")
    assert sorted(x.doc_id for x in near_copies.drop_near_copies(df).collect()) == [0, 2]


def test_a_passage_in_many_texts_links_nothing(spark):
    r = random.Random(6)
    passage = " ".join(f"s{i}" for i in range(150))
    rows = [(i, " ".join(f"d{r.random()}" for _ in range(90)) + " " + passage) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_copies.drop_near_copies(df).count() == 150 == len(slow(rows))


def test_very_long_and_clashing_columns(spark):
    r = random.Random(8)
    words = [f"w{r.randrange(50_000)}" for _ in range(200_000)]
    rows = [(i, t, {"k": i}, i, "x", None) for i, t in enumerate([" ".join(words), edited(words, 900, r), "short", "Short "])]
    df = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, n int, label string, t string")
    got = near_copies.drop_near_copies(df)
    assert got.columns == df.columns and sorted(x.doc_id for x in got.collect()) == [0, 2]


def test_odd_ids(spark):
    rows = [(None, "a b", 1), (5, "a b", 2), (5, "a b", 3), (None, None, 4), (None, "", 5), (7, "c d", 6), (7, "e f", 7)]
    got = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, s int")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(5, "a b", 2), (None, None, 4), (7, "c d", 6), (7, "e f", 7)], key=str)
    assert near_copies.drop_near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = quality_rules.clean(docs).select("doc_id", "text").collect()
    got = corpus_pipeline.near_copies(spark, corpus_pipeline.quality(spark, docs, sf_dir), sf_dir).collect()
    assert sorted(r.doc_id for r in got) == slow(sorted(map(tuple, rows)))


def test_passages_are_not_compared(spark, monkeypatch):
    """Texts that share less than a near copy has are no pairs, also where no sample knows what they share."""
    monkeypatch.setattr(near_copies, "SAMPLE", 0)
    r, like = random.Random(9), near_copies.Likeness()
    words = lambda n: " ".join(f"d{r.random()}" for _ in range(n))
    passage, near = words(60), words(300).split()
    texts = [words(r.randrange(200, 260)) + " " + passage for _ in range(150)] + [" ".join(near), edited(near, 5, r)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_copies._different_texts(docs, "doc_id", "text")
    sets = near_copies._sketches(rows, "doc_id", "text", like).withColumn("n", F.col("id"))
    pairs = {frozenset(p) for p in near_copies._by_first(sets, None, like).select("n", "other").collect()}
    assert frozenset((150, 151)) in pairs and len(pairs) <= len(texts)


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    """Texts of one length that share a passage of more than half are told apart before they meet, near copies never."""
    monkeypatch.setattr(near_copies, "SAMPLE", 0)
    r, like = random.Random(10), near_copies.Likeness()
    words = lambda n: " ".join(f"e{r.random()}" for _ in range(n))
    passage, near = words(150), words(300).split()
    texts = [words(90) + " " + passage for _ in range(100)] + [" ".join(near), edited(near, 5, r)]
    for n in (5, 12, 100, 4000):
        long = words(n).split()
        texts += [" ".join(long), edited(long, max(1, n // 60), r)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_copies._different_texts(docs, "doc_id", "text")
    sets = near_copies.cut_lineage(near_copies._sketches(rows, "doc_id", "text", like).withColumn("n", F.col("id")))
    pairs = {tuple(sorted(p)) for p in near_copies._by_first(sets, None, like).select("n", "other").collect()}
    same = [runs(t) for t in texts]
    assert {(a, b) for b in range(len(texts)) for a in range(b) if alike(same[a], same[b])} <= pairs
    assert len(pairs) <= len(texts)


def test_rounds_end_when_they_find_little(spark, monkeypatch):
    """Texts around one, many of them no near copies of each other, take few rounds and give the same groups."""
    r, base = random.Random(11), [f"g{i}" for i in range(300)]
    rows = list(enumerate(edited(base, r.randrange(4, 13), r) for _ in range(200)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rounds, hold = [], near_copies._to_hold
    monkeypatch.setattr(near_copies, "_to_hold", lambda *a: rounds.append(0) or hold(*a))
    got = near_copies.drop_near_copies(df).collect()
    assert sorted(x.doc_id for x in got) == slow(rows)
    assert len(rounds) <= 3
