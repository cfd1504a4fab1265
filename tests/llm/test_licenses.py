"""License scans against exact containment at every place."""

import random
import re

import pytest

from loomwork.llm import licenses as lic

INDEX = lic.Index(lic.TEMPLATES, lic.Settings())


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(text, templates=lic.TEMPLATES, n=5):
    """Names of templates of which four fifths of the shingles lie within 1.25 times their number."""
    ws, out = words(text), set()
    runs = [tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)]
    for name, t in templates:
        tw = words(t)
        wanted = {tuple(tw[i : i + n]) for i in range(len(tw) - n + 1)}
        length = -(-5 * len(wanted) // 4)
        for i in range(len(runs)):
            if len(wanted & set(runs[i : i + length])) >= 0.8 * len(wanted):
                out.add(name)
    return out


def changed(text, share, r):
    return " ".join("changed" if r.random() < share else w for w in text.split())


@pytest.mark.parametrize("seed", range(3))
def test_against_every_place(seed):
    r = random.Random(seed)
    filler = [f"word{i}" for i in range(500)] + words(" ".join(t for _, t in lic.TEMPLATES))
    say = lambda n: " ".join(r.choice(filler) for _ in range(n))
    texts = []
    for _, t in lic.TEMPLATES * 3:
        texts.append(f"{say(r.randrange(40))} {changed(t, r.choice([0, 0, 0.01, 0.05]), r)} {say(r.randrange(40))}")
    texts += ["", "too short", say(3000), say(200) + lic.TEMPLATES[4][1] * 2 + lic.TEMPLATES[0][1]]
    got = [{m.license for m in ms} for ms in lic.find([t.encode() for t in texts], INDEX)]
    assert got == [slow(t) for t in texts]


def test_places():
    text = "one two three\nReleased under the MIT License. " + "x " * 30 + "released UNDER the mit-license"
    (a, b), = lic.find([text.encode()], INDEX)
    assert (a, b) == (lic.Match("MIT", 1.0, 3, 5), lic.Match("MIT", 1.0, 38, 5))


def test_probability():
    for level in INDEX.levels:
        for t in level.templates:
            m = len(INDEX.templates[t].shingles)
            least = 0.8 * m / (level.size + 0.2 * m)
            assert lic.collision_probability(least, level.bands, 1) >= 0.999
            assert level.size - level.size // 4 + 1 >= INDEX.templates[t].run
    assert lic.bands_for(0.5, 2, 0.99) == 17


def test_more_rows_in_a_band():
    index = lic.Index(lic.TEMPLATES, lic.Settings(rows=2))
    text = lic.TEMPLATES[4][1].encode()
    assert {m.license for m in lic.find([text], index)[0]} == {"MIT"}


def test_short_template():
    with pytest.raises(ValueError):
        lic.Index([("x", "only four words here")], lic.Settings())


def test_rows(spark):
    text = "Licensed under CC BY-NC 4.0."
    rows = [(1, text, 1), (None, text, 2), (2, None, 3), (3, "", 4), (1, text, 1), (4, "w " * 100_000 + text, 5)]
    got = lic.scan(spark.createDataFrame(rows, "doc_id long, text string, licenses int")).collect()
    found = sorted(((r.doc_id, r.licenses, r.n_matches) for r in got), key=str)
    one = "CC-BY-NC-4.0", 1
    assert found == sorted([(1, *one), (1, *one), (None, *one), (2, "", 0), (3, "", 0), (4, *one)], key=str)
    assert lic.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf_dir):
    from loomwork.llm.queries import op9_licenses

    want = {r.doc_id: ",".join(sorted(slow(r.text))) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r.licenses for r in op9_licenses(spark, sf_dir).collect()}
    assert got == want and any(want.values())


def test_own_name_only(spark):
    rows = [(i, f"before it {t} and after it") for i, (_, t) in enumerate(lic.TEMPLATES)]
    gpl = {name: [t for n, t in lic.TEMPLATES if n == name] for name in ("GPL-2.0", "GPL-3.0")}
    rows += [(100, f"{gpl['GPL-2.0'][1]} {gpl['GPL-3.0'][1]}"), (101, gpl["GPL-2.0"][1].replace("version 2", "version 9"))]
    rows += [(102, gpl["GPL-2.0"][1].replace("can redistribute", "can share") + " " + gpl["GPL-3.0"][1])]
    got = {r.doc_id: r.licenses for r in lic.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    both = "GPL-2.0,GPL-3.0"
    assert got == {**{i: name for i, (name, _) in enumerate(lic.TEMPLATES)}, 100: both, 101: both, 102: both}
