"""Passages found against an edit distance over every place."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martline.llm import decontaminate as D
from tests.llm.conftest import ODD


def distance(p, t):
    """Least edits of p against any part of t."""
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rnd, text, edits):
    s = list(text)
    for _ in range(edits):
        k = rnd.randrange(len(s))
        kind = rnd.randrange(3)
        s[k:k + (kind != 1)] = [] if kind == 0 else [rnd.choice("qxz")]
    return "".join(s)


def test_found_exactly_within_the_budget(spark, docs):
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice("abcde ") for _ in range(n)).strip() or "a"
    passages = [(k, text(rnd.choice([5, 30, 90, 150]))) for k in range(8)] + [(90, None), (91, ""), (92, None)]
    passages += [(95, passages[2][1])]  # an equal passage
    rows = [(i, t) for i, t in enumerate(ODD)]
    for _ in range(60):
        p = rnd.choice(passages[:8])[1]
        rows.append((len(rows), text(80) + edited(rnd, p, rnd.randrange(0, 7)) + text(40)))
    rows.append((len(rows), text(3000) + passages[3][1] + text(3000)))
    bench = spark.createDataFrame(passages, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.find(docs(rows), bench).collect()}
    norm = {i: D.normalise(t) for i, t in rows}
    for i, _ in rows:
        for k, raw in passages:
            p = D.normalise(raw)
            least = distance(p, norm[i]) if p else 99
            most = D.budget(len(p)) if len(p) >= D.Q else 0
            assert ((i, k) in got) == (bool(p) and least <= most), (i, k, least, most)
            if (i, k) in got:
                r = got[i, k]
                assert r.edits == least
                assert distance(p, norm[i][r.start:r.end]) == least
    kept = {r.doc_id for r in D.clean(docs(rows), bench).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in got}


def test_pieces_and_blocks_change_nothing(spark, docs, monkeypatch):
    rnd = random.Random(4)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(120)).strip()
    noise = "".join(rnd.choice("ijklmn ") for _ in range(900))
    rows = [(i, noise[:k] + passage + noise[k:]) for i, k in enumerate(range(0, 900, 37))]
    bench = spark.createDataFrame([(1, passage), (2, passage.upper()), (3, noise[:50])], "item_id long, text string")
    want = sorted(map(tuple, D.find(docs(rows), bench).collect()))
    monkeypatch.setattr(D, "BLOCK_CHARS", 1)
    assert sorted(map(tuple, D.find(docs(rows), bench).collect())) == want
    assert sum(r[1] == 1 for r in want) == len(rows) == sum(r[1] == 2 for r in want)
    block = D.Block([(1, D.normalise(passage))])
    whole = {next(block.places(t), None) is not None for _, t in rows}
    monkeypatch.setattr(D, "PIECE", 200)
    assert whole == {True} == {next(block.places(t), None) is not None for _, t in rows}


@settings(max_examples=100, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=16))
def test_alignment(p, t):
    got = D.align(D.codes(p), D.codes(t), 99)
    assert got[0] == distance(p, t) == distance(p, t[got[1]:got[2]])


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([(1, "some passage of text here")], "item_id long, text string")
    assert D.find(docs([(1, "x")]).where("doc_id < 0"), bench).count() == 0
    assert D.find(docs([(1, "x")]), bench.where("item_id < 0")).count() == 0
    odd = docs([(1, "some passage of text here"), (1, None), (2, "clean")]).withColumnRenamed("lang", "item_id")
    kept = D.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == 2


def test_passages_with_a_null_id_count(spark, docs):
    bench = spark.createDataFrame([(None, "some passage of text here"), (None, "another passage without id"),
                                   (2**60 + 1, "a passage with an id")], "item_id long, text string")
    df = docs([(1, "x some passage of text here and another passage without id"), (2, "clean"),
               (3, "x a passage with an id, some passage of text here"), (4, "a passage with an id")])
    assert [r.doc_id for r in D.clean(df, bench).collect()] == [2]
    got = {(r.doc_id, r.item_id, r.edits, r.start) for r in D.find(df, bench).collect()}
    assert got == {(1, None, 0, 2), (3, None, 0, 24), (3, 2**60 + 1, 0, 2), (4, 2**60 + 1, 0, 0)}


def test_grams_are_equal_only_for_equal_text():
    c = D.codes("abcdefghijklmnop abcdefghijklmnoq")
    h = D.grams(c)
    assert h[0] == h[17] and h[4] != h[21] and len(h) == len(c) - D.Q + 1
    assert len(np.unique(h)) == len({bytes(c[i:i + D.Q]) for i in range(len(h))})
