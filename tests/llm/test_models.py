"""Language mixtures, toxic spans and token files."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martline.llm import langid, token_files, toxicity
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"
SYLLABLES = {"aa": ["ba", "bo", "bu"], "cc": ["ki", "ke", "ka"], "dd": ["zol", "zur", "zet"]}


def prose(rnd, lang, words):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def model(spark):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, lang, 60), lang) for i, lang in enumerate(list(SYLLABLES) * 40)]
    rows += [(900, "kikeka", None), (901, None, "aa"), (902, None, None)]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_mixtures(spark, model, docs):
    rnd = random.Random(2)
    texts = {1: prose(rnd, "aa", 50), 2: prose(rnd, "aa", 70) + " " + prose(rnd, "cc", 30), 3: prose(rnd, "dd", 20000),
             4: " ".join(prose(rnd, x, 100) for x in SYLLABLES)}
    rows = {r.doc_id: r for r in langid.predict(docs(list(texts.items())), model).collect()}
    assert rows[1].lang_pred == "aa" and rows[1].score == 1 and set(rows[1].proportions) == {"aa"}
    assert rows[2].lang_pred == "aa" and rows[2].proportions == pytest.approx({"aa": 0.7, "cc": 0.3}, abs=0.05)
    assert rows[3].lang_pred == "dd" and rows[3].score == 1
    assert set(rows[4].proportions) == set(SYLLABLES)
    assert all(abs(v - 1 / 3) < 0.05 for v in rows[4].proportions.values())


def test_odd_texts_have_no_language(spark, model, docs):
    df = docs([(i, t) for i, t in enumerate([*ODD, "123 !!", "ba\x00bo ba"])] + [(0, None)])
    rows = langid.predict(df, model).collect()
    assert len(rows) == len(ODD) + 3 and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        text = dict(enumerate([*ODD, "123 !!", "ba\x00bo ba"]))[r.doc_id] or ""
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text))
    kept = langid.accepted(df, model)
    assert kept.columns == df.columns and kept.where("text IS NULL OR text = ''").count() == 0
    none = langid.fit(df.where("doc_id < 0"))
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}


def test_texts_do_not_influence_each_other(model):
    rnd = random.Random(3)
    texts = [prose(rnd, rnd.choice(list(SYLLABLES)), rnd.randrange(0, 40)) for _ in range(30)]
    best, score, _ = langid.infer(model, texts)
    for t, b, s in zip(texts, best, score):
        one, two, _ = langid.infer(model, [t])
        assert (one[0], two[0]) == (b, pytest.approx(s))


def test_held_out_languages(spark):
    from martline.llm.queries import QUERIES
    rows = QUERIES["op8_language_mixture"](spark, "/root/testdata/sf0.01").collect()
    truth = dict(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect())
    out = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and {r.doc_id for r in out} == {
        i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.98 * len(out)


# --- toxicity --------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=5), st.integers(0, 99))
def test_marginals_equal_all_taggings(lengths, seed):
    rng = np.random.default_rng(seed)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    emit, pair = rng.normal(size=int(ends[-1])), rng.normal(size=(2, 2))
    old, toxicity.CHUNK = toxicity.CHUNK, 3
    try:
        marginal, pairs, total = toxicity.forward_backward(emit, starts, ends, pair)
    finally:
        toxicity.CHUNK = old
    want, want_pairs, want_total = np.zeros(len(emit)), np.zeros((2, 2)), 0.0
    for s, e in zip(starts, ends):
        if s == e:
            continue
        z, m, p = 0.0, np.zeros(e - s), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(e - s)):
            w = math.exp(sum(a * b for a, b in zip(emit[s:e], y)) + sum(pair[a, b] for a, b in zip(y, y[1:])))
            z, m = z + w, m + w * np.array(y)
            for a, b in zip(y, y[1:]):
                p[a, b] += w
        want[s:e], want_pairs, want_total = m / z, want_pairs + p / z, want_total + math.log(z)
    assert np.allclose(marginal, want) and np.allclose(pairs, want_pairs) and np.isclose(total, want_total)


def toxic_rows(n=400):
    rnd = random.Random(6)
    clean = [f"word{i}" for i in range(150)]
    bad = ["vilex", "vilor", "grunk"]
    rows = []
    for i in range(n):
        w = [rnd.choice(clean) for _ in range(rnd.randrange(5, 60))]
        toxic = int(rnd.random() < 0.2)
        for _ in range(2 * toxic):
            w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        rows.append((i, " ".join(w), toxic))
    return rows


@pytest.fixture(scope="module")
def tagger(spark):
    rows = toxic_rows() + [(9000, None, 0), (9001, "", 1), (9002, "vilex", None)]
    return toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))


def test_scores_and_spans(spark, tagger, docs):
    texts = [*ODD, "word1 word2 vilex word3 grunk", "word4 word5", "word1 " * 30_000 + "Vilor GRUNK"]
    rows = {r.doc_id: r for r in toxicity.score(docs(list(enumerate(texts))), tagger).collect()}
    n = len(ODD)
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert rows[n].score >= 0.3 > rows[n + 1].score and rows[n + 2].score >= 0.3
    assert [texts[n][s.start:s.end] for s in rows[n].spans] == ["vilex", "grunk"]
    assert [texts[n + 2][s.start:s.end] for s in rows[n + 2].spans] == ["Vilor", "GRUNK"]
    assert all(not rows[i].spans for i in range(n)) and rows[0].score == rows[1].score < 0.3


def test_without_both_labels(spark, docs):
    rows = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "doc_id long, text string, toxic int")
    got = toxicity.score(docs([(1, "a"), (2, None)]), toxicity.fit(rows)).collect()
    assert [r.score for r in got] == [0.0, 0.0]
    assert toxicity.score(docs([(1, "a")]).where("doc_id < 0"), toxicity.fit(rows.where("toxic = 2"))).count() == 0


def test_labels_in_a_table_of_their_own(spark, docs):
    """The same model as from labelled documents; labels other than 0 and 1,
    and those of documents that aren't there, count nothing."""
    rows = toxic_rows(400)
    whole = spark.createDataFrame(rows + [(9000, "vilex", None), (9001, "vilex", 7)], "doc_id long, text string, toxic int")
    one = toxicity.fit(whole)
    two = toxicity.fit(whole.drop("toxic"), labels=whole.select("doc_id", "toxic"))
    texts = docs([(i, t) for i, (_, t, _) in enumerate(rows[:50])])
    a, b = ({r.doc_id: round(r.score, 9) for r in toxicity.score(texts, m).collect()} for m in (one, two))
    assert a == b and len(set(a.values())) > 2


def test_held_out_toxicity(spark, tagger):
    fresh = [(10_000 + i, t, x) for i, t, x in toxic_rows(700)[400:]]
    df = spark.createDataFrame(fresh, "doc_id long, text string, toxic int")
    rows = toxicity.score(df, tagger).collect()
    assert sum((r.score >= 0.3) == (r.toxic == 1) for r in rows) >= 0.97 * len(rows)


def test_scores_do_not_move_with_the_size_of_the_table(spark, docs):
    """The same rows ten times, under new ids: the sample of each label is
    capped, the share of toxic rows is not."""
    rnd = random.Random(8)
    rows = []
    for i in range(1500):
        w = [rnd.choice([f"word{k}" for k in range(40)]) for _ in range(rnd.randrange(20, 40))]
        toxic = int(rnd.random() < 0.1)
        # A weak hit: in half of the toxic rows and in some of the clean ones.
        w += ["vilex"] * (rnd.random() < (0.5 if toxic else 0.03)) + ["grunk"] * (toxic and rnd.random() < 0.3)
        rows.append((" ".join(w), toxic))
    texts = docs([(0, "word1 word2 word3 " * 8), (1, "word1 word2 word3 " * 8 + "vilex"),
                  (2, "word1 word2 word3 " * 8 + "vilex grunk")])
    found = []
    for times in (1, 10):
        table = [(k * len(rows) + i, t, x) for k in range(times) for i, (t, x) in enumerate(rows)]
        model = toxicity.fit(spark.createDataFrame(table, "doc_id long, text string, toxic int"), fit_docs=250)
        found.append({r.doc_id: r.score for r in toxicity.score(texts, model).collect()})
    assert all(abs(found[0][i] - found[1][i]) < 0.15 for i in found[0]), found
    odds = [math.log(f[0] / (1 - f[0])) for f in found]
    assert abs(odds[0] - odds[1]) < 0.7, found


# --- token files -------------------------------------------------------------------

P = pytest.importorskip("public_tokenizers")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 50_000), st.integers(0, 2**32 - 1)), max_size=700),
       st.integers(0, 700), st.integers(0, 700))
def test_blocks_round_trip(values, a, b):
    ids = np.array(values, np.uint32)
    blocks, index = token_files.pack(ids)
    assert token_files.unpack(blocks, index).tolist() == values
    a, b = sorted((min(a, len(ids)), min(b, len(ids))))
    assert token_files.unpack(blocks, index, a, b).tolist() == values[a:b]


def test_outliers_go_to_the_exception_list():
    ids = np.full(256, 7, np.uint32)
    ids[::50] = 2**31
    blocks, _ = token_files.pack(ids)
    assert len(blocks) < 60  # 8 of head, none of width, 6 exceptions of 5 bytes


def test_files(spark, scratch, docs, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    path = P.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = [*ODD, "long words " * 5000, "a\x1cb <|endoftext|> don't", "q" * 2000]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(100, "again"), (100, "again")]
    out = scratch("tokens")
    token_files.write(docs(rows), path, 2, out, parts=4)
    back = sorted(token_files.read(spark, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in back] == sorted(i for i, _ in rows)
    start, left = 0, {}
    for i, t in rows:
        left.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    for r in back:
        assert r.start == start
        left[r.doc_id].remove(list(r.ids))
        start += len(r.ids)
    digests = {r.start: r for r in token_files.digests(spark, out).collect()}
    for r in back:
        crc = zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert (digests[r.start].n_tokens, digests[r.start].ids_crc32) == (len(r.ids), crc)


def test_added_tokens_as_the_library_has_them(spark, scratch, tmp_path):
    """The query's ids equal those of an untouched tokenizer."""
    from martline.llm.queries import QUERIES
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = ["end of text <|endoftext|> next", "a<|endoftext|><|startoftext|>b'll", "<|endoftext|>", " <|ENDOFTEXT|> x",
             "<|endoftext <|endoftext|>|>\x1c\x1dé<|startoftext|> e\u0301", "plain words", None, "", "<|endoftext|>" * 300]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op7_patched_token_files"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert (rows[i].n_tokens, rows[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t


def test_empty_and_null_ids(spark, scratch, docs):
    path = P.path("word_bpe_49k.json")
    out = scratch("tokens-empty")
    token_files.write(docs([(1, "x")]).where("doc_id < 0"), path, 2, out)
    assert token_files.digests(spark, out).count() == 0
    out = scratch("tokens-null")
    token_files.write(docs([(None, "x"), (3, "y")]), path, 2, out)
    assert [r.doc_id for r in token_files.read(spark, out).orderBy("start").collect()] == [None, 3]


def test_damage_is_found(spark, scratch, docs):
    out, bad = scratch("tokens-ok"), scratch("tokens-bad")
    token_files.write(docs([(1, "some words here"), (2, "and more")]), P.path("word_bpe_49k.json"), 2, out, parts=1)
    from pyspark.sql import functions as F
    spark.read.parquet(out).withColumn("crcs", F.transform("crcs", lambda c: c + 1)).write.parquet(bad)
    with pytest.raises(Exception, match="damaged"):
        token_files.digests(spark, bad).collect()
