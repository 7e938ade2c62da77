"""Prefix encoding against the tiktoken library; appends and edits against a
fresh encoding."""

import hashlib

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from martline.llm import bpe
from tests.llm.conftest import ODD

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(RANKS, P.PATTERN)
TEXT = st.text(alphabet=st.sampled_from(list("abcdehrst'  \n\t12,.!éß日\x1c\x85\xa0　")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_equals_the_library_and_decodes(text):
    ids = ENCODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(TEXT, TEXT)
def test_append_is_exact(text, more):
    d = bpe.Document(ENCODER, text)
    d.append(more)
    assert d.all_ids() == LIBRARY.encode_ordinary(text + more)


@settings(max_examples=150, deadline=None)
@given(TEXT, TEXT, st.integers(0, 60), st.integers(0, 60))
def test_edit_is_exact(text, new, a, b):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    d = bpe.Document(ENCODER, text)
    d.splice(a, b, new)
    assert d.all_ids() == LIBRARY.encode_ordinary(text[:a] + new + text[b:])


def test_edit_encodes_only_its_surroundings():
    text = "the cat sat on the mat and " * 200
    d = bpe.Document(ENCODER, text)
    assert d.splice(2000, 2003, "dog") < 12
    assert d.all_ids() == LIBRARY.encode_ordinary(d.text)


def test_prefix_table_grows_and_shrinks():
    v = bpe.Vocabulary(RANKS)
    t = bpe.PrefixTable(v, b"tokenisation")
    for word in (b"tokeniser", b"token", b"unbelievably", b"", b"zz"):
        t.become(word)
        assert t.tokens() == bpe.PrefixTable(v, word).tokens()
        assert b"".join(v.tokens[i] for i in t.tokens()) == word
    t = bpe.PrefixTable(v, b"abcdefgh")
    t.replace(2, 4, b"XYZ")
    assert t.tokens() == bpe.PrefixTable(v, b"abXYZefgh").tokens()


def test_frames(spark, docs):
    texts = [*ODD, "long " * 60_000, "z" * 3000]
    df = docs([(i, t) for i, t in enumerate(texts)] + [(3, "x")])
    coded = bpe.encode(df, PATH, P.PATTERN)
    assert coded.columns == ["doc_id", "lang", "source", "n_chars", "ids"]
    rows = bpe.decode(coded, PATH).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == LIBRARY.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
    assert bpe.encode(df.where("doc_id < 0"), PATH, P.PATTERN).count() == 0


def test_clashing_column_is_replaced(spark):
    df = spark.createDataFrame([(1, "a b", "mine")], "doc_id long, text string, ids string")
    assert bpe.encode(df, PATH, P.PATTERN).first().ids == LIBRARY.encode_ordinary("a b")


def test_registered_query(spark):
    from martline.llm.queries import QUERIES
    rows = QUERIES["op2_prefix_bpe"](spark, "/root/testdata/sf0.001").collect()
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_pairs_are_told_without_merging_their_bytes(monkeypatch):
    import random
    v, r = bpe.Vocabulary(RANKS), random.Random(3)
    pairs = [(r.randrange(50000), r.randrange(50000)) for _ in range(2000)]
    for token in r.sample(sorted(v.tokens), 4000):  # cut tokens: pairs that often merge
        data = v.tokens[token]
        cut = r.randrange(len(data))
        if data[:cut] in RANKS and data[cut:] in RANKS:
            pairs.append((RANKS[data[:cut]], RANKS[data[cut:]]))
    pairs = [p for p in pairs if p[0] in v.tokens and p[1] in v.tokens]
    whole = [v.merge(v.tokens[a] + v.tokens[b]) == [a, b] for a, b in pairs]
    assert True in whole and False in whole
    assert [v.apart(a, b) for a, b in pairs] == whole
    monkeypatch.setattr(v, "merge", None)
    v.pairs.clear()
    assert [v.apart(a, b) for a, b in pairs] == whole


def test_lists_are_decoded_at_once():
    lists = bpe.pa.array([[], None, ENCODER.encode("añb 日"), ENCODER.encode(" x" * 40), [], None], bpe.pa.list_(bpe.pa.int32()))
    expected = [b"", None, "añb 日".encode(), b" x" * 40, b"", None]
    assert ENCODER.decode_lists(lists).to_pylist() == expected
    assert ENCODER.decode_lists(lists.slice(1, 3)).to_pylist() == expected[1:4]
    for bad in (-1, len(RANKS) + 5):
        with pytest.raises(KeyError):
            ENCODER.decode_lists(bpe.pa.array([[bad]], bpe.pa.list_(bpe.pa.int32())))


def test_a_full_cache_keeps_the_strings_in_use(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_RUNS", 3)
    e = bpe.Encoder(RANKS, P.PATTERN)
    for text in ("the cat sat", "the dog ran off", " the cat\n\n", "", "dog the"):
        assert e.encode(text) == LIBRARY.encode_ordinary(text)
        assert len(e._runs) <= 3 + 4
    e.encode("the end")
    assert "the" in e._runs
