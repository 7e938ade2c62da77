"""What a worker keeps of encoded strings, and the words that reach the library."""
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martline.llm import bpe, token_files
from martline.llm.id_lists import IdLists

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def ids_of(lists, *names):
    found, numbers = lists.find(pa.array(names))
    assert found == list(names)
    return [None if n < 0 else lists.gather(np.array([n]))[0].tolist() for n in numbers]


def test_ids_are_gathered_by_number():
    lists = IdLists(limit=4, longest=3)
    lists.add(["a", "b"], np.array([1, 2, 3], np.uint32), np.array([1, 2]))
    lists.add(["", "long", "c"], np.array([9, 9, 4], np.uint32), np.array([0, 2, 1]))
    assert ids_of(lists, "c", "", "long", "a", "none") == [[4], [], [9, 9], [1], None]
    lists.forget_long(2)
    assert ids_of(lists, "c", "", "long", "b") == [[4], [], None, [2, 3]]
    lists.trim(pa.array(["x", "c", "b"]))  # four: full
    assert len(lists) == 2 and ids_of(lists, "b", "c", "a") == [[2, 3], [4], None]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_words_reach_the_library_as_matches_and_once():
    words, sent = token_files._Words(PATH), []
    send = words._library
    words._library = lambda ws: (sent.extend(ws), send(ws))
    words.encode(pa.array(["Überall, überall. ÜBERALL! don't", "DON'T überall; (don't)"]))
    assert len(sent) == len(set(sent)) and {w for w in sent if w.isalpha()} == {"überall", "don"}
    words.encode(pa.array(["Don't überall"]))
    assert len(sent) == len(set(sent))


def test_matches_of_plain_words_go_straight_to_the_model(library):
    words, sent = token_files._Words(PATH), []

    class Spy:
        def encode(self, text, **options):
            sent.append(text)
            return library.encode(text, **options)

    words.tokenizer = Spy()
    texts = ["Überall, überall. ÇÀÿß! don't 'S x1", "日本 don't İx naïve\x7f DON'T"]
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in words.encode(pa.array(texts))] == wanted
    assert sorted(" ".join(sent).split(" ")) == ["naïve\x7f", "İx", "日本"]


_words = token_files._Words(PATH)
_words_small = token_files._Words(PATH)
_words_small.known.limit = 5


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(
    st.sampled_from("aZ'stredvmlÉéßÿ×÷09-.! \n\t\x1c\x85\xa0ªµºİσΣςé 日"), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_ids_are_the_librarys(library, texts):
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for words in (_words, _words_small):  # with and without what earlier texts left
        assert [x.tolist() for x in words.encode(pa.array(texts, pa.string()))] == wanted


class Counting(dict):
    asked = 0

    def get(self, key, default=None):
        Counting.asked += 1
        return dict.get(self, key, default)


def test_prefixes_ask_for_sizes_that_tokens_have():
    ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    vocabulary = bpe.Vocabulary(Counting(ranks))
    data = b" internationalization of misunderstandings and straightforwardly characterizations" * 3
    Counting.asked = 0
    tokens = bpe.PrefixTable(vocabulary, data).tokens()
    once = Counting.asked
    assert b"".join(vocabulary.tokens[t] for t in tokens) == data
    bpe.PrefixTable(vocabulary, data)  # the pairs are known now
    assert Counting.asked - once < 4 * len(data)


@pytest.fixture(scope="module")
def byte_library():
    import tiktoken
    return tiktoken.Encoding("b", pat_str=P.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")))


_encoder = bpe.Encoder(bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
_encoder_small = bpe.Encoder(bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
_encoder_small._runs.limit = _encoder_small._words.limit = 5


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.one_of(
    st.sampled_from("a's1.  \n\n\t\r\x01\x02\x1c\x85\xa0 　é日"), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_white_space_is_cut_as_the_pattern_has_it(byte_library, texts):
    wanted = [byte_library.encode_ordinary(t) for t in texts]
    for encoder in (_encoder, _encoder_small):
        assert [x.tolist() for x in encoder.encode_batch(texts)] == wanted
        long = " ".join(texts) + "y" * 100  # longer than what is kept
        assert encoder.encode(long) == byte_library.encode_ordinary(long)
