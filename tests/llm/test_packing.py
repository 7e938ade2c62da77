"""Packing: the tokenizer's ids, whole documents, gapless sequences, few of them."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from martline.llm import packing as K
from martline.llm import packing_plan as L
from martline.llm.queries import QUERIES
from tokenizers import Tokenizer

from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts, end=0):
    t = Tokenizer.from_file(PATH)
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


def test_ids_equal_the_library():
    with open(PATH, encoding="utf-8") as f:
        encode = K.encoder(f.read())
    texts = [t or "" for t in ODD] + ["a <|endoftext|> b", " " * 3000 + "x  <|endoftext|>  \n\n y", "don't 12's  é日本\r\n \t", "<|endoftext|>"]
    assert [[*encode(t), 0] for t in texts] == ids_of(texts)
    assert len(encode(" " * 300_000 + "<|endoftext|>z")) == 300_002  # beyond the fast matcher
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    assert K.encoder(spec)("Some text") == Tokenizer.from_str(spec).encode("Some text", add_special_tokens=False).ids


def test_linear_groups():
    rnd = random.Random(5)
    for _ in range(50):
        counts = np.array([0, *(rnd.choice([0, 0, 1, 5, 80]) for _ in range(60))])
        groups = L.linear_groups(counts, 15, 6)
        lengths = np.repeat(np.arange(61), counts)[::-1]
        lengths = lengths[lengths > 15]
        assert [g.first for g in groups] == [0, *(g.last for g in groups)][:len(groups)]
        assert (groups[-1].last if groups else 0) == len(lengths) and len(groups) <= 12
        for g in groups:
            assert lengths[g.first] == g.size and (g.last == len(lengths) or lengths[g.last] < lengths[g.last - 1])


def test_configurations_cover_and_are_few():
    rnd = random.Random(6)
    for case in range(30):
        sizes = np.array(sorted(rnd.sample(range(26, 101), rnd.randrange(1, 14)), reverse=True))
        demand = np.array([rnd.randrange(1, 60) for _ in sizes])
        plan = L.configurations(sizes, demand, 100)
        assert sum(c * n for c, n in plan).tolist() == demand.tolist()
        assert all((c * sizes).sum() <= 100 for c, _ in plan)
        # No more than first fit by falling length, and one a size at most above the linear bound.
        rooms = []
        for s in np.repeat(sizes, demand).tolist():
            k = next((k for k, r in enumerate(rooms) if r >= s), None)
            if k is None:
                rooms.append(100 - s)
            else:
                rooms[k] -= s
        assert sum(n for _, n in plan) <= len(rooms) + 1, case


def test_best_fit_equals_one_by_one():
    rnd = random.Random(7)
    for _ in range(200):
        counts = np.array([0, *(rnd.choice([0, 1, 3, 9]) for _ in range(10))])
        rooms = np.array([rnd.choice([0, 0, 1, 4]) for _ in range(30)] + [0])
        fills, opened = L.best_fit(counts, 10, rooms, 30)
        left = sorted(np.repeat(np.arange(31), rooms).tolist())
        new = 0
        for s in np.repeat(np.arange(11), counts)[::-1].tolist():
            fit = [r for r in left if r >= s]
            if fit:
                left.remove(min(fit))
                left.append(min(fit) - s)
            else:
                new += 1
                left.append(30 - s)
        bins = {(r, k): r for r in range(30) for k in range(rooms[r])} | {(30, k): 30 for k in range(opened)}
        ranks = Counter()
        for f in fills:
            assert f.first == ranks[f.size]
            ranks[f.size] = f.last
            for rank in range(f.first, f.last):
                bins[f.room, f.at + (rank - f.first) // f.each] -= f.size
        assert opened == new and sorted(bins.values()) == sorted(left)
        assert [ranks[s] for s in range(11)] == counts.tolist()


def check(rows, ids, capacity):
    """``rows`` are the pieces of ``ids`` by doc_id, packed without gaps."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == sorted(ids)
    for doc, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids[doc])
        assert all(r.length == capacity for r in own[1:]) and (len(own) == 1 or len(ids[doc]) > capacity)
        at = 0
        for r in own:
            assert r.start == at
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[doc][r.start:at], "<u4").tobytes())
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq)


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip((r.doc_id for r in docs), ids_of([r.text for r in docs]), strict=True))
    n = check(QUERIES["op12_grouped_packing"](spark, "/root/testdata/sf0.01").collect(), ids, 2048)
    assert n <= 1.003 * -(-sum(map(len, ids.values())) // 2048) + 1


@pytest.mark.parametrize("capacity", [8, 16])
def test_small_capacity_edges_and_sequences(spark, docs, capacity):
    rnd = random.Random(capacity)
    texts = [*ODD, *(" word" * rnd.randrange(0, 40) for _ in range(200)), *[" word" * 3] * 300]
    ids = dict(enumerate(ids_of(texts)))
    df = docs(list(enumerate(texts))).repartition(5)
    packed = K.pack(df, PATH, 0, capacity=capacity, groups=4, keep_ids=True).persist()
    n = check(packed.collect(), ids, capacity)
    assert n <= -(-sum(map(len, ids.values())) // capacity) * 1.15 + 2
    assert {r.lang for r in packed.collect()} == {"en"}
    for r in K.sequences(packed).collect():
        assert len(r.ids) == sum(s.length for s in r.spans) <= capacity
        for s in r.spans:
            assert "".join(map(str, r.ids[s.offset:s.offset + s.length])) in "".join(map(str, ids[s.doc_id]))
    packed.unpersist()


def test_empty_repeated_and_clashing(spark, docs):
    assert K.pack(docs([]), PATH, 0).count() == 0
    rows = K.pack(docs([(1, "a"), (1, "a"), (None, None)]), PATH, 0).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 1), (1, 2), (1, 2)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3
    with pytest.raises(ValueError):
        K.pack(docs([(1, "a")]).withColumnRenamed("lang", "offset"), PATH, 0)
