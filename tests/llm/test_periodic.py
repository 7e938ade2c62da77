"""Runs of words against brute force; the query against its contract in Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from martline.llm import periodic as P
from martline.llm.queries import QUERIES

from tests.llm.conftest import ODD


def brute(words, least=12):
    """(start, length, period) of all runs by comparing words at each distance."""
    got = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                got.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in got.items())


def by_start(rows):
    return sorted((int(a), int(b), int(c)) for a, b, c in rows)


def random_words(rnd):
    n, kinds = rnd.randrange(0, 90), rnd.choice([1, 2, 2, 3, 5])
    words = [rnd.randrange(kinds) for _ in range(n)]
    if words and rnd.random() < 0.6:
        a = rnd.randrange(n)
        p = rnd.randrange(1, max(2, (n - a) // 2 + 1))
        words[a:] = [words[a + (i - a) % p] for i in range(a, n)]
        if rnd.random() < 0.5:
            words[rnd.randrange(n)] = 9
        if rnd.random() < 0.4:
            words += words[::-1]
    return words


@pytest.mark.parametrize("least", [12, 5])
def test_runs_equal_brute_force(least):
    rnd = random.Random(least)
    for _ in range(800):
        words = random_words(rnd)
        assert by_start(P.find(np.array([*words, 1000]), least)) == brute(words, least), words


def test_factors():
    """Names, range successor and extensions against plain search."""
    rnd = random.Random(3)
    for _ in range(6):
        seq = [rnd.randrange(2) for _ in range(rnd.randrange(1, 22))] + [9]
        f, n = P.Factors(np.array(seq)), len(seq)
        order = np.argsort(f.names[-1])
        assert [seq[i:] for i in order] == sorted(seq[i:] for i in range(n)) or len(set(seq)) < 3
        for low in range(n):
            for high in range(low + 1, n + 1):
                for x in range(n + 1):
                    want = min((v for v in order[low:high] if v >= x), default=n)
                    assert f.successor(*(np.array([v]) for v in (low, high, x)))[0] == want
        for i in range(n):
            for j in range(i + 1, n):
                right = next(k for k in range(n) if j + k >= n or seq[i + k] != seq[j + k])
                left = next(k for k in range(n + 1) if i - k - 1 < 0 or seq[i - k - 1] != seq[j - k - 1])
                assert (f.right(np.array([i]), np.array([j]))[0], f.left(np.array([i]), np.array([j]))[0]) == (right, left)


def test_long_texts():
    n = 60_000
    for words, want in (([0] * n, [(0, n, 1)]), ([i % 7 for i in range(n)], [(0, n, 7)]),
                        ([*range(n // 2)] * 2, [(0, n, n // 2)]), ([*range(n)], [])):
        assert by_start(P.find(np.array([*words, 1 << 30]))) == want


def test_edges(spark, docs):
    """Odd texts, repeated rows, other columns, batches of any size."""
    texts = [*ODD, "a b " * 10, "x " + "a b c " * 5 + "y", "a b " * 10]
    df = docs([(i % 5, t) for i, t in enumerate(texts)] + [(None, "a " * 12)])
    for size in (1, 40, 1 << 16):
        rows = P.detect(df, batch_words=size).collect()
        assert sorted(r.collapsed for r in rows if not r.runs) == sorted(b" ".join((t or "").encode().split()).decode() for t in ODD)
        found = sorted(([tuple(x) for x in r.runs], r.collapsed) for r in rows if r.runs)
        assert found == [([(0, 12, 1)], "a"), ([(0, 20, 2)], "a b"), ([(0, 20, 2)], "a b"), ([(1, 15, 3)], "x a b c y")]
        assert {r.lang for r in rows} == {"en"}
    assert P.detect(df.where("doc_id < 0")).count() == 0
    with pytest.raises(ValueError):
        P.detect(df.withColumnRenamed("lang", "runs"))


def contract(doc_id, text):
    """The query's row, from the text by plain Python."""
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(((-k, s, q) for s, k, q in runs), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{k},{q}\n" for s, k, q in sorted(runs, key=lambda r: (r[0], r[2]))).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 4000")
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([*ODD, "a b " * 40])], "doc_id long, text string")
    folder = str(tmp_path)
    table.select("doc_id", "text").unionByName(odd).write.parquet(f"{folder}/documents.parquet")
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = sorted(map(tuple, QUERIES["op11_word_runs"](spark, folder).collect()))
    assert got == sorted(contract(r.doc_id, r.text) for r in rows)
    assert sum(r[1] > 0 for r in got) > 10
