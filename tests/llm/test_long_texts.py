"""Texts that make a backtracking matcher, or a growing array, go wrong: each
takes seconds, and has its defined result."""

import math
import time
from itertools import product

import numpy as np
import pytest
from martline.llm import licenses, pii, sharding
from pyspark.sql import functions as F

N = 1_000_000


@pytest.mark.parametrize("text, kinds", [
    ("a." * (N // 2) + "1", []),
    ("x@" + "a." * 100_000 + "com", []),                        # a domain of 100,000 labels is none
    ("x" * 65 + "@b.org and y@" + "a." * 100 + "com", ["email"]),
    ("." * N + "\n software", []),
    ("a@" * (N // 4), []),
])
def test_pii_patterns_are_linear(spark, docs, text, kinds):
    begin = time.time()
    rows = pii.pseudonymise(docs([(1, text)]), "k").collect()
    assert [x.kind for x in rows[0].pii] == kinds and len(rows[0].text) == len(text)
    assert time.time() - begin < 60


def test_many_values_in_one_text(spark, docs):
    begin = time.time()
    text = " ".join(f"{1900 + i % 120}-{1 + i % 12:02d}-{1 + i % 28:02d}" for i in range(20_000))
    row = pii.pseudonymise(docs([(1, text)]), "k").first()
    assert len(row.pii) == 20_000 and {x.kind for x in row.pii} == {"date"}
    assert [x.pseudonym for x in row.pii] == row.text.split(" ")
    assert time.time() - begin < 120


@pytest.mark.parametrize("filler", [".", ".-", "- ", "!\n", "\t"])
def test_license_cuts_are_linear(spark, docs, filler):
    begin = time.time()
    text = "all rights reserved.\n" + filler * (N // len(filler)) + "\nAll rights reserved. "
    row = licenses.scan(docs([(1, text)])).first()
    assert row.licenses == ["all-rights-reserved"] and len(row.sentence_ids) == 2
    assert time.time() - begin < 60


def test_license_cuts_equal_the_plain_pattern(spark):
    """The cuts that the SQL makes, up to signs that count nothing."""
    import random
    import re
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab .-!\n,") for _ in range(rnd.randrange(1, 25))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    norm = lambda s: re.sub("[^a-z]+", " ", s).strip()
    for end, once in ((licenses._END, licenses._ONCE), (licenses._LINE_END, licenses._LINE_ONCE)):
        for r in df.select("t", F.split("t", end).alias("a"), F.split("t", once).alias("b")).collect():
            assert list(map(norm, r.a)) == list(map(norm, r.b)), r.t


def law(sizes, columns):
    """Probability of every matrix of these row and column sums."""
    total = math.factorial(sum(sizes))
    out = {}
    for cells in product(*(range(min(n, c) + 1) for n in sizes for c in columns)):
        m = np.array(cells).reshape(len(sizes), len(columns))
        if m.sum(axis=1).tolist() == list(sizes) and m.sum(axis=0).tolist() == list(columns):
            ways = math.prod(map(math.factorial, sizes)) * math.prod(map(math.factorial, columns))
            out[m.tobytes()] = ways / total / math.prod(math.factorial(int(x)) for x in cells)
    return out


@pytest.mark.parametrize("sizes, shards", [((2, 3), 2), ((1, 2, 2), 2), ((3, 1), 3)])
def test_matrices_follow_the_joint_law(sizes, shards):
    n = sum(sizes)
    want = law(sizes, [n // shards + (j < n % shards) for j in range(shards)])
    assert abs(sum(want.values()) - 1) < 1e-9
    draws = 6000
    seen: dict = {}
    for seed in range(draws):
        m = sharding.draw_matrix(list(sizes), shards, seed).tobytes()
        seen[m] = seen.get(m, 0) + 1
    assert set(seen) <= set(want)
    chi = sum((seen.get(m, 0) - draws * p) ** 2 / (draws * p) for m, p in want.items())
    assert chi < len(want) + 6 * math.sqrt(2 * len(want)) + 6


def test_large_urns_follow_the_law(monkeypatch):
    """The inversion, on small urns where the law is known exactly."""
    monkeypatch.setattr(sharding, "NUMPY_URN", 0)
    for good, bad, draws in ((5, 7, 4), (3, 2, 5), (50, 1, 30), (0, 4, 2)):
        want = {k: math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
                for k in range(max(0, draws - bad), min(good, draws) + 1)}
        rng = np.random.default_rng(4)
        got = [sharding._hypergeometric(rng, good, bad, draws) for _ in range(4000)]
        assert set(got) <= set(want)
        assert all(abs(got.count(k) / 4000 - p) < 0.05 for k, p in want.items())
    rng = np.random.default_rng(5)
    big = [sharding._hypergeometric(rng, 4 * 10**10, 6 * 10**10, 10**6) for _ in range(300)]
    assert abs(np.mean(big) - 400_000) < 150 and 380 < np.std(big) < 610


def test_whole_rows_move(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), 5).alias("text"))
    rows = sharding.shuffle_shards(df.repartition(7), 5, part_rows=100).collect()
    assert all(r.text == str(r.doc_id) * 5 for r in rows) and len({r.doc_id for r in rows}) == 3000
    sizes = [sum(r.shard == s for r in rows) for s in range(5)]
    assert sizes == [600] * 5
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(600)) for s in range(5))
