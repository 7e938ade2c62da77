"""The prefix trie against one built from dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from martline.llm import prefix_trie as P
from martline.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append(((t is not None, t or 0), (r or "", x or "")))
    convs = {c: [turn for _, turn in sorted(v, key=lambda p: p[0])] for c, v in convs.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
    return {c: convs.get(c - c % 5, [])[:h[c]] + v[h[c]:] for c, v in convs.items()}


def brute(convs):
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved, rows = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        m = members[k]
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = (len(m) - 1) * (len(k[-1][1].encode()) if k else 0) + sum(saved[x] for x in kids[k])
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k))
        rows.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def nodes(turns, cap, borrow=True):
    convs = P.conversations(turns)
    return sorted(map(tuple, P.trie(P.strings(P.with_borrowed_starts(convs) if borrow else convs), cap).collect()), key=str)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = list(map(tuple, spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
    got = sorted(map(tuple, QUERIES["op13_conversation_trie"](spark, sf).collect()), key=str)
    assert got == brute(rebuilt(rows)) and len(got) > 250


@pytest.mark.parametrize("cap", [1, 4, 30, 1 << 18])
def test_bursts_equal_brute_force(spark, cap):
    """Few distinct turns, so prefixes meet; copies, nulls and a long chain."""
    rnd = random.Random(cap)
    rows = []
    for c in range(60):
        for t in range(rnd.randrange(1, 9)):
            rows.append((c, t if rnd.random() < 0.95 else None, rnd.choice(["user", None, ""]),
                         rnd.choice(["a", "é", None, "bb"]) if rnd.random() < 0.3 else "same"))
    seen, unique = set(), []
    for r in rows:  # one turn number of a conversation once: ties have an order of their own
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            unique.append(r)
    for c in range(100, 120):
        unique += [(c, t, "user", f"t{t}") for t in range(25 + c % 2)]
    df = spark.createDataFrame(unique, SCHEMA).repartition(3)
    assert nodes(df, cap) == brute(rebuilt(unique))


def test_edges(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert nodes(df, 10) == []
    # Only rows without a conversation; a conversation without turns of its own.
    assert nodes(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA), 10) == []
    lone = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    rows = [(lone, 0, "user", "x")]
    assert nodes(spark.createDataFrame(rows, SCHEMA), 10) == brute(rebuilt(rows)) == [
        (lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    # Ties and repeated rows have one result, whatever their order; role and text stay apart.
    tied = [(1, 0, "a", "bc"), (1, 0, "ab", "c"), (1, 0, "ab", "c"), (2, 0, "ab", "c"), (2, 1, "a", "bc")]
    a = nodes(spark.createDataFrame(tied, SCHEMA), 10, borrow=False)
    assert a == nodes(spark.createDataFrame(tied[::-1], SCHEMA).repartition(4), 1, borrow=False)
    assert max(r[1] for r in a) == 3
    extra = spark.createDataFrame(tied, SCHEMA).selectExpr("*", "1 AS head", "2 AS seq", "3 AS n")
    assert nodes(extra, 10, borrow=False) == a


def test_member_digests_over_many_stretches(spark, monkeypatch):
    rows = [(b"k" * 16, c) for c in range(-5, 20_000)] + [(b"l" * 16, 7)]
    got = {bytes(r.key): r.ends for r in P._member_digests(spark.createDataFrame(rows, "key binary, conv_id long")).collect()}
    want = {k: hashlib.sha256(",".join(str(c) for x, c in rows if x == k).encode()).hexdigest() for k in {k for k, _ in rows}}
    assert got == want
