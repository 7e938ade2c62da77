"""Components of the join against all pairs compared."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martline.llm import ngram_join as J
from martline.llm.components import connected
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 4:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(w, w[1:], w[2:], w[3:]))


def brute(rows):
    """Row number -> least row number of its component, by comparing all."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(rows))], [len(s) for s in sets]


def corpus(seed=5):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(words) for _ in range(60)]
    out = []
    for g in range(6):  # near copies with changes of different sizes
        base = [rnd.choice(words) for _ in range(rnd.choice([40, 120, 300]))]
        for _ in range(40 if g == 0 else 6):
            w = base[:]
            for _ in range(rnd.randrange(0, max(2, len(w) // 40))):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            out.append(" ".join(w))
    for _ in range(50):  # a passage that unrelated texts share
        out.append(" ".join([rnd.choice(words) for _ in range(50)] + passage))
    out += [out[3]] * 30 + ODD + ["One  two", "one two", "a b c d", "A B C D"]
    rnd.shuffle(out)
    return list(enumerate(out))


def check(rows, df, **options):
    want, sizes = brute(rows)
    got = {r.doc_id: r for r in J.join(df, **options).collect()}
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        assert got[i].component_id == rows[want[k]][0], (i, got[i])
        assert got[i].n_shingles == sizes[k]


def test_join_equals_all_pairs(docs):
    rows = corpus()
    check(rows, docs(rows))


def test_small_classes_give_the_same_links(docs):
    """Every path: tokens frequent from four sets on, sets with many of them."""
    rows = corpus(8)
    check(rows, docs(rows), frequent_level=1, many=4)


def test_dictionary_bound_gives_the_same_links(docs):
    rows = corpus(9)
    check(rows, docs(rows), dictionary=10)


def test_a_shared_key_exists_for_every_link():
    """Index entries alone, any classes: linked sets meet with enough room."""
    rnd = np.random.default_rng(3)
    for _ in range(300):
        n = int(rnd.integers(6, 80))
        a = np.unique(rnd.integers(0, 1 << 60, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[rnd.random(len(a)) > 0.08],
                                      rnd.integers(0, 1 << 60, int(rnd.integers(0, 6)), dtype=np.uint64))))
        common = len(np.intersect1d(a, b))
        if len(a) == common == len(b) or 100 * common < 85 * (len(a) + len(b) - common):
            continue
        class_of = {int(x): int(c) for x, c in zip(np.union1d(a, b), rnd.integers(0, 9, 400))}
        entries = []
        for s in (a, b):
            (rare, place), (keys, place2, role) = J.prefix_keys(
                s, np.array([class_of[int(x)] for x in s], np.uint8))
            e = {("r", int(k)): (len(s) - int(x), 1) for k, x in zip(rare, place)}
            e.update({("f", int(k)): (len(s) - int(x), int(y)) for k, x, y in zip(keys, place2, role)})
            entries.append(e)
        meet = [k for k in entries[0].keys() & entries[1].keys()
                if entries[0][k][1] + entries[1][k][1] > 0
                and min(entries[0][k][0], entries[1][k][0]) * 185 >= 85 * (len(a) + len(b))]
        assert meet


def test_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (1, "other words here now ok"), (None, text), (4, text), (4, text)],
                               "doc_id long, text string")
    rows = J.join(df).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in rows) == [
        (0, 27, 1), (1, 2, 1), (1, 27, 1), (4, 27, 1), (4, 27, 1)]
    assert J.representatives(df).count() == 2


def test_empty_table_and_extra_columns(spark, docs):
    df = docs([(1, "a b c d e"), (2, "a b c d e")]).withColumnRenamed("lang", "component_id")
    assert J.join(df.where("doc_id < 0")).count() == 0
    kept = J.representatives(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\x0bé", max_size=40)), min_size=1, max_size=6))
def test_sets_have_the_contract_sizes(texts):
    got, want = J.shingle_sets(texts), [shingles(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for a, x in zip(got, want):
        for b, y in zip(got, want):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 8), (3, 1), *[(i, i + 1) for i in range(20, 60)]]
    got = dict(connected(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, **{i: 20 for i in range(20, 61)}}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_passes_take_few_rows_and_workers_keep_one_operators_state(spark, docs):
    from martline.llm import common
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        for batch in batches:
            yield batch.slice(0, 1).set_column(0, "n", common.pa.array([batch.num_rows], common.pa.int64()))

    rows = spark.range(50).selectExpr("id AS n").coalesce(1)
    with common.batch_rows(spark, 20):
        assert sorted(r.n for r in rows.mapInArrow(sizes, "n long").collect()) == [10, 20, 20]
    assert spark.conf.get(key) == before
    common.kept("a")["x"] = 1
    assert common.kept("a") == {"x": 1}
    assert common.kept("b") == {}
    assert common.kept("a") == {}
