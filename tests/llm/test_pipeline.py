"""The pipeline's stages on a small corpus, each against what it should keep."""

import random

import corpus_pipeline as C
import pytest
from martline.llm import common
from martline.llm.common import batch_rows, materialise
from martline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(C.STAGES):
        out = materialise(stage(spark, docs, SF), f"test-{name}")
        assert out.count() <= before
        if k < len(C.STAGES) - 1:
            assert out.columns == columns
        docs, before = out, out.count()
    assert {"doc_id", "ids", "n_tokens"} <= set(docs.columns) and "text" not in docs.columns
    assert docs.where("n_tokens <> size(ids)").count() == 0 and before > 100


def test_stage_decisions(spark, docs):
    rnd = random.Random(9)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where(
        "lang = 'en'").orderBy("doc_id").limit(40).collect() if len(r.text.split()) > 60][:12]
    rows = [(i, t) for i, t in enumerate(real)] + [(50, real[0]), (51, real[1] + " end"), (60, None), (61, "1 2 3"),
            (70, f"{real[2][:200]} {item.text} {real[3][:200]}"), (71, " ".join(rnd.sample(real[4].split(), 60)) + " 10.1.2.3")]
    df = docs(rows)
    kept = materialise(C.language_id(spark, df, SF), "stage")
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {60, 61}
    assert {i for i, _ in rows} - {r.doc_id for r in C.near_duplicates(spark, df, SF).collect()} >= {50, 51}
    assert 70 not in {r.doc_id for r in C.benchmark_leaks(spark, df, SF).collect()}
    text = {r.doc_id: r.text for r in C.pseudonyms(spark, df, SF).collect()}
    assert "10.1.2.3" not in text[71] and text[60] is None


def test_near_duplicates_equal_brute_force(spark, docs):
    """Five words and 80 %: appended and cut copies just above and below."""
    rnd = random.Random(12)
    rows = []
    for extra in (45, 52, -34, -44, 20, 60):
        base = [f"w{rnd.randrange(5000)}" for _ in range(200)]
        copy = base + [f"w{rnd.randrange(5000)}" for _ in range(extra)] if extra > 0 else base[:extra]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(copy))]
    sets = [frozenset(zip(*[t.split()[k:] for k in range(5)])) for _, t in rows]
    near = [{i for i in range(len(rows)) if 100 * len(s & sets[i]) >= 80 * len(s | sets[i])} for s in sets]
    want = {i for i, group in enumerate(near) if i == min(group)}
    assert 196 / 241 > 0.8 and {1, 5} & want == set() and {3, 7} < want
    assert {r.doc_id for r in C.near_duplicates(spark, docs(rows), SF).collect()} == want


@pytest.mark.parametrize("k", range(4))
def test_empty_table_and_clashing_columns(spark, docs, k):
    from pyspark.sql import functions as F
    stage = C.STAGES[k][1]
    odd = docs([(1, "a b c d e f"), (None, None), (1, "a b c d e f")]).withColumns(
        {c: F.lit("mine") for c in ("ids", "pii", "score", "lang_pred", "component_id", "label", "edits")})
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns
    assert out.where("score <> 'mine' OR ids <> 'mine'").count() == 0
    assert stage(spark, odd.where("doc_id < 0"), SF).count() == 0


def test_stages_pass_few_rows_at_a_time_to_python(spark, docs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    df = docs([(1, "The committee will meet again in the morning and read the report.")])
    try:
        for stage in (C.language_id, C.benchmark_leaks, C.token_ids):
            for limit, wanted in (("10000", "1000"), ("0", "1000"), ("10", "10")):
                spark.conf.set(key, limit)
                stage(spark, df, SF)
                assert spark.conf.get(key) == wanted  # when the result is written
        spark.conf.set(key, "10000")
        with batch_rows(spark, C.BATCH_ROWS):
            C.token_ids(spark, df, SF)
        assert spark.conf.get(key) == "10000"
    finally:
        spark.conf.set(key, before)


def test_another_operators_memory_goes_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "_kept", {"before": {"cache": 1}})
    monkeypatch.setattr(common, "give_back", lambda: calls.append(dict(common._kept)))
    common.kept("before")
    assert not calls
    common.kept("bpe")["encoder"] = 2
    assert calls == [{}]  # given back once nothing refers to it
    assert common.kept("bpe") == {"encoder": 2} and len(calls) == 1


def test_registered():
    import __spark_entry__ as e
    names = set(e.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE) <= set(e.oracle_sql())
