"""Pseudonyms, quality rules, licences and shards: DataFrame operators, held
against plain Python versions."""

import datetime as dt
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from martline.llm import licenses, pii, quality, sharding
from tests.llm.conftest import ODD

KEY = "test-key"


# --- pseudonyms ----------------------------------------------------------------


def run_of(c):
    return next(((a, n) for a, n in pii.RUNS if a <= c < a + n), (c, 1))


def feistel(digits, tweak):
    d = [x for x, _ in digits]
    r = [y for _, y in digits]
    cut = len(d) // 2
    for rnd in range(pii.ROUNDS):
        side, other, base = (range(cut, len(d)), d[:cut], cut) if rnd % 2 == 0 else (range(cut), d[cut:], 0)
        seed = f"{KEY}|{tweak}|{rnd}|{','.join(map(str, other))}"
        for i in side:
            h = hashlib.sha256(f"{seed}|{i}".encode()).hexdigest()[:12]
            d[i] = (d[i] + int(h, 16)) % r[i]
    return d


def permuted(s, tweak):
    where = [i for i, c in enumerate(s) if run_of(ord(c))[1] > 1]
    moved = feistel([(ord(s[i]) - run_of(ord(s[i]))[0], run_of(ord(s[i]))[1]) for i in where], tweak)
    out = list(s)
    for i, m in zip(where, moved):
        out[i] = chr(run_of(ord(s[i]))[0] + m)
    return "".join(out)


def luhn(s):
    d = [int(c) for c in s[::-1]]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def replaced(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.pseudonymise(df, KEY).collect()}
    return [rows[i] for i in range(len(texts))]


def test_values_of_all_kinds(spark):
    card, iban = "4111 1111-1111 1111", "GB82 WEST 1234 5698 7654 32"
    texts = [
        f"pay {card}!! now", "call +1 (017) 555-7713 or 555-123-4567", f"to {iban}.", "from 97.51.17.173, ok",
        "und.34@mail7.example.com enößber.68@mail7.example.com", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
        "born 1999-02-28, 31/12/2001, 12/31/2001, 05.06.1980", "ssn 123-45-6789",
    ]
    r = replaced(spark, *texts)
    assert [[x.kind for x in row.pii] for row in r] == [
        ["card"], ["phone", "phone"], ["iban"], ["ipv4"], ["email", "email"], ["secret"], ["date"] * 4, ["ssn"]]
    shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", s)))
    new = r[0].pii[0].pseudonym
    assert shape(new) == shape(card) and luhn(re.sub("[^0-9]", "", new)) and new != card
    assert re.sub("[^0-9]", "", new)[:-1] == permuted("411111111111111", "card")
    assert r[0].text == f"pay {new}!! now"
    assert r[1].text.startswith("call +1 (") and shape(r[1].text) == shape(texts[1])
    got = r[2].pii[0].pseudonym.replace(" ", "")
    assert got[:2] == "GB" and int("".join(str(int(c, 36)) for c in got[4:] + got[:4])) % 97 == 1
    assert all(0 <= int(x) <= 255 for x in r[3].pii[0].pseudonym.split("."))
    assert r[4].pii[0].pseudonym == permuted("und.34", "email") + "@mail7.example.com"
    assert r[4].pii[1].pseudonym == permuted("enößber.68", "email") + "@mail7.example.com"
    assert re.fullmatch("[0-9a-f]{40}", r[5].pii[0].pseudonym)
    d = [x.pseudonym for x in r[6].pii]
    for s, f in zip(d, ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d.%m.%Y")):
        dt.datetime.strptime(s, f)
    day = (dt.date(1999, 2, 28) - dt.date(1800, 1, 1)).days
    a, b = feistel([(day // 773, 189), (day % 773, 773)], "date")
    assert d[0] == str(dt.date(1800, 1, 1) + dt.timedelta(days=a * 773 + b))
    assert re.fullmatch(r"\d{3}-\d{2}-\d{4}", r[7].pii[0].pseudonym)


def test_invalid_values_and_clean_texts_stay(spark):
    texts = ["4111111111111112", "999.1.2.3", "2001-02-30 and 30.02.2001", "GB82WEST12345698765433",
             "version 4.0 of 2.0", "room 12, 3456 people", "x@y", "000-12-3456", *ODD]
    for text, row in zip(texts, replaced(spark, *texts)):
        assert row.text == text and row.pii == []


def test_equal_values_stay_linked_and_different_ones_differ(spark):
    cards = [c for c in (f"40000000{i:08d}" for i in range(400)) if luhn(c)]
    rows = replaced(spark, *[f"a {c} b {c}" for c in cards], f"z{' y' * 20000} {cards[0]}")
    first = [r.pii[0].pseudonym for r in rows[:-1]]
    assert all(r.pii[0].pseudonym == r.pii[1].pseudonym for r in rows[:-1])
    assert len(set(first)) == len(cards) and rows[-1].text.endswith(first[0])


def test_adjacent_values_of_every_pair_of_kinds(spark):
    values = {
        "card": ["4111111111111111", "4111 1111 1111 1111", "3782 822463 10005"], "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
        "ipv4": ["190.137.223.204"], "date": ["1999-02-28", "31/12/2001", "05.06.1980"], "ssn": ["123-45-6789"],
        "phone": ["+1 (826) 555-4081", "+44 20 7946 0958", "(555) 123-4567", "555-123-4567"],
        "email": ["und.34@mail7.example.com"], "secret": ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff"]}
    flat = [(k, v) for k, vs in values.items() for v in vs]
    alone = {v: r.pii for (_, v), r in zip(flat, replaced(spark, *[f"a {v}" for _, v in flat]))}
    assert all([x.kind for x in alone[v]] == [k] for k, v in flat)
    pairs = [(a, b) for _, a in flat for _, b in flat]
    for (a, b), row in zip(pairs, replaced(spark, *[f"x {a} {b}. y" for a, b in pairs])):
        assert row.pii == alone[a] + alone[b], (a, b)
        assert row.text == f"x {alone[a][0].pseudonym} {alone[b][0].pseudonym}. y"


def test_a_number_beside_a_value_hides_nothing(spark):
    card = "4111111111111111"
    texts = [f"{card} 12/25", f"12 {card}", "4111 1111 1111 1111 123", "1234 4111 1111 1111 1111", f"{card}-{card}",
             "41111111 11111111 99", "123-45-6789 41 1111 1111 1111 11"]
    kinds = [[x.kind for x in r.pii] for r in replaced(spark, *texts)]
    assert kinds == [["card"]] * 4 + [["card"] * 2, ["card"], ["ssn", "card"]]
    first = replaced(spark, card)[0].text
    rows = replaced(spark, *texts[:2])
    assert [r.text for r in rows] == [f"{first} 12/25", f"12 {first}"]


def test_dates_are_permuted(spark):
    days = spark.range(0, 146_097, 7).select(
        F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("text"))
    out = pii.pseudonymise(days, KEY)
    assert out.select("text").distinct().count() == days.count()
    assert out.where("size(pii) <> 1").count() == 0


def test_extra_columns_pass(spark):
    df = spark.createDataFrame([(1, "10.0.0.1", "x")], "doc_id long, text string, pii string")
    out = pii.pseudonymise(df, KEY, found="_f")
    assert out.columns == ["doc_id", "text", "pii", "_f"] and out.first().pii == "x"
    assert pii.pseudonymise(df.where("doc_id < 0"), KEY).count() == 0


# --- quality --------------------------------------------------------------------


def counts(text):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    w = word.findall(text or "")
    tri = list(zip(w, w[1:], w[2:]))
    covered = {j for i, t in enumerate(tri) if tri.count(t) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if word.search(x)]
    return (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_counts(docs):
    texts = [*ODD, "a b c a b c", "a a a a a", "x y z\nx y z\n\nx y z", "p q r s p q r t # * $", "one two three"]
    rows = {r.doc_id: r for r in quality.measure(docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(t), t
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_fences_by_group(docs):
    clean = lambda i: " ".join(f"w{(i * 31 + k * 7) % 997}" for k in range(60))
    rows = [(i, clean(i), "en", "big") for i in range(150)] + [(500 + i, clean(i) + " # # #", "fr", "hash")
                                                              for i in range(120)]
    rows += [(900, clean(1) + " # # # # # # # # # # # #", "en", "big"), (901, clean(2), None, None), (902, None, "en", None)]
    out = {r.doc_id: r for r in quality.verdicts(quality.measure(docs(rows))).collect()}
    assert len(out) == len(rows)
    assert out[900].outside == ["symbol_rate"] and not out[900].kept
    assert all(out[i].kept for i, *_ in rows if i < 900)  # three symbols are usual in "hash"
    assert out[901].kept and not out[902].kept and out[902].base_failed
    assert quality.verdicts(quality.measure(docs(rows)).where("doc_id < 0")).count() == 0


def test_bucket_is_close_and_merges(spark):
    v = spark.range(0, 3_000_000, 37).select("id", quality.bucket(F.col("id")).alias("b"))
    assert v.where("b > id OR id - b > id / 64").count() == 0
    assert v.where("id < 128 AND b <> id").count() == 0


# --- licences -------------------------------------------------------------------


def test_licences(docs):
    mit = licenses.SENTENCES
    wrapped = "Permission is hereby granted,\nfree" + mit["mit-grant"].removeprefix("permission is hereby granted free")
    texts = {
        1: ("Words before\nReleased under the MIT License.\nmore", ["MIT"]),
        2: ("Licensed*** under%%% the&&& Apache### License,$$$ Version*** 2.0.### And on.", ["Apache-2.0"]),
        3: (f"{wrapped}. The above copyright notice and this permission notice shall be included in all copies "
            "or substantial portions of the Software.", ["MIT"]),
        4: (". ".join(mit[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")) + ".",
            ["BSD-2-Clause", "BSD-3-Clause"]),
        5: (". ".join(mit[k] for k in ("bsd-binary", "bsd-source", "bsd-grant")), []),  # wrong order
        6: ("All rights reserved.\nAll rights reserved.", ["all-rights-reserved"]),
        7: ("not licensed under anything at all. The license is lost", []),
        8: (None, []), 9: ("", []), 10: ("z " * 30_000 + "\nLicensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    }
    rows = {r.doc_id: r for r in licenses.scan(docs([(i, t) for i, (t, _) in texts.items()])).collect()}
    for i, (_, want) in texts.items():
        assert rows[i].licenses == want, i
    assert rows[6].sentence_ids == ["all-rights"] * 2
    assert any(r == "mit-grant > mit-keep" for r in rows[3].rules)


# --- shards ---------------------------------------------------------------------


def test_matrix_has_its_sums():
    for sizes, shards in (([5, 0, 7, 100], 3), ([1], 4), ([10] * 40, 7), ([], 2)):
        m = sharding.draw_matrix(sizes, shards, 3)
        assert m.sum(axis=1).tolist() == sizes and (m >= 0).all()
        assert m.sum(axis=0).max() - m.sum(axis=0).min() <= 1
    assert sharding._hypergeometric(__import__("numpy").random.default_rng(1), 3 * 10**9, 10**9, 4 * 10**9) == 3 * 10**9


@pytest.mark.parametrize("part_rows", [1_000_000, 50])
def test_shards_are_whole_and_even(spark, part_rows):
    df = spark.createDataFrame([(i if i % 3 else 0, None if i % 7 == 0 else "t") for i in range(1000)],
                               "doc_id long, text string")
    out = sharding.shuffle_shards(df, 24, part_rows=part_rows)
    rows = out.collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(24)) and {len(v) for v in by.values()} <= {41, 42}
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((r.doc_id, r.text or "") for r in df.collect())
    again = sharding.shuffle_shards(df, 24, part_rows=part_rows).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_shuffle_is_even_over_shards(spark):
    """Neighbours of the input land in each shard about equally often."""
    out = sharding.shuffle_shards(spark.range(24_000), 24, seed=11).where("id < 2400")
    n = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(n) == 24 and sum((x - 100) ** 2 / 100 for x in n) < 60  # chi-squared, 23 degrees


def test_few_rows_and_clashes(spark):
    assert sharding.shuffle_shards(spark.range(0), 24).columns == ["id", "shard", "slot"]
    assert sharding.shuffle_shards(spark.range(3), 24).count() == 3
    with pytest.raises(ValueError, match="rename"):
        sharding.shuffle_shards(spark.range(3).withColumn("slot", F.lit(1)), 2)
