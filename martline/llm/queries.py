"""Registered queries of the operators: ``QUERIES[name](spark, sf_dir)`` and,
where SQL can express the result, the DuckDB text ``ORACLE[name]``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.llm import (
    bpe,
    decontaminate,
    langid,
    licenses,
    ngram_join,
    packing,
    periodic,
    pii,
    prefix_trie,
    quality,
    sharding,
    token_files,
    toxicity,
)
from martline.llm.common import documents
from martline.session import scratch_path, table_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op9_hypergeometric_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return sharding.shuffle_shards(documents(spark, sf_dir).select("doc_id", "text"), 24).select(
        "doc_id", (F.length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _quality_sql() -> str:
    """Counts, sketches, fences and verdicts, with the module's figures."""
    sp = "[\\x20\\x09-\\x0D]"
    bucket = "v - v % CAST(power(2, greatest(length(bin(v)) - 7, 0)) AS BIGINT)"
    exprs = {m: e.replace(" div ", " // ") for m, (e, _) in quality.MEASURES.items()}
    rows = " UNION ALL ".join(
        f"SELECT doc_id, g_lang, g_source, '{m}' AS measure, {e} AS v FROM m WHERE n_words > 0"
        for m, e in exprs.items())
    slack = "CASE measure " + " ".join(
        f"WHEN '{m}' THEN {x}" for m, (_, x) in quality.MEASURES.items()) + " END"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, lang, source FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{sp}+'), lambda x: x <> '') AS w FROM t),
p AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS p FROM w),
x AS (SELECT doc_id, p, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM p
      WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM x WHERE c IS NOT NULL),
r AS (SELECT doc_id, least(3, p - coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -10)) AS x
      FROM g WHERE n > 1),
rep AS (SELECT doc_id, sum(x) AS n FROM r GROUP BY 1),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
m AS (SELECT doc_id, len(w) AS n_words,
        length(regexp_replace(text, '{sp}', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        coalesce('=' || lang, 'null') AS g_lang, coalesce('=' || source, 'null') AS g_source
      FROM t JOIN w USING (doc_id) JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),
v AS ({rows}),
b AS (SELECT *, {bucket} AS b FROM v),
k AS (SELECT 2 AS level, g_lang, g_source, measure, b FROM b
      UNION ALL SELECT 1, g_lang, NULL, measure, b FROM b
      UNION ALL SELECT 0, NULL, NULL, measure, b FROM b),
q AS (SELECT level, g_lang, g_source, measure, count(*) AS total,
        quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM k GROUP BY ALL),
f AS (SELECT level, g_lang, g_source, measure, total,
        q1 - {quality.SPREAD} * (q3 - q1) - {slack} AS low,
        q3 + {quality.SPREAD} * (q3 - q1) + {slack} AS high FROM q),
o AS (SELECT v.doc_id, count(*) FILTER (
        v < CASE WHEN a.total >= {quality.MIN_GROUP} THEN a.low WHEN c.total >= {quality.MIN_GROUP} THEN c.low ELSE d.low END
        OR v > CASE WHEN a.total >= {quality.MIN_GROUP} THEN a.high WHEN c.total >= {quality.MIN_GROUP} THEN c.high ELSE d.high END) AS n
      FROM v JOIN f a ON a.level = 2 AND a.measure = v.measure AND a.g_lang = v.g_lang AND a.g_source = v.g_source
      JOIN f c ON c.level = 1 AND c.measure = v.measure AND c.g_lang = v.g_lang
      JOIN f d ON d.level = 0 AND d.measure = v.measure GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(o.n, 0) = 0 AS kept
FROM m LEFT JOIN o USING (doc_id)"""


@register("op5_adaptive_quality", _quality_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of its group's fences."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return quality.verdicts(quality.measure(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def _license_sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(s)}, {q(i)})" for i, s in licenses.SENTENCES.items())
    end, line_end = licenses._END, licenses._LINE_END
    rules = []
    for name, group in licenses.RULES.items():
        for rule in group:
            joins = " ".join(
                f"JOIN s s{k} ON s{k}.doc_id = s0.doc_id AND s{k}.cut = s0.cut AND s{k}.id = {q(i)} "
                f"AND s{k}.i > s{k - 1}.i AND s{k}.i <= s{k - 1}.i + 1 + {licenses.GAP}"
                for k, i in enumerate(rule) if k)
            rules.append(f"SELECT s0.doc_id, {q(name)} AS license FROM s s0 {joins} WHERE s0.id = {q(rule[0])}")
    return f"""
WITH known(s, id) AS (VALUES {known}),
c AS (SELECT doc_id, 'l' AS cut, regexp_split_to_array(coalesce(text, ''), {q(line_end)}) AS s FROM documents
      UNION ALL SELECT doc_id, 'w', regexp_split_to_array(regexp_replace(coalesce(text, ''), '[\\r\\n]+', ' ', 'g'), {q(end)}) FROM documents),
u AS (SELECT doc_id, cut, unnest(s) AS s, generate_subscripts(s, 1) AS i FROM c),
s AS (SELECT doc_id, cut, i, id FROM u JOIN known
      ON known.s = trim(regexp_replace(lower(u.s), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))),
n AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, cut, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY 1),
r AS ({" UNION ".join(rules)}),
a AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses FROM r GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_sentences, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN a USING (doc_id)"""


@register("op6_license_scan", _license_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that every document's sentences declare."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return licenses.scan(docs).select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("licenses", ",").alias("licenses"))


#: Key of the registered query; a deployment passes its own secret.
PII_KEY = "registered-query"


@register("op1_feistel_pseudonyms")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by pseudonyms."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).select(
        "doc_id", "text", F.size("pii").cast("long").alias("n_found"), "pii")


RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
WORD_BPE_END = 2


@register("op2_prefix_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to byte-level BPE ids and decoded again."""
    path = public_tokenizers.path(RANKS)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    decimals = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimals.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op7_patched_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to token files and read back."""
    path = scratch_path(spark, "token-files")
    token_files.write(documents(spark, sf_dir).select("doc_id", "text"),
                      public_tokenizers.path(WORD_BPE), WORD_BPE_END, path, added=True)
    return token_files.digests(spark, path)


@register("op8_language_mixture")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = documents(spark, sf_dir).withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.fit(docs.where("NOT held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")


@register("op3_ngram_jaccard")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, class and component of every document."""
    return ngram_join.join(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id", "class_id")


@register("op4_qgram_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages found in the documents."""
    benchmark = spark.read.parquet(table_path(sf_dir, "benchmark")).select("item_id", "text")
    return decontaminate.find(documents(spark, sf_dir).select("doc_id", "text"), benchmark)


@register("op10_toxic_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from three quarters of the labels."""
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn(
        "held_out", toxicity.held_out(F.col("doc_id")))
    labels = spark.read.parquet(table_path(sf_dir, "labels")).select("doc_id", "toxic")
    model = toxicity.fit(docs, labels=labels.where(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"))


@register("op11_word_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document's words, a tenth of them with a periodic tail."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    tail = periodic.periodic_tail(
        F.col("text"), start=lambda n: g % n, period=lambda n, a: 1 + F.floor((n - a) / (3 + g % 8)))
    docs = documents(spark, sf_dir).select("doc_id", F.when(h % 10 == 0, tail).otherwise(F.col("text")).alias("text"))
    found = periodic.detect(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_END = 0


@register("op12_grouped_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens packed into sequences of 2048."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE), BYTE_BPE_END).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op13_conversation_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    turns = spark.read.parquet(table_path(sf_dir, "conversations"))
    convs = prefix_trie.with_borrowed_starts(prefix_trie.conversations(turns))
    return prefix_trie.trie(prefix_trie.strings(convs))
