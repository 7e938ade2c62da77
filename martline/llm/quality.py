"""Quality rules whose cutoffs adapt to each language and source.

Every document is measured once. Per (language, source) and measure, a
mergeable quantile sketch is built: a log-linear histogram whose buckets keep
the seven leading bits of a value, so a quantile is off by under 1 % and two
sketches merge by adding counts (which is what the partial aggregation and the
roll-up to language and corpus do). The cutoff of a measure is Tukey's outer
fence, upper quartile + ``spread`` x interquartile range, plus a slack of the
measure's own scale, since most texts repeat nothing and have no symbols, and a
group without any spread says nothing about how much would be too much; a group with fewer than
``min_group`` documents uses the merged sketch of its language, then that of
the corpus. A document is kept when it passes the base rule and lies within
all fences of its group.

Edges: null or wordless text has zero counts and fails the base rule; null
language or source is a group of its own; an empty table gives an empty
result. Integer arithmetic throughout: equal input, equal verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import SPACES, let, materialise, words

SYMBOLS = "#*$%&|<>"
MIN_GROUP = 100
SPREAD = 3

#: Measure -> (expression over the counts, slack added to the fence), both in
#: thousandths; a wordless document has no measures.
MEASURES = {
    "symbol_rate": ("n_symbols * 1000 div word_chars", 20),
    "dup_line_rate": ("n_dup_lines * 1000 div n_words", 50),
    "repeat_rate": ("n_repeat_words * 1000 div n_words", 300),
    "word_length": ("word_chars * 1000 div n_words", 1000),
}


def _repeat_words(w: Column) -> Column:
    """Words inside a 3-word window that the text holds at least twice.
    Windows are sorted by hash; those with an equal neighbour repeat, and in
    order of position each adds the words that the one before didn't cover."""
    def marked(s: Column) -> Column:
        same = lambda i, j: (j >= 0) & (j < F.size(s)) & (F.get(s, j)["h"] == F.get(s, i)["h"])
        hits = F.filter(s, lambda x, i: F.coalesce(same(i, i - 1) | same(i, i + 1), F.lit(False)))
        at = F.sort_array(F.transform(hits, lambda x: x["p"]))
        return F.aggregate(
            at, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
            lambda a, p: F.struct(p.alias("last"),
                                  (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
            lambda a: a["n"])

    def counted(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint"))
                .otherwise(let(pairs, marked)))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 4, F.lit(0).cast("bigint")).otherwise(let(windows, counted))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("bigint"))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base counts and ``base_failed`` in place of the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    counts = let(words(t), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    return (df.withColumns({
        "_counts": counts,
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("bigint"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": _dup_lines(t)})
        .withColumns({"n_words": F.col("_counts.n_words"),
                      "n_repeat_words": F.col("_counts.n_repeat_words")})
        .drop("_counts", text)
        .withColumn("base_failed", F.expr(
            "n_words < 50 OR 100 * n_repeat_words > 50 * n_words")))


def bucket(v: Column) -> Column:
    """Lower end of the sketch bucket of a non-negative long."""
    shift = F.greatest(F.length(F.bin(v)) - 7, F.lit(0))
    return v - F.pmod(v, F.pow(F.lit(2.0), shift).cast("bigint"))


def sketches(measured: DataFrame) -> DataFrame:
    """Bucket counts by language, source and measure, and merged by language
    and over all (level 2, 1, 0)."""
    long = measured.where("n_words > 0").select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")).alias("g_lang"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("g_source"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(e).alias("v"))
                            for m, (e, _) in MEASURES.items()])).alias("x"))
    own = (long.groupBy("g_lang", "g_source", F.col("x.measure").alias("measure"),
                        bucket(F.col("x.v")).alias("bucket"))
           .agg(F.count("*").alias("n")))
    lang = own.groupBy("g_lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    corpus = lang.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))
    none = F.lit(None).cast("string")
    return (own.withColumn("level", F.lit(2))
            .unionByName(lang.withColumns({"g_source": none, "level": F.lit(1)}))
            .unionByName(corpus.withColumns({"g_lang": none, "g_source": none, "level": F.lit(0)})))


def fences(measured: DataFrame, min_group: int = MIN_GROUP, spread: int = SPREAD) -> DataFrame:
    """(g_lang, g_source) -> lower and upper fence of every measure."""
    group = ["level", "g_lang", "g_source", "measure"]
    w = Window.partitionBy(*group)
    ranked = (materialise(sketches(measured), "quality-sketches")
              .withColumn("upto", F.sum("n").over(w.orderBy("bucket")))
              .withColumn("total", F.sum("n").over(w)))
    at = lambda num: F.min(F.when(F.col("upto") * 4 >= F.col("total") * num, F.col("bucket")))
    q = ranked.groupBy(*group).agg(F.max("total").alias("total"), at(1).alias("q1"), at(3).alias("q3"))
    slack = F.expr("CASE measure " + " ".join(
        f"WHEN '{m}' THEN {s}" for m, (_, s) in MEASURES.items()) + " END").cast("bigint")
    q = q.withColumns({"low": F.col("q1") - spread * (F.col("q3") - F.col("q1")) - slack,
                       "high": F.col("q3") + spread * (F.col("q3") - F.col("q1")) + slack})
    wide = lambda level: q.where(F.col("level") == level).groupBy("g_lang", "g_source").agg(
        F.max("total").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "high")))).alias("f"))
    own, lang, corpus = wide(2), wide(1), wide(0)
    return (own.join(lang.select("g_lang", F.col("total").alias("lang_total"),
                                 F.col("f").alias("lang_f")), "g_lang")
            .withColumn("level", F.lit(0))
            .join(corpus.select(F.lit(0).alias("level"), F.col("f").alias("corpus_f")), "level")
            .select("g_lang", "g_source",
                    F.when(F.col("total") >= min_group, F.col("f"))
                    .when(F.col("lang_total") >= min_group, F.col("lang_f"))
                    .otherwise(F.col("corpus_f")).alias("fences")))


def verdicts(measured: DataFrame, min_group: int = MIN_GROUP, spread: int = SPREAD) -> DataFrame:
    """``measured`` (with lang and source) plus ``kept`` and ``outside``, the
    measures that lie outside their fences."""
    table = materialise(measured, "quality-measured")
    limit = fences(table, min_group, spread)
    joined = (table.withColumns({
        "g_lang": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")),
        "g_source": F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))})
        .join(limit, ["g_lang", "g_source"], "left"))
    outside = F.array_compact(F.array(*[
        F.when((F.expr(e) < F.col("fences")[m]["low"]) | (F.expr(e) > F.col("fences")[m]["high"]),
               F.lit(m)) for m, (e, _) in MEASURES.items()]))
    outside = F.when(F.col("n_words") > 0, outside).otherwise(F.array().cast("array<string>"))
    return (joined.withColumn("outside", outside)
            .withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))
            .drop("g_lang", "g_source", "fences"))
