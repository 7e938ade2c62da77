"""Language identification by multilingual mixture inference.

A document is a bag of words, each written in one of the languages of an
unknown set. The likelihood of a word in a language is the product of its
character n-gram probabilities there. Expectation-maximisation estimates the
proportion of each language; languages join the set in the order of their
proportions as long as the likelihood gains more than the penalty (a multiple
of the logarithm of the word count for each further language). The language
with the largest proportion in the chosen set is the prediction, and that
proportion is the score.

The n-gram counts come from labelled documents. They are taken from a sample
with a documented bound, ``per_language`` documents or so of each language
(by a hash of the id), counted by Spark, and hashed to ``1 << BITS`` cells a
language, so the model that the driver broadcasts has a fixed size per
language, however large the corpus.

Edges: null texts and texts without a letter are ``und`` with score 0; equal
texts get equal results; long texts are scored whole; with no labelled
document every text is ``und``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import keep_rows

#: Cells of the n-gram table of a language, and the orders counted.
BITS = 16
ORDERS = (2, 3)
PER_LANGUAGE = 3000
MAX_LANGUAGES = 512
ROUNDS = 12
PENALTY = 2.0
#: Characters scored at a time; a longer text is a piece of its own.
PIECE = 1 << 18

_CODE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Table: is this code point a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool,
                               sys.maxunicode + 1)
    return _letters


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the n-grams of lower-cased words, a mark at either end of a
    word: (word number of each n-gram, its cell, document of each word)."""
    joined = "\0".join(t.lower() for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    padded = np.concatenate(([0], codes, [0]))
    inside = letters()[padded]
    # A word takes the mark before it and the mark after it along.
    begin = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    # Document of a word: separators seen before it.
    ends_of_docs = np.flatnonzero(codes == 0) + 1
    doc = np.searchsorted(ends_of_docs, begin, "right")
    value = np.where(inside, padded, 32).astype(np.uint64)
    words, cells = [], []
    length = end - begin + 2  # with both marks
    for n in ORDERS:
        h = np.zeros(len(value) - n + 1, np.uint64)
        for k in range(n):
            h += value[k:len(value) - n + 1 + k] * _CODE[k]
        h ^= h >> np.uint64(29)
        h *= _CODE[0] + np.uint64(2 * n)
        count = np.maximum(length - n + 1, 0)
        first = begin - 1
        offset = np.cumsum(count) - count
        at = np.arange(int(count.sum())) - np.repeat(offset - first, count)
        words.append(np.repeat(np.arange(len(begin)), count))
        cells.append((h[at] >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(words), np.concatenate(cells), doc


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PIECE characters."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= PIECE):
            size += len(texts[upto])
            upto += 1
        yield at, upto
        at = upto


class Model:
    def __init__(self, languages: list[str], logs: np.ndarray):
        #: logs[cell, language]: log probability of an n-gram of the cell.
        self.languages, self.logs = languages, logs


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id",
        per_language: int = PER_LANGUAGE) -> Model:
    """Count n-grams of about ``per_language`` labelled documents a language.

    Rows with null language or text don't count. The rate is set per language
    from its count, so rare languages keep all their documents.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(1_000_000)).alias("u"))
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32))
    bar = {r["lang"]: min(1_000_000, int(np.ceil(1e6 * per_language / r["count"]))) for r in sizes}
    bars = F.create_map(*[x for k, v in bar.items() for x in (F.lit(k), F.lit(v))])
    sample = rows.where(F.col("u") < bars[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {}
        for batch in batches:
            for name, group in batch.groupby("lang"):
                texts = group["text"].tolist()
                for a, b in _pieces(texts):
                    _, cells, _ = ngrams(texts[a:b])
                    total[name] = total.get(name, 0) + np.bincount(cells, minlength=1 << BITS)
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": name, "cell": at, "n": n[at]})

    counts = (sample.mapInPandas(count, "lang string, cell int, n long")
              .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas())  # cells x languages
    table = np.full((1 << BITS, len(languages)), 0.5)
    table[counts["cell"], counts["lang"].map({x: i for i, x in enumerate(languages)})] += counts["n"]
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def _mixture(like: np.ndarray, doc: np.ndarray, starts: np.ndarray, weight: np.ndarray,
             among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log likelihood) per document after EM over the languages
    allowed in ``among`` (documents x languages); like: words x languages,
    scaled to a maximum of 1 per word."""
    share = among / among.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        part = like * share[doc]
        part /= part.sum(axis=1, keepdims=True) + 1e-300
        share = np.add.reduceat(part, starts, axis=0) / weight[:, None]
    total = np.add.reduceat(np.log((like * share[doc]).sum(axis=1) + 1e-300), starts)
    return share, total


def infer(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, list[dict]]:
    """(language, score, proportions) of each text."""
    n, k = len(texts), len(model.languages)
    best, score, mix = ["und"] * n, np.zeros(n), [{} for _ in range(n)]
    if not k:
        return best, score, mix
    word, cell, doc = ngrams(texts)
    if not len(doc):
        return best, score, mix
    logs = np.empty((len(doc), k))
    for j in range(k):
        logs[:, j] = np.bincount(word, model.logs[cell, j], len(doc))
    like = np.exp(logs - logs.max(axis=1, keepdims=True))
    found, starts, at, counts = np.unique(doc, return_index=True, return_inverse=True, return_counts=True)
    weight, rows = counts.astype(float), np.arange(len(found))
    full, _ = _mixture(like, at, starts, weight, np.ones((len(found), k)))
    order = np.argsort(-full, axis=1, kind="stable")
    chosen = np.zeros((len(found), k))
    chosen[rows, order[:, 0]] = 1
    share, total = _mixture(like, at, starts, weight, chosen)
    open_ = np.ones(len(found), bool)
    for size in range(1, k):  # one language more, where it pays
        trial = chosen.copy()
        trial[rows[open_], order[open_, size]] = 1
        open_ &= full[rows, order[:, size]] > 0.5 / weight
        if not open_.any():
            break
        keep = open_[at]
        sub = np.cumsum(open_) - 1
        begin = np.flatnonzero(np.diff(np.concatenate(([-1], sub[at[keep]]))))
        new_share, new_total = _mixture(like[keep], sub[at[keep]], begin, weight[open_], trial[open_])
        pays = new_total - total[open_] > PENALTY * np.log(weight[open_] + 1)
        which = np.flatnonzero(open_)[pays]
        share[which], total[which], chosen[which] = new_share[pays], new_total[pays], trial[which]
        open_[np.flatnonzero(open_)[~pays]] = False
        if not open_.any():
            break
    top = share.argmax(axis=1)
    for r, d in enumerate(found):
        best[d] = model.languages[top[r]]
        score[d] = min(1.0, max(0.0, share[r, top[r]]))
        mix[d] = {model.languages[j]: float(share[r, j]) for j in np.flatnonzero(chosen[r])}
    return best, score, mix


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` without its text, plus ``lang_pred``, ``score`` (0 to 1) and
    ``proportions`` (map of the chosen languages). Reads the text only."""
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.logs))
    keep = [c for c in df.columns if c not in (text, "lang_pred", "score", "proportions")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(*shared.value)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch[text]]
            # The mark between documents must not occur in one.
            texts = [t.replace("\0", " ") for t in texts]
            rest = batch.drop(columns=text)
            for a, b in _pieces(texts):
                best, score, mix = infer(m, texts[a:b])
                yield rest.iloc[a:b].assign(lang_pred=best, score=score, proportions=mix)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep]
                       + ["lang_pred string, score double, proportions map<string,double>"])
    return df.select(*keep, text).mapInPandas(run, schema)


def accepted(df: DataFrame, model: Model, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows whose text has a language: not ``und``, and one language that
    holds at least the share ``least`` of the words."""
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.logs))

    def verdicts():
        m = Model(*shared.value)

        def keep(texts: list[str]) -> list[bool]:
            out: list[bool] = []
            for a, b in _pieces(texts):
                best, score, _ = infer(m, [t.replace("\0", " ") for t in texts[a:b]])
                out += [x != "und" and s >= least for x, s in zip(best, score, strict=True)]
            return out
        return keep

    return keep_rows(df, text, verdicts)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
