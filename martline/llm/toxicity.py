"""Toxic spans by a linear-chain conditional random field.

Tokens (runs of letters) are tagged toxic or not. The chain's potentials are a
weighted sum of a few features of each token plus a weight for each pair of
neighbouring tags. Forward-backward gives the marginal probability that a
token is toxic; a document's score grows with the expected number of toxic
tokens, and its spans are the tokens whose marginal is at least one half.

Features come from labelled documents: for a token, and for its prefixes and
suffixes of three to five letters, how much oftener it occurs in toxic than in
other documents (log odds of document counts, shrunk towards none, counted by
Spark). Token labels
for training: in a toxic document the tokens that are clearly oftener in toxic
ones; everywhere else none. The chain's weights are fitted on a bounded number
of labelled documents by gradient ascent, the document score by a logistic
curve on the expected count.

Bounds: ``count_docs`` labelled documents or so for the counts, ``fit_docs``
of each label for the weights (by a hash of the id), each row weighed by the
inverse of its label's share in the sample, so that scores do not move with
the size of the table. The lexicon holds every unit that the counted documents
have more of in toxic ones, met in MIN_DOCS of these at least.

Edges: null, empty and letterless texts score as no toxic token; equal texts
score alike; long texts are tagged whole, in chunks joined exactly by their
transfer matrices; without both labels in the training rows every score is the
share of toxic ones.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from operator import mul

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import materialise

COUNT_DOCS = 60_000
FIT_DOCS = 500
MIN_DOCS = 3
CHUNK = 128
PIECE_TOKENS = 400_000
CACHE = 1_000_000
TAU = 2.3  # log odds from which a token of a toxic document is labelled toxic
STEPS = 80
SHRINK = 5.0  # documents of the base rate that each count is mixed with

_TOKEN = re.compile(r"[^\W\d_]+")
N_FEATURES = 6  # constant, token, prefix, suffix, known token, strong token


def units(token: str) -> list[str]:
    """The token and its affixes, as lexicon keys."""
    out = ["=" + token]
    for n in (3, 4, 5):
        if len(token) > n:
            out += ["<" + token[:n], ">" + token[-n:]]
    return out


class Lexicon:
    def __init__(self, odds: dict[str, float]):
        self.odds = odds

    def features(self, token: str) -> tuple[float, ...]:
        look = self.odds.get
        own = look("=" + token)
        prefix = suffix = -1.0
        for n in (3, 4, 5):
            if len(token) > n:
                prefix = max(prefix, look("<" + token[:n], -1.0))
                suffix = max(suffix, look(">" + token[-n:], -1.0))
        return (1.0, own or 0.0, prefix, suffix, float(own is not None),
                float((max(prefix, suffix) if own is None else own) >= TAU))


def _logistic(z):
    return 0.5 * (1 + np.tanh(z / 2))


def forward_backward(emit: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                     pair: np.ndarray, count_pairs: bool = True,
                     weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of tag 1, expected tag pairs (2 x 2) and the log partition,
    for the chains [starts, ends) of ``emit`` (log potential of tag 1 against
    tag 0); ``pair``: 2 x 2 log potentials of neighbouring tags; ``weight``:
    how much each chain's tag pairs count (1 by default).

    Chains are cut into chunks. Each chunk's transfer matrix is built by
    running both starting tags through it, all chunks side by side; a walk
    over the chunk matrices gives each chunk its entering vectors, and a
    second run within the chunks the marginals. Nothing is approximated.
    """
    chains = [(int(s), int(e)) for s, e in zip(starts, ends, strict=True) if e > s]
    weight = np.ones(len(chains)) if weight is None else weight[ends > starts]
    if not chains:
        return np.zeros(len(emit)), np.zeros((2, 2)), 0.0
    cuts = [range(s, e, CHUNK) for s, e in chains]
    begin = np.array([c for r in cuts for c in r])
    size = np.minimum(np.repeat([e for _, e in chains], [len(r) for r in cuts]), begin + CHUNK) - begin
    first = np.zeros(len(begin), bool)
    first[np.cumsum([0] + [len(r) for r in cuts[:-1]])] = True
    order = np.argsort(-size, kind="stable")
    rank = np.argsort(order, kind="stable")  # chunk in order of place -> row
    begin, size, first = begin[order], size[order], first[order]
    weight = np.repeat(weight, [len(r) for r in cuts])[order]
    n, longest = len(begin), int(size[0])
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(longest)]  # chunks longer than t
    move, enter = np.exp(pair), np.full((2, 2), 0.5)  # the first token has no pair
    heat = np.exp(np.clip(emit, -30, 30))
    # mats[c]: product over the chunk of (move, then emit), scaled.
    mats, logs = np.tile(move, (n, 1, 1)), np.zeros(n)
    mats[first] = enter
    for t in range(longest):
        k = live[t]
        step = mats[:k] if t == 0 else mats[:k] @ move
        step[:, :, 1] *= heat[begin[:k] + t][:, None]
        total = step.sum(axis=(1, 2))
        mats[:k], logs[:k] = step / total[:, None, None], logs[:k] + np.log(total)
    # Entering vectors: left to right and right to left over each chain.
    alpha, beta = np.ones((n, 2)), np.ones((n, 2))
    partition, at, table = 0.0, 0, mats.tolist()
    for r in cuts:
        rows = rank[at:at + len(r)].tolist()
        at += len(r)
        x, y = 1.0, 1.0
        for c in rows:
            alpha[c] = x, y
            (m00, m01), (m10, m11) = table[c]
            x, y = x * m00 + y * m10, x * m01 + y * m11
            total = x + y
            x, y, partition = x / total, y / total, partition + math.log(total) + logs[c]
        x, y = 1.0, 1.0
        for c in reversed(rows):
            beta[c] = x, y
            (m00, m01), (m10, m11) = table[c]
            x, y = m00 * x + m01 * y, m10 * x + m11 * y
            total = x + y
            x, y = x / total, y / total
    # Within the chunks: forward vectors kept, backward on the way back.
    fwd = np.empty((longest, n, 2))
    v = alpha.copy()
    for t in range(longest):
        k = live[t]
        v[:k] = np.where(first[:k, None], 1.0, v[:k] @ move) if t == 0 else v[:k] @ move
        v[:k, 1] *= heat[begin[:k] + t]
        v[:k] /= v[:k].sum(axis=1, keepdims=True)
        fwd[t, :k] = v[:k]
    marginal, pairs = np.zeros(len(emit)), np.zeros((2, 2))
    b = beta.copy()
    for t in range(longest - 1, -1, -1):
        k = live[t]
        both = fwd[t, :k] * b[:k]
        marginal[begin[:k] + t] = both[:, 1] / both.sum(axis=1)
        after = b[:k].copy()
        after[:, 1] *= heat[begin[:k] + t]
        if count_pairs:
            joint = (fwd[t - 1, :k] if t else alpha[:k])[:, :, None] * move * after[:, None, :]
            joint *= (weight[:k] / joint.sum(axis=(1, 2)))[:, None, None]
            pairs += (joint if t else joint[~first[:k]]).sum(axis=0)
        b[:k] = after @ move.T
        b[:k] /= b[:k].sum(axis=1, keepdims=True)
    return marginal, pairs, partition


class Model:
    def __init__(self, odds: dict[str, float], weights=None, pair=None, curve=(0.0,) * 4, prior=0.0):
        self.lexicon = Lexicon(odds)
        self.weights = [0.0] * N_FEATURES if weights is None else [float(w) for w in weights]
        self.pair = np.zeros((2, 2)) if pair is None else pair
        self.curve, self.prior = curve, prior
        self._emit: dict[str, float] = {}

    def parts(self):
        return self.lexicon.odds, self.weights, self.pair, self.curve, self.prior

    def emission(self, token: str) -> float:
        """Log potential of the toxic tag of a token, from a bounded cache."""
        value = self._emit.get(token)
        if value is None:
            value = sum(map(mul, self.lexicon.features(token.lower()), self.weights))
            if len(self._emit) >= CACHE:
                self._emit.clear()
            self._emit[token] = value
        return value

    def tag(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """(score of each text, character spans of its toxic tokens)."""
        known, emission, emit, ends = self._emit.get, self.emission, [], []
        for t in texts:
            tokens = _TOKEN.findall(t)
            values = list(map(known, tokens))
            if None in values:
                values = [emission(w) if x is None else x for w, x in zip(tokens, values, strict=True)]
            emit += values
            ends.append(len(emit))
        ends = np.array(ends, np.int64)
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        marginal, _, _ = forward_backward(np.array(emit), starts, ends, self.pair, False)
        hits: list[list[tuple[int, int]]] = []
        for t, a, b in zip(texts, starts, ends, strict=True):
            at = set(np.flatnonzero(marginal[a:b] >= 0.5).tolist())
            hits.append([m.span() for k, m in enumerate(_TOKEN.finditer(t)) if k in at] if at else [])
        return self.scores(marginal, starts, ends), hits

    def scores(self, marginal, starts, ends) -> np.ndarray:
        return _logistic(_aggregate(marginal, starts, ends) @ np.array(self.curve))


def _aggregate(marginal, starts, ends) -> np.ndarray:
    """What a document's score weighs: constant, logarithm of the expected
    number of toxic tokens, log odds of the likeliest one, log length."""
    total = np.concatenate(([0.0], np.cumsum(marginal)))
    most = np.zeros(len(ends))
    some = np.flatnonzero(ends > starts)
    if len(some):
        most[some] = np.maximum.reduceat(marginal, starts[some])
    most = np.clip(most, 1e-4, 1 - 1e-4)
    expected = np.maximum(total[ends] - total[starts], 0)
    return np.stack([np.ones(len(ends)), np.log(expected + 0.01), np.log(most / (1 - most)),
                     np.log1p(ends - starts)], 1)


#: Sampled ids that are broadcast to the texts; more are joined.
BROADCAST_IDS = 1_000_000


def fit(docs: DataFrame, text: str = "text", toxic: str = "toxic", key: str = "doc_id",
        count_docs: int = COUNT_DOCS, fit_docs: int = FIT_DOCS, labels: DataFrame | None = None) -> Model:
    """Counts, chain weights and score curve from labelled documents; rows
    with a label other than 0 and 1 don't count, null texts are empty ones.

    ``labels`` (``key``, ``toxic``) where the labels are a table of their own:
    the sample is drawn from it, and the texts of the sample, whose size is
    bounded, are all that is read of ``docs``. Else ``docs`` has the labels."""
    known = (docs if labels is None else labels).where(F.col(toxic).isin(0, 1)).select(
        F.col(key).alias("key"), F.col(toxic).cast("int").alias("toxic"),
        # A fifth of the documents, by hash, is for the weights alone: counts
        # that hold by chance must not look reliable there.
        (F.pmod(F.xxhash64(F.lit(31), F.col(key)), F.lit(5)) == 0).alias("apart"),
        *([F.col(text).alias("text")] if labels is None else []))
    sizes = {(r["apart"], r["toxic"]): r["count"] for r in known.groupBy("apart", "toxic").count().collect()}
    n0, n1 = (sum(n for (_, label), n in sizes.items() if label == k) for k in (0, 1))
    if not n0 or not n1:
        return Model({}, prior=float(bool(n1)))
    # About so many documents of each label and part, by a hash of the id.
    draw = F.pmod(F.xxhash64(F.lit(29), F.col("key")), F.lit(1_000_000))
    chosen = F.lit(False)
    for (apart, label), n in sizes.items():
        rate = min(1, (fit_docs if apart else count_docs) / n)
        chosen |= (F.col("apart") == apart) & (F.col("toxic") == label) & (draw < int(np.ceil(1e6 * rate)))
    sample = known.where(chosen)
    if labels is not None:
        sample = materialise(sample, "toxicity-ids")
        if sample.count() <= BROADCAST_IDS:
            sample = F.broadcast(sample)
        sample = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(sample, "key")
    sample = materialise(sample.select("toxic", "apart", F.coalesce("text", F.lit("")).alias("text")), "toxicity-sample")
    counted = sample.where(~F.col("apart"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, list[int]] = {}

        def held() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.string()), *[
                    pa.array([v[k] for v in totals.values()], pa.int64()) for k in (0, 1)]],
                ["unit", "n0", "n1"])

        for batch in batches:
            for t, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(),
                                strict=True):
                for u in {u for w in set(_TOKEN.findall(t.lower())) for u in units(w)}:
                    totals.setdefault(u, [0, 0])[label] += 1
                if len(totals) > 200_000:
                    yield held()
                    totals.clear()
        yield held()

    used = {r["toxic"]: r["count"] for r in counted.groupBy("toxic").count().collect()}
    base = used.get(1, 0) / max(1, used.get(0, 0) + used.get(1, 0))
    if not 0 < base < 1:
        return Model({}, prior=n1 / (n0 + n1))
    counts = (counted.select("text", "toxic").mapInArrow(count, "unit string, n0 long, n1 long")
              .groupBy("unit").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
              .where(F.col("n1") >= MIN_DOCS)
              .withColumn("p", (F.col("n1") + SHRINK * base) / (F.col("n0") + F.col("n1") + SHRINK))
              .withColumn("odds", F.log(F.col("p") / (1 - F.col("p"))) - math.log(base / (1 - base)))
              .where("odds > 0").toPandas().sort_values("unit"))
    model = Model(dict(zip(counts["unit"], counts["odds"], strict=True)))
    sample = sample.where("apart").select("text", "toxic").toPandas().sort_values(["toxic", "text"])
    toxic_of = sample["toxic"].to_numpy()
    weight = np.ones(len(sample))
    for label in (0, 1):
        mine = toxic_of == label
        weight[mine] = sizes.get((True, label), 0) / max(1, mine.sum())
    _fit_chain(model, sample["text"].tolist(), toxic_of, weight * (len(weight) / max(1.0, weight.sum())))
    return model


def _fit_chain(model: Model, texts: list[str], toxic: np.ndarray, weight: np.ndarray) -> None:
    """Conditional likelihood of the token labels, by AdaGrad; then the
    logistic curve of the documents' labels, by Newton steps. ``weight``: of
    each document, one on average."""
    tokens = [_TOKEN.findall(t.lower()) for t in texts]
    x = np.array([model.lexicon.features(w) for ws in tokens for w in ws]).reshape(-1, N_FEATURES)
    ends = np.cumsum([len(ws) for ws in tokens])
    starts = ends - [len(ws) for ws in tokens]
    y = ((x[:, -1] > 0) & np.repeat(toxic == 1, ends - starts)).astype(float)
    gold = np.zeros((2, 2))
    for s, e, v in zip(starts, ends, weight, strict=True):
        tags = y[s:e].astype(int)
        np.add.at(gold, (tags[:-1], tags[1:]), v)
    each = np.repeat(weight, ends - starts)
    # Most tokens of most documents are alike: one vector product a step.
    w, pair = np.zeros(N_FEATURES), np.zeros((2, 2))
    w[0] = -3.0
    seen_w, seen_p = np.full(N_FEATURES, 1e-6), np.full((2, 2), 1e-6)
    n = max(1.0, each.sum())
    for _ in range(STEPS):
        marginal, pairs, _ = forward_backward(x @ w, starts, ends, pair, weight=weight)
        gw = x.T @ (each * (y - marginal)) / n - 1e-6 * w
        gp = (gold - pairs) / n - 1e-6 * pair
        seen_w += gw ** 2
        seen_p += gp ** 2
        w += 0.5 * gw / np.sqrt(seen_w)
        pair += 0.1 * gp / np.sqrt(seen_p)
    model.weights, model.pair = w.tolist(), pair
    marginal, _, _ = forward_backward(x @ w, starts, ends, pair)
    design = _aggregate(marginal, starts, ends)
    c = np.zeros(design.shape[1])
    for _ in range(30):
        p = _logistic(design @ c)
        hess = design.T @ (design * (weight * p * (1 - p))[:, None]) + 0.1 * np.eye(len(c))
        c += np.linalg.solve(hess, design.T @ (weight * (toxic - p)) - 0.1 * c)
    model.curve = tuple(c.tolist())


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` without its text, plus ``score`` (0 to 1) and ``spans`` (array
    of start and end offsets, characters). Reads the text only."""
    shared = df.sparkSession.sparkContext.broadcast(model.parts())
    keep = [c for c in df.columns if c not in (text, "score", "spans")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(*shared.value)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch[text]]
            rest, at = batch.drop(columns=text), 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size < 4 * PIECE_TOKENS):
                    size += len(texts[upto])
                    upto += 1
                if m.lexicon.odds:
                    value, hits = m.tag(texts[at:upto])
                else:
                    value, hits = np.full(upto - at, m.prior), [[] for _ in range(upto - at)]
                yield rest.iloc[at:upto].assign(
                    score=value, spans=[[{"start": a, "end": b} for a, b in h] for h in hits])
                at = upto

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep]
                       + ["score double, spans array<struct<start:int,end:int>>"])
    return df.select(*keep, text).mapInPandas(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2
