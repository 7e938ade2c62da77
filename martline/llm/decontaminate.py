"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A passage of m characters found in a text with at most e edits keeps at least
m - q + 1 - q * e of its q-grams, and the diagonals (text position minus
passage position) of the kept ones differ by e at most. So the shared q-grams
are counted per passage in bands of 2 * (e + 1) diagonals, each band overlapping
the next by half: every such occurrence lies in one band whole. Bands that
reach the bound are aligned with the passage within the band, and those within
the edit budget are reported. No occurrence within the budget is missed, and
none beyond it is reported.

Texts and passages are compared lower-cased with white space runs as one
space. The edit budget is ``rate`` of the passage's length, less where the
bound would fall to nothing; a passage shorter than q is looked for as it is.

Passages are worked on in blocks of ``BLOCK_CHARS`` characters: the q-gram
index of a block is what goes to the workers, so it has a fixed size however
large the benchmark, and every block meets every document, in pieces of
``PIECE`` characters that overlap by more than a passage.

Edges: null and empty texts match nothing; null and empty passages are never
found; a passage with a null id counts like others (those found in a document
are one row with a null item_id); equal passages are all reported; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import keep_rows

Q = 12
RATE = 0.05
BLOCK_CHARS = 4_000_000
PIECE = 1 << 20
FILTER_BITS = 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
_SPACE = re.compile(r"\s+")


def normalise(text) -> str:
    return _SPACE.sub(" ", text.lower()).strip() if isinstance(text, str) else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(c: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each position, by doubling."""
    if len(c) < Q:
        return np.empty(0, np.uint64)
    h, size, power = c.astype(np.uint64) * _MIX, 1, _BASE
    while size * 2 <= Q:
        h = h[:-size] * power + h[size:]
        size, power = size * 2, power * power
    rest = Q - size
    if rest:  # the last characters: two overlapping windows fix all of them
        h = h[:len(h) - rest] * (power * _MIX) + h[rest:]
    return (h ^ (h >> np.uint64(31))) * _MIX


def budget(m: int, rate: float = RATE) -> int:
    """Edits allowed for a passage of m >= Q characters."""
    return min(int(rate * m), (m - Q) // Q)


def align(pattern: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of ``pattern`` in ``text`` with at
    most ``most`` edits, else None. Both ends of the text are free; the text
    is a band's region, so each row of the table is short."""
    n = len(text)
    place = np.arange(n + 1)
    cost, start = np.zeros(n + 1, np.int64), place.copy()
    for i, p in enumerate(pattern, 1):
        diag = np.empty(n + 1, np.int64)
        diag[0], diag[1:] = i, cost[:-1] + (text != p)
        up = cost + 1
        take = diag <= up
        take[0] = False
        new = np.where(take, diag, up)
        begin = np.where(take, np.concatenate(([0], start[:-1])), start)
        # Characters of the text that the pattern lacks: a running minimum.
        slope = new - place
        low = np.minimum.accumulate(slope)
        at = np.maximum.accumulate(np.where(slope == low, place, 0))
        cost, start = low + place, begin[at]
        if cost.min() > most:
            return None
    end = int(cost.argmin())
    return (int(cost[end]), int(start[end]), end) if cost[end] <= most else None


class Block:
    """Q-gram index of some passages."""

    def __init__(self, passages: list[tuple[int, str]], rate: float = RATE):
        self.ids = [i for i, _ in passages]
        self.texts = [t for _, t in passages]
        self.codes = [codes(t) for t in self.texts]
        self.short = [k for k, c in enumerate(self.codes) if 0 < len(c) < Q]
        self.edits = np.array([budget(len(c), rate) if len(c) >= Q else 0 for c in self.codes], np.int64)
        size = np.array([len(c) for c in self.codes], np.int64)
        self.bound = size - Q + 1 - Q * self.edits
        self.reach = int(size.max(initial=0) + self.edits.max(initial=0)) + 1
        hashes = [grams(c) for c in self.codes]
        flat = np.concatenate([np.empty(0, np.uint64), *hashes])
        item = np.repeat(np.arange(len(passages)), [len(h) for h in hashes])
        place = np.concatenate([np.empty(0, np.int64), *[np.arange(len(h)) for h in hashes]])
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, self.first = np.unique(flat[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(flat)))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(passage number, edits, start, end) of the places in a normalised
        text, one per band that holds one."""
        out = []
        for k in self.short:
            at = text.find(self.texts[k])
            if at >= 0:
                out.append((k, 0, at, at + len(self.texts[k])))
        c = codes(text)
        h = grams(c)
        at = np.flatnonzero(self.filter[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return out
        key = np.searchsorted(self.keys, h[at])
        key[key == len(self.keys)] = 0
        same = self.keys[key] == h[at]
        at, key = at[same], key[same]
        if not len(at):
            return out
        # Every (text position, passage position) of a shared q-gram.
        n = self.count[key]
        row = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[key], n)
        item, diagonal = self.item[row], np.repeat(at, n) - self.place[row]
        width = 2 * (self.edits[item] + 1)
        seen: set[tuple[int, int, int]] = set()
        for shift in (0, 1):  # the two rows of half-overlapping bands
            band = (diagonal + shift * (width // 2)) // width
            pairs, shared = np.unique(np.stack([item, band], 1), axis=0, return_counts=True)
            for (k, b), s in zip(pairs.tolist(), shared.tolist(), strict=True):
                if s < self.bound[k]:
                    continue
                e = int(self.edits[k])
                w = 2 * (e + 1)
                low = max(0, b * w - shift * (w // 2) - e)
                high = b * w - shift * (w // 2) + w + len(self.codes[k]) + e
                region = text[low:high]
                exact = region.find(self.texts[k])
                hit = ((0, exact, exact + len(self.texts[k])) if exact >= 0
                       else align(self.codes[k], c[low:high], e))
                if hit and (k, low + hit[1], low + hit[2]) not in seen:
                    seen.add((k, low + hit[1], low + hit[2]))
                    out.append((k, hit[0], low + hit[1], low + hit[2]))
        return out


    def places(self, raw) -> Iterator[tuple[int, int, int, int]]:
        """(item, edits, start, end) of the places in a raw text, piece by
        piece."""
        whole = normalise(raw)
        for low in range(0, max(1, len(whole)), PIECE):
            for k, edits, start, end in self.find(whole[low:low + PIECE + self.reach]):
                yield self.ids[k], edits, low + start, low + end


def blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int | None, str]]]:
    """The passages, in blocks of about BLOCK_CHARS characters; one block is
    on the driver at a time."""
    rows = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
    held, size = [], 0
    for row in rows.toLocalIterator():
        passage = normalise(row["text"])
        if not passage:
            continue
        held.append((row["item"], passage))
        size += len(passage)
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def find(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
         item: str = "item_id", passage: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, edits, start, end): each place of a passage, once per
    document and passage at the least edits and then the first place; offsets
    are characters of the normalised text. Repeated doc_ids count as one."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, edits int, start long, `end` long"
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = spark.createDataFrame([], schema)
    for some in blocks(benchmark, item, passage):
        shared = spark.sparkContext.broadcast(some)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            block = Block(shared.value, rate)
            for batch in batches:
                out = [(key, *place) for key, raw in zip(batch["doc_id"], batch["text"], strict=True)
                       for place in block.places(raw)]
                if out:
                    key, item, edits, start, end = zip(*out, strict=True)
                    yield pd.DataFrame({"doc_id": key, "item_id": pd.array(item, "Int64"), "edits": edits,
                                        "start": start, "end": end})

        found = found.unionByName(narrow.mapInPandas(run, schema))
    best = F.min(F.struct("edits", "start", "end"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.edits", "b.start", "b.end")


def clean(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
          passage: str = "text", rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` in which no passage is found; all columns pass
    unchanged, whatever their names."""
    for some in blocks(benchmark, item, passage):
        shared = docs.sparkSession.sparkContext.broadcast(some)

        def verdicts(shared=shared):
            block = Block(shared.value, rate)
            return lambda texts: [next(block.places(t), None) is None for t in texts]

        docs = keep_rows(docs, text, verdicts)
    return docs
