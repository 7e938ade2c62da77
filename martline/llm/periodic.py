"""Runs (maximal repetitions) of words in texts.

A run is a stretch of consecutive words with smallest period q, at least
``max(min_length, 2 q)`` long, that no neighbouring word extends with that
period. They are found by internal pattern matching:

* Texts of a batch form one sequence of word numbers, each text followed by a
  number of its own, so nothing repeats across texts. Prefix doubling names the
  factor of 2**k words at each place by the start of its interval in the suffix
  array; two factors are equal when their names are. Descending through the
  levels gives longest common extensions to the right and to the left.
* A run of period q holds an aligned block of 2**k words in its first period,
  with ``2**(k+1) - 1 <= q < 2**(k+2) - 1``, and the same block q words on.
  So for each dyadic block its occurrences in that neighbouring window are
  queried: the block's interval of the suffix array, stored as a wavelet tree
  (a matrix of bits), is asked for the next larger position (range successor).
  With 12 words or more, blocks of two words serve for periods 1 and 2 as well.
* Two occurrences less than half a block apart begin an arithmetic progression,
  the block's places in a run of that smaller period, whose end is found by one
  extension query. If the block itself lies in that run, the progression's
  distances are multiples of the smaller period and give nothing new; if not,
  each is a candidate period. A block gets at most 2**(k+1) candidates, so
  there are n log n at worst, whatever the text.
* A candidate is extended both ways; the least period of each stretch stays.

Everything is done with arrays over a batch of texts, in one task's memory:
about 16 bytes a word and level. A long text is a batch of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import let, words

MIN_LENGTH = 12
#: Words of a batch, about; a longer text is a batch of its own.
BATCH_WORDS = 1 << 16

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class Factors:
    """Names of the factors of 2**k words of a sequence, its suffix array, and
    the array's wavelet matrix. The last number must occur once."""

    def __init__(self, seq: np.ndarray):
        n = self.n = len(seq)
        order = np.argsort(seq, kind="stable").astype(np.int32)
        name = np.empty(n, np.int32)
        at = seq[order]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        name[order] = np.repeat(first, np.diff(np.append(first, n))).astype(np.int32)
        self.names = [name]
        # Only what shares its name with another place is sorted further.
        size = np.bincount(name, minlength=n)
        open_ = np.flatnonzero(size[name] > 1)
        step = 1
        while len(open_):
            after = np.minimum(open_ + step, n - 1)
            key = name[open_].astype(np.int64) * (n + 1) + np.where(open_ + step < n, name[after] + 1, 0)
            by = np.argsort(key)
            places, key = open_[by], key[by]
            head = np.concatenate(([True], key[1:] != key[:-1]))
            old = name[places]
            # A place's new name: its group's, plus the places before it there.
            begin = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
            rank = np.arange(len(places)) - np.repeat(begin, np.diff(np.append(begin, len(places))))
            heads = np.flatnonzero(head)
            new = np.repeat((old + rank)[heads], np.diff(np.append(heads, len(places)))).astype(np.int32)
            name = name.copy()
            name[places] = new
            self.names.append(name)
            size = np.bincount(new, minlength=n)
            open_ = np.sort(places[size[new] > 1])
            step *= 2
        suffixes = np.empty(n, np.int32)
        suffixes[name] = np.arange(n, dtype=np.int32)
        self._matrix(suffixes)

    def _matrix(self, values: np.ndarray) -> None:
        """Zeros before each place, by bit from the highest on; values are
        dealt to zeros first, then ones, before the next bit."""
        self.zeros: list[np.ndarray] = []
        for bit in range(max(1, int(self.n - 1).bit_length()) - 1, -1, -1):
            zero = (values >> bit & 1) == 0
            count = np.zeros(self.n + 1, np.int32)
            np.cumsum(zero, out=count[1:])
            self.zeros.append(count)
            values = np.concatenate((values[zero], values[~zero]))

    def interval(self, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the suffix array that starts with the factors there."""
        if k >= len(self.names):
            low = self.names[-1][places]
            return low, low + 1
        if not hasattr(self, "_sizes"):
            self._sizes = {}
        if k not in self._sizes:
            self._sizes[k] = np.bincount(self.names[k], minlength=self.n).astype(np.int32)
        low = self.names[k][places]
        return low, low + self._sizes[k][low]

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Least position >= ``least`` in each interval of the suffix array, or
        n where there is none."""
        top = len(self.zeros)
        a, b, below = low.astype(np.int32), high.astype(np.int32), np.zeros(len(low), np.int32)
        for i, zeros in enumerate(self.zeros):
            za, zb, all_zeros = zeros[a], zeros[b], zeros[-1]
            one = (least >> (top - 1 - i) & 1).astype(bool)
            below += np.where(one, zb - za, 0)
            a = np.where(one, a - za + all_zeros, za)
            b = np.where(one, b - zb + all_zeros, zb)
        out = np.full(len(low), self.n, np.int64)
        have = np.flatnonzero((below < high - low) & (least < self.n))
        if len(have):
            a, b, kth = low[have].astype(np.int32), high[have].astype(np.int32), below[have]
            value = np.zeros(len(have), np.int64)
            for zeros in self.zeros:
                za, zb, all_zeros = zeros[a], zeros[b], zeros[-1]
                one = kth >= zb - za
                kth = np.where(one, kth - (zb - za), kth)
                value = value << 1 | one
                a = np.where(one, a - za + all_zeros, za)
                b = np.where(one, b - zb + all_zeros, zb)
            out[have] = value
        return out

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from places i < j on."""
        i, j, start, last = i.copy(), j.copy(), i, self.n - 1
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            same = name[np.minimum(i, last)] == name[np.minimum(j, last)]
            same &= j < self.n
            i += same << k
            j += same << k
        return i - start

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words that end before places i < j."""
        i, j, start = i.copy(), j.copy(), i
        for k in range(len(self.names) - 1, -1, -1):
            name, step = self.names[k], 1 << k
            same = i >= step
            same &= name[np.maximum(i - step, 0)] == name[np.maximum(j - step, 0)]
            i -= same << k
            j -= same << k
        return start - i


def _candidates(f: Factors, k: int, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the blocks of 2**k words and their occurrences."""
    size = 1 << k
    p = np.arange(0, f.n - size, size)
    low, high = f.interval(p, k)
    many = high - low > 1
    p, low, high = p[many], low[many], high[many]
    least, last = p + (1 if small else 2 * size - 1), np.minimum(p + 4 * size - 2, f.n - 1)
    places, periods = [], []
    while len(p):
        found = f.successor(low, high, least)
        go = np.flatnonzero(found <= last)
        p, low, high, last, found = p[go], low[go], high[go], last[go], found[go]
        if not len(p):
            break
        after = f.successor(low, high, found + 1)
        delta = after - found
        apart = delta > size // 2
        places.append(p[apart])
        periods.append(found[apart] - p[apart])
        least = np.where(apart, after, 0)
        run = np.flatnonzero(~apart)
        if len(run):
            x, d, own = found[run], delta[run], p[run]
            end = x + d + f.right(x, x + d)
            begin = x - f.left(x, x + d)
            least[run] = end - size + 1
            if small:  # no smaller blocks have tried the run's own period
                places.append(own[begin <= own])
                periods.append((x - own)[begin <= own])
            other = np.flatnonzero(begin > own)
            count = (np.minimum(last[run], end - size)[other] - x[other]) // d[other] + 1
            which = np.repeat(other, count)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            places.append(own[which])
            periods.append(x[which] + nth * d[which] - own[which])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *periods])


def find(seq: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of numbers whose
    last one occurs once, by start, then period. ``min_length`` is 5 or more."""
    if min_length < 5:
        raise ValueError("min_length must be 5 or more")  # blocks of two words
    out = np.empty((0, 3), np.int64)
    if len(seq) < min_length:
        return out
    f = Factors(seq)
    for k in range(1, len(f.names)):
        p, q = _candidates(f, k, k == 1)
        if not len(p):
            continue
        before, after = f.left(p, p + q), f.right(p, p + q)
        length = before + q + after
        good = length >= np.maximum(2 * q, min_length)
        if good.any():
            rows = np.stack((p - before, length, q), axis=1)[good]
            out = np.concatenate((out, np.unique(rows, axis=0)))
    # Of a stretch's periods the least; others are its multiples.
    out = out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:, :2] != out[:-1, :2]).any(axis=1)
    out = out[new]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _batch(texts: list[list[bytes]], min_length: int) -> list[tuple[np.ndarray, bytes]]:
    """Of each list of words: its runs, and the words outside their repeats."""
    number: dict[bytes, int] = {}
    seq: list[int] = []
    starts = np.zeros(len(texts) + 1, np.int64)
    many = sum(map(len, texts)) + 1
    for k, text in enumerate(texts):
        seq.extend([number.setdefault(w, len(number)) for w in text])
        seq.append(many + k)  # ends the text
        starts[k + 1] = len(seq)
    runs = find(np.array(seq, np.int64), min_length)
    drop = np.zeros(len(seq) + 1, np.int32)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(drop) == 0
    of = np.searchsorted(starts, runs[:, 0], "right") - 1
    runs[:, 0] -= starts[of]
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for k, text in enumerate(texts):
        own = runs[bounds[k]:bounds[k + 1]]
        if len(own):
            text = [text[i] for i in np.flatnonzero(keep[starts[k]:starts[k + 1] - 1])]
        out.append((own, b" ".join(text)))
    return out


def detect(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed",
           min_length: int = MIN_LENGTH, batch_words: int = BATCH_WORDS) -> DataFrame:
    """``df`` without its text, plus ``runs`` (array of start, length, period in
    words, by start, then period) and ``collapsed`` (the words that no run holds
    after its first period, joined by one space).

    Words are what lies between space and U+0009 to U+000D. Rows are taken one
    by one, so repeated rows and ids give the same rows again; a null or blank
    text has no runs and an empty ``collapsed``; an empty table gives no rows.
    Other columns pass unchanged; one named like an output is refused."""
    others = [c for c in df.columns if c != text]
    if clash := {runs, collapsed} & set(others):
        raise ValueError(f"columns of the input named like outputs: {sorted(clash)}")
    schema = T.StructType([df.schema[c] for c in others] + [
        T.StructField(runs, RUNS), T.StructField(collapsed, T.StringType())])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def columns(parts):
        sizes = [len(r) for r, _ in parts]
        flat = np.concatenate([r for r, _ in parts]) if parts else np.empty((0, 3), np.int64)
        struct = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(kind.value_type))
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
        return (pa.ListArray.from_arrays(offsets, struct).cast(kind),
                pa.array([t for _, t in parts], pa.binary()).cast(pa.string()))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            begin, held, total = 0, [], 0
            for i in range(len(texts)):
                held.append((texts[i].as_py() or "").encode().split())
                total += len(held[-1]) + 1
                if total >= batch_words or i + 1 == len(texts):
                    found = columns(_batch(held, min_length))
                    part = batch.slice(begin, i + 1 - begin)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(part.schema.get_field_index(c)) for c in others), *found],
                        names=[*others, runs, collapsed])
                    begin, held, total = i + 1, [], 0

    return df.select(*others, text).mapInArrow(run, schema)


def periodic_tail(text: Column, start, period) -> Column:
    """``text`` with word i >= a replaced by word a + (i - a) % p, words joined
    by one space; a = ``start(n)`` and p = ``period(n, a)`` of n words. Texts
    without words stay as they are."""
    def rebuilt(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = start(n)
        p = period(n, a)
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + (i - a) % p).cast("int")))
        return F.when(n == 0, text).otherwise(F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " "))

    return let(words(text), rebuilt)
