"""Exact Jaccard self-join on word n-grams by token-combination prefixes.

A text's tokens are its distinct shingles of so many words (four by default, up
to six), as 64-bit hashes. All
tokens have one order: rare ones first, then by how many sets hold them, then
by hash. Two sets of sizes n <= m link at the threshold t when they share at
least t / (1 + t) (n + m) tokens, which is at least 2 t / (1 + t) n and t m. So
they share one token of the first n - ceil(2 t / (1 + t) n) + 1 of the smaller
(its short prefix) and the first m - ceil(t m) + 1 of the larger (its long
prefix), and two tokens when both prefixes are one longer. So

* rare tokens of the longer prefixes are indexed singly,
* tokens of a frequent class are indexed as pairs of tokens of one set: a link
  whose shared prefix tokens are all frequent shares two of them,
* a set with more than ``MANY`` frequent tokens in its prefix would have too
  many pairs: it indexes them singly in an index of its own, which the other
  sets look up with theirs.

An entry knows its ``room``: how many tokens its set can share with another if
the key's tokens are the first that both share. Two sets meet at a key only if
both rooms hold the overlap that their sizes ask for, so a link is met at its
first shared tokens, and others at few keys. Every link shares an index key,
whatever the classes, which come from counts of all texts but only steer the
amount of work. Sets that meet are verified whole.

Work is saved where groups are large. Equal sets are one class, found by a
128-bit hash. Verification runs in rounds: first every set of a key meets only
the key's leader, and what links falls into one component; a second round
takes another leader; at last each two sets of a key that are still in
different components meet. Components are those of all links, as pairs inside
a component change nothing.

Data that grows moves through Spark's shuffles only. What is broadcast is the
dictionary of frequent tokens, of ``DICTIONARY`` entries at most (beyond, only
tokens of more sets are in it, and the others count as rare), and up to
``BROADCAST_IDS`` ids of the documents to verify, beyond which they are joined.

Edges: null, empty and wordless texts have the empty set and link with
nothing; texts of fewer words than a shingle has are one; equal texts link; very
long texts are taken whole; null or repeated doc_ids are replaced by row
numbers within, so every row is a document of its own; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import batch_rows, discard, kept, materialise, release
from martline.llm.components import connected

WORDS = 4
PERCENT = 85
#: A token of more sets than 2**FREQUENT is of a frequent class.
FREQUENT = 5
DICTIONARY = 4_000_000
MANY = 12
ROUNDS = 2
#: Ids (8 bytes each) that may be broadcast instead of shuffling the texts.
BROADCAST_IDS = 2_000_000
#: Pairs of one document that are verified together.
GROUP = 256
#: Bytes hashed at a time, tokens held before they are written.
PIECE = 1 << 18
FLUSH = 1 << 19
#: Rows, of texts or sets, that go to Python at a time.
BATCH_ROWS = 1000

_TABLE = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_A = np.random.default_rng(5).integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TABLE[_SPACE] = 0
_powers = np.ones(1, np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words before each text and in all)."""
    global _powers
    parts = [(t if isinstance(t, str) else "").encode("utf-8", "surrogatepass").lower() for t in texts]
    joined = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    space = _SPACE[joined]
    begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    text_ends = 1 + np.cumsum([len(p) + 1 for p in parts])
    ends = np.concatenate(([0], np.searchsorted(begin, text_ends)))
    if not len(begin):
        return np.empty(0, np.uint64), ends
    longest = int((end - begin).max())
    if longest > len(_powers):
        _powers = np.full(longest * 2, _BASE, np.uint64)
        _powers[0] = 1
        _powers = np.cumprod(_powers, dtype=np.uint64)
    # Place of each byte in its word; the text starts with a space.
    place = np.zeros(len(joined), np.int64)
    place[begin[0]:] = np.arange(begin[0], len(joined)) - np.repeat(
        begin, np.diff(np.append(begin, len(joined))))
    # The white space after a word counts nothing; cut its place off.
    np.minimum(place, longest - 1, out=place)
    sums = np.add.reduceat(_TABLE[joined] * _powers[place], begin)
    return _mix(sums + (end - begin).astype(np.uint64) * _A[7]), ends


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    if not 1 <= words <= 6:
        raise ValueError("a shingle has one to six words")
    h, ends = _word_hashes(texts)
    if len(h) >= words:
        grams = np.zeros(len(h) - words + 1, np.uint64)
        for k in range(words):
            grams += h[k:len(h) - words + 1 + k] * _A[k]
        grams = _mix(grams)
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a:b - words + 1]))
        elif b > a:
            whole = np.append(h[a:b] * _A[:b - a], _A[6] >> np.uint64(b - a))
            out.append(_mix(whole.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _pieces(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """(ids, sets) of about PIECE bytes of texts at a time."""
    kept("ngrams")
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(ids):
            upto = min(len(ids), 1 + int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE)))
            yield (ids.slice(at, upto - at).to_pylist(),
                   shingle_sets(texts.slice(at, upto - at).to_pylist(), words))
            at = upto


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _cut(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of sorted hashes with equal top bits."""
    buckets = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
    for a, b in zip(starts, np.append(starts[1:], len(keys)), strict=True):
        yield int(buckets[a]), int(a), int(b)


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits after the bucket's: enough to index by."""
    return ((keys >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")


def _three_bytes(keys: np.ndarray, bits: int) -> bytes:
    """The 24 bits after the bucket's: enough to count by, as counts only set
    the order of the tokens."""
    return (_short(keys, bits) >> np.uint32(8)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _from_three(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return out.view("<u4").ravel()


def _packed(ids: np.ndarray) -> bytes:
    """Ids in four bytes each where they fit, else in eight."""
    small = len(ids) == 0 or (ids.min() >= 0 and ids.max() < 1 << 32)
    return ids.astype("<u4" if small else "<i8").tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u4" if len(data) == 4 * n else "<i8").astype(np.int64)


def _survey(docs: DataFrame, bits: int, words: int) -> DataFrame:
    """Rows of (bucket, tokens, more, counts): a bucket's tokens of some
    thousand sets, each once, with the counts above one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def flush():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            rows = []
            for bucket, a, b in _cut(keys, bits):
                more = np.flatnonzero(counts[a:b] > 1)
                rows.append((bucket, _three_bytes(keys[a:b], bits), more.astype("<u4").tobytes(),
                             counts[a:b][more].astype("<u4").tobytes()))
            bucket, *data = zip(*rows, strict=True)
            return _batch(bucket=pa.array(bucket, pa.int64()), **{
                c: pa.array(x, pa.binary()) for c, x in zip(("tokens", "more", "counts"), data, strict=True)})

        for _, sets in _pieces(batches, words):
            for s in sets:
                c = _digest(s)
                if len(s) and c not in seen:
                    seen.add(c)
                    held.append(s)
                    size += len(s)
                if size >= FLUSH:
                    yield flush()
                    held, size, seen = [], 0, set()
        if held:
            yield flush()

    return docs.mapInArrow(run, "bucket long, tokens binary, more binary, counts binary")


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _sizes(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, c1, c2): size and 128-bit hash of every document's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _pieces(batches, words):
            c1, c2 = zip(*map(_digest, sets), strict=True)
            yield _batch(**{c: pa.array(x, pa.int64()) for c, x in (
                ("doc_id", ids), ("n", list(map(len, sets))), ("c1", c1), ("c2", c2))})

    return docs.mapInArrow(run, "doc_id long, n long, c1 long, c2 long")


def _frequent(survey: DataFrame) -> DataFrame:
    """Tokens of three sets or more by bucket, with the level (the logarithm
    of the count) of each, and how many there are of each level."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        tokens, counts = [], []
        for row in frame.itertuples():
            t = _from_three(row.tokens)
            c = np.ones(len(t), np.int64)
            c[np.frombuffer(row.more, "<u4")] = np.frombuffer(row.counts, "<u4")
            tokens.append(t)
            counts.append(c)
        t, c = np.concatenate(tokens), np.concatenate(counts)
        order = np.argsort(t, kind="stable")
        t, c = t[order], c[order]
        first = np.flatnonzero(np.diff(t.astype(np.int64), prepend=-1))
        total = np.add.reduceat(c, first)
        keep = total > 2
        level = np.floor(np.log2(total[keep])).astype(np.uint8)
        return pd.DataFrame({"bucket": [frame["bucket"].iloc[0]], "tokens": [t[first][keep].tobytes()],
                             "levels": [level.tobytes()],
                             "sizes": [np.bincount(level, minlength=64).tolist()]})

    return survey.groupBy("bucket").applyInPandas(run, "bucket long, tokens binary, levels binary, sizes array<long>")


class Dictionary:
    """Levels of the frequent tokens, by bucket and the 24 bits behind."""

    def __init__(self, bits: int, keys: np.ndarray, levels: np.ndarray):
        self.bits, self.keys, self.levels = bits, keys, levels

    def level(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(tokens), np.uint8)
        short = tokens >> np.uint64(40 - self.bits)
        at = np.searchsorted(self.keys, short)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == short, self.levels[at], 0).astype(np.uint8)


def _dictionary(frequent: DataFrame, bits: int, most: int = DICTIONARY) -> Dictionary:
    """At most ``most`` tokens, the most frequent: the least level is set
    from the counts by level, then only the tokens from it on are fetched."""
    sizes = frequent.select(F.posexplode("sizes").alias("level", "n")).groupBy("level").agg(
        F.sum("n").alias("n")).collect()  # 64 rows
    total, least = 0, 64
    for level, n in sorted(((r["level"], r["n"]) for r in sizes), reverse=True):
        if total + n > most:
            break
        total, least = total + n, level

    def only(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                levels = np.frombuffer(row.levels, np.uint8)
                keep = levels >= least
                if keep.any():
                    yield pd.DataFrame({"bucket": [row.bucket], "levels": [levels[keep].tobytes()],
                                        "tokens": [np.frombuffer(row.tokens, "<u4")[keep].tobytes()]})

    rows = sorted(frequent.select("bucket", "tokens", "levels").mapInPandas(
        only, "bucket long, tokens binary, levels binary").collect(), key=lambda r: r["bucket"])
    keys = [np.frombuffer(r["tokens"], "<u4").astype(np.uint64) + (np.uint64(r["bucket"]) << np.uint64(24))
            for r in rows]
    levels = [np.frombuffer(r["levels"], np.uint8) for r in rows]
    return Dictionary(bits, np.concatenate([np.empty(0, np.uint64), *keys]),
                      np.concatenate([np.empty(0, np.uint8), *levels]))


def prefix_keys(s: np.ndarray, level: np.ndarray, percent: int = PERCENT, frequent_level: int = FREQUENT,
                many: int = MANY):
    """Index entries of a set: ((rare tokens, place), (keys of the frequent
    ones, place, role)); the room at a key is the set's size less its place;
    role 1: an entry that others find, 0: a look-up of
    entries only."""
    n = len(s)
    none = (np.empty(0, np.uint64), np.empty(0, np.int64))
    if n == 0 or 100 * n < percent * (n + 1):
        return none, (*none, np.empty(0, np.int64))  # only an equal set can link
    long = n + 1 + (-percent * n) // 100
    order = np.lexsort((s, level))[:long + 1]  # the long prefix and one more
    ext, frequent, place = s[order], level[order] > frequent_level, np.arange(len(order))
    first = ~frequent & (place < long)
    rare = (ext[first], place[first])
    heavy, at = ext[frequent], place[frequent]
    inside = at < long
    if not inside.any():
        # No link can have a frequent token as its first shared one.
        return rare, (*none, np.empty(0, np.int64))
    single, near = _mix(heavy[inside] ^ _A[4]), at[inside]
    if len(heavy) > many:
        return rare, (single, near, np.ones(len(single), np.int64))
    i, j = np.triu_indices(len(heavy), 1)
    low, high = np.minimum(heavy[i], heavy[j]), np.maximum(heavy[i], heavy[j])
    return rare, (np.concatenate([_mix(low * _A[0] + high * _A[1]), single]),
                  np.concatenate([at[j] - 1, near]), np.repeat([1, 0], [len(i), len(single)]))


def _index(docs: DataFrame, frequent: Dictionary, words: int, *options: int) -> DataFrame:
    """A second pass. Rows of kind 0: an index key of a frequent class (role 1)
    or a look-up (role 0); of kind 1: a bucket's rare tokens and their ids."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent.bits, frequent.keys, frequent.levels))

    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()),
                        ("role", pa.int32()), ("bucket", pa.int64()), ("tokens", pa.binary()),
                        ("ids", pa.binary()), ("places", pa.binary())])

    def filled(kind: int, n: int, **columns) -> pa.RecordBatch:
        """Rows of a kind; null in the other kind's columns."""
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n, kind), f.type) if f.name == "kind" else
            pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
            for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = Dictionary(*shared.value)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            k, o, f = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(k, kind="stable")
            k, o, f = k[order], o[order], f[order]
            rows = [(bucket, _short(k[a:b], d.bits).tobytes(), _packed(o[a:b]),
                     _packed(f[a:b]) if f.max() >= 1 << 16 else f[a:b].astype("<u2").tobytes())
                    for bucket, a, b in _cut(k, d.bits)]
            return filled(1, len(rows), **dict(zip(
                ("bucket", "tokens", "ids", "places"), map(list, zip(*rows, strict=True)), strict=True)))

        for ids, sets in _pieces(batches, words):
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            levels, at, more = d.level(flat), 0, []
            for i, s in zip(ids, sets, strict=True):
                (rare, space), (keys, place, role) = prefix_keys(s, levels[at:at + len(s)], *options)
                at += len(s)
                if len(rare):
                    held.append((rare, np.full(len(rare), i, np.int64), space))
                    size += len(rare)
                if len(keys):
                    more.append((keys.view(np.int64), np.full(len(keys), i, np.int64), place, role))
            if more:
                key, doc, place, role = (np.concatenate(x) for x in zip(*more, strict=True))
                yield filled(0, len(key), key=key, doc_id=doc, place=place, role=role)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(
        run, "kind int, key long, doc_id long, place long, role int, bucket long, "
             "tokens binary, ids binary, places binary")


def _shared_tokens(index: DataFrame) -> DataFrame:
    """(key, doc_id, place, role) of the rare tokens that two documents have."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        t = np.concatenate([np.frombuffer(b, "<u4") for b in frame["tokens"]])
        sizes = [len(b) // 4 for b in frame["tokens"]]
        i = np.concatenate([_unpacked(b, n) for b, n in zip(frame["ids"], sizes, strict=True)])
        r = np.concatenate([np.frombuffer(b, f"<u{len(b) // n}") for b, n in zip(
            frame["places"], sizes, strict=True)])
        order = np.argsort(t, kind="stable")
        t, i, r = t[order], i[order], r[order].astype(np.int64)
        same = t[1:] == t[:-1]
        keep = np.concatenate((same, [False])) | np.concatenate(([False], same))
        key = t[keep].astype(np.uint64) + (np.uint64(frame["bucket"].iloc[0]) << np.uint64(32))
        return pd.DataFrame({"key": _mix(key + _A[5]).view(np.int64), "doc_id": i[keep],
                             "place": r[keep], "role": 1})

    return index.where("kind = 1").select("bucket", "tokens", "ids", "places").groupBy("bucket").applyInPandas(
        run, "key long, doc_id long, place long, role int")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, total) of the pairs: sizes of intersection and union.
    Of a pair, the one with fewer pairs travels with it; the pairs of the other
    meet its set there, in one group for each and salt, with ``GROUP`` pairs or
    so, so no group is large and a leader's set is sent once for many pairs."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("pairs"))
    of = lambda c: ends.select(F.col("doc_id").alias(c), F.col("pairs").alias(f"{c}_pairs"))
    more = F.col("a_pairs") >= F.col("b_pairs")
    turned = pairs.join(of("a"), "a").join(of("b"), "b").select(
        F.when(more, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(more, F.col("b")).otherwise(F.col("a")).alias("b"),
        F.greatest("a_pairs", "b_pairs").alias("pairs"))
    spread = F.ceil(F.col("pairs") / GROUP)
    carried = (turned.withColumn("salt", F.pmod(F.xxhash64("b"), spread).cast("int")).drop("pairs")
               .join(sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("of_b")), "b"))
    own = (carried.select("a", "salt").distinct()
           .join(sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("of_a")), "a"))
    met = (carried.select("a", "b", "salt", "of_b", F.lit(None).cast("binary").alias("of_a"))
           .unionByName(own.select("a", F.lit(None).cast("long").alias("b"), "salt",
                                   F.lit(None).cast("binary").alias("of_b"), "of_a")))
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(n, "a", "salt").sortWithinPartitions("a", "salt", F.col("of_a").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = None
        for batch in batches:
            out, of_a, of_b = [], batch.column("of_a"), batch.column("of_b")
            for k, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                if of_a[k].is_valid:
                    mine = np.frombuffer(of_a[k].as_py(), "<u8")
                    continue
                other = np.frombuffer(of_b[k].as_buffer(), "<u8")
                at = np.searchsorted(mine, other)
                at[at == len(mine)] = 0
                common = int((mine[at] == other).sum())
                out.append((min(a, b), max(a, b), common, len(mine) + len(other) - common))
            if out:
                yield _batch(**{c: pa.array(x, pa.int64()) for c, x in zip(
                    ("a", "b", "common", "total"), zip(*out, strict=True), strict=True)})

    return met.mapInArrow(run, "a long, b long, common long, total long")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _pieces(batches, words):
            yield _batch(doc_id=pa.array(ids, pa.int64()),
                         tokens=pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()))

    return docs.mapInArrow(run, "doc_id long, tokens binary")


def classes(rows: DataFrame) -> DataFrame:
    """(doc_id, n, rep) of every document, from ``_sizes``: rep is the least
    doc_id with the same set; a document with the empty set represents itself."""
    reps = rows.where("n > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"))
    return (rows.join(reps, ["c1", "c2"], "left")
            .select("doc_id", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep")))


def links(docs: DataFrame, members: DataFrame, bits: int,
          percent: int = PERCENT, frequent_level: int = FREQUENT, many: int = MANY,
          dictionary: int = DICTIONARY, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(links found, component labels) between class representatives. Links
    inside a component beyond those that join it are not all listed."""
    # Texts are hashed again for each use; what is counted is not written.
    counted = materialise(_frequent(_survey(docs, bits, words)), "ngram-frequent")
    frequent = _dictionary(counted, bits, dictionary)
    discard(counted)
    index = materialise(_index(docs, frequent, words, percent, frequent_level, many), "ngram-index")
    # Copies give the entries of their representative.
    entries = (index.where("kind = 0").select("key", "doc_id", "place", "role")
               .unionByName(_shared_tokens(index)).join(members, "doc_id")
               .groupBy("key", F.col("rep").alias("doc_id"), "n")
               .agg((F.col("n") - F.min("place")).alias("room"), F.max("role").alias("role"))
               .withColumn("short", F.expr(f"room * (100 + {percent}) >= {2 * percent} * n")))
    entries = every = materialise(entries, "ngram-entries")
    discard(index)
    shared = entries.groupBy("key").agg(
        F.count("*").alias("c"), F.max("role").alias("r"), F.max("short").alias("s")).where(
        "c > 1 AND r = 1 AND s").select("key")
    entries = materialise(entries.join(shared, "key"), "ngram-shared")
    discard(every)
    wanted = materialise(entries.select("doc_id").distinct(), "ngram-wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)  # saves a shuffle of the texts
    sets = materialise(_sets(docs.join(wanted, "doc_id", "left_semi"), words), "ngram-sets")
    spark = docs.sparkSession
    close = F.expr(f"""role_a + role_b > 0 AND 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)
        AND least(room_a, room_b) * (100 + {percent}) >= {percent} * (n_a + n_b)""")
    found, labels, seen = None, None, None
    for rnd in range(ROUNDS + 1):
        e = entries.withColumn("label", F.col("doc_id")) if labels is None else (
            entries.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .withColumn("label", F.coalesce("label", "doc_id")))
        # The leader: of the entries with an index role and a short prefix the
        # one with the most room, then, in the second round, one by hash. A key
        # within one component has nothing left to join.
        size = F.expr("n - room") if rnd == 0 else F.xxhash64(F.lit(rnd), "label")
        mixed = e.groupBy("key").agg(
            F.min("label").alias("l0"), F.max("label").alias("l1"),
            F.min(F.when((F.col("role") == 1) & F.col("short"), F.struct(
                size.alias("size"), F.xxhash64("doc_id").alias("h"), F.col("doc_id").alias("b"),
                F.col("n").alias("n_b"), F.col("room").alias("room_b"), F.col("role").alias("role_b"),
                F.col("label").alias("label_b")))).alias("x")
        ).where("l0 < l1").select("key", "x.*").drop("size", "h")
        side = e.select("key", *[F.col(c).alias(f"{c}_a") for c in ("n", "room", "role", "label")],
                        F.col("doc_id").alias("a"))
        if rnd == ROUNDS:
            open_ = materialise(side.join(mixed.select("key"), "key"), "ngram-open")
            side = open_
            mixed = open_.withColumnsRenamed({c: c[:-1] + "b" for c in open_.columns if c != "key"})
        both = side.join(mixed, "key").where((F.col("label_a") != F.col("label_b")) & close)
        if rnd == ROUNDS:
            both = both.where("a < b")
        pairs = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if seen is not None:
            pairs = pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti")
        checked = materialise(_verify(pairs, sets), f"ngram-checked-{rnd}")
        release(spark)
        seen = checked if seen is None else seen.unionByName(checked)
        new = checked.where(f"100 * common >= {percent} * total")
        found = new if found is None else found.unionByName(new)
        if labels is None or not new.isEmpty():
            labels = connected(found.select("a", "b"))
            release(spark)
    return found, labels


def _members(docs: DataFrame, percent: int, words: int = WORDS, **classes_of_tokens: int) -> DataFrame:
    """(doc_id, n, rep, label) of documents with unique ids."""
    bits = min(24, max(6, math.ceil(math.log2(docs.count() / 2000 + 1))))
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        members = materialise(classes(materialise(_sizes(docs, words), "ngram-sizes")), "ngram-classes")
        _, labels = links(docs, members, bits, percent, words=words, **classes_of_tokens)
    return members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "label", F.coalesce("label", "rep"))


def _numbered(df: DataFrame, doc_id: str) -> DataFrame | None:
    """None if the ids are unique and not null; else ``df``, written once with
    a row number ``_row`` to stand in for them."""
    sizes = df.agg(F.count("*"), F.count_distinct(doc_id)).first()
    if sizes[0] == sizes[1]:
        return None
    return materialise(df.withColumn("_row", F.monotonically_increasing_id()), "ngram-numbered")


def join(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT,
         words: int = WORDS, **classes_of_tokens: int) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every row, by shingles
    of ``words`` words and a Jaccard of ``percent`` or more: equal sets share a
    class, and linked classes a component; both are named by the least doc_id
    (null where no row has one). ``classes_of_tokens``: frequent_level, many
    and dictionary, which change the work and not the result."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = _numbered(docs, "doc_id")
    if rows is None:
        return _members(docs, percent, words, **classes_of_tokens).select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"),
            F.col("label").alias("component_id"))
    found = materialise(
        _members(rows.select(F.col("_row").alias("doc_id"), "text"), percent, words, **classes_of_tokens)
        .withColumnRenamed("doc_id", "_row").join(rows.select("_row", "doc_id"), "_row"), "ngram-rows")
    name = lambda c, out: found.groupBy(c).agg(F.min("doc_id").alias(out))
    return (found.join(name("rep", "class_id"), "rep").join(name("label", "component_id"), "label")
            .select("doc_id", F.col("n").alias("n_shingles"), "class_id", "component_id"))


def representatives(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The rows of ``df`` that stand for their component: the one of the least
    doc_id, or of the first row where ids are null or repeated. All columns
    pass unchanged."""
    rows = _numbered(df, doc_id)
    if rows is None:
        kept = _members(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), percent, words)
        kept = kept.where("doc_id = label").select(F.col("doc_id").alias("_kept"))
        return df.join(kept, df[doc_id].cast("long") == kept["_kept"], "left_semi")
    kept = _members(rows.select(F.col("_row").alias("doc_id"), F.col(text).alias("text")), percent, words)
    kept = kept.where("doc_id = label").select(F.col("doc_id").alias("_kept"))
    return rows.join(kept, rows["_row"] == kept["_kept"], "left_semi").drop("_row")
