"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that can end its
encoding. ``PrefixTable`` stores that token per prefix: the token t ending at
byte i is the one whose predecessor (the stored token of the prefix before t)
and t stay apart when their bytes are merged together. Encoding walks back
through the table. Appending bytes only adds entries, and taking bytes away
only drops some, so a change re-uses the table up to the first changed byte.

A text is cut by the tokenizer's pattern first and each match is encoded on
its own; ``Document`` keeps the matches, appends text and re-encodes around an
edit, until the matches fall on old boundaries again.

``encode`` / ``decode`` run this over a DataFrame: Spark deals the documents
out, the workers encode them; words met before come from a bounded cache.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from martline.llm.common import kept
from martline.llm.id_lists import IdLists, pieces, strings

#: Entries of a worker's caches (white space with what follows it, matches of
#: the pattern, token pairs); a full cache starts anew, that of the strings
#: and matches with those of the texts at hand.
CACHE_RUNS = 300_000
CACHE_WORDS = 300_000
CACHE_PAIRS = 300_000
CACHED_CHARS = 64
#: Last bytes by which the tokens that can end somewhere are looked up.
SUFFIX = 4
#: Bytes of texts that are encoded together.
PIECE = 1 << 20

# A text is cut where white space follows other characters: the pattern's
# matches never reach across, so these runs are cut and cached first.
# The characters with the White_Space property.
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PAIR = f"[{_SPACES}][{_SPACES}]"
_EDGE = f"([^{_SPACES}])([{_SPACES}])"


class Vocabulary:
    """Ranks of a byte-level BPE, and which token pairs can stand together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        sizes: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) >= SUFFIX:
                sizes.setdefault(token[-SUFFIX:], set()).add(len(token))
        #: Sizes that a shorter token may have.
        self.short = tuple(range(SUFFIX - 1, 0, -1))
        #: Sizes of the tokens that end in given SUFFIX bytes, the largest first.
        self.ends = {end: (*sorted(found, reverse=True), *self.short) for end, found in sizes.items()}
        self.pairs: dict[int, bool] = {}
        self._single: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        self._table: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        #: Whether all bytes rank before all merges.
        self.bytes_first = (max(i for b, i in ranks.items() if len(b) == 1)
                            < min((i for b, i in ranks.items() if len(b) > 1), default=1 << 40))

    def merge(self, data: bytes, upto: int = 1) -> list[int]:
        """Encoding by merging the lowest-ranked neighbours, again and again,
        until ``upto`` are left; used on the few bytes of a token."""
        rank, none = self.ranks.get, 1 << 40
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = [rank(data[i:i + 2], none) for i in range(len(data) - 1)]
        while len(ranks) >= upto:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]  # the pairs on either side are other ones now
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], none)
        return [self.ranks[p] for p in parts]

    def reachable(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        ok = self._single.get(token)
        if ok is None:
            ok = self._single[token] = self.merge(self.tokens[token]) == [token]
        return ok

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes in a row, and by id where each begins and its size
        (0: no token has the id)."""
        if self._table is None:
            size = np.zeros(max(self.tokens) + 1, np.int64)
            for token, data in self.tokens.items():
                size[token] = len(data)
            data = b"".join(self.tokens[i] for i in np.flatnonzero(size).tolist())
            self._table = np.frombuffer(data, np.uint8), np.cumsum(size) - size, size
        return self._table

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens of the last merge that gives a reachable token; a
        single byte is both of its halves."""
        both = self._halves.get(token)
        if both is None:
            data = self.tokens[token]
            both = self._halves[token] = (token, token) if len(data) == 1 else tuple(self.merge(data, 2))
        return both

    def _apart(self, left: int, right: int) -> bool:
        """Undoes the merges of both, the last ones first, and looks at each
        time whether the neighbours at the border merge before what is undone."""
        rank, tokens, halves, limit = self.ranks.get, self.tokens, self.halves, 1 << 40
        while True:
            if rank(tokens[left] + tokens[right], limit) < limit:
                return False
            # Equal ranks merge from the left on.
            for side in ("left", "right") if left > right else ("right", "left"):
                if side == "left":
                    part = halves(left)[1]
                    if part != left:
                        left, limit = part, left
                        break
                else:
                    part = halves(right)[0]
                    if part != right:
                        right, limit = part, right + 1
                        break
            else:
                return True

    def apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two tokens."""
        key = left << 32 | right
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            if self.bytes_first:
                ok = self.reachable(left) and self.reachable(right) and self._apart(left, right)
            else:
                ok = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
            self.pairs[key] = ok
        return ok


class PrefixTable:
    """The last token of the encoding of each prefix of ``data``."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        v, last = self.vocabulary, self.last
        rank, known, ends, short, start = v.ranks.get, v.pairs.get, v.ends.get, v.short, len(self.data)
        self.data = data = self.data + more
        for end in range(start + 1, len(data) + 1):
            # No token of another size ends here.
            for size in ends(data[end - SUFFIX:end], short) if end >= SUFFIX else short:
                begin = end - size
                if begin < 0:
                    continue
                token = rank(data[begin:end])
                if token is None:
                    continue
                if begin:
                    ok = known(last[begin] << 32 | token)
                    if ok is None:
                        ok = v.apart(last[begin], token)
                else:
                    ok = v.reachable(token)
                if ok:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte of the data")

    def truncate(self, size: int) -> None:
        self.data = self.data[:size]
        del self.last[size + 1:]

    def replace(self, begin: int, end: int, new: bytes) -> None:
        """Replace a range of bytes; the table before it is kept."""
        tail = self.data[end:]
        self.truncate(begin)
        self.append(new + tail)

    def become(self, data: bytes) -> None:
        """Change to ``data``, keeping the table of the common prefix."""
        size = 0
        for x, y in zip(self.data, data):
            if x != y:
                break
            size += 1
        self.truncate(size)
        self.append(data[size:])

    def tokens(self) -> list[int]:
        out, at, sizes = [], len(self.data), self.vocabulary.tokens
        while at:
            out.append(self.last[at])
            at -= len(sizes[self.last[at]])
        return out[::-1]


class Encoder:
    """Encodes texts; one per worker process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern)
        self.table = PrefixTable(self.vocabulary)
        #: Ids of runs and of matches.
        self._runs = IdLists(CACHE_RUNS, CACHED_CHARS)
        self._words = IdLists(CACHE_WORDS, CACHED_CHARS)

    def _new_words(self, words: list[str]) -> list[list[int]]:
        """Ids of matches. A whole word of the vocabulary is its own token;
        the others are encoded in order, so that neighbours share a prefix."""
        out, ranks, table = [[]] * len(words), self.vocabulary.ranks, self.table
        for data, i in sorted((w.encode(), i) for i, w in enumerate(words)):
            whole = ranks.get(data)
            if whole is None:
                table.become(data)
                out[i] = table.tokens()
            else:
                out[i] = [whole]
        if len(table.data) > 1 << 16:
            table.truncate(0)
        return out

    def _new_runs(self, runs: pa.Array) -> np.ndarray:
        """Add the ids of distinct unknown runs; returns their numbers."""
        names, held = strings(runs), self._words
        cut = list(map(self.pattern.findall, names))
        matches = pa.array(list(chain.from_iterable(cut)), pa.string()).dictionary_encode()
        held.trim(matches.dictionary)
        before = len(held)
        words, numbers = held.find(matches.dictionary)
        new = np.flatnonzero(numbers < 0)
        numbers[new] = before + np.arange(len(new))
        fresh = [words[i] for i in new.tolist()]
        lists = self._new_words(fresh)
        held.add(fresh, np.fromiter(chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64))
        ids, sizes = held.gather(numbers[matches.indices.to_numpy()])
        held.forget_long(before)
        starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, cut), np.int64))))
        sizes = np.diff(np.concatenate(([0], np.cumsum(sizes)))[starts])
        before = len(self._runs)
        self._runs.add(names, ids, sizes)
        return before + np.arange(len(names))

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin and the last
        one's end); a null is an empty text."""
        texts, mark = pc.fill_null(texts, ""), "\x01"
        while pc.any(pc.match_substring(texts, mark)).as_py():
            mark += "\x02"
        # Single spaces are marked at once; next to more white space only an
        # edge is one.
        pairs = pc.match_substring_regex(texts, _PAIR)
        marked = pc.replace_with_mask(
            pc.replace_substring(texts, " ", f"{mark} "), pairs,
            pc.replace_substring_regex(texts.filter(pairs), _EDGE, f"\\1{mark}\\2"))
        lists = pc.split_pattern(marked, mark)
        runs = lists.flatten().dictionary_encode()
        self._runs.trim(runs.dictionary)
        before = len(self._runs)
        _, numbers = self._runs.find(runs.dictionary)
        new = numbers < 0
        if new.any():
            numbers[new] = self._new_runs(runs.dictionary.filter(pa.array(new)))
        ids, sizes = self._runs.gather(numbers[runs.indices.to_numpy()])
        self._runs.forget_long(before)
        return ids.view(np.int32), np.concatenate(([0], np.cumsum(sizes)))[lists.offsets.to_numpy()]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as an array."""
        ids, ends = self.encode_column(pa.array(texts, pa.string()))
        return [ids[x:y] for x, y in zip(ends.tolist(), ends[1:].tolist())]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def word(self, word: str) -> list[int]:
        """Ids of one match of the pattern."""
        return self._new_words([word])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids (null: null), all gathered at once."""
        data, begin, size = self.vocabulary.table()
        ids = lists.flatten().to_numpy(zero_copy_only=True)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(size) or not size[ids].all()):
            raise KeyError("an id outside the vocabulary")
        sizes = size[ids]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(ends[-1]) + np.repeat(begin[ids] - ends[:-1], sizes)
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        offsets = ends[np.concatenate(([0], np.cumsum(counts)))].astype(np.int32)
        valid = None if lists.null_count == 0 else pc.is_valid(lists).cast(pa.uint8()).to_numpy()
        bits = None if valid is None else pa.py_buffer(np.packbits(valid, bitorder="little"))
        return pa.Array.from_buffers(pa.binary(), len(lists), [bits, pa.py_buffer(offsets), pa.py_buffer(data[at])])


class Document:
    """A text with the ids of its matches, for appends and edits."""

    #: Matches before a change that may come out otherwise: the pattern's
    #: contractions look at up to three characters from their start.
    BACK = 3

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text, self.starts, self.ids = encoder, "", [], []
        self.splice(0, 0, text)

    def append(self, more: str) -> None:
        self.splice(len(self.text), len(self.text), more)

    def splice(self, begin: int, end: int, new: str) -> int:
        """Replace a range of characters; returns how many matches were
        encoded again."""
        old, shift = self.text, len(new) - (end - begin)
        self.text = text = old[:begin] + new + old[end:]
        first = max(0, int(np.searchsorted(self.starts, begin, "right")) - self.BACK)
        at = self.starts[first] if first < len(self.starts) else 0
        if not self.starts:
            at = 0
        # Old matches wholly behind the edit, by their new start.
        behind = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        starts, ids, rest = [], [], len(self.starts)
        for m in self.encoder.pattern.finditer(text, at):
            k = behind.get(m.start())
            if k is not None and m.start() >= begin + len(new):
                rest = k
                break
            starts.append(m.start())
            ids.append(self.encoder.word(m.group()))
        self.starts = self.starts[:first] + starts + [s + shift for s in self.starts[rest:]]
        self.ids = self.ids[:first] + ids + self.ids[rest:]
        return len(starts)

    def all_ids(self) -> list[int]:
        return [i for word in self.ids for i in word]


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _encoder(ranks: bytes, pattern: str) -> Encoder:
    """The worker's encoder for the broadcast rank file."""
    encoders = kept("bpe")
    key = hashlib.sha256(ranks).hexdigest() + pattern
    if key not in encoders:
        encoders[key] = Encoder({base64.b64decode(a): int(b) for a, b in map(
            bytes.split, ranks.splitlines())}, pattern)
    return encoders[key]


def _shared(df: DataFrame, ranks_path: str):
    """The rank file (under 1 MB for a 50k vocabulary) for the workers."""
    with open(ranks_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _replace(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [c for c in batch.schema.names if c != name]
    return pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [values], [*names, name])


def _schema(df: DataFrame, drop: str, add: str) -> str:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in (drop, add.split()[0])]
    return ", ".join([*kept, add])


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text",
           ids: str = "ids") -> DataFrame:
    """``df`` with the text column replaced by ``ids`` (array<int>).

    Null and empty texts give an empty array; texts of any length are encoded
    whole; other columns pass through (one already named ``ids`` is replaced).
    """
    shared = _shared(df, ranks_path)
    keep = [c for c in df.columns if c not in (text, ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for batch in batches:
            for a, b in pieces(batch.column(text), PIECE):
                part = batch.slice(a, b - a)
                found, ends = encoder.encode_column(part.column(text))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found))
                yield pa.RecordBatch.from_arrays([*part.select(keep).columns, lists], [*keep, ids])

    return df.select(*keep, text).mapInArrow(run, _schema(df, text, f"{ids} array<int>"))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` plus ``out`` (binary): the bytes of the ids. A null array gives
    null; an id outside the vocabulary fails the job."""
    shared = _shared(df, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _encoder(shared.value, "").decode_lists
        for batch in batches:
            step = max(1, batch.num_rows * PIECE // max(1, 2 * batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                yield _replace(part, out, decode(part.column(ids)))

    return df.mapInArrow(run, _schema(df, out, f"{out} binary"))
