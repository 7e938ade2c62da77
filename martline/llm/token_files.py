"""Token-id files of patched frame-of-reference blocks.

Ids are cut into blocks of 256. A block stores its minimum, the differences to
it packed at a width that holds a given share of them (90 % by default), and
an exception list of (position, high bits) for the larger ones. A block may
choose a larger width where that makes it smaller altogether. Blocks vary in
size, so a segment's index holds the byte at which each block starts: a range
of ids is read by unpacking its blocks alone.

A table of segments is the file format: each row holds some consecutive
documents (their ids, lengths and checks), the packed blocks and the block
index. It is written by Spark as Parquet, so it lies wherever Spark can write,
and a lost executor's half-written files never become part of it. Segments are
numbered by (part, seq); parts follow one another in document order, so the
ids before a segment are the sum over the earlier ones.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martline.llm.id_lists import IdLists, pieces, strings

BLOCK = 256
SHARE = 0.9
#: Ids of a segment, about; a longer document is a segment of its own.
SEGMENT_IDS = 1 << 18
#: Bytes of texts that are encoded together.
PIECE = 1 << 23

SCHEMA = ("part int, seq int, n_ids long, doc_ids array<long>, lengths array<long>, "
          "crcs array<long>, starts binary, blocks binary")
_ARROW_SCHEMA = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("crcs", pa.list_(pa.int64())), ("starts", pa.binary()),
    ("blocks", pa.binary())])
_HEAD = np.dtype([("low", "<u4"), ("count", "<u2"), ("width", "u1"), ("extra", "u1")])


def _bits(v: np.ndarray) -> np.ndarray:
    """Bit length of unsigned 32-bit values."""
    return np.frexp(v.astype(np.float64))[1].astype(np.int64)


def pack(ids: np.ndarray, share: float = SHARE) -> tuple[bytes, bytes]:
    """(blocks, index of block starts) of an array of ids below 2**32.

    A block is a head (minimum, number of exceptions, width), the packed low
    bits, then the exceptions: their positions, then their high bits.
    """
    n = len(ids)
    if n == 0:
        return b"", b""
    count = -(-n // BLOCK)
    values = np.full(count * BLOCK, ids[-1], np.uint32)  # the last one fills up
    values[:n] = ids
    values = values.reshape(count, BLOCK)
    low = values.min(axis=1)
    diff = values - low[:, None]
    # Of each block: how many differences need more than so many bits.
    widths = np.arange(33)
    need = _bits(diff) + np.arange(count)[:, None] * 33
    over = BLOCK - np.bincount(need.ravel(), minlength=count * 33).reshape(count, 33).cumsum(axis=1)
    # The percentile's width, or a wider one if exceptions cost more there.
    least = (over > (1 - share) * BLOCK).sum(axis=1)
    cost = widths * (BLOCK // 8) + over * 5
    cost[widths[None, :] < least[:, None]] = 1 << 40
    cost[over > 255] = 1 << 40
    width = cost.argmin(axis=1)
    extra = over[np.arange(count), width]
    starts = np.cumsum(_HEAD.itemsize + width * (BLOCK // 8) + extra * 5)
    out = np.empty(starts[-1], np.uint8)
    starts = np.concatenate(([0], starts[:-1]))
    heads = np.zeros(count, _HEAD)
    heads["low"], heads["count"], heads["width"], heads["extra"] = low, BLOCK, width, extra
    heads["count"][-1] = n - (count - 1) * BLOCK
    out[starts[:, None] + np.arange(_HEAD.itemsize)] = heads.view(np.uint8).reshape(count, -1)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        body = starts[rows] + _HEAD.itemsize
        raw = diff[rows].astype("<u4").view(np.uint8).reshape(len(rows), BLOCK, 4)
        bits = np.unpackbits(raw[:, :, :max(1, -(-int(w) // 8))], axis=2, bitorder="little")[:, :, :w]
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        out[body[:, None] + np.arange(packed.shape[1])] = packed
        high = diff[rows].astype(np.uint64) >> np.uint64(w)
        row, at = np.nonzero(high)
        after, many = body + int(w) * (BLOCK // 8), extra[rows]
        # A block's exceptions in a row: each one's place among them.
        place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        out[after[row] + place] = at
        out[(after[row] + many[row] + 4 * place)[:, None] + np.arange(4)] = (
            high[row, at].astype("<u4").view(np.uint8).reshape(-1, 4))
    return out.tobytes(), starts.astype("<u8").tobytes()


def unpack(blocks: bytes, index: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive; all by default): only the blocks
    that hold them are unpacked."""
    starts = np.frombuffer(index, "<u8").astype(np.int64)
    if len(starts) == 0:
        return np.empty(0, np.uint32)
    a = first // BLOCK
    b = len(starts) if last is None else min(len(starts), -(-last // BLOCK))
    if b <= a:
        return np.empty(0, np.uint32)
    data = np.frombuffer(blocks, np.uint8)
    starts = starts[a:b]
    heads = data[starts[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD).ravel()
    out = np.empty((b - a, BLOCK), np.uint32)
    for w in np.unique(heads["width"]):
        rows = np.flatnonzero(heads["width"] == w)
        size = int(w) * (BLOCK // 8)
        if size:
            body = data[starts[rows][:, None] + _HEAD.itemsize + np.arange(size)]
            # A value lies in the bytes from its first bit's on: five at most.
            body = np.concatenate((body, np.zeros((len(rows), 5), np.uint8)), axis=1)
            bit = np.arange(BLOCK) * int(w)
            value = np.zeros((len(rows), BLOCK), np.uint32 if w <= 17 else np.uint64)
            for k in range(3 if w <= 17 else 5):
                value |= body[:, (bit >> 3) + k].astype(value.dtype) << value.dtype.type(8 * k)
            out[rows] = (value >> (bit & 7).astype(value.dtype)) & value.dtype.type((1 << int(w)) - 1)
        else:
            out[rows] = 0
    for k in np.flatnonzero(heads["extra"]):
        e, w = int(heads["extra"][k]), int(heads["width"][k])
        at = int(starts[k]) + _HEAD.itemsize + w * (BLOCK // 8)
        high = data[at + e:at + 5 * e].copy().view("<u4")
        out[k, data[at:at + e]] |= high << np.uint32(w)
    out += heads["low"][:, None]
    flat = out.ravel()[:(b - a - 1) * BLOCK + int(heads["count"][-1])]
    return flat[first - a * BLOCK:None if last is None else last - a * BLOCK]


#: Normalizers and pre-tokenizers whose matches in plain words are known: what
#: a plain word holds, its letters in lower case, and the matches there.
_PLAIN_RULES = ({"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN = "^[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
_MATCH = f"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+)"


class _Words:
    """Ids of texts by the tokenizers library, word by word: white space
    always parts the pattern's matches and has no id, so a text's ids are
    those of its words in a row. Words met before come from a bounded cache;
    the others go to the library some hundreds at a time, and each id belongs
    to the word that its offset lies in.

    Where the tokenizer's rules are known, a word of ASCII and Latin-1 letters
    goes as its lower-case matches, which many words share, and these straight
    to the library's model: normalizer and pre-tokenizer would leave each as it
    is. Any other word (and every word under other rules) goes as it is.

    ``added``: the tokenizer's added tokens, such as <|endoftext|>, are matched
    in the raw text, inside words too, and part it, as the library does by
    default; without, they are text like other text."""

    LIMIT = 1_500_000
    AT_ONCE = 500

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # The words that reach the library hold no added token.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        #: The byte-level names of the letters beyond ASCII.
        name = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.names = {i: name(chr(i))[0][0] for i in range(0xc0, 0x100)}
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self.plain = (rules["normalizer"], rules["pre_tokenizer"]) == _PLAIN_RULES
        self.added: dict[str, int] = {}
        if added:
            tokens = self.tokenizer.get_added_tokens_decoder()
            if any(t.normalized or t.lstrip or t.rstrip or t.single_word or not t.special for t in tokens.values()):
                raise ValueError("added tokens must be special and match the raw text as they are")
            self.added = {t.content: i for i, t in tokens.items()}
            # A word's lower-case match must not be taken for an added token.
            self.plain = self.plain and not any(re.fullmatch(_MATCH, t) for t in self.added)
        # The library takes the leftmost, then the longest.
        self.parts = "(" + "|".join(
            re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")" if self.added else None
        self.known = IdLists(self.LIMIT)

    def _matches(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, how many each has) of lower-case matches of plain words."""
        ids, sizes, model = [], [], self.model.tokenize
        for word in words:
            found = model(word if word.isascii() else word.translate(self.names))
            sizes.append(len(found))
            ids += [token.id for token in found]
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def _others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, how many each has) of any words."""
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for i in range(0, len(words), self.AT_ONCE):
            part = words[i:i + self.AT_ONCE]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            starts = np.cumsum([0, *[n + 1 for n in map(len, part)]])
            at = np.array([x for x, _ in found.offsets], np.int64)
            sizes.append(np.diff(np.searchsorted(at, starts)))
            ids.append(np.array(found.ids, np.uint32))
        return np.concatenate(ids), np.concatenate(sizes)

    def _library(self, words: list[str]) -> None:
        """Add the library's ids of distinct unknown words."""
        match = np.zeros(len(words), bool)
        if self.plain:  # a word that isn't plain doesn't read like a match of one
            match = pc.match_substring_regex(pa.array(words, pa.string()), _PLAIN).to_numpy(zero_copy_only=False)
        names = np.array(words, object)
        ids, sizes = self._matches(names[match].tolist())
        more, many = self._others(names[~match].tolist())
        size = np.empty(len(words), np.int64)
        size[match], size[~match] = sizes, many
        both, of = np.empty(len(ids) + len(more), np.uint32), np.repeat(match, size)
        both[of], both[~of] = ids, more
        self.known.add(words, both, size)

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Add the ids of distinct unknown words; returns their numbers."""
        cut = words
        if self.plain:
            low = pc.utf8_lower(words)
            plain = pc.match_substring_regex(words, _PLAIN)
            apart = pc.and_not(plain, pc.utf8_is_alpha(words))
            cut = pc.replace_with_mask(pc.if_else(plain, low, words), apart, pc.ascii_rtrim_whitespace(
                pc.replace_substring_regex(low.filter(apart), _MATCH, "\\1 ")))
        lists = pc.ascii_split_whitespace(cut)
        matches = lists.flatten().dictionary_encode()
        distinct, numbers = self.known.find(matches.dictionary)
        unknown = np.flatnonzero(numbers < 0)
        numbers[unknown] = len(self.known) + np.arange(len(unknown))
        self._library([distinct[i] for i in unknown.tolist()])
        numbers = numbers[matches.indices.to_numpy()]
        starts = lists.offsets.to_numpy()
        out = numbers[starts[:-1]]  # right for a word that is its own match
        rest = pc.not_equal(cut, words)
        if pc.any(rest).as_py():
            ids, sizes = self.known.gather(numbers)
            mask = rest.to_numpy(zero_copy_only=False)
            sizes_of = np.diff(np.concatenate(([0], np.cumsum(sizes)))[starts])
            out[mask] = len(self.known) + np.arange(mask.sum())
            self.known.add(strings(words.filter(rest)), ids[np.repeat(mask, sizes_of)], sizes_of[mask])
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (null: none)."""
        texts = pc.fill_null(texts, "")
        if self.parts and pc.any(pc.match_substring_regex(texts, self.parts)).as_py():
            texts = pc.replace_substring_regex(texts, self.parts, " \\1 ")
        lists = pc.ascii_split_whitespace(texts)
        found = lists.flatten().dictionary_encode()
        self.known.trim(found.dictionary)
        for name, i in {"": None, **self.added}.items():
            if name not in self.known.index:
                ids = np.array([] if i is None else [i], np.uint32)
                self.known.add([name], ids, np.array([len(ids)]))
        before = len(self.known)
        _, numbers = self.known.find(found.dictionary)
        new = numbers < 0
        if new.any():
            numbers[new] = self._learn(found.dictionary.filter(pa.array(new)))
        ids, sizes = self.known.gather(numbers[found.indices.to_numpy()])
        self.known.forget_long(before)
        ends = np.concatenate(([0], np.cumsum(sizes)))[lists.offsets.to_numpy()].tolist()
        return [ids[x:y] for x, y in zip(ends, ends[1:])]


_tokenizers: dict[tuple[str, bool], _Words] = {}


def write(df: DataFrame, tokenizer_path: str, end_id: int, path: str, *, doc_id: str = "doc_id",
          text: str = "text", parts: int | None = None, added: bool = False) -> None:
    """Encode every text, append ``end_id`` to each, and write the ids as
    segments in ascending ``doc_id`` order (ties by text; null ids first).

    Null and empty texts are the end id alone; a text of any length is encoded
    whole, in a segment of its own if long. Equal doc_ids, even many, are
    dealt over parts by their text. ``added``: the tokenizer's added tokens in
    a text get their own ids, the library's default; else they are plain text.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (df.select(F.col(doc_id).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))
            .withColumn("tie", F.xxhash64("text"))
            .repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (tokenizer_path, added) not in _tokenizers:
            _tokenizers[tokenizer_path, added] = _Words(tokenizer_path, added)
        words = _tokenizers[tokenizer_path, added]
        part, seq, docs, ids, held = TaskContext.get().partitionId(), 0, [], [], 0

        def segment() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            blocks, starts = pack(flat)
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "n_ids": len(flat), "doc_ids": docs,
                "lengths": [len(x) for x in ids], "crcs": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                "starts": starts, "blocks": blocks}], _ARROW_SCHEMA)

        for batch in batches:
            for a, b in pieces(batch.column("text"), PIECE):
                keys = batch.column("doc_id").slice(a, b - a).to_pylist()
                for key, one in zip(keys, words.encode(batch.column("text").slice(a, b - a)), strict=True):
                    docs.append(key)
                    ids.append(np.append(one, np.uint32(end_id)))
                    held += len(one) + 1
                    if held >= SEGMENT_IDS:
                        yield segment()
                        seq, docs, ids, held = seq + 1, [], [], 0
        if docs:
            yield segment()

    rows.select("doc_id", "text").mapInArrow(run, SCHEMA).write.option(
        "compression", "none").parquet(path)


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(row, ids of each document, ids before each) of the segments' rows."""
    for batch in batches:
        for row in batch.itertuples():
            flat = unpack(row.blocks, row.starts)
            lengths = np.array(row.lengths, np.int64)
            if len(flat) != row.n_ids or lengths.sum() != row.n_ids:
                raise ValueError(f"segment {row.part}/{row.seq} is damaged")
            ends = np.cumsum(lengths)
            yield row, [flat[e - n:e] for e, n in zip(ends, lengths, strict=True)], ends - lengths


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document, read from the blocks: ``start``
    counts the ids of all documents before it."""
    segments = spark.read.schema(SCHEMA).parquet(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, ids, before in _documents(batches):
            yield pd.DataFrame({"part": row.part, "seq": row.seq, "doc_id": row.doc_ids,
                                "before": before, "ids": [x.astype(np.int64) for x in ids]})

    docs = segments.mapInPandas(run, "part int, seq int, doc_id long, before long, ids array<long>")
    return docs.join(bases(segments), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "ids")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the ids
    that the blocks hold; an id list that differs from what was written (by
    its check in the segment) fails the job."""
    segments = spark.read.schema(SCHEMA).parquet(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, ids, before in _documents(batches):
            crcs = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
            if crcs != [int(c) for c in row.crcs]:
                raise ValueError(f"segment {row.part}/{row.seq} is damaged")
            yield pd.DataFrame({"part": row.part, "seq": row.seq, "doc_id": row.doc_ids,
                                "before": before, "n_tokens": row.lengths, "ids_crc32": crcs})

    docs = segments.mapInPandas(
        run, "part int, seq int, doc_id long, before long, n_tokens long, ids_crc32 long")
    return docs.join(bases(segments), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def bases(segments: DataFrame) -> DataFrame:
    """(part, seq) -> ids before the segment: a running sum over the parts
    (a row each), then within each part."""
    narrow = segments.select("part", "seq", "n_ids")
    over = (narrow.groupBy("part").agg(F.sum("n_ids").alias("n"))
            .withColumn("part_base", F.coalesce(F.sum("n").over(
                Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (narrow.withColumn("inner", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)))
            .join(over, "part")
            .select("part", "seq", (F.col("part_base") + F.col("inner")).alias("base")))
