"""Packing of documents' tokens into sequences of a fixed capacity.

A linear grouping scheme over the pieces' lengths:

* A document longer than the capacity is cut into full pieces, behind one
  shorter first piece; every other document is one piece. Full pieces are
  sequences of their own.
* Large pieces (longer than a quarter of the capacity) are sorted by length into
  groups of equal cardinality, and each length is rounded up to its group's
  greatest. For these few sizes the configurations of a sequence are optimised
  by linear programming (``packing_plan.configurations``).
* The actual documents take the places of the rounded ones, by their rank in
  the group, which leaves a little more room in each sequence.
* Small pieces go by best fit, longest first, into the room that is left, then
  into new sequences.

The driver sees the number of pieces of each length and of sequences by room
left: ``capacity`` numbers each, whatever the corpus. Pieces find their place by
rank: the number in their part of the table, counted while encoding, plus the
number in earlier parts. No group of equal lengths meets in one task, and the
only exchange of pieces is by sequence.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.bpe import Encoder
from martline.llm.common import materialise
from martline.llm.packing_plan import best_fit, configurations, linear_groups

CAPACITY = 2048
#: Groups of equal cardinality, so sizes of the linear programme.
GROUPS = 256
#: Pieces up to this share of the capacity are small: 1 / SMALL.
SMALL = 4
#: Tokens of an output batch, about.
BATCH_TOKENS = 1 << 20

_PLACE = ("piece", "start", "length", "ids_crc32")
_OWN = ("_part", "_nth")


def _byte_symbols() -> dict[str, int]:
    """Bytes by the characters that byte-level vocabularies write them with:
    printable ones for themselves, the others, in order, from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


#: What the byte-level pre-tokenizer cuts texts by (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks equal to a tokenizer file's merges, where it is a plain byte-level
    BPE whose merges are numbered in order; else None."""
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = (spec["normalizer"] is None and spec["post_processor"] is None and pre.get("type") == "ByteLevel"
             and not pre.get("add_prefix_space") and pre.get("use_regex", True) and model.get("type") == "BPE"
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                "end_of_word_suffix", "byte_fallback", "ignore_merges"))
             and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))
    if not plain:
        return None
    vocab, symbols = model["vocab"], _byte_symbols()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocab[a + b] for a, b in merges]
    added = {t["content"] for t in spec["added_tokens"]}
    if order != sorted(set(order)) or len(order) + 256 != len(vocab.keys() - added):
        return None
    return {bytes(map(symbols.__getitem__, t)): i for t, i in vocab.items() if t not in added}


def encoder(file: str) -> Callable[[str], list[int]]:
    """Ids of a text as the tokenizers library gives them for a tokenizer file
    (its text) without special tokens around them. A plain byte-level BPE runs
    in tiktoken, which has the same result several times faster; a text that
    its matcher can't take (very long white space) goes to ``bpe.Encoder``."""
    spec = json.loads(file)
    ranks = _ranks(spec)
    if ranks is None:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(file)
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    import regex
    import tiktoken
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    slow = Encoder(ranks, PATTERN)
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all") if added else fast.encode_ordinary(text)
        except BaseException as e:  # the matcher's panic isn't an Exception
            if type(e).__name__ not in ("PanicException", "ValueError"):
                raise
        out: list[int] = []
        for k, part in enumerate(cut.split(text) if cut else [text]):
            out += [added[part]] if k % 2 else slow.encode(part)
        return out

    return encode


def pieces(df: DataFrame, tokenizer: str, end_id: int, text: str = "text", capacity: int = CAPACITY,
           keep_ids: bool = False) -> DataFrame:
    """A row for each piece of each text's ids and ``end_id``: the other
    columns of ``df``, piece (from 0), start, length, ids_crc32, ``ids`` if
    asked for, and the piece's part and number among the part's pieces of its
    length. A null text is empty: one piece that holds the end alone."""
    others = [c for c in df.columns if c != text]
    added = [*_PLACE, "ids", "sequence_id", "offset", *_OWN]
    if clash := set(others) & set(added):
        raise ValueError(f"columns of the input named like outputs: {sorted(clash)}")
    with open(tokenizer, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    fields = [T.StructField(c, T.IntegerType() if c in ("piece", "_part") else T.LongType()) for c in (*_PLACE, *_OWN)]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    kinds = [pa.int32() if c in ("piece", "_part") else pa.int64() for c in (*_PLACE, *_OWN)]

    def run(batches):
        encode, part, seen = encoder(shared.value), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            rows: list[tuple] = []
            of: list[int] = []
            held: list[np.ndarray] = []
            tokens = 0
            for i in range(len(texts)):
                ids = np.array([*encode(texts[i].as_py() or ""), end_id], "<u4")
                at = 0
                while at < len(ids):
                    end = at + ((len(ids) - at) % capacity or capacity)
                    own = ids[at:end]
                    rows.append((len(of) and of[-1] == i and rows[-1][0] + 1 or 0, at, end - at,
                                 zlib.crc32(own.tobytes()), part, int(seen[end - at])))
                    seen[end - at] += 1
                    of.append(i)
                    if keep_ids:
                        held.append(own)
                    at = end
                tokens += len(ids)
                if tokens >= BATCH_TOKENS or i + 1 == len(texts):
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    if keep_ids:
                        ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held).astype(np.int32))))
                    kept = batch.select(others).take(pa.array(of)) if others else None
                    yield pa.RecordBatch.from_arrays([*(kept.columns if others else ()), *columns],
                                                     names=[*others, *(f.name for f in fields)])
                    rows, of, held, tokens = [], [], [], 0

    return df.select(*others, text).mapInArrow(run, T.StructType([*(df.schema[c] for c in others), *fields]))


def _table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A plan's rows: their number depends on capacity and groups alone."""
    return spark.createDataFrame([tuple(map(int, r)) for r in rows], schema)


def _first_ranks(cells: DataFrame, key: str) -> DataFrame:
    """(part, key, n) with the number of rows of the key in earlier parts."""
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def place(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> DataFrame:
    """``cut`` (of ``pieces``, written) plus sequence_id and offset."""
    spark = cut.sparkSession
    least = capacity // small
    columns = [c for c in cut.columns if c not in _OWN]
    cells = materialise(cut.groupBy("_part", "length").agg(F.count("*").alias("n")), "packing-cells")
    counts = np.zeros(capacity + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        counts[r.length] = r.n
    full, counts[capacity] = int(counts[capacity]), 0
    ranked = cut.join(_first_ranks(cells, "length").drop("n"), ["_part", "length"]).withColumn(
        "_rank", F.col("_before") + F.col("_nth"))

    # Large pieces: groups, configurations, places by rank in the group.
    grouped = linear_groups(counts, least, groups)
    plan = configurations(np.array([g.size for g in grouped], np.int64),
                          np.array([g.last - g.first for g in grouped], np.int64), capacity)
    taken, slots, sequences = [0] * len(grouped), [], 0
    for config, times in plan:
        for g in np.flatnonzero(config).tolist():
            each = int(config[g])
            slots.append((g, taken[g], taken[g] + each * times, each, sequences))
            taken[g] += each * times
        sequences += times
    in_group, g, longer = [], 0, 0
    for length in np.flatnonzero(counts)[::-1].tolist():
        if length > least:
            if longer >= grouped[g].last:
                g += 1
            in_group.append((length, g, longer - grouped[g].first))
            longer += int(counts[length])
    large = (ranked.where((F.col("length") > least) & (F.col("length") < capacity))
             .join(F.broadcast(_table(spark, in_group, "length long, _group int, _skip long")), "length")
             .withColumn("_at", F.col("_rank") + F.col("_skip"))
             .join(F.broadcast(_table(spark, slots, "_group int, _lo long, _hi long, _each long, _first long")),
                   ["_group"]).where("_at >= _lo AND _at < _hi")
             .withColumn("sequence_id", F.expr("_first + (_at - _lo) div _each")))
    large = materialise(large.select(*columns, *_OWN, "sequence_id"), "packing-large")

    # Room left in each sequence, sequences ranked among those of equal room.
    rooms = large.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("_room"))
    rooms = materialise(rooms.withColumn("_part", F.spark_partition_id()), "packing-rooms")
    free = np.zeros(capacity + 1, np.int64)
    of_room = materialise(rooms.groupBy("_part", "_room").agg(F.count("*").alias("n")), "packing-cells")
    for r in of_room.groupBy("_room").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        free[r["_room"]] = r.n
    fills, opened = best_fit(counts, least, free, capacity)
    nth = F.row_number().over(Window.partitionBy("_part", "_room").orderBy("sequence_id")) - 1
    rooms = (rooms.withColumn("_nth", nth).join(_first_ranks(of_room, "_room").drop("n"), ["_part", "_room"])
             .select("_room", (F.col("_before") + F.col("_nth")).alias("_bin"), "sequence_id"))

    # Small pieces: into old sequences by room and rank, or into new ones.
    filled = (ranked.where(F.col("length") <= least)
              .join(F.broadcast(_table(spark, [(f.size, f.first, f.last, f.room, f.at, f.each) for f in fills],
                                       "length long, _lo long, _hi long, _room long, _first long, _each long")), "length")
              .where("_rank >= _lo AND _rank < _hi")
              .withColumn("_bin", F.expr("_first + (_rank - _lo) div _each")))
    keep = [*columns, *_OWN, "sequence_id"]
    old = filled.where(F.col("_room") < capacity).join(rooms, ["_room", "_bin"]).select(keep)
    new = filled.where(F.col("_room") == capacity).withColumn("sequence_id", F.col("_bin") + sequences).select(keep)
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *_OWN).rowsBetween(Window.unboundedPreceding, -1)
    shared = large.select(keep).unionByName(old).unionByName(new).withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    whole = ranked.where(F.col("length") == capacity).withColumn(
        "sequence_id", F.col("_rank") + sequences + opened).withColumn("offset", F.lit(0).cast("long"))
    return shared.unionByName(whole.select(*keep, "offset")).drop(*_OWN)


def pack(df: DataFrame, tokenizer: str, end_id: int, text: str = "text", capacity: int = CAPACITY,
         groups: int = GROUPS, small: int = SMALL, keep_ids: bool = False) -> DataFrame:
    """Every row's text packed: a row for each piece, with the other columns,
    piece, start, length, ids_crc32, sequence_id and offset (gapless from 0 in
    each sequence), and its ``ids`` if asked for.

    Null and empty texts are one piece, the end alone; repeated rows are packed
    each for itself, whatever their ids; an empty table gives no rows. Columns
    named like an output are refused."""
    cut = materialise(pieces(df, tokenizer, end_id, text, capacity, keep_ids), "packing-pieces")
    return place(cut, capacity, groups, small)


def sequences(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The sequences themselves, from pieces with ids: sequence_id, ids, and
    spans (key, piece, offset, length) in their order."""
    part = F.struct("offset", "length", "piece", F.col(key).alias("key"), "ids")
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"),
        F.transform("p", lambda x: F.struct(x["key"].alias(key), x["piece"].alias("piece"), x["offset"].alias("offset"),
                                            x["length"].alias("length"))).alias("spans"))
