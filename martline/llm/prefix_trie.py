"""Prefix trie of conversations as burst tries.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it. Turns are known by the first 128 bits of the
SHA-256 of their role and text, so a conversation is a short byte string, and
equal conversations are one string with a weight before anything else happens.

* The shards hold containers: all strings below one trie head, without the
  head's own turns. A container with more than ``cap`` turns is burst: its
  strings lose what all of them share (the longest common prefix, one turn at
  least below the root), and each next turn id heads a container of its own.
  The turns they shared are nodes of the trie head, written as one hub.
* Bursting goes on, a round of shuffles each, until every container is small.
  A chain of shared turns costs one round, whatever its length.
* The containers are dealt by head, sorted, and swept: a string's turns beyond
  the common prefix with the one before are new nodes.
* Each container's totals (leaves, saved tokens) are added to all hubs above it
  in one aggregation.

A conversation's turn ids are held in one row (16 bytes a turn); a group of
equal conversations, of any size, is counted by partial aggregation, and the
digest of its ids is taken over sorted stretches that many tasks write.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import materialise, partitions

#: Turns of a container, at most; more, and it bursts.
CAP = 1 << 18
#: Bytes of a turn's id.
WIDTH = 16
#: Ids of a stretch of members whose digest is taken at once.
STRETCH = 8192
EMPTY = hashlib.sha256(b"").hexdigest()

NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")


def _id(*values: Column) -> Column:
    """First 128 bits of the SHA-256 of binary values."""
    return F.unhex(F.substring(F.sha2(F.concat(*values), 256), 1, 2 * WIDTH))


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """A row for each conversation: conv_id, turns (array of id, size) by turn,
    nulls first, equal turns by their ids. Null role or text is empty; rows
    without a conv_id belong to no conversation and are left out."""
    role_, text_ = (F.coalesce(F.col(c), F.lit("")).cast("binary") for c in (role, text))
    # The role's length keeps ("ab", "c") and ("a", "bc") apart.
    head = F.concat(F.length(role_).cast("string"), F.lit(":")).cast("binary")
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        _id(head, role_, text_).alias("id"), F.length(text_).cast("long").alias("size"))
    return rows.groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "id", "size"))),
                    lambda x: F.struct(x["id"].alias("id"), x["size"].alias("size"))).alias("turns"))


def strings(convs: DataFrame) -> DataFrame:
    """(conv_id, seq: the turns' ids in one binary, sizes)."""
    joined = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""))
    return convs.select("conv_id", joined.alias("seq"), F.col("turns.size").alias("sizes"))


def _member_digests(members: DataFrame) -> DataFrame:
    """(key, ends) of (key, conv_id): SHA-256 of the ids by number, joined by
    commas. Stretches of each key's ids, sorted over many tasks, become text
    first; one pass over those, in order, takes the digest."""
    def stretches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            of = (f["key"] != f["key"].shift()).cumsum()
            nth = f.groupby(of).cumcount() // STRETCH
            groups = f.groupby([of, nth], sort=False)
            yield pd.DataFrame({
                "key": groups["key"].first().to_numpy(), "first": groups["conv_id"].min().to_numpy(),
                "ids": groups["conv_id"].agg(lambda ids: ",".join(map(str, ids))).to_numpy()})

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, done = None, None, []
        for f in frames:
            for k, ids in zip(f["key"], f["ids"], strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["key", "ends"])
            done = []
        if key is not None:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends"])

    n = partitions(members.sparkSession)
    cut = members.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInPandas(
        stretches, "key binary, first long, ids string")
    return cut.repartition(n, "key").sortWithinPartitions("key", "first").mapInPandas(
        digests, "key binary, ends string")


def _common(low: Column, high: Column) -> Column:
    """Turns that two strings, and all between them, share."""
    n = F.least(F.length(low), F.length(high)) / WIDTH
    at = lambda s, i: F.substring(s, i * WIDTH + 1, WIDTH)
    i = F.sequence(F.lit(0), n.cast("int"))
    # The first place that differs, or the shorter one's end.
    return F.array_min(F.filter(i, lambda k: (k == n.cast("int")) | (at(low, k) != at(high, k))))


def _burst(rows: DataFrame, cap: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(tables of the strings in small containers, tables of hubs)."""
    small, hubs = [], []
    while True:
        sizes = rows.groupBy("head").agg(
            F.sum(F.length("seq")).alias("_bytes"), F.min("seq").alias("_low"), F.max("seq").alias("_high"),
            F.sum("n").alias("hub_n"), F.min("conv_id").alias("hub_conv"), F.count("*").alias("_strings"))
        large = sizes.where((F.col("_bytes") > cap * WIDTH) & (F.col("_strings") > 1)).select(
            "head", "hub_n", "hub_conv", _common(F.col("_low"), F.col("_high")).alias("shared"))
        rows = materialise(rows.join(large, "head", "left"), "trie-round")
        small.append(rows.where("shared IS NULL").drop("hub_n", "hub_conv", "shared"))
        burst = rows.where("shared IS NOT NULL")
        if burst.isEmpty():
            return small, hubs
        hub = F.col("head")
        ended = F.length("seq") == F.col("shared") * WIDTH
        hubs.append(burst.groupBy(hub.alias("hub")).agg(
            F.first("above").alias("above"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
            F.first("hub_n").alias("n"), F.first("hub_conv").alias("conv_id"),
            F.slice(F.first("sizes"), F.lit(1), F.first("shared")).alias("sizes"),
            F.max(F.when(ended, F.col("ends"))).alias("ends")))
        rest = F.expr(f"substring(seq, shared * {WIDTH} + 1)")
        first = F.expr(f"substring(seq, shared * {WIDTH} + 1, {WIDTH})")
        rows = burst.where(~ended).select(
            _id(hub, first).alias("head"), F.concat("above", F.array(hub)).alias("above"),
            (F.col("depth") + F.col("shared")).alias("depth"), F.col("hub_conv").alias("parent"),
            rest.alias("seq"), F.expr("slice(sizes, shared + 1, size(sizes))").alias("sizes"),
            "conv_id", "n", "ends")


def _sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes of containers, given sorted by head and string."""
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               "ends_sha256", "above"]

    def nodes(held: list) -> Iterator[pd.DataFrame]:
        """The trie of one container's strings: parents before children."""
        _, above, base, parent_conv = held[0][:4]
        up, depth, size, n, conv, ends, path = [], [], [], [], [], [], []
        before = b""
        for _, _, _, _, seq, sizes, conv_id, weight, digest in held:
            shared = 0
            while shared < len(path) and seq[shared * WIDTH:(shared + 1) * WIDTH] == before[
                    shared * WIDTH:(shared + 1) * WIDTH]:
                shared += 1
            del path[shared:]
            for k in range(shared, len(sizes)):
                up.append(path[-1] if path else -1)
                path.append(len(depth))
                depth.append(base + k + 1)
                size.append(int(sizes[k]))
                n.append(0)
                conv.append(conv_id)
                ends.append(EMPTY)
            n[path[-1]], ends[path[-1]], before = weight, digest, seq
            conv[path[-1]] = min(conv[path[-1]], conv_id)
        total = len(depth)
        children, leaves, saved = [0] * total, [0] * total, [0] * total
        for i in range(total - 1, -1, -1):
            leaves[i] = leaves[i] or 1
            saved[i] += (n[i] - 1) * size[i]
            if (p := up[i]) >= 0:
                n[p] += n[i]
                conv[p] = min(conv[p], conv[i])
                children[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
        parents = [conv[p] if p >= 0 else parent_conv for p in up]
        tops = [list(above) if p < 0 else None for p in up]
        rows = list(zip(conv, depth, parents, n, children, leaves, saved, ends, tops, strict=True))
        for at in range(0, total, 1 << 16):
            yield pd.DataFrame(rows[at:at + (1 << 16)], columns=columns)

    held: list = []
    for f in frames:
        out = []
        for row in f.itertuples(index=False, name=None):
            if held and row[0] != held[0][0]:
                out.extend(nodes(held))
                held = []
            held.append(row)
        if out:
            yield pd.concat(out)
    if held:
        yield from nodes(held)


def trie(convs: DataFrame, cap: int = CAP) -> DataFrame:
    """Nodes of the prefix trie of ``convs`` (conv_id, seq, sizes, as from
    ``strings``; a conv_id once). Per node: conv_id (the smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. No conversations, no nodes; a turnless one ends at the root."""
    spark = convs.sparkSession
    keyed = materialise(convs.select(_id(F.col("seq")).alias("key"), "conv_id", "seq", "sizes"), "trie-strings")
    ends = _member_digests(keyed.select("key", "conv_id"))
    distinct = keyed.groupBy("key").agg(F.first("seq").alias("seq"), F.first("sizes").alias("sizes"),
                                        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    distinct = materialise(distinct.join(ends, "key").drop("key"), "trie-distinct")

    # The root is burst from the start; its children's heads are turn ids.
    root = distinct.agg(F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"),
                        F.max(F.when(F.length("seq") == 0, F.col("ends"))).alias("ends")).where("n IS NOT NULL")
    root = materialise(root, "trie-root")
    least = root.select(F.col("conv_id").alias("parent"))
    no_head = F.lit(b"").cast("binary")
    rows = distinct.where(F.length("seq") > 0).join(F.broadcast(least)).select(  # one row on that side
        F.expr(f"substring(seq, 1, {WIDTH})").alias("head"), F.array(no_head).alias("above"),
        F.lit(0).cast("long").alias("depth"), "parent", "seq", "sizes", "conv_id", "n", "ends")
    small, hubs = _burst(rows, cap)
    hubs.insert(0, root.select(
        no_head.alias("hub"), F.array().cast("array<binary>").alias("above"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent"), "n", "conv_id", F.array().cast("array<bigint>").alias("sizes"), "ends"))

    union = lambda tables: tables[0] if len(tables) == 1 else tables[0].unionByName(union(tables[1:]))
    containers = union(small).select("head", "above", "depth", "parent", "seq", "sizes", "conv_id", "n", "ends")
    swept = containers.repartition(partitions(spark), "head").sortWithinPartitions("head", "seq").mapInPandas(
        _sweep, NODES + ", above array<binary>")
    swept = materialise(swept, "trie-swept")

    hub = materialise(union(hubs), "trie-hubs")
    own = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, s: a + s) * (F.col("n") - 1)
    parts = swept.where("above IS NOT NULL").select("above", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    parts = parts.unionByName(hub.select("above", F.lit(0).cast("long").alias("leaves"), own.alias("saved")))
    parts = parts.select(F.posexplode("above").alias("_at", "hub"), "leaves", "saved",
                         (F.size("above") - 1).alias("_last"))
    below = parts.groupBy("hub").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
                                     F.count(F.when(F.col("_at") == F.col("_last"), 1)).alias("children"))
    hub = hub.join(below, "hub", "left").select(
        "depth", "parent", "n", "conv_id", "sizes", F.coalesce("ends", F.lit(EMPTY)).alias("ends"),
        F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
        F.coalesce("children", F.lit(0)).alias("children"))
    # A hub's nodes: one for each shared turn, or the root.
    chain = hub.withColumn("i", F.explode(F.when(F.size("sizes") == 0, F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(1), F.size("sizes")))))
    last = F.col("i") == F.size("sizes")
    rest = F.aggregate(F.expr("slice(sizes, greatest(i, 1), size(sizes))"), F.lit(0).cast("long"), lambda a, s: a + s)
    chain = chain.select(
        "conv_id", (F.col("depth") + F.col("i")).alias("depth"),
        F.when(F.col("i") <= 1, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") + rest * (F.col("n") - 1)).alias("saved_tokens"),
        F.when(last, F.col("ends")).otherwise(F.lit(EMPTY)).alias("ends_sha256"))
    return swept.drop("above").unionByName(chain)


def with_borrowed_starts(convs: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Conversations (conv_id, turns) whose first h turns are those of the
    conversation ``conv_id - conv_id % family`` (all if it has fewer, none if
    it is absent), h being crc32 of the decimal conv_id modulo ``most``."""
    base = F.col("conv_id") - F.col("conv_id") % family
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = F.when(F.col("conv_id") == F.col("_base"), F.expr(f"slice(turns, 1, {most - 1})"))
    start = F.first(own, ignorenulls=True).over(Window.partitionBy("_base"))  # a family's rows at most
    return (convs.withColumn("_base", base).withColumn("_start", start).withColumn("_h", h)
            .select("conv_id", F.concat(
                F.coalesce(F.expr("slice(_start, 1, _h)"), F.expr("slice(turns, 1, 0)")),
                F.expr("slice(turns, _h + 1, size(turns))")).alias("turns")))
