"""Uniform shuffle into shards of exact sizes by a hypergeometric
communication matrix.

The rows lie in P source parts of known sizes n_i; the S shards have sizes
s_j = N // S or N // S + 1. A uniform permutation of all rows sends a random
number of part i's rows to shard j, and these counts follow the multivariate
hypergeometric law. So the counts are drawn first (a P x S matrix whose row
sums are the n_i and whose column sums are the s_j, exactly), then

1. each part is permuted locally and cut by its matrix row,
2. every piece goes to its shard,
3. every shard is permuted again, which fixes the slots.

The parts are the input's partitions: a part is sorted by random numbers where
it lies and written, its rows numbered in that order, so equal rows, and a third
of all rows being one row, spread like any others, and a retried task sees the
same numbers. Whole rows then move once, to their shards. The second
permutation works on sub-ranges of the random sort key, so a shard never has to
fit one task. The matrix is all that the driver holds, ``MAX_ENTRIES`` numbers
at most: beyond, partitions are read together as larger parts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import materialise

#: Rows of a shard's sub-range that one task sorts, about.
PART_ROWS = 1_000_000
MAX_ENTRIES = 50_000_000


def draw_matrix(sizes: list[int], shards: int, seed: int = 0) -> np.ndarray:
    """Random matrix of row sums ``sizes`` and column sums at most one apart,
    distributed as the piece sizes of a uniform permutation."""
    total = int(sum(sizes))
    left = np.array([total // shards + (j < total % shards) for j in range(shards)], np.int64)
    rng = np.random.default_rng(seed)
    out = np.zeros((len(sizes), shards), np.int64)
    for i, n in enumerate(sizes):
        # Column by column: of the rows still free, how many of part i's.
        need, free = int(n), int(left.sum())
        for j in range(shards):
            if need == 0:
                break
            free -= int(left[j])
            out[i, j] = need if free == 0 else _hypergeometric(rng, int(left[j]), free, need)
            need -= int(out[i, j])
        left -= out[i]
    return out


#: numpy draws from urns of fewer balls of each kind than this.
NUMPY_URN = 1_000_000_000


def _hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    """Number of good balls among ``draws`` without replacement. Urns too large
    for numpy are drawn from by inversion: the probabilities from the mode
    outwards, each by its ratio to the next, as far as they are not below
    1e-30 of it, added up and looked up with one uniform number."""
    if max(good, bad) < NUMPY_URN:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    spread = (draws * (good / (good + bad)) * (bad / (good + bad))) ** 0.5
    reach = int(12 * spread) + 200  # beyond, less than 1e-30 in all
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    up = np.log(good - k[:-1]) + np.log(draws - k[:-1]) - np.log(k[1:]) - np.log(bad - draws + k[1:])
    logs = np.concatenate(([0.0], np.cumsum(up)))
    p = np.exp(logs - logs.max())
    total = np.cumsum(p)
    return int(k[np.searchsorted(total, rng.random() * total[-1], "right")])


def shuffle_shards(df: DataFrame, shards: int, seed: int = 7, *,
                   part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` plus ``shard`` (int, 0 to ``shards`` - 1) and ``slot`` (long,
    gapless from 0 in each shard). Shard sizes differ by one row at most.

    Rows move whole, nulls and repeated rows included; an empty table gives an
    empty result. Columns of ``df`` named like the working columns
    (``_shard_*``), ``shard`` or ``slot`` are refused. For one layout of the
    input the result is the same each time.
    """
    taken = [c for c in df.columns if c.lower() in ("shard", "slot") or c.startswith("_shard_")]
    if taken:
        raise ValueError(f"rename these columns first: {taken}")
    spark = df.sparkSession
    parts = df.rdd.getNumPartitions()
    if parts * shards > MAX_ENTRIES:
        df = df.coalesce(max(1, MAX_ENTRIES // shards))
    # Permuted where they lie; the row number is (part, place), 33 bits each way.
    rows = materialise(df.withColumn("_shard_random", F.rand(seed)).sortWithinPartitions("_shard_random")
                       .drop("_shard_random").withColumn("_shard_row", F.monotonically_increasing_id()), "shard-rows")
    part, place = F.shiftright("_shard_row", 33), F.col("_shard_row").bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.withColumn("_shard_part", part)
    counts = rows.groupBy("_shard_part").count().orderBy("_shard_part").collect()  # a row for each part
    total = sum(r["count"] for r in counts)
    if total == 0:
        return rows.drop("_shard_row", "_shard_part").select(
            "*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    key = lambda k: F.xxhash64(F.lit(seed * 2 + k), F.col("_shard_row"))
    matrix = draw_matrix([r["count"] for r in counts], shards, seed)
    ends = spark.createDataFrame(
        [(r["_shard_part"], [int(x) for x in row]) for r, row in zip(counts, matrix.cumsum(axis=1), strict=True)],
        "_shard_part long, _shard_ends array<bigint>")
    cut = (rows.join(F.broadcast(ends), "_shard_part")  # MAX_ENTRIES numbers at most
           .withColumn("shard", F.size(F.filter("_shard_ends", lambda e: e <= place)))
           .drop("_shard_part", "_shard_ends"))
    # Second permutation: the sort key's leading bits are a sub-range.
    ranges = max(1, -(-total // (shards * part_rows)))
    step = -(-(1 << 32) // ranges)
    cut = cut.withColumn("_shard_key", key(1)).withColumn(
        "_shard_range", F.floor((F.shiftrightunsigned("_shard_key", 32)) / F.lit(step)).cast("int"))
    if ranges > 1:
        cut = materialise(cut, "shard-cut")
    inner = Window.partitionBy("shard", "_shard_range").orderBy(
        F.shiftrightunsigned("_shard_key", 1), "_shard_row")
    out = cut.withColumn("slot", (F.row_number().over(inner) - 1).cast("long"))
    if ranges > 1:
        before = (cut.groupBy("shard", "_shard_range").count()
                  .withColumn("_shard_base", F.coalesce(F.sum("count").over(
                      Window.partitionBy("shard").orderBy("_shard_range")
                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                  .drop("count"))
        out = (out.join(before, ["shard", "_shard_range"])
               .withColumn("slot", F.col("slot") + F.col("_shard_base")))
    return out.select(*df.columns, "shard", "slot")
