"""Declarative data-quality checks.

A check is ``(name, kind, expression)`` with expected result 0:
* ``count_if``: rows where a predicate holds;
* ``duplicate_keys``: keys of a column list that occur more than once.

``run`` evaluates every check of one table in one scan, for any number of key
sets: a single set groups the rows by its key (map-side combined) and sums the
groups' predicate counts; several sets are one expansion (grouping sets), each
row once for each set and once for the predicates, combined before anything is
exchanged. Output: ``(check, result, expected, passed)``. ``enforce`` raises
listing every failed check.

The same groups, with a digest in place of the key, are a mergeable state
(``grouped``, ``merged``): ``quality_state`` keeps it for each load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Check = tuple[str, str, object]


def count_if(name: str, pred: Column) -> Check:
    return (name, "count_if", pred)


def duplicate_keys(name: str, cols: list[str]) -> Check:
    return (name, "duplicate_keys", cols)


# The checks run on the two fact tables.
def fact_sales_checks() -> list[Check]:
    return [
        count_if("null_customer_key_count", F.col("customer_key").isNull()),
        count_if("null_product_key_count", F.col("product_key").isNull()),
        count_if("null_seller_key_count", F.col("seller_key").isNull()),
        duplicate_keys("duplicate_order_item_rows", ["order_id", "order_item_id"]),
        count_if("negative_gross_sales_rows", F.col("gross_sales_value") < 0),
        count_if("negative_freight_rows", F.col("freight_value") < 0),
    ]


def fact_sales_enriched_checks() -> list[Check]:
    return [
        count_if("negative_payment_rows", F.col("total_payment_value") < 0),
        duplicate_keys("duplicate_order_item_rows", ["order_id", "order_item_id"]),
        # Named "mismatched" in the source; it tests only for negative counts.
        count_if("mismatched_payment_count", F.col("payment_count") < 0),
    ]


def key_checks(table: str, pk: list[str], natural: list[str] | None = None) -> list[Check]:
    """Primary key NOT NULL + unique, natural key unique (the DDL
    constraints)."""
    null_pk = F.lit(False)
    for c in pk:
        null_pk = null_pk | F.col(c).isNull()
    checks = [count_if(f"{table}.pk_null", null_pk),
              duplicate_keys(f"{table}.pk_duplicate", pk)]
    if natural:
        checks.append(duplicate_keys(f"{table}.natural_key_duplicate", natural))
    return checks


def _split(checks: list[Check]) -> tuple[list[tuple[str, Column]], dict[tuple[str, ...], list[str]]]:
    """(name, predicate) of the row checks, and the duplicate checks by key."""
    preds = [(n, p) for n, kind, p in checks if kind == "count_if"]
    sets: dict[tuple[str, ...], list[str]] = {}
    for n, kind, cols in checks:
        if kind == "duplicate_keys":
            sets.setdefault(tuple(cols), []).append(n)
    return preds, sets


def grouped(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One scan: a row for each key of each key set (``set``: its number, from
    0; ``digest``: 128 bits of the key; ``n``: its rows) and, as set -1, one
    with the predicates' counts. Rows of equal set and digest add up."""
    preds, sets = _split(checks)
    columns = list(dict.fromkeys(c for cols in sets for c in cols))
    # A set's grouping id has a bit for each column it leaves out.
    ids = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in cols): k
           for k, cols in enumerate(sets)}
    counts = F.array(*[F.count_if(p) for _, p in preds]).cast("array<bigint>")
    if not columns:
        return df.agg(F.count(F.lit(1)).alias("n"), counts.alias("counts")).select(
            F.lit(-1).alias("set"), F.lit(b"").alias("digest"), "n", "counts")
    of = F.lit(-1)
    for gid, k in ids.items():
        of = F.when(F.col("_gid") == gid, k).otherwise(of)
    g = df.groupingSets([[F.col(c) for c in cols] for cols in sets] + [[]], *[F.col(c) for c in columns]).agg(
        F.count(F.lit(1)).alias("n"), counts.alias("counts"), F.grouping_id().alias("_gid"))
    values = F.to_json(F.struct(*[F.col(c) for c in columns]))
    return g.withColumn("set", of).select(
        "set", F.unhex(F.substring(F.sha2(values, 256), 1, 32)).alias("digest"), "n",
        F.when(F.col("set") == -1, F.col("counts")).alias("counts"))


def merged(groups: DataFrame, checks: list[Check], combined: bool = False) -> DataFrame:
    """Results of ``checks`` from the rows of ``grouped``, of one table or of
    several loads of it (then the rows of a key are added up first)."""
    preds, sets = _split(checks)
    keys = groups if combined else groups.where("set >= 0").groupBy("set", "digest").agg(F.sum("n").alias("n"))
    results = [F.coalesce(F.count_if((F.col("set") == k) & (F.col("n") > 1)), F.lit(0)).alias(n)
               for k, names in enumerate(sets.values()) for n in names]
    row = lambda c, v: F.struct(F.lit(c).alias("check"), v.cast("long").alias("result"))
    sums = [F.coalesce(F.sum(F.when(F.col("set") == -1, F.col("counts")[i])), F.lit(0)).alias(n)
            for i, (n, _) in enumerate(preds)]
    if combined:
        wide = [keys.agg(*results, *sums)]
    else:
        wide = [df.agg(*aggs) for df, aggs in ((keys, results), (groups.where("set = -1"), sums)) if aggs]
    out = None
    for df in wide:
        long = df.select(F.explode(F.array(*[row(c, F.col(f"`{c}`")) for c in df.columns])).alias("r")).select("r.*")
        out = long if out is None else out.unionByName(long)
    return (out.withColumn("expected", F.lit(0).cast("long"))
            .withColumn("passed", F.col("result") == F.col("expected")))


def run(df: DataFrame, checks: list[Check]) -> DataFrame:
    preds, sets = _split(checks)
    if len(sets) != 1:
        return merged(grouped(df, checks), checks, combined=True)
    # One key set: its groups carry the predicates' counts, nothing expands.
    (cols, names), = sets.items()
    aggs = [F.count_if(p).alias(f"_p_{i}") for i, (_, p) in enumerate(preds)]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    wide = g.agg(*[F.count_if(F.col("_rows") > 1).alias(n) for n in names],
                 *[F.coalesce(F.sum(f"_p_{i}"), F.lit(0)).cast("long").alias(n) for i, (n, _) in enumerate(preds)])
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").cast("long").alias("result"))
        for c in wide.columns])).alias("r")).select("r.*")
    return (long.withColumn("expected", F.lit(0).cast("long"))
            .withColumn("passed", F.col("result") == F.col("expected")))


def enforce(results: DataFrame) -> None:
    """Raise if any check failed, naming every failure (one small collect:
    one row per check)."""
    failed = [r for r in results.collect() if not r["passed"]]
    if failed:
        detail = ", ".join(f"{r['check']}={r['result']} (expected {r['expected']})" for r in failed)
        raise AssertionError(f"data quality failed: {detail}")


def observed_write(raw: DataFrame, valid_of, path: str) -> tuple[int, int, int]:
    """Write ``valid_of(raw)`` and return the rows read, the valid ones, and
    those stored: the first two are observed by the writing pass itself, the
    last comes from the footers of the files. A task that is run again after a
    lost executor may be observed twice; what is stored is exact."""
    seen, valid = Observation(), Observation()
    one = F.count(F.lit(1)).alias("rows")
    valid_of(raw.observe(seen, one)).observe(valid, one).write.mode("overwrite").parquet(path)
    return seen.get["rows"], valid.get["rows"], raw.sparkSession.read.parquet(path).count()


def reconcile(counts: dict[str, DataFrame]) -> DataFrame:
    """Stage-by-stage row counts ``(stage, row_count)`` of named DataFrames,
    e.g. raw -> valid -> stored. Each count is a partial aggregation."""
    out = None
    for stage, df in counts.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(stage).alias("stage"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
