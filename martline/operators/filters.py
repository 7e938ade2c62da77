"""Row validation: not-null, non-negative, drop-if-any-null, and the reject
side of the same rules with a reason per failed rule.

A rule set is a list of ``(name, predicate)``; a row is valid when every
predicate is TRUE (NULL counts as failed, as in a SQL WHERE)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def not_null_rules(cols: list[str]) -> list[Rule]:
    return [(f"{c}_is_null", F.col(c).isNotNull()) for c in cols]


def non_negative_rules(cols: list[str]) -> list[Rule]:
    """``c >= 0``; a NULL value fails the rule too."""
    return [(f"{c}_negative_or_null", F.col(c) >= 0) for c in cols]


def _all(rules: list[Rule]) -> Column:
    cond = F.lit(True)
    for _, p in rules:
        cond = cond & F.coalesce(p, F.lit(False))
    return cond


def keep_valid(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows passing every rule (one combined Filter, pushed into the scan
    where the predicates allow it)."""
    return df.filter(_all(rules)) if rules else df


def filter_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return keep_valid(df, not_null_rules(cols))


def filter_non_negative(df: DataFrame, cols: list[str]) -> DataFrame:
    return keep_valid(df, non_negative_rules(cols))


def dropna_subset(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``cols`` (pandas ``dropna(subset=…)``)."""
    return df.dropna(how="any", subset=cols)


def rejects(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows failing at least one rule, with ``reject_reasons``: the names of
    all failed rules in rule order."""
    reasons = F.array_compact(F.array(*[
        F.when(~F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules]))
    return df.filter(~_all(rules)).withColumn("reject_reasons", reasons)
