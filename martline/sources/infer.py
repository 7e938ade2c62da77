"""Lossless type inference for text columns.

The types form a lattice, from the narrowest that says a column's values to
text, which says all: nothing < boolean, int < bigint < decimal-as-double,
date < timestamp, and text above all. A value's own types are those whose text
form gives the value back: ``01409`` is no number, as a number's text has no
leading zero, nor is a number of more than 15 digits a double. A column's type
is the join of its values' types, found in one aggregation over all columns:
for each column and type, whether every value has it. Partial results are
joined as the rows are, so nothing but a row of flags leaves the tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martline.sources.files import CSV_KEEP_SPACES

# The types from the narrowest on, and the form of their values.
_WHOLE, _DAY, _TIME = "-?(0|[1-9][0-9]*)", "[0-9]{4}-[0-9]{2}-[0-9]{2}", "[0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]{1,6})?"
FORMS = {
    "boolean": "(true|false)",
    "int": _WHOLE,
    "bigint": _WHOLE,
    "double": "-?(0|[1-9][0-9]*)(\\.[0-9]+)?",
    "date": _DAY,
    "timestamp_ntz": f"{_DAY}([ T]{_TIME})?",
}


def _has(value: Column, kind: str) -> Column:
    """Is the text a value of the type, nothing lost?"""
    fits = value.rlike(f"^{FORMS[kind]}$") & value.try_cast(kind).isNotNull() & (value != "-0")
    if kind == "double":
        fits &= F.length(F.regexp_replace(value, "[^0-9]", "")) <= 15
    return F.when(value.isNotNull(), fits)


def infer(text: DataFrame) -> StructType:
    """The schema of a table of text columns, in one pass. A column without a
    value stays text."""
    names = text.columns
    flags = text.agg(*[f for i, c in enumerate(names) for f in (
        F.count(F.col(f"`{c}`")).alias(f"n{i}"),
        *[F.bool_and(_has(F.col(f"`{c}`"), k)).alias(f"{k}{i}") for k in FORMS])]).first()
    kinds = {}
    for i, c in enumerate(names):
        kinds[c] = next((k for k in FORMS if flags[f"n{i}"] and flags[f"{k}{i}"]), "string")
    empty = text.sparkSession.createDataFrame([], StructType([StructField(c, StringType()) for c in names]))
    return empty.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) for c in names]).schema


def read_csv_lossless(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder with a header, typed without loss: read once as
    text for the types and once for the rows."""
    text = spark.read.option("header", "true").options(**CSV_KEEP_SPACES).csv(path)
    schema = infer(text)
    return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
