"""File sources and sinks: CSV with a declared schema (or inferred, as the
dimension loads of the source pipeline did), strict CSV, Parquet tables
written whole or reloaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The strings pandas' CSV reader takes as missing by default
# (the producers read their CSVs with pandas); Spark's reader takes only the
# empty string.
PANDAS_NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null"]

# CSV text keeps leading/trailing spaces both ways (Spark's writer trims by
# default, which would change padded ids).
CSV_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             strict: bool = False, na_values: list[str] | None = None, **options) -> DataFrame:
    """CSV folder with a header. With ``schema`` the types are declared (no
    inference pass); without one they are inferred (one extra read; a zip
    code ``01409`` becomes the integer 1409). ``strict`` fails the job on the
    first value that does not fit the schema instead of reading NULL.
    ``na_values`` (e.g. ``PANDAS_NA_VALUES``): text read as NULL; the file is
    read as text, the tokens nulled, then the text cast to ``schema``
    (``try_cast``, or ANSI ``cast`` when ``strict``)."""
    if na_values is not None and schema is not None:
        text = read_csv(spark, path, StructType([StructField(f.name, StringType(), True)
                                                 for f in schema.fields]), **options)
        cols = []
        for f in schema.fields:
            c = F.when(~F.col(f.name).isin(na_values), F.col(f.name))
            if not isinstance(f.dataType, StringType):
                c = c.cast(f.dataType) if strict else c.try_cast(f.dataType)
            cols.append(c.alias(f.name))
        return text.select(cols)
    r = spark.read.option("header", "true").options(**CSV_KEEP_SPACES).options(**options)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    if strict:
        r = r.option("mode", "FAILFAST")
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").options(**CSV_KEEP_SPACES).csv(path)


def overwrite_table(df: DataFrame, path: str) -> DataFrame:
    """Replace a Parquet table with ``df`` and return it read back. The
    schema is the DataFrame's own (declare it with ``schemas.conform``);
    constraints become quality checks (``quality.key_checks``)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def input_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files present in ``folder``: ``(file_name, length)``. Only metadata is
    read (the content column is pruned)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
            .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length"))


def missing_inputs(spark: SparkSession, folder: str, expected: DataFrame) -> DataFrame:
    """Expected inputs ``(input_name, file_name)`` with ``present`` and the
    file size: a left join of the manifest with the files found."""
    found = input_files(spark, folder)
    return (expected.join(found, "file_name", "left")
            .select("input_name", "file_name", F.col("length").isNotNull().alias("present"),
                    F.coalesce("length", F.lit(0)).alias("file_bytes")))
