"""Message encoding: a row as a JSON object (nulls kept) and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martline.functions.time import iso_text


def encode_value(df: DataFrame, columns: list[str] | None = None) -> Column:
    """JSON text of the row; timestamps become ISO text, NULL fields are
    written as ``null`` (the consumer's schema expects every field)."""
    cols = columns or df.columns
    fields = []
    for name in cols:
        dt = df.schema[name].dataType.typeName()
        c = iso_text(name) if dt.startswith("timestamp") else F.col(name)
        fields.append(c.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_messages(df: DataFrame, key: Column, columns: list[str] | None = None) -> DataFrame:
    """Keyed messages ``(key, value)`` as strings, one per row."""
    return df.select(key.alias("key"), encode_value(df, columns).alias("value"))


def decode_value(value: str | Column, schema: StructType) -> Column:
    """Permissive JSON decode: malformed text gives an all-NULL struct and a
    wrongly typed field gives NULL for that field."""
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v.cast("string"), schema, {"mode": "PERMISSIVE"})
