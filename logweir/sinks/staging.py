"""Text staging of typed rows (CSV or JSON, plain or gzip) and the exact way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.config import STAGING_FORMATS

# Microsecond patterns, because the writers' defaults stop at milliseconds.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Quotes are doubled, white space and empty texts are kept, and NULL is the unquoted empty cell.
_CSV = {
    "header": "false",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}
# What the reader gives for a quoted empty cell; it would take an empty text for NULL otherwise. Texts of the data never
# hold it: a NUL character is escaped.
_EMPTY = "\0"
# Fixed values of this format: characters that a cell must not hold, and what is written for each. The mark is escaped too, so
# that every mark in a file begins one of these pairs, and the pairs can be undone one after the other, the mark's last.
_MARK = "\\"
_PAIRS = {"\n": _MARK + "n", "\r": _MARK + "r", "\0": _MARK + "0"}
_MARK_PAIR = _MARK + "m"


def escaped(text: Column) -> Column:
    """Text without line breaks, so that a line of a file is a row and a file can be read by many tasks."""
    text = F.replace(text, F.lit(_MARK), F.lit(_MARK_PAIR))
    for character, pair in _PAIRS.items():
        text = F.replace(text, F.lit(character), F.lit(pair))
    return text


def unescaped(cell: Column) -> Column:
    text = cell
    for character, pair in _PAIRS.items():
        text = F.replace(text, F.lit(pair), F.lit(character))
    text = F.replace(text, F.lit(_MARK_PAIR), F.lit(_MARK))
    return F.when(cell == _EMPTY, "").otherwise(text)


def stage(df: DataFrame, path: str, staging_format: str = "JSON") -> None:
    """Plain files are splittable. A gzip file is read by one task, so rows are dealt into files of a partition's size.

    The ``rebalance`` hint does that by the bytes adaptive execution sees, not by a number of rows, and as finely as the
    shares of the tasks before it allow.
    """
    kind, codec = _parse(staging_format)
    if kind == "CSV":
        df = df.withColumns({name: escaped(F.col(f"`{name}`")) for name in _texts(df.schema)})
    if codec == "gzip":
        df = df.hint("rebalance")
    writer = df.write.mode("overwrite").options(**_TIMES).option("compression", codec)
    if kind == "CSV":
        writer.options(**_CSV).csv(path)
    else:
        writer.json(path)


def read_staged(spark: SparkSession, path: str, schema: T.StructType, staging_format: str = "JSON") -> DataFrame:
    """Read back with the declared schema: JSON leaves out NULL keys and CSV has no types of its own."""
    kind, _ = _parse(staging_format)
    reader = spark.read.schema(schema).options(**_TIMES)
    if kind == "JSON":
        return reader.json(path)
    csv = reader.options(**{**_CSV, "emptyValue": _EMPTY}).csv(path)
    return csv.withColumns({name: unescaped(F.col(f"`{name}`")) for name in _texts(schema)})


def _texts(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def _parse(staging_format: str) -> tuple[str, str]:
    if staging_format not in STAGING_FORMATS:
        raise ValueError(f"staging format must be one of {STAGING_FORMATS}, got {staging_format!r}")
    kind, *codec = staging_format.split()
    return kind, "gzip" if codec else "none"
