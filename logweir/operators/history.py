"""Schemas of events over many batches.

What a batch shows of a key is *evidence*: how often it occurs, which kinds of values it has, how many digits numbers need, and
how its name is written. Evidence is a handful of maxima, flags and counts, so it adds up in any order: over rows in partial
aggregates before the shuffle, and over batches in the same way. Types follow from the evidence as in a lattice, and can
only widen:

    null < bigint < decimal < double < string,  null < boolean < string,  struct and array < variant

Keys that differ in case only are one key here, because they would be one column of a table; every spelling is reported.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.schema import observed_paths
from logweir.sinks.ledger import SLOTS, load_if_there

#: Digits of a whole number of 64 bits, and the most that a decimal can have.
LONG_DIGITS = 19
MOST_DIGITS = 38

FLAGS = ("boolean", "exact", "double", "string", "struct", "array", "other")
KEYS = ("event", "path")


def evidence(tagged: DataFrame, batch_id: int) -> DataFrame:
    """One row for each event and folded path of ``tagged(value, event)``, nested objects one level deep.

    Values are counted by event, path as written and kind first, by plain keys; all else is said of those few rows, not of each value.
    """
    # what an object or a list holds is no part of the evidence, and would make its kind a group of its own
    outer = F.substring_index(F.schema_of_variant("doc"), "<", 1)
    seen = observed_paths(tagged).select("event", "path", outer.alias("kind"))
    counted = seen.groupBy("event", "path", "kind").agg(F.count(F.lit(1)).alias("rows"))
    kind = F.col("kind")
    shape = r"^DECIMAL\((\d+),(\d+)\)$"
    precision, scale = (F.regexp_extract(kind, shape, group).try_cast("int") for group in (1, 2))
    flags = {
        "boolean": kind == "BOOLEAN",
        "exact": kind.rlike("^(BIGINT|DECIMAL)"),
        "double": kind.isin("DOUBLE", "FLOAT"),
        "string": kind == "STRING",
        "struct": kind == "OBJECT",
        "array": kind == "ARRAY",
    }
    known = kind == "VOID"
    for flag in flags.values():
        known = known | flag
    return counted.groupBy("event", F.lower("path").alias("path")).agg(
        F.sum("rows").alias("rows"),
        F.array_sort(F.collect_set("path")).alias("spellings"),
        F.max(F.when(kind == "BIGINT", LONG_DIGITS).otherwise(precision - scale)).alias("digits"),
        F.max(F.when(kind == "BIGINT", 0).otherwise(scale)).alias("scale"),
        *[F.bool_or(flag).alias(name) for name, flag in flags.items()],
        F.bool_or(~known).alias("other"),
        F.lit(batch_id).cast("bigint").alias("first_batch"),
        F.lit(batch_id).cast("bigint").alias("last_batch"),
    )


def merged(rows: DataFrame) -> DataFrame:
    """Evidence of several batches, added up."""
    return rows.groupBy(*KEYS).agg(
        F.sum("rows").alias("rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spellings")))).alias("spellings"),
        F.max("digits").alias("digits"),
        F.max("scale").alias("scale"),
        *[F.bool_or(name).alias(name) for name in FLAGS],
        F.min("first_batch").alias("first_batch"),
        F.max("last_batch").alias("last_batch"),
    )


def type_of() -> Column:
    """The narrowest type that holds all values the evidence tells of."""
    flag = F.col
    nested = flag("struct").cast("int") + flag("array").cast("int")
    number = flag("exact") | flag("double")
    scalar = number | flag("boolean") | flag("string")
    precision = F.col("digits") + F.col("scale")
    decimal = F.concat(F.lit("decimal("), precision.cast("string"), F.lit(","), F.col("scale").cast("string"), F.lit(")"))
    return (
        F.when(flag("other") | (nested > 1) | ((nested > 0) & scalar), F.lit("variant"))
        .when(flag("struct"), F.lit("struct"))
        .when(flag("array"), F.lit("array"))
        .when(flag("string") | (flag("boolean") & number), F.lit("string"))
        .when(flag("boolean"), F.lit("boolean"))
        .when(flag("double") | (precision > MOST_DIGITS), F.lit("double"))
        .when((F.col("scale") == 0) & (F.col("digits") <= LONG_DIGITS), F.lit("bigint"))
        .when(flag("exact"), decimal)
        .otherwise(F.lit("null"))
    )


def schema_table(rows: DataFrame) -> DataFrame:
    """``event, path, type, spellings, rows, first_batch, last_batch`` of merged evidence."""
    return rows.select(*KEYS, type_of().alias("type"), "spellings", "rows", "first_batch", "last_batch")


def case_variants(schemas: DataFrame) -> DataFrame:
    """Keys that are written in more than one way."""
    return schemas.where(F.size("spellings") > 1)


@dataclass(frozen=True)
class SchemaHistory:
    """The evidence of all batches of each source, under ``root``.

    The state after a batch replaces the state before the last one: there are two places, and the one that holds the state the
    batch starts from is never written. So a repeated batch starts from the same state again and counts once.
    """

    spark: SparkSession
    root: str

    def _places(self, source_id: str) -> list[str]:
        return [f"{self.root}/source_id={source_id}/slot={slot}" for slot in range(SLOTS)]

    def _states(self, source_id: str) -> list[tuple[int, str]]:
        """(last batch, place) of the states there are."""
        found = []
        for place in self._places(source_id):
            frame = load_if_there(lambda place=place: self.spark.read.parquet(place))
            last = frame.agg(F.max("last_batch")).first()[0] if frame is not None else None
            if last is not None:
                found.append((last, place))
        return sorted(found)

    def record(self, tagged: DataFrame, source_id: str, batch_id: int) -> DataFrame:
        """Adds what a batch shows; returns the schemas as of this batch."""
        before = [place for last, place in self._states(source_id) if last < batch_id]
        new = evidence(tagged, batch_id)
        if before:
            new = merged(new.unionByName(self.spark.read.parquet(before[-1])))
        place = next(p for p in self._places(source_id) if not before or p != before[-1])
        new.coalesce(1).write.mode("overwrite").parquet(place)
        return schema_table(self.spark.read.parquet(place))

    def schemas(self, source_id: str) -> DataFrame | None:
        """The schemas after the last batch of a source."""
        states = self._states(source_id)
        return schema_table(self.spark.read.parquet(states[-1][1])) if states else None
