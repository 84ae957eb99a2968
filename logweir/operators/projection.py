"""Catalog-driven typed projection: outer columns first, then the properties, in catalog order."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions import coercion, records
from logweir.functions.specs import declared_type
from logweir.operators.catalog import DELIMITER, OUTER, PROPERTY


@dataclass(frozen=True)
class FieldSpec:
    """One target column: where it is found in the record and what it must become."""

    name: str
    type_text: str
    scope: str = OUTER
    source_key: str | None = None

    @property
    def key(self) -> str:
        return self.source_key or self.name

    @property
    def place(self) -> tuple[str, str]:
        """Where the value is in a record."""
        return self.scope, self.key


@dataclass(frozen=True)
class CastRules:
    """How text becomes typed values; the defaults never fail and never change a value silently."""

    cast_mode: str = "try"
    width_unit: str = "bytes"


def fields_from_specs(specs: Sequence[str], delimiter: str = DELIMITER) -> tuple[FieldSpec, ...]:
    """Ordered ``name:type`` texts → fields, split at the delimiter, first declaration of a name wins."""
    seen: dict[str, FieldSpec] = {}
    pairs = [spec.split(":", 1) for spec in specs]
    names = [pair[0].lower() for pair in pairs]
    end = names.index(delimiter.lower()) if delimiter.lower() in names else len(names)
    for position, (name, type_text) in enumerate(pairs):
        scope = OUTER if position <= end else PROPERTY
        seen.setdefault(name.lower(), FieldSpec(name, type_text, scope))
    return tuple(seen.values())


def exact_places(fields: Sequence[FieldSpec]) -> frozenset[tuple[str, str]]:
    """Where values are read as variants: all fields that read the place need more than its text."""
    text = {f.place for f in fields if not coercion.is_exact(declared_type(f.type_text))} | {(OUTER, records.EVENT_KEY)}
    return frozenset(f.place for f in fields) - text


def record_schema(fields: Sequence[FieldSpec]) -> T.StructType:
    exact = exact_places(fields)
    return records.record_type(
        outer=[f.key for f in fields if f.scope == OUTER],
        properties=[f.key for f in fields if f.scope == PROPERTY],
        exact_outer=[key for scope, key in exact if scope == OUTER],
        exact_properties=[key for scope, key in exact if scope == PROPERTY],
    )


def table_schema(fields: Sequence[FieldSpec]) -> T.StructType:
    """The declared schema of a target table."""
    return T.StructType([T.StructField(f.name, declared_type(f.type_text).data_type) for f in fields])


def outer_columns(
    record: Column, fields: Sequence[FieldSpec], rules: CastRules = CastRules(), present: Collection[str] | None = None
) -> list[Column]:
    """Outer fields as typed columns. With ``present`` given, fields not in it are left out; else they are NULL."""
    chosen = [f for f in fields if f.scope == OUTER and (present is None or f.key in present)]
    exact = exact_places(fields)
    return [_typed(record.getField(f.key), f, rules, exact) for f in chosen]


def property_columns(record: Column, fields: Sequence[FieldSpec], rules: CastRules = CastRules()) -> list[Column]:
    """Properties as typed columns; an absent property, or no property object at all, gives typed NULLs."""
    props = record.getField(records.PROPERTIES_KEY)
    exact = exact_places(fields)
    return [_typed(props.getField(f.key), f, rules, exact) for f in fields if f.scope == PROPERTY]


def _typed(value: Column, field: FieldSpec, rules: CastRules, exact: Collection[tuple[str, str]]) -> Column:
    declared = declared_type(field.type_text)
    if field.place in exact:
        return coercion.coerce_exact(value, declared).alias(field.name)
    return coercion.coerce(value, declared, rules.cast_mode, rules.width_unit).alias(field.name)


def project(
    df: DataFrame,
    fields: Sequence[FieldSpec],
    rules: CastRules = CastRules(),
    present: Collection[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``value`` texts of one target → its typed table. One parse, one projection, no shuffle."""
    parsed = df.withColumn("record", records.parse_record("value", record_schema(fields)))
    return project_parsed(parsed, fields, rules, present, keep)


def project_parsed(
    parsed: DataFrame,
    fields: Sequence[FieldSpec],
    rules: CastRules = CastRules(),
    present: Collection[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    application = parsed.sparkSession.sparkContext.applicationId
    chosen = None if present is None else frozenset(present)
    return parsed.select(*keep, *_projection(application, tuple(fields), rules, chosen))


@lru_cache(maxsize=20_000)
def _projection(
    application: str, fields: tuple[FieldSpec, ...], rules: CastRules, present: frozenset[str] | None
) -> list[Column]:
    """The select list of a target. Expressions are unresolved, so every batch of an application can use them again."""
    record = F.col("record")
    return [*outer_columns(record, fields, rules, present), *property_columns(record, fields, rules)]


def preview_rows(df: DataFrame, order_by: Sequence[str] = (), rows: int = 5, width: int = 20) -> DataFrame:
    """The first rows with every cell as text cut to ``width``, the last three characters showing the cut."""
    first = df.orderBy(*order_by).limit(rows) if order_by else df.limit(rows)
    return first.select(*[_cut(F.col(f"`{name}`"), width).alias(name) for name in df.columns])


def _cut(cell: Column, width: int) -> Column:
    text = cell.cast("string")
    cut = F.concat(F.left(text, F.lit(width - 3)), F.lit("..."))
    return F.when(F.length(text) > width, cut).otherwise(text)


def preview_text(df: DataFrame, rows: int = 5, width: int = 20) -> str:
    """Schema tree plus the first rows, for logs."""
    lines = [" | ".join(df.columns)]
    lines += [" | ".join(str(cell) for cell in row) for row in preview_rows(df, rows=rows, width=width).collect()]
    return df.schema.treeString() + "\n" + "\n".join(lines)
