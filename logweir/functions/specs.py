"""Catalog text: ``name:type`` specs, declared types and comma-separated id lists."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from pyspark.errors import ParseException
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse type names that Spark's DDL parser does not know, and the Spark type each one means.
TYPE_ALIASES = {
    "varchar": "string",
    "char": "string",
    "text": "string",
    "bpchar": "string",
    "timestamptz": "timestamp",
    "super": "variant",
    "int2": "smallint",
    "int4": "int",
    "int8": "bigint",
    "float4": "float",
    "float8": "double",
    "bool": "boolean",
}

_SIZED_TEXT = re.compile(r"^(?:varchar|char|bpchar|nchar|nvarchar)\s*\(\s*(\d+)\s*\)$")


@dataclass(frozen=True)
class DeclaredType:
    """A catalog type: the text as written, the Spark type behind it, and the declared text width if any."""

    text: str
    spark_ddl: str
    width: int | None = None

    @property
    def data_type(self) -> T.DataType:
        return T.DataType.fromDDL(self.spark_ddl)


@lru_cache(maxsize=4096)
def declared_type(text: str) -> DeclaredType:
    """Resolve catalog type text; raises ``ValueError`` when neither we nor Spark know the name."""
    name = " ".join(text.strip().lower().split())
    sized = _SIZED_TEXT.match(name)
    if sized:
        return DeclaredType(text, "string", int(sized.group(1)))
    ddl = TYPE_ALIASES.get(name, name)
    try:
        T.DataType.fromDDL(ddl)
    except ParseException as err:
        raise ValueError(f"unknown catalog type {text!r}") from err
    return DeclaredType(text, ddl)


def field_spec(name: Column | str, data_type: Column | str) -> Column:
    """``name:type``; a NULL part is left out together with its colon."""
    return F.concat_ws(":", name, data_type)


def spec_name(spec: Column) -> Column:
    return F.nullif(F.split(spec, ":", 2).getItem(0), F.lit(""))


def spec_type(spec: Column) -> Column:
    return F.get(F.split(spec, ":", 2), F.lit(1))


def spark_type_name(data_type: Column) -> Column:
    """The alias table as an expression, for catalogs that stay distributed."""
    name = F.lower(F.trim(data_type))
    pairs = [F.lit(part) for item in TYPE_ALIASES.items() for part in item]
    return F.when(name.rlike(_SIZED_TEXT.pattern), F.lit("string")).otherwise(
        F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)
    )


def int_list(text: str) -> list[int]:
    """``"0,1,2"`` → ``[0, 1, 2]``. The text is parsed, never spliced into SQL."""
    return [int(part) for part in text.split(",")]


def in_int_list(column: Column, text: Column) -> Column:
    """The same membership test as an expression, for a list that stays text in the plan."""
    return F.find_in_set(column.cast("string"), F.regexp_replace(text, r"\s", "")) > 0
