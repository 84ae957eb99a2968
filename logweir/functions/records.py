"""Reading one JSON record: a single ``from_json`` gives the event tag, the readable fields and the verdict."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The keys of the record envelope.
EVENT_KEY = "event"
PROPERTIES_KEY = "properties_raw"

UNREADABLE = "__unreadable"
END = "__end"

TRAILING = "text after the record"

ROUTED = "routed"
UNROUTED = "unrouted"
QUARANTINED = "quarantined"


def record_type(
    outer: Iterable[str] = (),
    properties: Iterable[str] = (),
    exact_outer: Collection[str] = (),
    exact_properties: Collection[str] = (),
) -> T.StructType:
    """Parse schema with every leaf as text: no inference, and no value lost to a wrong guess.

    Exact keys are read as variants, which keep every digit of a number and tell a text from what it spells; the event key
    never is. With no names given only the event key is read; the parser skips over everything else.
    """

    def leaf(name: str, exact: Collection[str]) -> T.StructField:
        return T.StructField(name, T.VariantType() if name in exact else T.StringType())

    event, *others = dict.fromkeys([EVENT_KEY, *outer])
    fields = [T.StructField(event, T.StringType()), *(leaf(name, exact_outer) for name in others)]
    props = dict.fromkeys(properties)
    if props:
        fields.append(T.StructField(PROPERTIES_KEY, T.StructType([leaf(name, exact_properties) for name in props])))
    fields.append(T.StructField(UNREADABLE, T.StringType()))
    return T.StructType(fields)


def parse_record(value: Column | str, schema: T.StructType) -> Column:
    return F.from_json(value, schema, {"columnNameOfCorruptRecord": UNREADABLE})


def event_of(record: Column) -> Column:
    return record.getField(EVENT_KEY)


def trailing_text(value: Column, record: Column) -> Column:
    """Whether a readable object is followed by anything but white space; never NULL.

    The parser stops after the first document. So the text is parsed once more, as the first of two elements of an array, the
    second of which is the text's own hash: whatever follows the object breaks the array, makes it longer or ends it early.
    """
    ends = F.from_json(
        F.concat(F.lit("["), value, F.lit(f',{{"{END}":'), F.xxhash64(value).cast("string"), F.lit("}]")),
        T.ArrayType(T.StructType([T.StructField(END, T.LongType())])),
    )
    alone = (F.size(ends) == 2) & (F.try_element_at(ends, F.lit(2)).getField(END) == F.xxhash64(value))
    readable = (record.getField(UNREADABLE).isNull() | event_of(record).isNotNull()) & value.rlike(r"^\s*\{")
    return F.when(F.coalesce(readable, F.lit(False)), ~F.coalesce(alone, F.lit(False))).otherwise(F.lit(False))


def defect(value: Column, record: Column, trailing: Column | None = None) -> Column:
    """Why a record cannot be read, or NULL if it can; ``trailing`` says whether text after it is such a reason.

    A readable record with a mistyped field also fills the unreadable column, but keeps its event tag; a valid JSON
    text that is not an object parses as a variant. The variant parse runs only for rows that get that far.
    """
    unread = record.getField(UNREADABLE).isNotNull() & event_of(record).isNull()
    found = (
        F.when(value.isNull(), F.lit("null value"))
        .when(record.isNull(), F.lit("empty value"))
        .when(unread & F.try_parse_json(value).isNull(), F.lit("malformed json"))
    )
    return found if trailing is None else found.when(trailing, F.lit(TRAILING))


def outcome(wanted: Column, reason: Column) -> Column:
    """``routed``, ``unrouted`` or ``quarantined``; every record gets exactly one of them."""
    return (
        F.when(wanted, F.lit(ROUTED))
        .when(reason.isNotNull(), F.lit(QUARANTINED))
        .otherwise(F.lit(UNROUTED))
    )
