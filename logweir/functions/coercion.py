"""Text → declared type, without ever failing on bad data.

Values arrive as the text of a JSON scalar. Each helper is one native expression, so a whole projection stays
inside a single generated-code stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions.specs import DeclaredType

CAST_MODES = ("try", "legacy")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)

# English month abbreviations in calendar order, three letters each.
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def coerce(text: Column, declared: DeclaredType, cast_mode: str = "try", width_unit: str = "bytes") -> Column:
    """``text`` as the declared type; NULL where the text does not fit."""
    if cast_mode not in CAST_MODES:
        raise ValueError(f"cast_mode must be one of {CAST_MODES}, got {cast_mode!r}")
    target = declared.data_type
    if isinstance(target, T.StringType):
        return text if declared.width is None else truncate(text, declared.width, width_unit)
    if isinstance(target, _INTEGRAL):
        return integral(text, declared.spark_ddl, cast_mode)
    if isinstance(target, T.TimestampType):
        return auto_timestamp(text, "timestamp")
    if isinstance(target, T.TimestampNTZType):
        return auto_timestamp(text, "timestamp_ntz")
    if isinstance(target, T.DateType):
        return F.coalesce(text.try_cast("date"), auto_timestamp(text, "timestamp_ntz").cast("date"))
    if isinstance(target, T.VariantType):
        return F.coalesce(F.try_parse_json(text), text.cast("variant"))
    if isinstance(target, _NESTED):
        return F.from_json(text, declared.spark_ddl)
    return text.try_cast(target)


def is_exact(declared: DeclaredType) -> bool:
    """Whether the text of a value is not enough: it would lose digits, or the kind of value."""
    return isinstance(declared.data_type, (T.VariantType, T.DecimalType))


def coerce_exact(value: Column, declared: DeclaredType) -> Column:
    """A variant as the declared type; a JSON null is NULL, and a text stays a text in a variant column."""
    if isinstance(declared.data_type, T.VariantType):
        return F.when(~F.is_variant_null(value), value)
    return F.try_variant_get(value, "$", declared.spark_ddl)


def integral(text: Column, ddl: str, cast_mode: str = "try") -> Column:
    """Whole numbers. ``3``, ``3.0`` and ``3e0`` all give 3; ``12.7`` gives NULL, or 12 in legacy mode.

    A fraction is judged and cut as text, so no digit is rounded away first.
    """
    shape = r"^\s*([+-]?\d*)\.(\d*)\s*$"
    whole = F.regexp_extract(text, shape, 1)
    whole = F.when(whole.rlike(r"^[+-]?$"), "0").otherwise(whole)
    decimal, double = text.try_cast("decimal(38,10)"), text.try_cast("double")
    if cast_mode == "try":
        whole = F.when(F.regexp_extract(text, shape, 2).rlike("^0*$"), whole)
        decimal = F.when((decimal == F.floor(decimal)) & (double == F.floor(double)), decimal)
    cut = F.when(text.rlike(shape) & text.rlike(r"\d"), whole.try_cast(ddl)).when(text.rlike("[eE]"), decimal.try_cast(ddl))
    return F.coalesce(F.when(~text.contains("."), text.try_cast(ddl)), cut)


def truncate(text: Column, width: int, unit: str = "bytes") -> Column:
    if unit == "bytes":
        return truncate_bytes(text, width)
    if unit == "chars":
        return truncate_chars(text, width)
    raise ValueError(f"width unit must be 'bytes' or 'chars', got {unit!r}")


def truncate_chars(text: Column, width: int) -> Column:
    return F.left(text, F.lit(width))


def truncate_bytes(text: Column, width: int) -> Column:
    """Longest prefix of whole characters whose UTF-8 form has at most ``width`` bytes.

    A UTF-8 character has at most three continuation bytes (0x80-0xBF), so the cut moves back by at most three.
    """
    raw = F.encode(text, "UTF-8")
    cut = F.decode(F.substring(raw, 1, max(width - 3, 0)), "UTF-8")
    for back in (2, 1, 0):
        length = width - back
        if length < 0:
            continue
        next_byte = F.hex(F.substring(raw, length + 1, 1))
        cut = F.when(~next_byte.between("80", "BF"), F.decode(F.substring(raw, 1, length), "UTF-8")).otherwise(cut)
    return F.when(F.octet_length(text) <= width, text).otherwise(cut)


#: 9999-12-31 23:59:59 as seconds since the epoch.
LAST_SECOND = 253_402_300_799


def auto_timestamp(text: Column, target: str = "timestamp") -> Column:
    """Date/time text in any of the usual layouts, or epoch seconds.

    The ISO form goes straight through ``try_cast``. Other layouts are rewritten to ISO text and cast the same way,
    which neither throws per row nor passes a zone-less time through the session time zone. A plain number is a year
    (four digits) or one of the numeric layouts if it is a date in it, and else seconds since the epoch, with any sign
    and number of digits up to the end of the year 9999.
    """
    t = F.trim(text)
    iso = F.coalesce(*[F.when(t.rlike(shape), rewrite(t)) for shape, rewrite in _LAYOUTS])
    seconds = F.timestamp_seconds(t.try_cast("decimal(20,6)"))
    number = t.rlike(r"^[+-]?\d+(\.\d+)?$")
    epoch = F.when(number & t.try_cast("double").between(-LAST_SECOND, LAST_SECOND), seconds.cast(target))
    direct = F.when(~number | t.rlike(r"^\d{4}$"), t.try_cast(target))
    return F.coalesce(direct, iso.try_cast(target), epoch)


def _numeric(shape: str, iso: str):
    return shape, lambda t: F.regexp_replace(t, shape, iso)


def _named_month(shape: str, day: int, month: int, year: int, rest: int):
    def rewrite(t: Column) -> Column:
        part = lambda group: F.regexp_extract(t, shape, group)
        number = F.array_position(F.array(*map(F.lit, _MONTHS)), _short(part(month)))
        return F.concat(part(year), F.lit("-"), number.cast("string"), F.lit("-"), part(day), part(rest))

    return shape, rewrite


def _short(month: Column) -> Column:
    return F.lower(F.left(month, F.lit(3)))


# The layouts the warehouse's automatic date/time recognition shares with ordinary log text.
_MONTH = r"((?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-zA-Z]*)\.?"
_TIME = r"((?:[ T]\d{1,2}:.*)?)$"
_LAYOUTS = (
    _numeric(r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})" + _TIME, "$1-$2-$3$4"),
    _numeric(r"^(\d{1,2})/(\d{1,2})/(\d{4})" + _TIME, "$3-$1-$2$4"),
    _numeric(r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    _numeric(r"^(\d{4})(\d{2})(\d{2})([ T]\d{1,2}:.*)$", "$1-$2-$3$4"),
    _numeric(r"^(\d{4})(\d{2})(\d{2})[ T]?(\d{2})(\d{2})(\d{2})(\.\d+)?$", "$1-$2-$3 $4:$5:$6$7"),
    _named_month(r"^(\d{1,2})[ -]" + _MONTH + r"[ -](\d{4})" + _TIME, day=1, month=2, year=3, rest=4),
    _named_month(r"^" + _MONTH + r" (\d{1,2}),? (\d{4})" + _TIME, day=2, month=1, year=3, rest=4),
)
