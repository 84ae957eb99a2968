"""Event routing: which records belong to which target.

``exact`` routing reads the top-level ``event`` key. ``regex`` routing is textual, for users who depend on that
behaviour: the pattern ``"event":"<name>"`` may match anywhere in the text, and a list of names becomes one
alternation over the *whole* pattern. ``each`` is textual too, with one pattern per name. All of it is native
expressions, so filters stay in generated code.

The cost of textual routing does not grow with the number of names. ``each`` reads every event text of a record in one pass
and looks the texts up in the set of names. ``regex`` folds the alternation into a prefix tree, so that a position of the
text is left at the first character that begins no name. Names with regular-expression characters keep patterns of their own.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions import records

ROUTING_MODES = ("exact", "regex", "each")

# Fixed value: the text pattern of regex routing.
TEXT_PATTERN = '"event":"{}"'


def event_tag() -> Column:
    """The top-level event name of ``value``; NULL when there is none or the record cannot be read."""
    return records.event_of(records.parse_record("value", records.record_type()))


def is_event(record: Column, names: Sequence[str]) -> Column:
    return records.event_of(record).isin(list(names))


# Every text after an event key, wherever it stands. The key is looked at without being consumed, because the closing
# quote of one text can be the opening quote of the next key.
_EVENT_TEXTS = r'(?="event":"([^"]*)")"'

_PLAIN = re.compile(r'[^"\\.^$*+?()\[\]{}|]+')


def is_plain(name: str) -> bool:
    """Whether the name as a pattern matches just itself, and can stand between the quotes of an event text."""
    return bool(_PLAIN.fullmatch(name))


def matches_text(value: Column, names: Sequence[str]) -> Column:
    """One alternation over the whole pattern: only the first name is bound to the key, only the last to the quote."""
    return value.rlike(alternation(tuple(names)))


@lru_cache(maxsize=64)
def alternation(names: tuple[str, ...]) -> str:
    """A pattern that finds something in the same texts as the plain alternation of the names does."""
    head, tail = TEXT_PATTERN.split("{}")
    if len(names) < 2:
        return TEXT_PATTERN.format("|".join(names))
    branches = [head + names[0], *names[1:-1], names[-1] + tail]
    plain = [b for b, name in zip(branches, names) if is_plain(name)]
    odd = [b for b, name in zip(branches, names) if not is_plain(name)]
    return "|".join([*([prefix_tree(plain)] if plain else []), *odd])


def prefix_tree(words: Sequence[str]) -> str:
    """A pattern that is found in a text if and only if one of the words is.

    A word that begins with another one adds nothing: where it is found, the shorter one is.
    """
    shortest: list[str] = []
    for word in sorted(set(words)):
        if not shortest or not word.startswith(shortest[-1]):
            shortest.append(word)
    return _branches(shortest, 0)


def _branches(words: list[str], at: int) -> str:
    """Sorted words that agree in their first ``at`` characters, none of them the beginning of another."""
    if len(words) == 1:
        return re.escape(words[0][at:])
    end = at
    while words[0][end : end + 1] and words[0][end] == words[-1][end : end + 1]:
        end += 1
    groups: dict[str, list[str]] = {}
    for word in words:
        groups.setdefault(word[end], []).append(word)
    inner = "|".join(_branches(group, end) for group in groups.values())
    return f"{re.escape(words[0][at:end])}(?:{inner})"


def text_events(names: Sequence[str]) -> Column:
    """The catalog names whose pattern the text in ``value`` contains, each once; never NULL.

    The set of names is one SQL text, which Spark turns into a hash set; a call for each of thousands of names would
    take seconds in the driver.
    """
    plain = [name for name in dict.fromkeys(names) if is_plain(name)]
    odd = [name for name in dict.fromkeys(names) if not is_plain(name)]
    none = F.array().cast("array<string>")
    found = none
    if plain:
        known = ", ".join("'" + name.replace("'", "\\'") + "'" for name in plain)
        texts = f"array_distinct(regexp_extract_all(value, r'{_EVENT_TEXTS}', 1))"
        found = F.coalesce(F.expr(f"filter({texts}, text -> text IN ({known}))"), none)
    matches = [F.when(matches_text(F.col("value"), [name]), F.lit(name)) for name in odd]
    return F.concat(found, F.array_compact(F.array(*matches))) if odd else found


def belongs(value: Column, record: Column, names: Sequence[str], mode: str) -> Column:
    """Whether a record is of one of the events; never NULL. ``value`` is the column of that name."""
    if mode == "exact":
        match = is_event(record, names)
    elif mode == "regex":
        match = matches_text(value, names)
    elif mode == "each":
        match = F.size(text_events(names)) > 0
    else:
        raise ValueError(f"routing mode must be one of {ROUTING_MODES}, got {mode!r}")
    return F.coalesce(match, F.lit(False))


def route(df: DataFrame, names: str | Sequence[str], mode: str = "exact") -> DataFrame:
    """Records of one event or of a set of events."""
    wanted = [names] if isinstance(names, str) else list(names)
    record = records.parse_record("value", records.record_type())
    return df.where(belongs(F.col("value"), record, wanted, mode))


def tag(df: DataFrame) -> DataFrame:
    """Add the event name as a column, so that later filters and joins do not parse again."""
    return df.withColumn("event", event_tag())


def route_join(tagged: DataFrame, events: DataFrame) -> DataFrame:
    """Records whose event is in the catalog."""
    return _match(tagged, events, "left_semi")


def unrouted(tagged: DataFrame, events: DataFrame) -> DataFrame:
    """Records that no catalog event claims, NULL tags included."""
    return _match(tagged, events, "left_anti")


def _match(tagged: DataFrame, events: DataFrame, how: str) -> DataFrame:
    """Join on a tag that is never NULL: Spark adds no null filter then, which would parse every record twice."""
    names = events.where(F.col("event_name") != "").select(F.col("event_name").alias("catalog_name"))
    tag_or_none = F.coalesce(F.col("event"), F.lit(""))
    return tagged.join(names, tag_or_none == F.coalesce(F.col("catalog_name"), F.lit("")), how)


def sort_out(
    df: DataFrame, names: Sequence[str], mode: str = "exact", schema: T.StructType | None = None, one_document: bool = False
) -> DataFrame:
    """Add ``record, event, outcome, reason``: one parse per record decides routed, unrouted or quarantined.

    With a wider ``schema`` than the bare event tag, the same parse also reads the fields. With ``one_document`` records that
    have text after their object are quarantined, which costs a second look at every text.
    """
    value, record, wanted = F.col("value"), F.col("record"), F.col("wanted")
    parsed = df.withColumn("record", records.parse_record("value", schema or records.record_type()))
    match, trailing = belongs(value, record, names, mode), None
    if one_document:
        parsed, trailing = parsed.withColumn("trailing", records.trailing_text(value, record)), F.col("trailing")
        match = match & ~trailing
    return (
        parsed.withColumn("wanted", match)
        .withColumn("reason", F.when(~wanted, records.defect(value, record, trailing)))
        .withColumn("outcome", records.outcome(wanted, F.col("reason")))
        .withColumn("event", records.event_of(record))
        .drop("wanted", "trailing")
    )


def having(df: DataFrame, names: Sequence[str], wanted: str, mode: str = "exact") -> DataFrame:
    """The records with one given outcome, each with its ``reason``.

    A filter on the columns of ``sort_out`` would be pushed below them, and parse the record again for each mention.
    Here the parsed record is bound once, as the variable of a one-element transform.
    """
    value = F.col("value")

    def judge(record: Column) -> Column:
        match = belongs(value, record, names, mode)
        reason = F.when(~match, records.defect(value, record))
        return F.struct(records.outcome(match, reason).alias("outcome"), reason.alias("reason"))

    parsed = records.parse_record("value", records.record_type())
    verdict = F.element_at(F.transform(F.array(parsed), judge), 1)
    judged = df.withColumn("verdict", verdict).where(F.col("verdict.outcome") == wanted)
    return judged.withColumn("reason", F.col("verdict.reason")).drop("verdict")


def quarantine(df: DataFrame) -> DataFrame:
    """Records that cannot be read, each with its reason."""
    return having(df, [], records.QUARANTINED)
