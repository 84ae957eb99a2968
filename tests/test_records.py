"""Literal records: one case for each routing, parsing and casting rule."""

import datetime as dt
import json
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from logweir.functions import coercion
from logweir.functions.specs import declared_type
from logweir.operators import projection, routing, schema
from logweir.operators.projection import CastRules, fields_from_specs

OUTCOMES = [
    ('{"event":"aa"}', "routed", None),
    ('{"event": "aa"}', "routed", None),
    ('{"p":{"event":"aa"}}', "unrouted", None),
    ('{"event":"aaXX"}', "unrouted", None),
    ('{"event":"zz","k":"bb"}', "unrouted", None),
    ('{"event":"zcc"}', "unrouted", None),
    (None, "quarantined", "null value"),
    ("", "quarantined", "empty value"),
    ('{"event":"aa", broken', "quarantined", "malformed json"),
    ('{"event":"aa","a":1,"a":2}', "routed", None),
    ("[1]", "unrouted", None),
    ('[{"event":"aa"}]', "unrouted", None),
    ('""', "unrouted", None),
    ("12", "unrouted", None),
    ("null", "unrouted", None),
    ('{"event":null}', "unrouted", None),
    ("{}", "unrouted", None),
    ('{"event":"bb","properties_raw":"text"}', "routed", None),
]


def test_each_record_has_one_outcome(texts):
    values = [value for value, _, _ in OUTCOMES]
    rows = routing.sort_out(texts(*values), ["aa", "bb", "cc"]).collect()
    got = sorted((str(r.value), r.outcome, str(r.reason)) for r in rows)
    assert got == sorted((str(value), outcome, str(reason)) for value, outcome, reason in OUTCOMES)


@pytest.mark.parametrize("wanted", ["routed", "unrouted", "quarantined"])
def test_having_agrees_with_sort_out(texts, wanted):
    df = texts(*[value for value, _, _ in OUTCOMES])
    got = routing.having(df, ["aa", "bb", "cc"], wanted).collect()
    want = routing.sort_out(df, ["aa", "bb", "cc"]).where(F.col("outcome") == wanted).collect()
    assert sorted((str(r.value), str(r.reason)) for r in got) == sorted((str(r.value), str(r.reason)) for r in want)


def test_text_after_a_record_is_a_reason_on_request(texts):
    good = '{"event":"aa","k":[1,{"x":"}"}]}'
    after = [' {"event":"bb"}', "}", "]", ",", ", {}", ' ,{"__end":1}', ',{"__end":1}]', " x", "\\", '"', "]]", "/"]
    whole = [good, f" {good} ", f"\n{good}\t\r\n", '{"event":"aa","__end":"x"}', '{"event":"aa","event":"aa"}', '{"event":"aa"}']
    other = ['{"k":1}', "[1]", "5", "", None, '{"event":"aa"', '{"k":1} {"event":"aa"}']
    df = texts(*[good + more for more in after], *whole, *other)
    loose = routing.sort_out(df, ["aa"]).groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in loose}["routed"] == len(after) + len(whole)
    rows = routing.sort_out(df, ["aa"], one_document=True).collect()
    assert [r.value for r in rows if r.outcome == "routed"] == whole
    assert [r.value for r in rows if r.reason == "text after the record"] == [good + more for more in after] + other[-1:]
    want = [r for r in routing.sort_out(texts(*other[:-1]), ["aa"]).collect()]
    assert [r.reason for r in rows if r.value in other[:-1]] == [r.reason for r in want]


def test_exact_and_textual_routing_differ_as_documented(texts):
    df = texts('{"event": "aa"}', '{"p":{"event":"aa"}}', '{"event":"aaXX"}', '{"event":"zz","k":"bb"}', '{"event":"zcc"}', None)
    names = ["aa", "bb", "cc"]
    assert [r.value for r in routing.route(df, names).collect()] == ['{"event": "aa"}']
    assert sorted(r.value for r in routing.route(df, names, mode="regex").collect()) == sorted(
        ['{"p":{"event":"aa"}}', '{"event":"aaXX"}', '{"event":"zz","k":"bb"}', '{"event":"zcc"}']
    )
    with pytest.raises(ValueError):
        routing.route(df, names, mode="fuzzy")


def _project(df, specs, **rules):
    return projection.project(df, fields_from_specs(specs), CastRules(**rules)).collect()


SPECS = ["event:varchar(10)", "asn:int", "k:int", "s:varchar(3)"]


def test_absent_properties_are_typed_nulls(texts):
    rows = _project(texts('{"event":"aa","asn":1,"properties_raw":{}}', '{"event":"aa","asn":1}'), SPECS)
    assert [tuple(row) for row in rows] == [("aa", 1, None, None)] * 2


def test_bad_numbers_are_null_or_truncated(texts):
    df = texts('{"event":"aa","asn":"q","properties_raw":{"k":"12.7"}}')
    assert tuple(_project(df, SPECS)[0]) == ("aa", None, None, None)
    assert tuple(_project(df, SPECS, cast_mode="legacy")[0]) == ("aa", None, 12, None)


@pytest.mark.parametrize(
    "text, tried, legacy",
    [("3", 3, 3), ("3.0", 3, 3), ("3e2", 300, 300), (" 7 ", 7, 7), ("12.7", None, 12), ("-12.7", None, -12),
     ("99999999999", None, None), ("x", None, None), ("", None, None), (None, None, None)],
)
def test_integral(texts, text, tried, legacy):
    row = texts(text).select(
        coercion.integral(F.col("value"), "int").alias("a"), coercion.integral(F.col("value"), "int", "legacy").alias("b")
    ).first()
    assert (row.a, row.b) == (tried, legacy)


def test_mistyped_property_object_keeps_the_outer_fields(texts):
    rows = _project(texts('{"event":"aa","asn":7,"properties_raw":"text"}'), SPECS)
    assert tuple(rows[0]) == ("aa", 7, None, None)


def test_last_of_repeated_keys_is_read(texts):
    assert tuple(_project(texts('{"event":"aa","asn":1,"asn":2}'), SPECS)[0])[:2] == ("aa", 2)


def test_widths(texts):
    row = _project(texts('{"event":"aa","asn":1,"properties_raw":{"s":"żółw"}}'), SPECS)[0]
    assert row.s == "ż"
    row = _project(texts('{"event":"aa","asn":1,"properties_raw":{"s":"żółw"}}'), SPECS, width_unit="chars")[0]
    assert row.s == "żół"


@pytest.mark.parametrize("text", ["", "a", "abcdef", "é", "aé€😀b", "😀😀", "€€€", "日本語テキスト", "a😀", None])
@pytest.mark.parametrize("width", [1, 2, 3, 4, 5, 7])
def test_byte_truncation_matches_brute_force(texts, text, width):
    got = texts(text).select(coercion.truncate_bytes(F.col("value"), width)).first()[0]
    want = None if text is None else max((text[:n] for n in range(len(text) + 1) if len(text[:n].encode()) <= width), key=len)
    assert got == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-01-05 07:08:09.123456", dt.datetime(2024, 1, 5, 7, 8, 9, 123456)),
        ("2024-01-05T07:08:09", dt.datetime(2024, 1, 5, 7, 8, 9)),
        ("2024/01/05 07:08:09", dt.datetime(2024, 1, 5, 7, 8, 9)),
        ("2024.01.05", dt.datetime(2024, 1, 5)),
        ("01/05/2024 07:08", dt.datetime(2024, 1, 5, 7, 8)),
        ("1/5/2024", dt.datetime(2024, 1, 5)),
        ("20240105", dt.datetime(2024, 1, 5)),
        ("20240105 070809", dt.datetime(2024, 1, 5, 7, 8, 9)),
        ("20240105070809", dt.datetime(2024, 1, 5, 7, 8, 9)),
        ("20240105 07:08:09", dt.datetime(2024, 1, 5, 7, 8, 9)),
        ("5 Jan 2024 07:08:09", dt.datetime(2024, 1, 5, 7, 8, 9)),
        ("05-DEC-2024", dt.datetime(2024, 12, 5)),
        ("May 5, 2024 07:08:09.5", dt.datetime(2024, 5, 5, 7, 8, 9, 500000)),
        ("September 30 2024", dt.datetime(2024, 9, 30)),
        ("1704438489", dt.datetime(2024, 1, 5, 7, 8, 9)),
        ("1704438489.25", dt.datetime(2024, 1, 5, 7, 8, 9, 250000)),
        ("13/45/2024", None),
        ("yesterday", None),
        ("", None),
        (None, None),
    ],
)
def test_auto_timestamp(texts, text, want):
    row = texts(text).select(coercion.auto_timestamp(F.col("value"), "timestamp_ntz").alias("t")).first()
    assert row.t == want


def test_every_month_is_recognised(texts):
    months = [dt.date(2024, m, 3) for m in range(1, 13)]
    for pattern in ("%d %b %Y", "%B %d, %Y", "%d-%b-%Y"):
        df = texts(*[day.strftime(pattern) for day in months])
        got = df.select(coercion.coerce(F.col("value"), declared_type("date")).alias("d")).collect()
        assert [r.d for r in got] == months


@pytest.mark.parametrize(
    "type_text, text, want",
    [
        ("varchar", "x", "x"),
        ("bool", "true", True),
        ("boolean", "maybe", None),
        ("float8", "1.5", 1.5),
        ("decimal(5,2)", "1.25", Decimal("1.25")),
        ("decimal(5,2)", "12345.6", None),
        ("smallint", "70000", None),
        ("array<int>", "[1,2]", [1, 2]),
        ("timestamp_ntz", "2024-01-05 07:08:09", dt.datetime(2024, 1, 5, 7, 8, 9)),
    ],
)
def test_declared_types(texts, type_text, text, want):
    got = texts(text).select(coercion.coerce(F.col("value"), declared_type(type_text)).alias("c")).first().c
    assert got == want


def test_unknown_type_is_refused(spark):
    with pytest.raises(ValueError):
        declared_type("nonsense")


def test_super_is_a_variant(texts):
    df = texts('{"a":[1,2]}', "plain text")
    rows = df.select(coercion.coerce(F.col("value"), declared_type("super")).cast("string").alias("c")).collect()
    assert [r.c for r in rows] == ['{"a":[1,2]}', "plain text"]


def test_fields_split_at_the_exact_delimiter_and_merge():
    fields = fields_from_specs(["my_asn:int", "a:int", "asn:int", "b:int", "A:bigint"])
    assert [(f.name, f.type_text, f.scope) for f in fields] == [
        ("my_asn", "int", "outer"), ("a", "int", "outer"), ("asn", "int", "outer"), ("b", "int", "property"),
    ]
    assert {f.scope for f in fields_from_specs(["a:int", "b:int"])} == {"outer"}


def test_source_key_rename(texts):
    fields = [projection.FieldSpec("user_id", "int", "outer", "uid")]
    assert projection.project(texts('{"event":"a","uid":"5"}'), fields).first().user_id == 5


def test_inferred_schema_merges_rows_and_reports_skipped(texts):
    df = texts('{"event":"a","n":1,"o":{"x":1}}', '{"event":"a","n":1.5,"o":{"y":"t"},"z":null}', '{"event":"a","q":1,"q":2}', "bad")
    rows = {r.event: r for r in schema.infer_schemas(routing.tag(df)).collect()}
    assert rows["a"].rows == 3 and rows["a"].rows_skipped == 1
    found = schema.struct_of(rows["a"].schema_ddl)
    assert found.names == ["event", "n", "o", "z"]
    assert found["o"].dataType.names == ["x", "y"]
    flat = schema.parse_flatten(df.where(F.col("value").contains('"o"')), found)
    assert flat.columns == ["event", "n", "o", "z"]
    assert '"name":"event"' in schema.schema_json(flat)


def test_classified_columns(texts):
    df = routing.tag(texts('{"event":"a","n":1,"o":{"x":1}}', '{"event":"a","n":"t","l":[1]}'))
    got = {(r.path, r.kind, r.family) for r in schema.classify_columns(df).collect()}
    assert got == {
        ("event", "scalar", "string"), ("n", "scalar", "mixed"), ("o", "struct", "object"), ("o.x", "scalar", "number"),
        ("l", "scalar", "array"),
    }


def _random_record(rng):
    """A record text and what it must become: its outcome and, if routed, its row."""
    event = rng.choice(["aa", "bb", "zz", None, "a\"a", "é"])
    asn = rng.choice([rng.randint(-(2**31), 2**31 - 1), str(rng.randint(0, 9)), None, "x", True, 2**40])
    text = rng.choice(["", "plain", 'q"uo\\te', "żółw\n\t", "😀", None])
    record = {"event": event, "asn": asn, "properties_raw": {"s": text, "n": {"deep": [1, {"event": "aa"}]}}}
    if rng.random() < 0.2:
        del record["properties_raw"]
        text = None
    value = json.dumps(record, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
    if rng.random() < 0.15:
        return value[: rng.randint(1, len(value) - 1)], "quarantined", None
    if event not in ("aa", "bb"):
        return value, "unrouted", None
    number = int(asn) if isinstance(asn, (int, str)) and not isinstance(asn, bool) and str(asn).lstrip("-").isdigit() else None
    fits = number is not None and -(2**31) <= number < 2**31
    return value, "routed", (event, number if fits else None, text)


def test_random_records_match_a_plain_reading(texts):
    rng = random.Random(7)
    cases = [_random_record(rng) for _ in range(600)]
    df = texts(*[value for value, _, _ in cases])
    got = routing.sort_out(df, ["aa", "bb"]).groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in got} == Counter(outcome for _, outcome, _ in cases)
    fields = fields_from_specs(["event:varchar", "asn:int", "s:varchar"])
    rows = projection.project(routing.route(df, ["aa", "bb"]), fields).collect()
    assert Counter(tuple(row) for row in rows) == Counter(row for _, _, row in cases if row)


def test_preview_cuts_cells(texts):
    df = texts("short", "x" * 21, "y" * 20)
    assert [r.value for r in projection.preview_rows(df, ["value"]).collect()] == ["short", "x" * 17 + "...", "y" * 20]
    assert "value: string" in projection.preview_text(df)
