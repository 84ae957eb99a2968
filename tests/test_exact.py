"""Values that need more than their text: decimals of any length and semi-structured columns."""

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from logweir.config import IngestConfig
from logweir.operators.projection import exact_places, fields_from_specs, project
from logweir.plans.batch import Batch
from logweir.plans.router import parsed_schema, route_batch
from logweir.sinks.tables import ParquetSink
from logweir.sources.catalog import EventCatalog

FIELDS = fields_from_specs(["asn:int", "d:decimal(38,10)", "s:super", "t:varchar"])


def record(**properties):
    inner = ",".join(f'"{key}":{value}' for key, value in properties.items())
    return f'{{"event":"e","asn":1,"properties_raw":{{{inner}}}}}'


@pytest.mark.parametrize(
    "value, want",
    [
        ("1234567890123456789012345678.0123456789", "1234567890123456789012345678.0123456789"),
        ('"12.5"', "12.5"), ("1e3", "1000"), ("0", "0"), ("-7", "-7"), ("null", None), ("true", "1"), ("{}", None),
        ('"x"', None), ("123456789012345678901234567890", None), ("0.00000000005", "0.0000000001"),
    ],
)
def test_decimals(texts, value, want):
    got = project(texts(record(d=value)), FIELDS).first().d
    assert got == (None if want is None else Decimal(want))


@pytest.mark.parametrize(
    "value, want",
    [
        ('"123"', '"123"'), ("123", "123"), ("null", None), ('{"a":[1,"1",null]}', '{"a":[1,"1",null]}'), ("[]", "[]"),
        ("12345678901234567890.5", "12345678901234567890.5"), ('""', '""'), ("false", "false"),
    ],
)
def test_semi_structured_values(texts, value, want):
    assert project(texts(record(s=value)), FIELDS).select(F.to_json("s").alias("s")).first().s == want


def test_one_value_that_cannot_be_read_leaves_the_others(texts):
    row = project(texts(record(s='{"x":1,"x":2}', d="2.5", t='"t"')), FIELDS).first()
    assert (row.asn, row.s, row.t) == (1, None, "t")
    assert project(texts('{"event":"e","asn":3}', "broken"), FIELDS).select("asn", "d", "s").collect() == [(3, None, None), (None, None, None)]


def test_a_key_wanted_in_both_ways_is_read_as_text_by_the_one_and_exactly_by_the_other(spark, texts, folder):
    catalog = EventCatalog({"a": fields_from_specs(["asn:int", "k:super"]), "b": fields_from_specs(["asn:int", "k:varchar"])})
    config = IngestConfig(checkpoint_location=f"{folder}/checkpoint")
    assert parsed_schema(catalog, config) is None
    df = texts('{"event":"a","asn":1,"properties_raw":{"k":"1"}}', '{"event":"b","asn":2,"properties_raw":{"k":{"x":1}}}')
    sink = ParquetSink(folder)
    route_batch(Batch(df, 0, uuid.uuid4().hex), catalog, sink, config, lambda _: None)
    assert sink.read(spark, "a").select(F.to_json("k").alias("k")).first().k == '"1"'
    assert sink.read(spark, "b").first().k == '{"x":1}'


def test_the_event_key_is_always_text():
    assert exact_places(fields_from_specs(["event:super", "asn:int"])) == frozenset()
    assert exact_places(FIELDS) == {("property", "d"), ("property", "s")}
