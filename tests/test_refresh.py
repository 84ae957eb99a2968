"""Catalog versions: loaded again while a stream runs, bound to batches, kept for repeats."""

import pytest

from logweir.operators.projection import fields_from_specs
from logweir.sources.catalog import EventCatalog
from logweir.sources.refresh import VersionedCatalog, catalog_of, catalog_rows, difference, digest_of

ONE, TWO = fields_from_specs(["asn:int"]), fields_from_specs(["asn:int", "k:varchar(8)"])


class Source:
    def __init__(self, **events):
        self.events, self.loads = events, 0

    def __call__(self):
        self.loads += 1
        if self.events is None:
            raise OSError("metadata database is away")
        return EventCatalog(dict(self.events))


def versioned(spark, folder, source, **more):
    return VersionedCatalog(spark, source, f"{folder}/catalog", **more)


def test_rows_and_back_keep_order_shared_fields_and_bare_events():
    catalog = EventCatalog({"z": TWO, "ghost": (), "a": ONE}, shared=TWO)
    back = catalog_of(reversed(catalog_rows(catalog)))
    assert back == catalog and list(back.fields) == ["z", "ghost", "a"]
    assert digest_of(EventCatalog({"a": ONE, "z": TWO})) != digest_of(EventCatalog({"z": TWO, "a": ONE}))


def test_new_batches_get_new_versions_and_repeats_their_own(spark, folder):
    source, changes = Source(click=ONE), []
    catalog = versioned(spark, folder, source, on_change=changes.append)
    assert catalog.for_batch("s", 0).event_names == ["click"]
    source.events = {"click": TWO, "view": ONE}
    assert catalog.for_batch("s", 1).fields == {"click": TWO, "view": ONE}
    source.events = {"view": ONE}
    restarted = versioned(spark, folder, source)
    assert restarted.for_batch("s", 1).fields == {"click": TWO, "view": ONE}
    assert restarted.for_batch("s", 2).fields == {"view": ONE}
    assert [(c.added, c.removed, c.changed) for c in changes] == [(("click",), (), ()), (("view",), (), ("click",))]


def test_sources_are_bound_apart(spark, folder):
    source = Source(click=ONE)
    catalog = versioned(spark, folder, source)
    catalog.for_batch("a", 0)
    source.events = {"view": ONE}
    assert catalog.for_batch("b", 0).event_names == ["view"]
    assert catalog.for_batch("a", 0).event_names == ["click"]


def test_the_catalog_is_not_loaded_more_often_than_asked(spark, folder):
    source, now = Source(click=ONE), [0.0]
    catalog = versioned(spark, folder, source, every_seconds=60, clock=lambda: now[0])
    for batch_id, now[0] in enumerate((0.0, 30.0, 59.0, 61.0, 100.0)):
        catalog.for_batch("s", batch_id)
    assert source.loads == 2


def test_a_source_that_is_away_stops_the_start_only(spark, folder):
    source, said = Source(click=ONE), []
    source.events = None
    with pytest.raises(OSError):
        versioned(spark, folder, source).for_batch("s", 0)
    source.events = {"click": ONE}
    catalog = versioned(spark, folder, source, on_trouble=said.append)
    catalog.for_batch("s", 0)
    source.events = None
    assert catalog.for_batch("s", 1).event_names == ["click"] and "away" in said[0]


def test_a_half_written_version_is_written_again(spark, folder):
    source = Source(click=TWO)
    digest = digest_of(source())
    spark.createDataFrame(catalog_rows(EventCatalog({"click": ONE})), "place int, event string, position int, name string, type_text string, scope string, source_key string").write.json(f"{folder}/catalog/versions/{digest}")
    versioned(spark, folder, source).for_batch("s", 0)
    assert versioned(spark, folder, source).saved(digest).fields == {"click": TWO}


def test_differences():
    old, new = EventCatalog({"a": ONE, "b": ONE}), EventCatalog({"b": TWO, "c": ()})
    change = difference(old, new)
    assert (change.added, change.removed, change.changed) == (("c",), ("a",), ("b",))
    assert difference(None, old).added == ("a", "b")
