"""A catalog that is looked at again while a stream runs, and that gives a repeated batch the version it had.

Each batch is bound to one version before it writes anything:

* the catalog is loaded again if the last look is old enough, and a version that was not seen before is saved under its digest;
* the digest is noted for the batch, in one of two slots a source: a streaming query repeats its last batch only;
* a batch that has a note gets the saved version of that note, whatever the catalog says by now, so a repeat writes the same
  tables and columns as the run that failed.

If the metadata source cannot be read, a running stream goes on with the version it has; only the first load must succeed.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import astuple, dataclass, field

from pyspark.sql import SparkSession

from logweir.operators.bounds import collect_metadata
from logweir.operators.projection import FieldSpec
from logweir.sinks.ledger import Slots, load_if_there
from logweir.sources.catalog import EventCatalog

PINNED = "version"

VERSION_DDL = "place int, event string, position int, name string, type_text string, scope string, source_key string"


@dataclass(frozen=True)
class CatalogChange:
    """What a new version brings, for logs."""

    digest: str
    added: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()
    changed: tuple[str, ...] = ()


def catalog_rows(catalog: EventCatalog) -> list[tuple]:
    """The catalog as rows of ``VERSION_DDL``, in its order, which textual routing depends on.

    The shared field list has no event name, an event without fields no field name.
    """
    rows = []
    for place, (event, fields) in enumerate([(None, catalog.shared), *catalog.fields.items()]):
        rows += [(place, event, position, *astuple(spec)) for position, spec in enumerate(fields)]
        if not fields and event is not None:
            rows.append((place, event, 0, None, None, None, None))
    return rows


def catalog_of(rows) -> EventCatalog:
    lists: dict[str | None, list[FieldSpec]] = {None: []}
    for _, event, _, *spec in sorted(rows, key=lambda row: (row[0], row[2])):
        lists.setdefault(event, []).extend([FieldSpec(*spec)] if spec[0] is not None else [])
    fields = {event: tuple(specs) for event, specs in lists.items()}
    shared = fields.pop(None)
    return EventCatalog(fields, shared=shared)


def digest_of(catalog: EventCatalog) -> str:
    rows = sorted(json.dumps(row) for row in catalog_rows(catalog))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def difference(old: EventCatalog | None, new: EventCatalog) -> CatalogChange:
    before = old.fields if old else {}
    return CatalogChange(
        digest_of(new),
        tuple(sorted(new.fields.keys() - before.keys())),
        tuple(sorted(before.keys() - new.fields.keys())),
        tuple(sorted(name for name in new.fields.keys() & before.keys() if new.fields[name] != before[name])),
    )


@dataclass
class VersionedCatalog:
    """``load`` reads the catalog as it is now; ``root`` is a folder that outlives the stream, as its checkpoint does."""

    spark: SparkSession
    load: Callable[[], EventCatalog]
    root: str
    every_seconds: float = 0.0
    on_change: Callable[[CatalogChange], None] = lambda change: None
    on_trouble: Callable[[str], None] = print
    clock: Callable[[], float] = time.monotonic
    _current: EventCatalog | None = field(default=None, init=False)
    _looked: float = field(default=0.0, init=False)

    def for_batch(self, source_id: str, batch_id: int) -> EventCatalog:
        pins = Slots(self.spark, f"{self.root}/pins/source_id={source_id}")
        pinned = pins.get(PINNED, batch_id)
        if pinned is not None:
            return self.current if self._current and digest_of(self._current) == pinned else self.saved(pinned)
        catalog = self.refreshed()
        pins.put(PINNED, batch_id, digest_of(catalog))
        return catalog

    @property
    def current(self) -> EventCatalog:
        return self._current or self.refreshed()

    def refreshed(self) -> EventCatalog:
        """The catalog as of now, or as of the last look if that was less than ``every_seconds`` ago."""
        if self._current and self.clock() - self._looked < self.every_seconds:
            return self._current
        try:
            new = self.load()
        except Exception as err:
            if self._current is None:
                raise
            self.on_trouble(f"warning: the catalog could not be read again, its last version stays: {err}")
            new = self._current
        self._looked = self.clock()
        if self._current is None or digest_of(new) != digest_of(self._current):
            change = difference(self._current, new)
            self._save(new, change.digest)
            self.on_change(change)
            self._current = new
        return self._current

    def saved(self, digest: str) -> EventCatalog:
        frame = self.spark.read.schema(VERSION_DDL).json(self._path(digest))
        return catalog_of(collect_metadata(frame, "the saved catalog"))

    def _path(self, digest: str) -> str:
        return f"{self.root}/versions/{digest}"

    def _save(self, catalog: EventCatalog, digest: str) -> None:
        """A version is never changed; a folder without all its rows is what a run that died has left."""
        there = load_if_there(lambda: self.spark.read.schema(VERSION_DDL).json(self._path(digest)))
        if there is None or digest_of(catalog_of(there.collect())) != digest:
            rows = self.spark.createDataFrame(catalog_rows(catalog), VERSION_DDL).coalesce(1)
            rows.write.mode("overwrite").json(self._path(digest))


def catalog_for(catalog: EventCatalog | VersionedCatalog, source_id: str, batch_id: int) -> EventCatalog:
    return catalog.for_batch(source_id, batch_id) if isinstance(catalog, VersionedCatalog) else catalog
