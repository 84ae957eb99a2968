"""Exactly-once appends through the ledger."""

import uuid

import pytest
from pyspark.sql import functions as F

from logweir.config import IngestConfig
from logweir.job import make_sink
from logweir.sinks.ledger import BATCH_MARK, ROW_MARK, LedgerSink, Slots, load_if_there
from logweir.sinks.tables import ConnectorSink


class Failing:
    """A connector that loses its connection after every n-th row, as often as told."""

    def __init__(self, inner, deaths):
        self.inner, self.deaths = inner, list(deaths)

    def load(self, spark, table):
        return self.inner.load(spark, table)

    def append(self, df, table, source_id, batch_id):
        if not self.deaths:
            return self.inner.append(df, table, source_id, batch_id)
        some = self.deaths.pop(0)
        if some:
            self.inner.append(df.where(F.col(ROW_MARK) % some == 0), table, source_id, batch_id)
        raise OSError("connection lost")


def connector(folder):
    return ConnectorSink("parquet", "public", table_option="path", prefix=f"{folder}/")


def values(spark, sink, table="t"):
    return sorted(r.value for r in sink.read(spark, table).collect())


@pytest.mark.parametrize("deaths", [[0], [1], [2], [0, 3, 2, 1], [2, 2, 2]])
def test_a_batch_that_dies_anywhere_is_there_once(spark, folder, deaths):
    batch = spark.range(20, numPartitions=3).select(F.col("id").alias("value"))
    sink = LedgerSink(Failing(connector(folder), deaths), f"{folder}/ledger")
    for _ in deaths:
        with pytest.raises(OSError):
            sink.append(batch, "t", "s", 0)
    for batch_id in (0, 0, 1):
        sink.append(batch, "t", "s", batch_id)
    assert values(spark, sink) == sorted(2 * list(range(20)))


def test_a_repeat_takes_the_staged_rows_not_the_source(spark, texts, folder):
    """Else a source that gives other rows, or the same in another order, would mix two versions of a batch."""
    sink = LedgerSink(Failing(connector(folder), [1]), f"{folder}/ledger")
    with pytest.raises(OSError):
        sink.append(texts("a", "b"), "t", "s", 0)
    sink.append(texts("c"), "t", "s", 0)
    assert values(spark, sink) == ["a", "b"]


def test_sources_and_tables_have_own_ledgers(spark, texts, folder):
    sink = LedgerSink(connector(folder), f"{folder}/ledger")
    for table, source in (("t", "a"), ("t", "b"), ("u", "a"), ("t", "a")):
        sink.append(texts("x"), table, source, 0)
    assert values(spark, sink) == ["x", "x"] and values(spark, sink, "u") == ["x"]
    marks = connector(folder).load(spark, "t").select(BATCH_MARK).collect()
    assert sorted(r[0] for r in marks) == ["a/0", "b/0"]


def test_two_slots_are_enough_and_older_batches_are_refused(spark, texts, folder):
    sink = LedgerSink(connector(folder), f"{folder}/ledger")
    for batch_id in range(5):
        sink.append(texts(str(batch_id)), "t", "s", batch_id)
        sink.append(texts(str(batch_id)), "t", "s", batch_id)
    assert values(spark, sink) == list("01234")
    with pytest.raises(ValueError, match="older"):
        sink.append(texts("2"), "t", "s", 2)
    assert spark.read.parquet(f"{folder}/ledger/t/source_id=s/rows").count() == 2


def test_empty_batches_and_slots(spark, texts, folder):
    sink = LedgerSink(Failing(connector(folder), [0]), f"{folder}/ledger")
    empty = texts("x").limit(0)
    with pytest.raises(OSError):
        sink.append(empty, "t", "s", 0)
    sink.append(empty, "t", "s", 0)
    sink.append(texts("y"), "t", "s", 1)
    assert values(spark, sink) == ["y"]
    slots = Slots(spark, f"{folder}/notes")
    assert slots.get("k", 3) is None
    slots.put("k", 3, "three")
    assert slots.get("k", 3) == "three" and slots.get("k", 4) is None


def test_other_errors_of_the_target_are_not_taken_for_an_empty_one(spark):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        load_if_there(lambda: spark.read.format(f"no.such.{uuid.uuid4().hex}").load())


def test_the_job_makes_a_ledger_on_request(folder):
    config = IngestConfig(checkpoint_location="/tmp/cp")
    files = {"sink_format": "parquet", "sink_table_option": "path", "sink_prefix": f"{folder}/", "sink.compression": "gzip"}
    plain, exact = make_sink(files, config), make_sink({**files, "ledger_location": f"{folder}/ledger"}, config)
    assert isinstance(plain, ConnectorSink) and plain.table_options("t") == {"compression": "gzip", "path": f"{folder}/public.t"}
    assert isinstance(exact, LedgerSink) and exact.target == plain
