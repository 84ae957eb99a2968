"""Schemas over several batches: the ``events`` table as two batches that write the same keys in different ways."""

from pyspark.sql import functions as F

from logweir.operators.history import SchemaHistory, case_variants
from logweir.registry import register
from logweir.registry.inputs import table
from logweir.sinks.workdir import new_folder

MIDDLE = "2024-01-16 00:00:00"

# In the first batch amounts are whole, ``a`` is a flag and ``k`` a number; in the second one amounts have cents, ``A`` is a
# text, and ``K`` is a text too.
WANTED_SQL = """
select event_type as event, path, type, spellings, count(*) as rows, cast(0 as bigint) as first_batch,
  cast(1 as bigint) as last_batch
from events, (values ('event', 'string', 'event'), ('amount', 'decimal(21,2)', 'amount'), ('a', 'string', 'A,a'),
  ('properties_raw', 'struct', 'properties_raw'),
  ('properties_raw.k', 'string', 'properties_raw.K,properties_raw.k')) as t(path, type, spellings)
group by event_type, path, type, spellings
"""


def batches(spark, sf_dir):
    # a compact file has few row groups to read side by side, and each of its rows becomes a text to parse
    wanted = table(spark, sf_dir, "events").select("ts", "event_type", "value", "props")
    events = wanted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    k = F.get_json_object("props", "$.k")
    head = F.concat(F.lit('{"event":"'), "event_type", F.lit('","amount":'))
    whole = F.concat(head, F.floor("value").cast("string"), F.lit(',"a":true,"properties_raw":{"k":'), k, F.lit("}}"))
    cents = F.concat(
        head, F.col("value").cast("decimal(12,2)").cast("string"), F.lit(',"A":"yes","properties_raw":{"K":"'), k, F.lit('"}}')
    )
    middle = F.lit(MIDDLE).cast("timestamp_ntz")
    tagged = F.col("event_type").alias("event")
    return [
        events.where(F.col("ts") < middle).select(tagged, whole.alias("value")),
        events.where(F.col("ts") >= middle).select(tagged, cents.alias("value")),
    ]


def _history(spark, sf_dir, order=(0, 1)):
    history = SchemaHistory(spark, new_folder(spark, "schema-history"))
    parts = batches(spark, sf_dir)
    for batch_id in order:
        history.record(parts[batch_id], "s", batch_id)
    return history.schemas("s")


@register(WANTED_SQL)
def schema_history(spark, sf_dir):
    """Types widen and spellings add up from batch to batch."""
    return _history(spark, sf_dir).withColumn("spellings", F.array_join("spellings", ","))


@register(WANTED_SQL)
def schema_history_replay(spark, sf_dir):
    """A repeated batch counts once."""
    return _history(spark, sf_dir, (0, 0, 1, 1, 1)).withColumn("spellings", F.array_join("spellings", ","))


@register(f"select event, path, spellings from ({WANTED_SQL}) where contains(spellings, ',')")
def schema_case_variants(spark, sf_dir):
    found = case_variants(_history(spark, sf_dir))
    return found.select("event", "path", F.array_join("spellings", ",").alias("spellings"))
