"""Job configuration: one frozen dataclass, filled from the job's properties."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import SparkSession

from logweir.operators.bounds import collect_metadata
from logweir.operators.catalog import DELIMITER
from logweir.operators.projection import CastRules

# Values of property keys with one of these parts must never be shown.
SECRET_PARTS = ("password", "secret", "role", "user", "token")

# The staging formats a job can name.
STAGING_FORMATS = ("CSV", "CSV GZIP", "JSON", "JSON GZIP")

ON_ERROR = ("fail", "quarantine")
FANOUT = ("staged", "cached")


@dataclass(frozen=True)
class IngestConfig:
    """Everything one ingestion job needs to know.

    ``stream_options`` and ``catalog_options`` go to Spark's readers as they are, so any format works the same way.
    """

    checkpoint_location: str
    trigger_interval: str = "30 seconds"
    available_now: bool = False

    stream_format: str = "kafka"
    stream_options: Mapping[str, str] = field(default_factory=dict, repr=False)
    stream_schema: str | None = None
    stream_path: str | None = None
    starting_offsets: str | None = None
    record_time: str | None = None
    max_offsets_per_trigger: int | None = None
    record_bytes: int | None = None
    consumer_group: str | None = None
    kafka_broker: str | None = None
    topic: str | None = None

    event_types: str = "0,1,2"
    delimiter: str = DELIMITER
    use_json_field_name: bool = False
    missing_outer: str = "null"
    cast_rules: CastRules = CastRules()
    routing_mode: str = "exact"
    trailing_text: str = "ignore"

    target_schema: str = "public"
    target_table: str | None = None
    staging_format: str = "JSON"
    quarantine_location: str | None = None
    unrouted_location: str | None = None
    status_location: str | None = None
    schema_location: str | None = None

    fanout: str = "staged"
    max_concurrent_writes: int = 30
    on_error: str = "fail"
    preview: bool = False

    def __post_init__(self):
        _one_of("fanout", self.fanout, FANOUT)
        _one_of("routing_mode", self.routing_mode, ("exact", "regex"))
        _one_of("on_error", self.on_error, ON_ERROR)
        _one_of("trailing_text", self.trailing_text, ("ignore", "quarantine"))
        _one_of("staging_format", self.staging_format, STAGING_FORMATS)
        _one_of("missing_outer", self.missing_outer, ("null", "drop"))
        if self.on_error == "quarantine" and not self.quarantine_location:
            raise ValueError("on_error='quarantine' needs a quarantine_location")

    @classmethod
    def from_properties(cls, properties: Mapping[str, str], **overrides) -> IngestConfig:
        """From a job properties file: its fixed keys, and any field of this class under its own name.

        Keys that begin with ``stream.`` are reader options. Other keys are for the sink and the catalog source.
        """
        p = {key: unquote(value) for key, value in properties.items()}
        values = {
            "checkpoint_location": p["checkpoint_location"],
            "trigger_interval": p["checkpoint_interval"],
            "kafka_broker": p["kafka_broker"],
            "topic": p["topic"],
            "starting_offsets": p["startingOffsets"],
            "max_offsets_per_trigger": int(p["max_offsets_per_trigger"]),
            "consumer_group": p["consumer_group"],
            "max_concurrent_writes": int(p["thread_max_workers"]),
            "preview": p["disable_msg"].lower() == "false",
            "staging_format": p.get("tempformat") or "JSON",
            "target_schema": p["redshift_schema"],
            "target_table": p.get("target_table"),
            "event_types": p["metadata_event_type"],
        }
        own = {f.name: f.default for f in fields(cls)}
        values.update({key: _like(own[key], text) for key, text in p.items() if key in own and key not in values})
        values["stream_options"] = {key[7:]: text for key, text in p.items() if key.startswith("stream.")}
        values["cast_rules"] = CastRules(p.get("cast_mode", "try"), p.get("width_unit", "bytes"))
        values.update(overrides)
        return cls(**values)


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, got {value!r}")


def _like(default, text: str):
    """Property text as the type of the field's default."""
    if isinstance(default, bool):
        return text.lower() == "true"
    return int(text) if text.isdigit() and not isinstance(default, str) else text


def unquote(text: str) -> str:
    text = text.strip()
    return text[1:-1] if len(text) >= 2 and text[0] == text[-1] and text[0] in "\"'" else text


def redacted(properties: Mapping[str, str]) -> dict[str, str]:
    """The properties as they may appear in a log."""
    return {
        key: "***" if any(part in key.lower() for part in SECRET_PARTS) else value for key, value in properties.items()
    }


def load_properties(spark: SparkSession, path: str) -> dict[str, str]:
    """``key = value`` lines from any file system Spark can read."""
    rows = collect_metadata(spark.read.text(path), "the properties file", max_rows=10_000)
    lines = [row.value.strip() for row in rows]
    pairs = [line.split("=", 1) for line in lines if "=" in line and not line.startswith("#")]
    properties = {key.strip(): unquote(value) for key, value in pairs}
    if not properties:
        raise ValueError(f"no properties found in {path}")
    return properties
