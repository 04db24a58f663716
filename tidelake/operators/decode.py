"""From raw messages to typed rows: header, envelope, split, flattening, payloads."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.keys import attribute_hash
from tidelake.operators.state import latest_state
from tidelake.plans.spec import ENTITIES, EntitySpec

HEADER_BYTES = 5


def strip_wire_header(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds schema_id and payload (the value without its header of a zero byte and a 4-byte
    schema id).  Null values stay null; shorter ones have neither."""
    v = F.col(value)
    whole = F.octet_length(v) >= HEADER_BYTES
    return messages.withColumn("schema_id", F.when(whole, F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("long"))).withColumn(
        "payload", F.when(whole, F.expr(f"substring({value}, {HEADER_BYTES + 1})"))
    )


def decode_envelope(messages: DataFrame, schema: str, payload: str = "payload", into: str = "envelope") -> DataFrame:
    """Adds the payload as a struct; what cannot be read becomes nulls inside it."""
    return messages.withColumn(into, F.from_json(F.col(payload).cast("string"), schema, {"mode": "PERMISSIVE"}))


class Classified(NamedTuple):
    good: DataFrame
    tombstones: DataFrame
    undecodable: DataFrame


def kind_of(required: str, value: str = "value") -> Column:
    """tombstone (no value), undecodable (a required field is null) or good: every row is one of them."""
    return F.when(F.col(value).isNull(), "tombstone").when(F.col(required).isNull(), "undecodable").otherwise("good")


def classify_batch(messages: DataFrame, required: str = "envelope.op", value: str = "value") -> Classified:
    """The three disjoint parts of a batch.  Keep the batch with ``persist`` if all are used."""
    kind = kind_of(required, value)
    return Classified(*(messages.where(kind == k) for k in ("good", "tombstone", "undecodable")))


def to_bronze_changes(good: DataFrame, table: str, key: str | None = None, ingest_ts: Column | None = None) -> DataFrame:
    """Flat change rows with the payloads as JSON and the message's coordinates."""
    key = key or ENTITIES[table].key
    ts = F.current_timestamp() if ingest_ts is None else ingest_ts
    return good.select(
        F.lit(table).alias("source_table"),
        F.coalesce(F.col(f"envelope.after.{key}"), F.col(f"envelope.before.{key}")).cast("long").alias("pk"),
        F.col("envelope.source.lsn").alias("lsn"),
        F.col("envelope.op").alias("op"),
        F.col("envelope.ts_ms").alias("event_ts_ms"),
        F.to_json("envelope.before").alias("before_json"),
        F.to_json("envelope.after").alias("after_json"),
        F.to_json("envelope.source").alias("source_json"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_ts"),
        ts.alias("ingest_ts"),
        F.to_date(ts).alias("ingest_date"),
    )


def to_bronze_pings(good: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Flat pings; the day is that of the device's clock."""
    ts = F.current_timestamp() if ingest_ts is None else ingest_ts
    fields = ("rider_id", "trip_id", "lat", "lon", "speed_kmph", "heading_deg", "accuracy_m", "event_ts")
    return good.select(
        *[F.col(f"ping.{f}") for f in fields], "topic", "partition", "offset", F.col("timestamp").alias("kafka_ts"),
        ts.alias("ingest_ts"), F.to_date("ping.event_ts").alias("event_date"),
    )


def with_images(changes: DataFrame) -> DataFrame:
    """Change rows with their row images as VARIANT (before, after) in place of the JSON texts:
    parsed once, when they are stored.  Fields that no spec knows stay; what is no JSON is null."""
    parsed = {c: F.try_parse_json(f"{c}_json") for c in ("before", "after")}
    return changes.withColumns(parsed).drop("before_json", "after_json")


def _field(spec: EntitySpec, name: str) -> Column:
    """A field of the row image of a change (the old one of a delete); null where it is absent or its type cannot hold it."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return F.try_variant_get(image, f"$.{name}", spec.types[name])


def with_key(changes: DataFrame, spec: EntitySpec) -> DataFrame:
    """Change rows with their images and the entity's key beside them, all else unparsed.  Changes without a key are dropped."""
    changes = changes if "after" in changes.columns else with_images(changes)
    return changes.withColumn(spec.key, _field(spec, spec.key)).where(F.col(spec.key).isNotNull())


def _parsed(changes: DataFrame, spec: EntitySpec) -> DataFrame:
    """The row image of a change as a struct, beside the change's columns."""
    changes = changes if "after" in changes.columns else with_images(changes)
    fields = [_field(spec, f).alias(f) for f in spec.types]
    return changes.withColumn("__row", F.struct(*fields)).where(F.col(f"__row.{spec.key}").isNotNull())


def _typed(spec: EntitySpec) -> list[Column]:
    return [F.expr(f"try_cast(__row.{f} AS timestamp)").alias(f) if f in spec.timestamps else F.col(f"__row.{f}").alias(f) for f in spec.fields]


def parse_changes(changes: DataFrame, spec: EntitySpec) -> DataFrame:
    """Typed rows of an entity with is_deleted, op and lsn.  Changes without a key are dropped."""
    return _parsed(changes, spec).select(*_typed(spec), (F.col("op") == "d").alias("is_deleted"), "op", "lsn")


def latest_changes(changes: DataFrame, spec: EntitySpec, key: str | None = None) -> DataFrame:
    """``latest_state`` of what ``parse_changes`` gives, by the entity's key: of a key's changes only
    the newest is parsed, as parsing an image costs more than all the rest.  key: a column that has the key
    already; a log that is not stored then makes its images once, not once more to look for keys in them."""
    keyed = with_key(changes, spec) if key is None else changes.withColumnRenamed(key, spec.key)
    return parse_changes(latest_state(keyed, [spec.key]), spec)


def parse_dim_changes(changes: DataFrame, spec: EntitySpec) -> DataFrame:
    """As ``parse_changes``, with valid_from and attr_hash for history.

    A version begins when its row was written; a delete begins at the change's own time, as
    its old row image still carries the time of the write before.
    """
    at = F.when(F.col("op") == "d", F.timestamp_millis("event_ts_ms")).otherwise(F.expr("try_cast(__row.updated_at AS timestamp)"))
    rows = _parsed(changes, spec).select(*_typed(spec), (F.col("op") == "d").alias("is_deleted"), "op", "lsn", at.alias("valid_from"))
    return rows.withColumn("attr_hash", attribute_hash([*spec.tracked, "is_deleted"]))


#: A change line of logical decoding (fixed format): table, operation, first bigint column.
_WAL = r"^table public\.(\w+): (INSERT|UPDATE|DELETE): (?:.*? )?(\w+)\[bigint\]:(\d+)"


def parse_wal_text(lines: DataFrame, keys: Mapping[str, str] | None = None) -> DataFrame:
    """(source_table, op, pk, lsn) from lines (lsn, data) of logical decoding.

    Transaction marks, unknown tables and lines whose first bigint column is not the table's
    key are skipped.
    """
    keys = keys or {t: e.key for t, e in ENTITIES.items()}
    found = lines.select("lsn", *[F.regexp_extract("data", _WAL, i).alias(n) for i, n in enumerate(("source_table", "op", "column", "pk"), 1)])
    known = F.create_map(*[F.lit(x) for pair in keys.items() for x in pair])
    return found.where(F.element_at(known, F.col("source_table")) == F.col("column")).select("source_table", "op", F.col("pk").cast("long").alias("pk"), "lsn")
