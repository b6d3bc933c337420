"""From raw change records to normalised log records.

Everything is a chain of column expressions: one scan, no shuffle. Each record
leaves with a ``route``: ``replicate`` goes to the target, ``local`` only
touches the source, ``reject`` is a dead letter with its ``error``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import record as R
from changeflow.functions.documents import document_error, document_fields
from changeflow.spec import DELETE_REPLICATE, UPDATE_REPLICATE, ReplicationSpec

REPLICATE, LOCAL, REJECT = "replicate", "local", "reject"


def select_events(df: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Records under the prefix whose event type is registered."""
    return df.where(
        R.under_prefix(F.col("key"), spec.keys_prefix) & F.col("event").isin(*spec.event_types)
    )


def validate(df: DataFrame) -> DataFrame:
    """Split the control field of hash records into ``op``, ``uuid`` and ``error``."""
    text = R.control(F.col("fields"))
    error = R.operation_error(text)
    if "kind" in df.columns:
        error = F.when(
            F.col("fields").isNotNull() & (F.col("kind") != "hash"), F.lit("not a hash")
        ).otherwise(error)
    return _with_control(df, text, error)


def validate_documents(df: DataFrame) -> DataFrame:
    """The same for documents: present means update, absent means delete.

    Adds the parsed ``fields``.
    """
    parsed = df.select("*", R.once(document_fields(F.col("doc"))).alias("fields"))
    return _with_control(
        parsed,
        R.document_control(F.col("doc")),
        document_error(F.col("doc"), F.col("fields")),
    )


def _with_control(df: DataFrame, text: Column, error: Column) -> DataFrame:
    return df.withColumns(
        {"op": R.operation(text), "uuid": R.ack_uuid(text), "error": error}
    )


def is_replicated(op: Column) -> Column:
    return op.isin(UPDATE_REPLICATE, DELETE_REPLICATE)


def missing_field(spec: ReplicationSpec) -> Column:
    """Name of the first mapped field the record lacks, null if it has them all."""
    return F.coalesce(
        F.lit(None).cast("string"),
        *[F.when(F.col("fields")[s].isNull(), F.lit(s)) for s in spec.fields],
    )


def bad_value(spec: ReplicationSpec) -> Column:
    """Name of the first column whose text does not fit its type, null if all fit."""
    return F.coalesce(
        F.lit(None).cast("string"),
        *[
            F.when(
                F.col("fields")[s].isNotNull()
                & F.col("fields")[s].try_cast(spec.type_of(c)).isNull(),
                F.lit(c),
            )
            for s, c in spec.fields.items()
            if spec.type_of(c) != "string"
        ],
    )


def map_fields(spec: ReplicationSpec) -> list[Column]:
    """Mapped fields as typed target columns, carried by replicated updates only."""
    return [
        F.when(F.col("op") == UPDATE_REPLICATE, F.col("fields")[s].try_cast(spec.type_of(c))).alias(c)
        for s, c in spec.fields.items()
    ]


def no_key_part() -> Column:
    """Complaint about a replicated record whose key has no primary key part."""
    lacking = is_replicated(F.col("op")) & F.col("pk").isNull()
    return F.when(lacking, F.lit("no primary key in the key"))


def record_error(spec: ReplicationSpec) -> Column:
    """First reason to refuse a record: control text, then key, then fields, then values."""
    update = F.col("op") == UPDATE_REPLICATE
    return F.coalesce(
        F.col("error"),
        no_key_part(),
        F.when(update, F.concat(F.lit("missing field "), missing_field(spec))),
        F.when(update, F.concat(F.lit("bad value for "), bad_value(spec))),
    )


def route(op: Column, error: Column) -> Column:
    return (
        F.when(error.isNotNull(), F.lit(REJECT))
        .when(is_replicated(op), F.lit(REPLICATE))
        .otherwise(F.lit(LOCAL))
    )


def normalize(df: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Selected hash records to log records of all three routes.

    Rejects keep their whole ``fields``, so that they can be mended and replayed.
    """
    if spec.transform is not None:
        df = df.transform(spec.transform)
    checked = (
        validate(df)
        .withColumn("pk", R.primary_key(F.col("key")))
        .withColumn("error", record_error(spec))
    )
    return _log_record(checked, spec, map_fields(spec), F.col("fields"))


def normalize_copies(df: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Like :func:`normalize` without a mapping: updates carry every plain field."""
    if spec.transform is not None:
        df = df.transform(spec.transform)
    checked = (
        validate(df)
        .withColumn("pk", R.primary_key(F.col("key")))
        .withColumn("error", record_error(replace(spec, mappings={})))
    )
    plain = F.when(F.col("op") == UPDATE_REPLICATE, R.without_reserved(F.col("fields")))
    return _log_record(checked, spec, [plain.alias("fields")], F.col("fields"))


def normalize_documents(df: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Selected document records to log records, the documents as maps of their fields."""
    checked = (
        validate_documents(df)
        .withColumn("pk", R.primary_key(F.col("key")))
        .withColumn("error", F.coalesce(no_key_part(), F.col("error")))
    )
    return _log_record(checked, spec, [F.col("fields")], F.col("doc"))


def _log_record(
    checked: DataFrame, spec: ReplicationSpec, columns: list[Column], raw: Column
) -> DataFrame:
    rejected = F.col("error").isNotNull()
    return checked.select(
        F.lit(spec.target).alias("target"),
        route(F.col("op"), F.col("error")).alias("route"),
        spec.shard(F.col("pk")).alias("shard"),
        "ms",
        "n",
        "key",
        "pk",
        "op",
        "uuid",
        "error",
        *columns,
        F.when(rejected, raw).alias("raw"),
    )


def capture(df: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Raw change records to log records: select, transform, validate, route, map, cast."""
    selected = select_events(df, spec)
    return normalize_copies(selected, spec) if spec.whole_hashes else normalize(selected, spec)


def capture_documents(df: DataFrame, spec: ReplicationSpec) -> DataFrame:
    return normalize_documents(select_events(df, spec), spec)


def replicated(captured: DataFrame) -> DataFrame:
    return captured.where(F.col("route") == REPLICATE).drop("route", "error", "raw")


def local_only(captured: DataFrame) -> DataFrame:
    return captured.where(F.col("route") == LOCAL).drop("route", "error", "raw")


def dead_letters(captured: DataFrame) -> DataFrame:
    return captured.where(F.col("route") == REJECT).select("target", "ms", "n", "key", "uuid", "error", "raw")
