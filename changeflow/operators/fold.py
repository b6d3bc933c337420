"""Folds of a log to one row per key.

Order within a batch matters only through the last record of a key and through
deletes that lie before it, so replaying a batch is one aggregation. Each fold
combines before its shuffle: a hot key leaves a task as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.record import position, positioned, without_control
from changeflow.spec import (
    DELETE_LOCAL,
    DELETE_REPLICATE,
    UPDATE_REPLICATE,
    ReplicationSpec,
)


def net_change(log: DataFrame, columns: tuple[str, ...], key: str = "pk") -> DataFrame:
    """Last operation per key, with its columns.

    ``reset`` tells that the key was deleted before its last update, so whatever
    the target holds for it must not survive.
    """
    # Ids are unique within a key, so the rest of the struct never decides.
    last = F.max(F.struct("arrived", "ms", "n", "op", *columns)).alias("last")
    return (
        positioned(log).groupBy(key)
        .agg(last, F.bool_or(F.col("op") == DELETE_REPLICATE).alias("deleted"))
        .select(
            key,
            "last.*",
            (F.col("deleted") & (F.col("last.op") == UPDATE_REPLICATE)).alias("reset"),
        )
    )


def net_fields(changes: DataFrame, key: str = "pk") -> DataFrame:
    """Per key what a series of field-wise updates and deletes comes to.

    ``changes`` has ``op`` (``~`` deletes) and a map column ``fields`` of any
    value type. Result: ``op`` of the last record, ``reset`` as in
    :func:`net_change`, and ``fields``, the last value of each field that no
    later delete took away.
    """
    deletes = F.col("op") == DELETE_REPLICATE
    # A record without fields still makes one entry, with a null field; so does a delete.
    entries = positioned(changes).select(
        key,
        "arrived",
        "ms",
        "n",
        deletes.alias("deletes"),
        F.posexplode_outer(F.when(~deletes, F.col("fields"))).alias("at", "field", "value"),
    )
    last = F.max_by(F.struct("arrived", "ms", "n", "value"), F.struct("arrived", "ms", "n", "at"))
    per_field = entries.groupBy(key, "field", "deletes").agg(last.alias("last"))
    at = F.struct("last.arrived", "last.ms", "last.n")
    per_key = per_field.groupBy(key).agg(
        F.max(F.when(F.col("deletes"), at)).alias("deleted_at"),
        F.max(at).alias("seen_at"),
        F.collect_list(
            F.when(F.col("field").isNotNull(), F.struct("field", "last.value", at.alias("at")))
        ).alias("entries"),
    )
    alive = F.filter(
        "entries", lambda e: F.col("deleted_at").isNull() | (e["at"] > F.col("deleted_at"))
    )
    gone = F.coalesce(F.col("seen_at") == F.col("deleted_at"), F.lit(False))
    return per_key.select(
        key,
        "seen_at.*",
        F.when(gone, DELETE_REPLICATE).otherwise(UPDATE_REPLICATE).alias("op"),
        (F.col("deleted_at").isNotNull() & ~gone).alias("reset"),
        F.map_from_entries(F.transform(alive, lambda e: F.struct(e["field"], e["value"]))).alias("fields"),
    )


def mapped_as_fields(spec: ReplicationSpec) -> Column:
    """Mapped columns as a hash of strings."""
    pairs = [x for c in spec.columns for x in (F.lit(c), F.col(c).cast("string"))]
    return F.create_map(*pairs)


def last_image(records: DataFrame) -> DataFrame:
    """Last whole hash per source key over all four operations.

    ``fields`` is null where the last operation removes the key from the source.
    """
    removed = F.col("op").isin(DELETE_REPLICATE, DELETE_LOCAL)
    return (
        positioned(records).select("key", "arrived", "ms", "n", F.when(~removed, F.col("fields")).alias("fields"))
        .groupBy("key")
        .agg(F.max_by(F.struct("fields"), position()).alias("last"))
        .select("key", without_control(F.col("last.fields")).alias("fields"))
    )
