"""Apply net changes to target state.

``target`` is a table keyed by ``spec.pk``, ``net`` one row per key as made in
:mod:`changeflow.operators.fold`. Both sides are unique per key, so the joins
have no hot keys to spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.documents import overlaid
from changeflow.spec import DELETE_REPLICATE, UPDATE_REPLICATE, ReplicationSpec


def delete(target: DataFrame, net: DataFrame, pk: str) -> DataFrame:
    """Target without the deleted keys; deleting an absent key does nothing."""
    gone = net.where(F.col("op") == DELETE_REPLICATE).select(F.col("pk").alias(pk))
    return target.join(gone, pk, "left_anti")


def _changes(net: DataFrame, spec: ReplicationSpec) -> DataFrame:
    return net.select(
        F.col("pk").alias(spec.pk),
        F.col("op").alias("_op"),
        F.col("reset").alias("_reset"),
        *[F.col(c).alias(f"_new_{c}") for c in spec.columns],
    )


def _merged(joined: DataFrame, columns: list[str], spec: ReplicationSpec) -> DataFrame:
    changed = F.col("_op").isNotNull()

    def column(name: str) -> Column:
        if name == spec.pk:
            return F.col(name)
        if name in spec.columns:
            return F.when(changed, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
        return F.when(F.col("_reset"), F.lit(None)).otherwise(F.col(name)).alias(name)

    kept = joined.where(~changed | (F.col("_op") != DELETE_REPLICATE))
    return kept.select(*[column(name) for name in columns])


def upsert_merge(target: DataFrame, net: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Insert new keys, set the mapped columns of known ones, keep their other columns.

    A key that was deleted on the way is a new row: its other columns are null.
    """
    joined = target.join(_changes(net, spec), spec.pk, "full_outer")
    return _merged(joined, target.columns, spec)


def upsert_merge_small(target: DataFrame, net: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """The same result where the changes are few beside the target.

    No outer join: the target is only probed, so Spark can broadcast the changes
    by their measured size and leave the target where it lies. ``net`` is read
    three times: give one that is checkpointed or stored.
    """
    keys = net.select(F.col("pk").alias(spec.pk))
    present = target.select(spec.pk).join(keys, spec.pk, "left_semi")
    updated = _merged(target.join(_changes(net, spec), spec.pk, "left"), target.columns, spec)
    inserted = inserts(net, spec).join(present, spec.pk, "left_anti")
    return updated.unionByName(inserted, allowMissingColumns=True)


def inserts(net: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Rows of the keys whose last operation is an update."""
    return net.where(F.col("op") == UPDATE_REPLICATE).select(
        F.col("pk").alias(spec.pk), *spec.columns
    )


def upsert_replace(target: DataFrame, net: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Insert or replace whole rows: columns outside the mapping become null."""
    untouched = target.join(net.select(F.col("pk").alias(spec.pk)), spec.pk, "left_anti")
    return untouched.unionByName(inserts(net, spec), allowMissingColumns=True)


def merge_fields(target: DataFrame, net: DataFrame, key: str, fields: str = "fields") -> DataFrame:
    """Set the changed fields of documents or hashes one by one, keep the others.

    ``target`` has the columns ``key`` and ``fields`` (a map), ``net`` has ``pk``,
    ``op``, ``reset`` and ``fields``.
    """
    changes = net.select(
        F.col("pk").alias(key),
        F.col("op").alias("_op"),
        F.col("reset").alias("_reset"),
        F.col("fields").alias("_new"),
    )
    joined = target.join(changes, key, "full_outer")
    kept = joined.where(F.col("_op").isNull() | (F.col("_op") != DELETE_REPLICATE))
    merged = (
        F.when(F.col("_op").isNull(), F.col(fields))
        .when(F.col("_reset"), F.col("_new"))
        .otherwise(overlaid(F.col(fields), F.col("_new")))
    )
    return kept.select(key, merged.alias(fields))


def with_prefix(net: DataFrame, prefix: str) -> DataFrame:
    """Net changes addressed to hashes named ``prefix:pk``."""
    return net.withColumn("pk", F.concat_ws(":", F.lit(prefix), F.col("pk")))


def source_state(source: DataFrame, images: DataFrame) -> DataFrame:
    """Source hashes after the batch, from their state before it and the last images."""
    latest = images.select("key", F.col("fields").alias("_image"), F.lit(True).alias("_seen"))
    joined = source.join(latest, "key", "full_outer")
    fields = F.when(F.col("_seen"), F.col("_image")).otherwise(F.col("fields"))
    return joined.select("key", fields.alias("fields")).where(F.col("fields").isNotNull())


def drift(source: DataFrame, target: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Keys whose mapped columns differ between source and target, and how.

    ``source`` has ``pk`` and the mapped columns, ``target`` is keyed by ``spec.pk``.
    """
    left = source.select(
        F.col("pk").alias(spec.pk),
        F.lit(True).alias("_in_source"),
        *[F.col(c).alias(f"_source_{c}") for c in spec.columns],
    )
    right = target.select(spec.pk, F.lit(True).alias("_in_target"), *spec.columns)
    same = F.lit(True)
    for c in spec.columns:
        same = same & F.col(f"_source_{c}").eqNullSafe(F.col(c))
    state = (
        F.when(F.col("_in_target").isNull(), F.lit("source only"))
        .when(F.col("_in_source").isNull(), F.lit("target only"))
        .when(~same, F.lit("different"))
    )
    return (
        left.join(right, spec.pk, "full_outer")
        .select(spec.pk, state.alias("state"))
        .where(F.col("state").isNotNull())
    )
