"""Delivery: exactly-once positions and acknowledgements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.record import ack_key, position, positioned
from changeflow.spec import ACK_TTL_SECONDS, LOCAL_OPERATIONS

WATERMARK = "target string, shard int, arrived bigint, ms bigint, n bigint"
ACKS = (
    "ack_key string, key string, uuid string, status string, error string, "
    "ack_ts timestamp, expires_at timestamp"
)
_SHARD = ["target", "shard"]


def skip_applied(log: DataFrame, watermark: DataFrame) -> DataFrame:
    """Records past the last applied position of their shard.

    The watermark has one row per shard, and a spec fixes the number of shards,
    so it is small whatever the log holds.
    """
    return _beside(log, watermark).where(~_reached()).select(*log.columns)


def applied(log: DataFrame, watermark: DataFrame) -> DataFrame:
    """The other records: those that the target has."""
    return _beside(log, watermark).where(_reached()).select(*log.columns)


def _beside(log: DataFrame, watermark: DataFrame) -> DataFrame:
    held = positioned(watermark).select(*_SHARD, position().alias("_applied"))
    return positioned(log).join(F.broadcast(held), _SHARD, "left")


def _reached() -> Column:
    return F.col("_applied").isNotNull() & (position() <= F.col("_applied"))


def positions(log: DataFrame) -> DataFrame:
    """Last position per shard; skipped records count as seen."""
    return (
        positioned(log).groupBy(*_SHARD)
        .agg(F.max(position()).alias("last"))
        .select(*_SHARD, "last.*")
    )


def advance(watermark: DataFrame, log: DataFrame) -> DataFrame:
    """The watermark once the batch is in; it never moves back, also where the batch came before."""
    return positions(positioned(watermark).unionByName(positions(log)))


def _acks(records: DataFrame, status: Column, error: Column, at: Column) -> DataFrame:
    return records.where(F.col("uuid").isNotNull()).select(
        ack_key(F.col("key"), F.col("uuid")).alias("ack_key"),
        "key",
        "uuid",
        status.alias("status"),
        error.cast("string").alias("error"),
        at.alias("ack_ts"),
        (at + F.expr(f"INTERVAL {ACK_TTL_SECONDS} SECONDS")).alias("expires_at"),
    )


def acks_done(records: DataFrame, at: Column) -> DataFrame:
    """One ``done`` for each record that asked for it and is in the target."""
    return _acks(records, F.lit("done"), F.lit(None), at)


def acks_local(records: DataFrame, at: Column) -> DataFrame:
    """The same at capture, for operations that do not go to the target."""
    return acks_done(records.where(F.col("op").isin(*LOCAL_OPERATIONS)), at)


def acks_failed(records: DataFrame, at: Column, error: Column | None = None) -> DataFrame:
    """One ``failed`` with its reason for each record that asked for it."""
    return _acks(records, F.lit("failed"), F.col("error") if error is None else error, at)


def ack_status(requests: DataFrame, acks: DataFrame, now: Column) -> DataFrame:
    """Status of each ``(key, uuid)`` asked for.

    The latest acknowledgement counts: an expired one reads ``expired``, none at
    all ``pending``.
    """
    latest = (
        acks.groupBy("key", "uuid")
        .agg(F.max(F.struct("ack_ts", "expires_at", "status", "error")).alias("last"))
        .select("key", "uuid", "last")
    )
    live = F.col("last.expires_at") > now
    return requests.join(latest, ["key", "uuid"], "left").select(
        *requests.columns,
        F.when(F.col("last").isNull(), F.lit("pending"))
        .when(live, F.col("last.status"))
        .otherwise(F.lit("expired"))
        .alias("status"),
        F.when(live, F.col("last.error")).alias("error"),
    )
