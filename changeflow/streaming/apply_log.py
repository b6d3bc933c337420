"""Apply the log to a sink, batch by batch."""

from __future__ import annotations

import logging
import time
import zlib
from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators import delivery
from changeflow.operators.capture import REJECT, local_only, replicated
from changeflow.operators.fold import net_change, net_fields
from changeflow.sinks.base import Sink
from changeflow.sources import log as log_source
from changeflow.spec import UPDATE_REPLICATE, ReplicationSpec

Trigger = dict[str, object]
#: Capture batches that one micro-batch applies at most.
BATCHES_AT_ONCE = 1000


def net_of(log: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Net changes of a log, by what it carries: fields (documents, whole hashes) or columns."""
    if spec.whole_hashes:
        log = log.where(F.col("op") == UPDATE_REPLICATE)
    if "fields" in log.columns:
        return net_fields(log)
    return net_change(log, spec.columns)


def apply_batch(log: DataFrame, spec: ReplicationSpec, sink: Sink) -> None:
    """Fold a batch of replicated log records and write it with its positions.

    Nothing is cached: the log is immutable, and every use of it reads only the
    columns it needs.
    """

    def write() -> None:
        fresh, positions = log, None
        if spec.exactly_once:
            # Asked again for each try: the positions may have moved meanwhile.
            held = sink.watermark(log.sparkSession)
            fresh, positions = delivery.skip_applied(log, held), delivery.advance(own_positions(held, spec), log)
        sink.apply(net_of(fresh, spec), positions)

    with_retries(write, spec)


def own_positions(watermark: DataFrame, spec: ReplicationSpec) -> DataFrame:
    return watermark.where(F.col("target") == spec.target)


def with_retries(write: Callable[[], None], spec: ReplicationSpec) -> None:
    """Try a write again after a pause, until it works or ``max_retries`` are used up.

    A query that stops for that gets the same offsets again when it is restarted, so nothing
    is lost.
    """
    for attempt in count():
        try:
            return write()
        except Exception as error:
            if attempt == spec.max_retries:
                raise
            logging.getLogger(__name__).warning("%s: attempt %d failed: %s", spec.target, attempt + 1, error)
            time.sleep(spec.retry_seconds)


def acks_of(batch: DataFrame, spec: ReplicationSpec, sink: Sink) -> DataFrame:
    """Acknowledgements of an applied batch: what the target has, and what it is not meant for.

    What the target has is what lies at or before its position, read after the write.
    """
    records = replicated(batch)
    if spec.exactly_once:
        records = delivery.applied(records, sink.watermark(batch.sparkSession))
    now = F.current_timestamp()
    return delivery.acks_done(records, now).unionByName(delivery.acks_local(local_only(batch), now))


def query_name(checkpoint: str) -> str:
    """A name that no other replication in this session has."""
    parts = checkpoint.rstrip("/").split("/")
    return f"{'-'.join(parts[-2:])}-{zlib.crc32(checkpoint.encode()):08x}"


def start_apply(
    spark: SparkSession,
    spec: ReplicationSpec,
    log_path: str,
    sink: Sink,
    acks_path: str,
    checkpoint: str,
    documents: bool = False,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Stream the log into a sink.

    A micro-batch takes whole capture batches, in the order of their numbers, never a part of
    one: records of a shard would otherwise reach the watermark out of order.
    Operations that the target is not meant for are acknowledged in the same batch.
    """

    def write(new: DataFrame, batch_id: int) -> None:
        # A row per capture batch, of which a micro-batch takes a bounded number.
        arrived = [r["arrived"] for r in new.select("arrived").distinct().collect()]
        if not arrived:
            return
        log = log_source.read_batches(spark, log_path, spec, arrived, documents).where(F.col("route") != REJECT)
        apply_batch(replicated(log), spec, sink)
        # Named by the batches: whoever applies them again replaces their acknowledgements.
        acks_of(log, spec, sink).write.mode("overwrite").parquet(f"{acks_path}/batch={min(arrived)}-{max(arrived)}")

    return (
        log_source.batches(spark, log_path, stream=True, maxFilesPerTrigger=str(BATCHES_AT_ONCE))
        .writeStream.queryName(query_name(checkpoint))
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{spec.duration_ms} milliseconds"}))
        .start()
    )


def catch_up(
    spark: SparkSession,
    spec: ReplicationSpec,
    log_path: str,
    sink: Sink,
    documents: bool = False,
) -> None:
    """Apply in one batch job whatever the log holds past the sink's watermark."""
    if spec.exactly_once:
        log = log_source.read_after(spark, log_path, spec, sink.watermark(spark), documents)
    else:
        log = log_source.read(spark, log_path, spec, documents)
    apply_batch(replicated(log), spec, sink)
