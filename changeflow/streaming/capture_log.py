"""Capture a change stream into the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.capture import capture, capture_documents
from changeflow.sources.log import LogWriter
from changeflow.spec import DEFAULT_DURATION_MS, ReplicationSpec
from changeflow.streaming.apply_log import query_name


def start_capture(
    changes: DataFrame,
    specs: ReplicationSpec | Sequence[ReplicationSpec],
    log_path: str,
    checkpoint: str,
    documents: bool = False,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Append a stream of changes to the log, for one target or several.

    A micro-batch is one batch of the log, also over restarts: see
    :class:`changeflow.sources.log.LogWriter`. With several targets a micro-batch is kept for the time of its
    writes, so its source is read once.
    """
    specs = [specs] if isinstance(specs, ReplicationSpec) else list(specs)
    writer, normalise = LogWriter(log_path), capture_documents if documents else capture

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist() if len(specs) > 1 else batch
        try:
            writer.add(kept, [(spec, normalise(kept, spec)) for spec in specs], batch_id)
        finally:
            if len(specs) > 1:
                kept.unpersist()

    pause = min((spec.duration_ms for spec in specs), default=DEFAULT_DURATION_MS)
    return (
        changes.writeStream.queryName(query_name(checkpoint))
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{pause} milliseconds"}))
        .start()
    )
