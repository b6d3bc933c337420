"""Several prefixes of one source to several targets: one capture, and one stream per target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from changeflow.sinks.base import Sink
from changeflow.sources import log as log_source
from changeflow.spec import ReplicationSpec
from changeflow.streaming.apply_log import Trigger, start_apply
from changeflow.streaming.capture_log import start_capture


@dataclass
class FanOut:
    """The running streams: ``capture``, and those of the targets by name."""

    capture: StreamingQuery
    targets: dict[str, StreamingQuery]

    def awaitTermination(self) -> None:  # noqa: N802 - as Spark names it
        """Wait for all streams; the error of one is raised when all have ended."""
        errors = []
        for query in (self.capture, *self.targets.values()):
            try:
                query.awaitTermination()
            except Exception as error:
                errors.append(error)
        if errors:
            raise errors[0]

    def stop(self) -> None:
        for query in (self.capture, *self.targets.values()):
            query.stop()


def start_fan_out(
    changes: DataFrame,
    routes: Sequence[tuple[ReplicationSpec, Sink]],
    folder: str,
    trigger: Trigger,
) -> FanOut:
    """Replicate each prefix to its sink.

    One stream reads the source and writes the log of all targets, batch by batch. Each target has a
    stream of its own that applies and acknowledges from there, with checkpoint, positions and retries of its
    own: one that is down holds up no other. Triggers that end take what is there: first the capture, then
    the targets.
    """
    if len({spec.target for spec, _ in routes}) != len(routes):
        raise ValueError("each target can be named once")
    spark, root, documents = changes.sparkSession, folder.rstrip("/"), "doc" in changes.columns
    capture = start_capture(changes, [spec for spec, _ in routes], log_folder(folder), f"{root}/capture", documents, trigger)
    if {"availableNow", "once"} & set(trigger):
        capture.awaitTermination()
    targets = {
        spec.target: start_apply(
            spark, spec, log_folder(folder), sink, acks_folder(folder, spec), f"{root}/{spec.target}/apply", documents, trigger
        )
        for spec, sink in routes
    }
    return FanOut(capture, targets)


def log_folder(folder: str) -> str:
    return f"{folder.rstrip('/')}/log"


def acks_folder(folder: str, spec: ReplicationSpec) -> str:
    return f"{folder.rstrip('/')}/{spec.target}/acks"


def read_log(spark: SparkSession, folder: str, spec: ReplicationSpec, documents: bool = False) -> DataFrame:
    """All that was captured for one target: replicated, local and rejected records."""
    return log_source.read(spark, log_folder(folder), spec, documents)
