"""The four ready-made replications: hashes or documents, behind or through."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.functions.record import digest_of
from changeflow.operators import delivery, through
from changeflow.operators.fold import net_change, net_fields
from changeflow.session import is_complete, stored
from changeflow.sinks.base import Sink
from changeflow.sinks.table import TableSink
from changeflow.spec import (
    DEFAULT_BATCH,
    DEFAULT_DURATION_MS,
    DEFAULT_RETRY_SECONDS,
    DOCUMENT_EVENTS,
    HASH_EVENTS,
    STAGED_EVENTS,
    ReplicationSpec,
)
from changeflow.streaming.apply_log import catch_up, own_positions, query_name, start_apply, with_retries
from changeflow.streaming.capture_log import start_capture


@dataclass
class _Behind:
    """Capture into a log and apply from it, as two streams that need not keep pace.

    ``folder`` holds the log, the acknowledgements and the two checkpoints. A
    ``version`` starts over with a folder of its own.
    """

    spec: ReplicationSpec
    sink: Sink
    name: str
    folder: str
    version: str = "1"

    documents = False

    @property
    def root(self) -> str:
        return f"{self.folder.rstrip('/')}/{self.name}-{self.version}"

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    @property
    def acks_path(self) -> str:
        return f"{self.root}/acks"

    def capture(self, changes: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return start_capture(
            changes, self.spec, self.log_path, f"{self.root}/capture", self.documents, trigger
        )

    def apply(self, spark: SparkSession, trigger: dict | None = None) -> StreamingQuery:
        return start_apply(
            spark,
            self.spec,
            self.log_path,
            self.sink,
            self.acks_path,
            f"{self.root}/apply",
            self.documents,
            trigger,
        )

    def run_once(self, changes: DataFrame) -> None:
        """Capture and apply what is there now, then stop."""
        now = {"availableNow": True}
        self.capture(changes, now).awaitTermination()
        self.apply(changes.sparkSession, now).awaitTermination()

    def catch_up(self, spark: SparkSession) -> None:
        catch_up(spark, self.spec, self.log_path, self.sink, self.documents)


class WriteBehind(_Behind):
    """Hashes to a target, asynchronously.

    ``batch`` and ``duration_ms`` bound a micro-batch by the rate limit of the
    source and by the trigger, see :func:`changeflow.write_behind`.
    """


class DocumentWriteBehind(_Behind):
    """JSON documents to a target, asynchronously."""

    documents = True


def write_behind(
    keys_prefix: str,
    mappings: dict[str, str],
    sink: Callable[[ReplicationSpec], Sink],
    target: str,
    pk: str,
    name: str,
    folder: str,
    version: str = "1",
    types: dict[str, str] | None = None,
    on_failed_retry_interval: float = DEFAULT_RETRY_SECONDS,
    batch: int = DEFAULT_BATCH,
    duration: int = DEFAULT_DURATION_MS,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    event_types: tuple[str, ...] = HASH_EVENTS,
    exactly_once: bool = True,
    shards: int = 16,
    max_retries: int | None = None,
) -> WriteBehind:
    """Replicate hashes under ``keys_prefix:`` to ``target``."""
    spec = ReplicationSpec(
        target=target,
        pk=pk,
        keys_prefix=keys_prefix,
        mappings=mappings,
        types=types or {},
        event_types=tuple(event_types),
        transform=transform,
        shards=shards,
        exactly_once=exactly_once,
        batch=batch,
        duration_ms=duration,
        retry_seconds=on_failed_retry_interval,
        max_retries=max_retries,
    )
    return WriteBehind(spec, sink(spec), name, folder, version)


def document_write_behind(
    keys_prefix: str,
    sink: Callable[[ReplicationSpec], Sink],
    target: str,
    pk: str,
    name: str,
    folder: str,
    version: str = "1",
    on_failed_retry_interval: float = DEFAULT_RETRY_SECONDS,
    batch: int = DEFAULT_BATCH,
    duration: int = DEFAULT_DURATION_MS,
    event_types: tuple[str, ...] = DOCUMENT_EVENTS,
    exactly_once: bool = True,
    shards: int = 16,
    max_retries: int | None = None,
) -> DocumentWriteBehind:
    """Replicate JSON documents under ``keys_prefix:`` to ``target``, field by field."""
    spec = ReplicationSpec(
        target=target,
        pk=pk,
        keys_prefix=keys_prefix,
        event_types=tuple(event_types),
        shards=shards,
        exactly_once=exactly_once,
        batch=batch,
        duration_ms=duration,
        retry_seconds=on_failed_retry_interval,
        max_retries=max_retries,
    )
    return DocumentWriteBehind(spec, sink(spec), name, folder, version)


@dataclass
class WriteThrough:
    """Staged hash writes: target first, source only if that worked.

    ``source`` is the source table in ``fields`` mode, keyed by ``key``. The target must take
    a batch as a whole or not at all. ``folder`` holds the outcome of each batch and its
    acknowledgements; a batch that comes again is not decided again.
    """

    spec: ReplicationSpec
    sink: Sink
    source: TableSink
    folder: str | None = None

    def __post_init__(self) -> None:
        if not getattr(self.sink, "transactional", True):
            raise ValueError("write-through needs a target that takes a batch as a whole")

    @property
    def acks_path(self) -> str:
        return f"{self.folder.rstrip('/')}/acks"

    def decide(self, staged: DataFrame, current: DataFrame, target_up: bool = True) -> DataFrame:
        writes = through.select_staged(staged, self.spec)
        return through.decide(writes, current, self.spec, target_up)

    def net(self, log: DataFrame) -> DataFrame:
        return net_change(log, self.spec.columns)

    def start(self, staged: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        """Write a stream of staged records through; the acknowledgements are in ``acks_path``."""
        checkpoint = f"{self.folder.rstrip('/')}/checkpoint"
        return (
            staged.writeStream.queryName(query_name(checkpoint))
            .foreachBatch(lambda batch, batch_id: self.commit(batch, batch_id) and None)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{self.spec.duration_ms} milliseconds"}))
            .start()
        )

    def commit(self, staged: DataFrame, batch_id: int | None = None) -> DataFrame:
        """Write a batch of staged records; returns its acknowledgements.

        If the target refuses the batch nothing of it is replicated and every
        record meant for it fails; writes to the source alone still count. Batches rank in the
        order of their commits, by a number that goes on from the positions of target and source,
        whatever ids they hold. A numbered batch whose records were committed under this number
        before leaves what it left then; other records under an old number are another batch.
        """
        spark = staged.sparkSession
        if batch_id is not None and self.folder is None:
            raise ValueError("numbered batches need a folder for their outcomes")
        name = None
        if batch_id is not None:
            records, digest = digest_of(staged, staged.columns)
            name = f"{batch_id:012d}-{records}-{hashlib.sha256(digest.encode()).hexdigest()[:32]}"
        number = F.lit(self._next_number(spark)).cast("bigint").alias("arrived")
        # The source as it was before the batch, unless the outcome is known already.
        current = self.source.read(spark)
        decided = self._outcome(spark, name, "up", lambda: self.decide(staged, current).select("*", number))
        failure = None
        refused = name is not None and is_complete(spark, self._outcome_path(name, "down"))
        if not refused:
            try:
                with_retries(lambda: self._replicate(through.replicated_log(decided)), self.spec)
            except Exception as error:
                refused, failure = True, str(error)
        if refused:
            def down() -> DataFrame:
                found = self.decide(staged, current, target_up=False)
                reason = F.when(F.col("error") == through.TARGET_DOWN, F.lit(failure)).otherwise(F.col("error"))
                return found.withColumn("error", reason).select("*", number)

            decided = self._outcome(spark, name, "down", down)
        changes = through.source_changes(decided)
        net = net_fields(changes, "key").withColumnRenamed("key", "pk")
        own = net.select(F.lit(self.source.spec.target).alias("target"), self.source.spec.shard(F.col("pk")).alias("shard"), "*")
        held = own_positions(self.source.watermark(spark), self.source.spec)
        fresh = delivery.skip_applied(own, held).drop("target", "shard")
        self.source.apply(fresh, delivery.advance(held, own))
        done = delivery.acks_done(decided.where("done"), F.current_timestamp())
        failed = delivery.acks_failed(decided.where(~F.col("done")), F.current_timestamp())
        given = done.unionByName(failed)
        if self.folder is None:
            return given
        first = decided.select("arrived").first()
        path = f"{self.acks_path}/batch={'none' if first is None else first['arrived']}"
        given.write.mode("overwrite").parquet(path)
        return spark.read.schema(given.schema).parquet(path)

    def _next_number(self, spark: SparkSession) -> int:
        """One more than any batch that target or source have; both rise only."""
        held = self.sink.watermark(spark).select("target", "arrived").where(F.col("target") == self.spec.target)
        both = held.union(self.source.watermark(spark).select("target", "arrived"))
        return (both.agg(F.max("arrived")).first()[0] or 0) + 1

    def _replicate(self, log: DataFrame) -> None:
        fresh, positions = log, None
        if self.spec.exactly_once:
            held = own_positions(self.sink.watermark(log.sparkSession), self.spec)
            fresh, positions = delivery.skip_applied(log, held), delivery.advance(held, log)
        self.sink.apply(self.net(fresh), positions)

    def _outcome_path(self, name: str, kind: str) -> str:
        return f"{self.folder.rstrip('/')}/decided/{name}-{kind}"

    def _outcome(self, spark: SparkSession, name: str | None, kind: str, decide: Callable[[], DataFrame]) -> DataFrame:
        """The decided batch from the folder, decided and written there if it is not yet."""
        if name is None:
            return stored(decide(), "decided")
        path = self._outcome_path(name, kind)
        if not is_complete(spark, path):
            decide().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


class DocumentWriteThrough(WriteThrough):
    """Staged documents: target first, source only if that worked."""

    def decide(self, staged: DataFrame, current: DataFrame, target_up: bool = True) -> DataFrame:
        writes = through.select_staged(staged, self.spec)
        return through.decide_documents(writes, self.spec, target_up)

    def net(self, log: DataFrame) -> DataFrame:
        return net_fields(log)


def write_through(
    keys_prefix: str,
    mappings: dict[str, str],
    sink: Callable[[ReplicationSpec], Sink],
    source: TableSink,
    target: str,
    pk: str,
    types: dict[str, str] | None = None,
    exactly_once: bool = True,
    shards: int = 16,
    folder: str | None = None,
) -> WriteThrough:
    """Write hashes staged under ``keys_prefix{key}`` through to ``target``."""
    spec = ReplicationSpec(
        target=target,
        pk=pk,
        keys_prefix=keys_prefix,
        mappings=mappings,
        types=types or {},
        event_types=STAGED_EVENTS,
        shards=shards,
        exactly_once=exactly_once,
        max_retries=0,
    )
    return WriteThrough(spec, sink(spec), source, folder)


def document_write_through(
    keys_prefix: str,
    sink: Callable[[ReplicationSpec], Sink],
    source: TableSink,
    target: str,
    pk: str,
    exactly_once: bool = True,
    shards: int = 16,
    folder: str | None = None,
) -> DocumentWriteThrough:
    """Write documents staged under ``keys_prefix{key}`` through to ``target``."""
    spec = ReplicationSpec(
        target=target,
        pk=pk,
        keys_prefix=keys_prefix,
        event_types=DOCUMENT_EVENTS,
        shards=shards,
        exactly_once=exactly_once,
        max_retries=0,
    )
    return DocumentWriteThrough(spec, sink(spec), source, folder)
