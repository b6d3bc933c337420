"""The change log: an append-only table of captured records.

A capture adds its records batch by batch. The log itself numbers the batches, one after the
other, and a record's place is that number, then its id. No clock and no counter of
a stream takes part, so the order neither steps back nor starts over when a host, a clock or a
checkpoint is another.

Records stand in one folder per target, batch and route; a row in the table of batches says that a batch
is whole, and readers go by these rows. A batch that a restart repeats is known by its number
in the stream and a digest of its records: if the log has it already, nothing is added.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.record import digest_of
from changeflow.session import make_folder
from changeflow.spec import ReplicationSpec

BATCHES = "arrived bigint, batch_id bigint, records bigint, digest string"
#: What tells the records of a source apart.
_IDENTITY = ("n", "ms", "event", "key")


def log_schema(spec: ReplicationSpec, documents: bool = False) -> T.StructType:
    if documents:
        payload, raw = ["fields map<string,variant>"], "raw string"
    elif spec.whole_hashes:
        payload, raw = ["fields map<string,string>"], "raw map<string,string>"
    else:
        payload = [f"`{c}` {spec.type_of(c)}" for c in spec.columns]
        raw = "raw map<string,string>"
    return T.StructType.fromDDL(
        ", ".join(
            [
                "target string, shard int, ms bigint, n bigint, key string, pk string",
                "op string, uuid string, error string",
                *payload,
                raw,
                "arrived bigint, route string",
            ]
        )
    )


@dataclass(frozen=True)
class _Batch:
    arrived: int
    batch_id: int | None
    records: int
    digest: str


class LogWriter:
    """Adds batches to a log. There is one writer per log at a time.

    The last batch is looked up when the writer adds its first; from then on it knows it.
    """

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")
        self._last: _Batch | None = None
        self._opened = False

    def add(self, changes: DataFrame, captured: Sequence[tuple[ReplicationSpec, DataFrame]], batch_id: int | None = None) -> int | None:
        """Add what was captured from ``changes`` for each target as one batch; returns its number.

        None, and nothing added, if there are no changes or if the log has the batch already.
        """
        spark = changes.sparkSession
        if not self._opened:
            self._last, self._opened = _last(spark, self.path), True
        records, digest = digest_of(changes, [c for c in _IDENTITY if c in changes.columns])
        last = self._last
        if records == 0 or (batch_id is not None and last and (last.batch_id, last.records, last.digest) == (batch_id, records, digest)):
            return None
        arrived = last.arrived + 1 if last else 1
        for spec, rows in captured:
            # What a broken try left under this number counts for nothing, and is replaced.
            rows.drop("target").write.mode("overwrite").partitionBy("route").parquet(f"{_records(self.path, spec)}/arrived={arrived}")
        self._last = _Batch(arrived, batch_id, records, digest)
        row = spark.createDataFrame([(arrived, batch_id, records, digest)], BATCHES)
        row.coalesce(1).write.mode("append").parquet(_batches(self.path))
        return arrived


def append(captured: DataFrame, path: str, spec: ReplicationSpec) -> int | None:
    """Append captured records to the log as one batch; no shuffle, one file per task and route."""
    return LogWriter(path).add(captured, [(spec, captured)])


def batches(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """One row per whole batch of the log; as a stream, new batches as they are added."""
    # Before the first capture there is nothing to read, but a place to look at.
    make_folder(spark, _batches(path))
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).schema(BATCHES).parquet(_batches(path))


def read(spark: SparkSession, path: str, spec: ReplicationSpec, documents: bool = False) -> DataFrame:
    """All whole batches of one target."""
    root = _records(path, spec)
    make_folder(spark, root)
    rows = spark.read.schema(_stored_schema(spec, documents)).parquet(root)
    whole = F.broadcast(batches(spark, path).select("arrived").distinct())
    return _targeted(rows.join(whole, "arrived", "left_semi"), spec, documents)


def read_batches(
    spark: SparkSession, path: str, spec: ReplicationSpec, arrived: Iterable[int], documents: bool = False
) -> DataFrame:
    """The given batches of one target; only their folders are looked at."""
    root = _records(path, spec)
    folders = [f"{root}/arrived={n}" for n in sorted(arrived)]
    for folder in folders:
        # A batch without records for this target.
        make_folder(spark, folder)
    rows = spark.read.option("basePath", root).schema(_stored_schema(spec, documents)).parquet(*folders)
    return _targeted(rows, spec, documents)


def read_after(
    spark: SparkSession, path: str, spec: ReplicationSpec, watermark: DataFrame, documents: bool = False
) -> DataFrame:
    """The log without the batches that every shard has behind it.

    The bound is a plain value on the column that the log is partitioned by, so those batches are not
    opened. What single shards have behind them is for ``skip_applied``.
    """
    log = read(spark, path, spec, documents)
    # At most one row per shard, and the spec fixes the number of shards.
    own = watermark.where(F.col("target") == spec.target)
    shards, lowest = own.agg(F.count_distinct("shard"), F.min("arrived")).first()
    return log.where(F.col("arrived") >= lowest) if shards == spec.shards else log


def _last(spark: SparkSession, path: str) -> _Batch | None:
    found = batches(spark, path).orderBy(F.desc("arrived")).first()
    return None if found is None else _Batch(**found.asDict())


def _batches(path: str) -> str:
    return f"{path.rstrip('/')}/batches"


def _records(path: str, spec: ReplicationSpec) -> str:
    return f"{path.rstrip('/')}/records/{spec.target}"


def _stored_schema(spec: ReplicationSpec, documents: bool) -> T.StructType:
    return T.StructType([f for f in log_schema(spec, documents).fields if f.name != "target"])


def _targeted(rows: DataFrame, spec: ReplicationSpec, documents: bool) -> DataFrame:
    return rows.withColumn("target", F.lit(spec.target)).select(*log_schema(spec, documents).names)
