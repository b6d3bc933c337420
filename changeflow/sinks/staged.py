"""Relational sinks: stage a batch in parallel, then merge it in one transaction."""

from __future__ import annotations

import uuid
from abc import ABC, abstractmethod
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.delivery import WATERMARK
from changeflow.sinks.dialects import GONE, PUT, Dialect
from changeflow.sinks.options import moved_positions, own_positions
from changeflow.spec import DELETE_REPLICATE, UPDATE_REPLICATE, ReplicationSpec


class StagedSink(ABC):
    """``positions_table`` (``id``, ``val``) holds the applied positions, if any are kept."""

    def __init__(
        self, spec: ReplicationSpec, dialect: Dialect, positions_table: str | None = None
    ) -> None:
        if spec.exactly_once and positions_table is None:
            raise ValueError("exactly-once delivery needs a table for the positions")
        self.spec = spec
        self.dialect = dialect
        self.positions_table = positions_table

    def watermark(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(own_positions(self.spec, self._applied(spark)), WATERMARK)

    def apply(self, net: DataFrame, positions: DataFrame | None) -> None:
        spark = net.sparkSession
        # A name of its own: a straggler of an earlier try cannot write into this batch.
        stage = f"cf_{uuid.uuid4().hex[:24]}"
        moved, held = [], set()
        if positions is not None:
            moved, held = moved_positions(self.spec, positions), {name for name, _ in self._applied(spark)}
        try:
            self._stage(self.staged(net), stage)
            self._transaction(spark, self.statements(stage, moved, held))
        finally:
            self._drop(spark, stage)

    def staged(self, net: DataFrame) -> DataFrame:
        """The rows of the staging table."""
        put = F.col("op") == UPDATE_REPLICATE
        return net.select(
            F.col("pk").try_cast(self.spec.type_of(self.spec.pk)).alias(self.spec.pk),
            *self.spec.columns,
            ((F.col("op") == DELETE_REPLICATE) | F.col("reset")).cast("int").alias(GONE),
            put.cast("int").alias(PUT),
        )

    def statements(self, stage: str, moved: Sequence[tuple[str, str]], held: Collection[str] = ()) -> list[str]:
        """Everything that one batch does to the target, in order; ``held`` names the positions that are there."""
        spec, d = self.spec, self.dialect
        out = [
            d.delete(spec.target, stage, spec.pk),
            d.put(spec.target, stage, spec.pk, spec.columns),
        ]
        if moved:
            out += d.positions(self.positions_table, moved, held)
        return out

    @abstractmethod
    def _applied(self, spark: SparkSession) -> list[tuple[str, str]]:
        """Shard names and positions; at most one row per shard."""

    @abstractmethod
    def _stage(self, rows: DataFrame, stage: str) -> None:
        """Write the rows to a new table, in parallel."""

    @abstractmethod
    def _transaction(self, spark: SparkSession, statements: list[str]) -> None:
        """Run all statements or none."""

    @abstractmethod
    def _drop(self, spark: SparkSession, stage: str) -> None:
        """Drop the staging table if it is there."""
