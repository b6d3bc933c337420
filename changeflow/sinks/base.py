"""What every sink offers to the apply step."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class Sink(Protocol):
    """``transactional`` says that a batch that fails leaves nothing behind; True where absent."""

    def watermark(self, spark: SparkSession) -> DataFrame:
        """Last applied position per shard: ``target, shard, arrived, ms, n``."""

    def apply(self, net: DataFrame, positions: DataFrame | None) -> None:
        """Write net changes and their positions; raise if that did not work.

        Where the store has transactions both become visible together. Where it
        has none, positions go last, so a broken batch is written again. A position that the
        target holds never goes down. No positions are given for at-least-once delivery.
        """
