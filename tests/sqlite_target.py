"""SQLite files as targets: they let tests run staging and transaction for real, in one process."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession

from changeflow.sinks.dialects import DIALECTS
from changeflow.sinks.options import Lazy, resolve
from changeflow.sinks.staged import StagedSink
from changeflow.spec import ReplicationSpec

_WAIT_SECONDS = 600


class SqliteSink(StagedSink):
    """Rows are replaced as a whole. Tasks take turns at the file to stage their rows.

    The file must lie where the driver and all executors see it.
    """

    def __init__(
        self, path: Lazy[str], spec: ReplicationSpec, positions_table: str | None = None
    ) -> None:
        super().__init__(spec, DIALECTS["sqlite"], positions_table)
        self.path = path

    def _connect(self) -> sqlite3.Connection:
        return sqlite3.connect(resolve(self.path), timeout=_WAIT_SECONDS, isolation_level=None)

    def _applied(self, spark: SparkSession) -> list[tuple[str, str]]:
        if self.positions_table is None:
            return []
        with closing(self._connect()) as connection:
            return connection.execute(f"SELECT id, val FROM {self.positions_table}").fetchall()

    def _stage(self, rows: DataFrame, stage: str) -> None:
        pk, *others = rows.columns
        columns = ", ".join(f'"{c}"' for c in others)
        with closing(self._connect()) as connection:
            connection.execute(f'CREATE TABLE {stage} ("{pk}" PRIMARY KEY, {columns})')
        marks = ", ".join("?" * len(rows.columns))
        # A task that runs twice puts its rows twice, under the same keys.
        insert = f"INSERT OR REPLACE INTO {stage} VALUES ({marks})"
        path, size = resolve(self.path), self.spec.batch

        def put(part: Iterator[Row]) -> None:
            with closing(sqlite3.connect(path, timeout=_WAIT_SECONDS)) as connection:
                while chunk := [tuple(r) for r in islice(part, size)]:
                    with connection:
                        connection.executemany(insert, chunk)

        rows.foreachPartition(put)

    def _transaction(self, spark: SparkSession, statements: list[str]) -> None:
        with closing(self._connect()) as connection:
            connection.execute("BEGIN IMMEDIATE")
            try:
                for text in statements:
                    connection.execute(text)
                connection.execute("COMMIT")
            except Exception:
                connection.execute("ROLLBACK")
                raise

    def _drop(self, spark: SparkSession, stage: str) -> None:
        with closing(self._connect()) as connection:
            connection.execute(f"DROP TABLE IF EXISTS {stage}")
