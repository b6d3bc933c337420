"""Relational targets over JDBC."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from changeflow.sinks.dialects import DIALECTS
from changeflow.sinks.options import Lazy, resolve
from changeflow.sinks.staged import StagedSink
from changeflow.spec import ReplicationSpec


@dataclass(frozen=True)
class JdbcConnection:
    """Where a target is; every value may be a function, asked when a batch starts."""

    dialect: str
    url: Lazy[str]
    driver: str
    user: Lazy[str] | None = None
    password: Lazy[str] | None = None
    options: dict[str, str] = field(default_factory=dict)

    def properties(self) -> dict[str, str]:
        out = {"driver": self.driver, **self.options}
        if self.user is not None:
            out["user"] = resolve(self.user)
        if self.password is not None:
            out["password"] = resolve(self.password)
        return out


def mysql(user: Lazy[str], password: Lazy[str], db: Lazy[str]) -> JdbcConnection:
    return JdbcConnection(
        "mysql", lambda: f"jdbc:mysql://{resolve(db)}", "com.mysql.cj.jdbc.Driver", user, password
    )


def postgres(user: Lazy[str], password: Lazy[str], db: Lazy[str]) -> JdbcConnection:
    return JdbcConnection(
        "postgres", lambda: f"jdbc:postgresql://{resolve(db)}", "org.postgresql.Driver", user, password
    )


def oracle(user: Lazy[str], password: Lazy[str], db: Lazy[str]) -> JdbcConnection:
    return JdbcConnection(
        "oracle", lambda: f"jdbc:oracle:thin:@//{resolve(db)}", "oracle.jdbc.OracleDriver", user, password
    )


def mssql(
    user: Lazy[str],
    password: Lazy[str],
    db: Lazy[str],
    server: Lazy[str],
    port: Lazy[int],
    driver: str = "com.microsoft.sqlserver.jdbc.SQLServerDriver",
) -> JdbcConnection:
    def url() -> str:
        return f"jdbc:sqlserver://{resolve(server)}:{resolve(port)};databaseName={resolve(db)}"

    return JdbcConnection("mssql", url, driver, user, password)


def snowflake(
    user: Lazy[str], password: Lazy[str], account: Lazy[str], db: Lazy[str]
) -> JdbcConnection:
    def url() -> str:
        return f"jdbc:snowflake://{resolve(account)}.snowflakecomputing.com/?db={resolve(db)}"

    return JdbcConnection(
        "snowflake", url, "net.snowflake.client.jdbc.SnowflakeDriver", user, password
    )


def db2(user: Lazy[str], password: Lazy[str], db: Lazy[str]) -> JdbcConnection:
    return JdbcConnection(
        "db2", lambda: f"jdbc:db2://{resolve(db)}", "com.ibm.db2.jcc.DB2Driver", user, password
    )


class JdbcSink(StagedSink):
    """Executors write the staging table, the driver runs one transaction of SQL.

    An index on the primary key of the target keeps that transaction short.
    ``writers`` bounds the connections that a batch opens. The staging table takes the types of
    its columns from the target, so whatever fits there fits here, in every alphabet, and keys
    compare as they do there.
    """

    def __init__(
        self,
        connection: JdbcConnection,
        spec: ReplicationSpec,
        positions_table: str | None = None,
        writers: int = 32,
        rows_per_insert: int = 1000,
    ) -> None:
        super().__init__(spec, DIALECTS[connection.dialect], positions_table)
        self.connection = connection
        self.writers = writers
        self.rows_per_insert = rows_per_insert

    def _applied(self, spark: SparkSession) -> list[tuple[str, str]]:
        if self.positions_table is None:
            return []
        query = f"SELECT id, val FROM {self.positions_table}"
        rows = (
            spark.read.format("jdbc")
            .option("url", resolve(self.connection.url))
            .option("query", query)
            .options(**self.connection.properties())
            .load()
            .collect()
        )
        return [(r[0], r[1]) for r in rows]

    def _stage(self, rows: DataFrame, stage: str) -> None:
        spec = self.spec
        self._transaction(rows.sparkSession, [self.dialect.staging(spec.target, stage, spec.pk, spec.columns)])
        writer = rows.write.option("batchsize", self.rows_per_insert).option("numPartitions", self.writers)
        writer.jdbc(resolve(self.connection.url), stage, mode="append", properties=self.connection.properties())

    def _open(self, spark: SparkSession):
        jvm = spark.sparkContext._jvm
        properties = self.connection.properties()
        driver = properties.pop("driver")
        info = jvm.java.util.Properties()
        for name, value in properties.items():
            info.setProperty(name, value)
        # The context loader also knows jars that came with the application.
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        return loader.loadClass(driver).newInstance().connect(resolve(self.connection.url), info)

    def _transaction(self, spark: SparkSession, statements: list[str]) -> None:
        connection = self._open(spark)
        try:
            run_all(connection, statements)
        finally:
            connection.close()

    def _drop(self, spark: SparkSession, stage: str) -> None:
        connection = self._open(spark)
        try:
            connection.createStatement().execute(f"DROP TABLE {stage}")
        except Exception as error:
            # Also where staging failed before the table was there.
            logging.getLogger(__name__).warning("could not drop %s: %s", stage, error)
        finally:
            connection.close()


def run_all(connection, statements: list[str]) -> None:
    """All statements in one transaction of a JDBC connection, or none of them."""
    connection.setAutoCommit(False)
    try:
        for text in statements:
            statement = connection.createStatement()
            try:
                statement.execute(text)
            finally:
                statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
