"""Targets without SQL: wide-column, document and hash stores.

Tasks write their rows through the client library of the store, in chunks. A
key has one net change per batch, so tasks need no order among them, and writing
a batch twice leaves the same. Positions are written last, from the driver.

``connect`` opens a client; it runs in the tasks, so it must not hold one.
"""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import VariantVal

from changeflow.operators.delivery import WATERMARK
from changeflow.sinks.options import Lazy, moved_positions, own_positions, resolve
from changeflow.spec import DELETE_REPLICATE, ReplicationSpec

Connect = Callable[[], Any]
Positions = list[tuple[str, str]]


def close(client: Any) -> None:
    """Close what ``connect`` opened, if the client can be closed.

    A session or a database hangs on a client of its own, which is what has to be closed.
    """
    for owner in (getattr(client, "cluster", None), getattr(client, "client", None), client):
        for name in ("shutdown", "close"):
            end = getattr(owner, name, None) if owner is not None else None
            if callable(end):
                end()
                return


class StoreSink(ABC):
    # Chunks that are written stay written when a later one fails.
    transactional = False

    def __init__(
        self, connect: Connect, spec: ReplicationSpec, positions_table: str | None = None
    ) -> None:
        if spec.exactly_once and positions_table is None:
            raise ValueError("exactly-once delivery needs a table for the positions")
        self.connect = connect
        self.spec = spec
        self.positions_table = positions_table

    def watermark(self, spark: SparkSession) -> DataFrame:
        applied = []
        if self.positions_table:
            client = self.connect()
            try:
                applied = self.read_positions(client)
            finally:
                close(client)
        return spark.createDataFrame(own_positions(self.spec, applied), WATERMARK)

    def apply(self, net: DataFrame, positions: DataFrame | None) -> None:
        connect, size, write = self.connect, self.spec.batch, self.writer()

        def put(part: Iterator[Row]) -> None:
            client = None
            try:
                while chunk := list(islice(part, size)):
                    client = connect() if client is None else client
                    write(client, chunk)
            finally:
                close(client)

        net.foreachPartition(put)
        if positions is not None:
            client = self.connect()
            try:
                self.write_positions(client, moved_positions(self.spec, positions))
            finally:
                close(client)

    @abstractmethod
    def writer(self) -> Callable[[Any, list[Row]], None]:
        """A function for the tasks that writes one chunk."""

    @abstractmethod
    def read_positions(self, client: Any) -> Positions: ...

    @abstractmethod
    def write_positions(self, client: Any, moved: Positions) -> None:
        """Raise positions; the store itself compares, so one that is higher by now stays."""


class WideColumnSink(StoreSink):
    """Cassandra tables: an update sets its columns and creates the row where needed.

    A task has up to ``batch`` prepared statements under way at a time: rows of a table lie on many
    hosts, so each statement goes to the host of its row, and nothing waits for a round trip of another.
    """

    def statements(self) -> tuple[str, str]:
        spec = self.spec
        sets = ", ".join(f"{c} = ?" for c in spec.columns)
        return (
            f"UPDATE {spec.target} SET {sets} WHERE {spec.pk} = ?",
            f"DELETE FROM {spec.target} WHERE {spec.pk} = ?",
        )

    def writer(self) -> Callable[[Any, list[Row]], None]:
        (update, delete), columns = self.statements(), self.spec.columns

        def write(session: Any, chunk: list[Row]) -> None:
            # The driver library keeps prepared statements, asking again costs nothing.
            put, drop = session.prepare(update), session.prepare(delete)
            gone = [[row["pk"]] for row in chunk if row["op"] == DELETE_REPLICATE or row["reset"]]
            new = [[*[row[c] for c in columns], row["pk"]] for row in chunk if row["op"] != DELETE_REPLICATE]
            # A deleted row may come again in the same chunk, so all deletes are through first.
            for statement, all_values in ((drop, gone), (put, new)):
                under_way = [session.execute_async(statement, values) for values in all_values]
                for each in under_way:
                    each.result()

        return write

    def read_positions(self, session: Any) -> Positions:
        return [(r[0], r[1]) for r in session.execute(f"SELECT id, val FROM {self.positions_table}")]

    def write_positions(self, session: Any, moved: Positions) -> None:
        held = dict(self.read_positions(session))
        add = session.prepare(f"INSERT INTO {self.positions_table} (id, val) VALUES (?, ?) IF NOT EXISTS")
        rise = session.prepare(f"UPDATE {self.positions_table} SET val = ? WHERE id = ? IF val < ?")
        for name, position in moved:
            if name in held:
                session.execute(rise, [position, name, position])
            else:
                session.execute(add, [name, position])


def cassandra(user: Lazy[str], password: Lazy[str], db: Lazy[str], keyspace: Lazy[str] = "") -> Connect:
    """Opens sessions on the hosts in ``db``, with the public driver library."""

    def connect() -> Any:
        from cassandra.auth import PlainTextAuthProvider
        from cassandra.cluster import Cluster

        auth = PlainTextAuthProvider(username=resolve(user), password=resolve(password))
        return Cluster(resolve(db).split(), auth_provider=auth).connect(resolve(keyspace) or None)

    return connect


def _plain(value: Any) -> Any:
    """A field as plain Python, numbers as ``int`` or ``float``."""
    return json.loads(value.toJson()) if isinstance(value, VariantVal) else value


def _bulk(database: Any, command: str, collection: str, **requests: list) -> None:
    """One round trip for all requests; a request that the store refuses fails the chunk."""
    if not any(requests.values()):
        return
    given = database.command(command, collection, ordered=False, **requests)
    if errors := given.get("writeErrors"):
        raise RuntimeError(f"{len(errors)} writes to {collection} refused, the first: {errors[0]}")


class DocumentStoreSink(StoreSink):
    """MongoDB collections: fields of a document are set one by one, others stay.

    A chunk takes two round trips, one for its updates and one for its deletes.

    ``connect`` gives a database; the target is a collection of it.
    """

    def writer(self) -> Callable[[Any, list[Row]], None]:
        collection, pk = self.spec.target, self.spec.pk

        def write(database: Any, chunk: list[Row]) -> None:
            updates, deletes = [], []
            for row in chunk:
                this = {pk: row["pk"]}
                if row["op"] == DELETE_REPLICATE:
                    deletes.append({"q": this, "limit": 1})
                    continue
                fields = {name: _plain(v) for name, v in row["fields"].items()}
                change = {**fields, **this} if row["reset"] else {"$set": {**fields, **this}}
                updates.append({"q": this, "u": change, "upsert": True})
            # Keys are unique within a chunk, so the requests need no order.
            _bulk(database, "update", collection, updates=updates)
            _bulk(database, "delete", collection, deletes=deletes)

        return write

    def read_positions(self, database: Any) -> Positions:
        return [(d["_id"], d["val"]) for d in database[self.positions_table].find({})]

    def write_positions(self, database: Any, moved: Positions) -> None:
        rises = [{"q": {"_id": name}, "u": {"$max": {"val": position}}, "upsert": True} for name, position in moved]
        _bulk(database, "update", self.positions_table, updates=rises)


def mongo(
    user: Lazy[str] | None,
    password: Lazy[str] | None,
    db: Lazy[str],
    database: str,
    auth_source: str = "admin",
    conn_string: Lazy[str] | None = None,
) -> Connect:
    """Opens ``database`` on ``db``, or on whatever a whole ``conn_string`` names."""

    def connect() -> Any:
        from pymongo import MongoClient

        text = resolve(conn_string) if conn_string is not None else None
        if text is None:
            text = f"mongodb://{resolve(user)}:{resolve(password)}@{resolve(db)}?authSource={auth_source}"
        return MongoClient(text)[database]

    return connect


#: Run by the store: sets a field of a hash unless it holds a higher text.
_RISE = """
local held = redis.call('HGET', KEYS[1], ARGV[1])
if not held or held < ARGV[2] then redis.call('HSET', KEYS[1], ARGV[1], ARGV[2]) end
"""


class HashStoreSink(StoreSink):
    """Hashes named ``prefix:pk`` in a key-value store.

    ``cluster`` stores cannot write positions and hashes under one roof, so
    exactly-once delivery is refused for them. Takes mapped columns as well as
    whole hashes (a ``fields`` map).
    """

    def __init__(
        self,
        connect: Connect,
        spec: ReplicationSpec,
        new_prefix: str,
        positions_table: str | None = None,
        cluster: bool = False,
    ) -> None:
        if cluster and (spec.exactly_once or positions_table is not None):
            raise ValueError("exactly-once delivery is not valid for a cluster of hash stores")
        super().__init__(connect, spec, positions_table)
        self.new_prefix = new_prefix

    def writer(self) -> Callable[[Any, list[Row]], None]:
        prefix, columns = self.new_prefix, self.spec.columns

        def write(client: Any, chunk: list[Row]) -> None:
            pipe = client.pipeline()
            for row in chunk:
                name = f"{prefix}:{row['pk']}"
                if row["op"] == DELETE_REPLICATE or row["reset"]:
                    pipe.delete(name)
                if row["op"] != DELETE_REPLICATE:
                    fields = row["fields"] if "fields" in row else {c: row[c] for c in columns}
                    # The client refuses to set nothing.
                    if fields:
                        pipe.hset(name, mapping=fields)
            pipe.execute()

        return write

    def read_positions(self, client: Any) -> Positions:
        return list(client.hgetall(self.positions_table).items())

    def write_positions(self, client: Any, moved: Positions) -> None:
        pipe = client.pipeline()
        for name, position in moved:
            pipe.eval(_RISE, 1, self.positions_table, name, position)
        pipe.execute()


def redis(host: Lazy[str], port: Lazy[int] = 6379, password: Lazy[str] | None = None, cluster: bool = False, **options: Any) -> Connect:
    """Opens clients of a hash store or, with ``cluster``, of a cluster of them."""

    def connect() -> Any:
        import redis as library

        kind = library.RedisCluster if cluster else library.Redis
        secret = None if password is None else resolve(password)
        return kind(host=resolve(host), port=int(resolve(port)), password=secret, decode_responses=True, **options)

    return connect
