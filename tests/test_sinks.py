"""Sinks: tables behind a view, SQL texts, SQLite files and stores behind stand-in clients."""

from __future__ import annotations

import json
import sqlite3
from contextlib import closing
from dataclasses import replace

import duckdb
import pytest
import replay
from pyspark.sql import functions as F
from sqlite_target import SqliteSink
from tables import table_name

from changeflow.functions.documents import document_fields
from changeflow.operators import delivery, fold
from changeflow.sinks import jdbc
from changeflow.sinks.dialects import DIALECTS
from changeflow.sinks.merge import MergeSink
from changeflow.sinks.stores import DocumentStoreSink, HashStoreSink, WideColumnSink
from changeflow.sinks.table import TableSink
from changeflow.spec import ReplicationSpec
from changeflow.streaming.apply_log import apply_batch

SPEC = ReplicationSpec(
    target="persons", pk="id", keys_prefix="k", mappings={"a": "x", "b": "y"}, shards=3, retry_seconds=0, max_retries=2
)
LOG = "target string, ms bigint, n bigint, pk string, op string, x string, y string"


def log_frame(spark, log):
    rows = [("persons", ms, n, pk, op, c.get("x"), c.get("y")) for ms, n, pk, op, c in log]
    return spark.createDataFrame(rows, LOG).withColumn("shard", SPEC.shard(F.col("pk")))


def put(pk, x, ms, op="="):
    return (ms, 0, pk, op, {"x": x, "y": x} if op == "=" else {})


def table(spark, tmp_path, mode="merge", rows=(("1", "o", "o", "z1"), ("2", "o", "o", "z2"))):
    sink = TableSink(table_name(tmp_path, "table"), SPEC, mode)
    sink.create(spark.createDataFrame(list(rows), "id string, x string, y string, z string"))
    return sink


def content(spark, sink):
    return {r["id"]: (r["x"], r["z"]) for r in sink.read(spark).collect()}


# Table behind a view


def test_table_commits_rows_with_positions(spark, tmp_path):
    sink = table(spark, tmp_path)
    log = log_frame(spark, [put("1", "n", 5), put("2", "", 6, "~"), put("3", "n", 7)])
    apply_batch(log, SPEC, sink)
    assert content(spark, sink) == {"1": ("n", "z1"), "3": ("n", None)}
    want = {(r["shard"], r["ms"], r["n"]) for r in delivery.positions(log).collect()}
    assert {(r["shard"], r["ms"], r["n"]) for r in sink.watermark(spark).collect()} == want


def test_table_repeats_change_nothing(spark, tmp_path):
    sink = table(spark, tmp_path)
    log = log_frame(spark, [put("1", "n", 5), put("2", "", 6, "~")])
    apply_batch(log, SPEC, sink)
    before = content(spark, sink)
    apply_batch(log, SPEC, sink)
    assert content(spark, sink) == before


def test_late_ids_of_a_later_batch_are_not_skipped(spark, tmp_path):
    sink = table(spark, tmp_path)
    for arrived, ms in ((1, 9), (2, 4)):
        log = log_frame(spark, [put("1", f"at {ms}", ms)]).withColumn("arrived", F.lit(arrived).cast("bigint"))
        apply_batch(log, SPEC, sink)
    assert content(spark, sink)["1"] == ("at 4", "z1")


def test_a_batch_reads_its_input_once(spark, tmp_path):
    rows = [(str(i), "o", "o", "z") for i in range(2000)]
    sink = table(spark, tmp_path, rows=rows)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    log = log_frame(spark, [put("7", "n", 5), put("8", "n", 6)])
    sink.apply(fold.net_change(log.mapInArrow(counted, log.schema), SPEC.columns), delivery.positions(log))
    assert reads.value == 2
    assert sink.read(spark).count() == 2000


def test_table_over_batches_and_in_another_session(spark, tmp_path):
    sink = table(spark, tmp_path)
    logs = [[put("1", "a", 1)], [put("2", "", 2, "~")], [put("2", "b", 3)], [put("3", "c", 4)], [put("1", "d", 5)]]
    for log in logs:
        content(spark, sink)
        # Streams write from sessions of their own, which have other lists of files.
        apply_batch(log_frame(spark.newSession(), log), SPEC, sink)
    assert content(spark, sink) == {"1": ("d", "z1"), "2": ("b", None), "3": ("c", None)}
    again = TableSink(sink.table, SPEC, "merge")
    assert content(spark, again) == content(spark, sink)
    assert {r["id"] for r in spark.table(sink.table).collect()} == {"1", "2", "3"}
    want = {(r["shard"], r["ms"]) for r in delivery.positions(log_frame(spark, [x for log in logs for x in log])).collect()}
    assert {(r["shard"], r["ms"]) for r in again.watermark(spark).collect()} == want


def test_rows_without_the_statement_of_the_view_do_not_count(spark, tmp_path, monkeypatch):
    """A crash after the rows and before the view: neither rows nor positions, and the next try replaces them."""
    sink = table(spark, tmp_path)

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(sink, "_point", crash)
        with pytest.raises(RuntimeError, match="crash"):
            apply_batch(log_frame(spark, [put("1", "n", 5)]), replace(SPEC, max_retries=0), sink)
    assert content(spark, sink)["1"] == ("o", "z1") and sink.watermark(spark).count() == 0
    apply_batch(log_frame(spark, [put("1", "m", 5)]), SPEC, sink)
    assert content(spark, sink)["1"] == ("m", "z1")


def test_positions_of_a_table_never_go_down(spark, tmp_path):
    sink = table(spark, tmp_path)
    late, early = (log_frame(spark, [put("1", x, ms)]) for x, ms in (("n", 9), ("m", 4)))
    for log in (late, early):
        sink.apply(fold.net_change(log, SPEC.columns), delivery.positions(log))
    assert [r["ms"] for r in sink.watermark(spark).collect()] == [9]


def test_table_at_a_location_and_without_one(spark, tmp_path):
    sink = TableSink(table_name(tmp_path, "placed"), SPEC, "replace", location=str(tmp_path / "here"))
    with pytest.raises(LookupError, match="create"):
        sink.read(spark)
    sink.create(spark.createDataFrame([("1", "o", "o", "z1")], "id string, x string, y string, z string"))
    apply_batch(log_frame(spark, [put("1", "n", 5)]), SPEC, sink)
    assert content(spark, sink) == {"1": ("n", None)}
    assert sorted(p.name for p in (tmp_path / "here").iterdir()) == ["a", "b"]


def test_table_is_untouched_where_a_write_breaks(spark, tmp_path):
    sink = table(spark, tmp_path)
    before = content(spark, sink)
    broken = log_frame(spark, [put("1", "n", 5)]).withColumn(
        "x", F.when(F.col("pk") == "1", F.raise_error(F.lit("broken"))).otherwise(F.col("x"))
    )
    with pytest.raises(Exception, match="broken"):
        apply_batch(broken, replace(SPEC, max_retries=1), sink)
    assert content(spark, sink) == before and sink.watermark(spark).count() == 0


def test_table_can_be_emptied_and_filled_again(spark, tmp_path):
    sink = table(spark, tmp_path)
    apply_batch(log_frame(spark, [put("1", "", 5, "~"), put("2", "", 5, "~")]), SPEC, sink)
    assert content(spark, sink) == {}
    apply_batch(log_frame(spark, [put("1", "n", 6)]), SPEC, sink)
    assert content(spark, sink) == {"1": ("n", None)}


def test_table_replaces_rows(spark, tmp_path):
    sink = table(spark, tmp_path, "replace")
    apply_batch(log_frame(spark, [put("1", "n", 5)]), SPEC, sink)
    assert content(spark, sink) == {"1": ("n", None), "2": ("o", "z2")}


def test_without_exactly_once_old_ids_are_written_again(spark, tmp_path):
    sink = table(spark, tmp_path)
    spec = replace(SPEC, exactly_once=False)
    apply_batch(log_frame(spark, [put("1", "n", 5)]), spec, sink)
    apply_batch(log_frame(spark, [put("1", "older", 4)]), spec, sink)
    assert content(spark, sink)["1"] == ("older", "z1")
    assert sink.watermark(spark).count() == 0


def test_retry_gets_over_a_passing_failure(spark, tmp_path):
    sink = table(spark, tmp_path)
    calls, write = [], sink.apply

    def flaky(net, positions):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not now")
        write(net, positions)

    sink.apply = flaky
    apply_batch(log_frame(spark, [put("1", "n", 5)]), SPEC, sink)
    assert len(calls) == 3 and content(spark, sink)["1"] == ("n", "z1")


# SQL texts

FLAGS = "cf_gone int, cf_put int"
STAGE = [("1", "n", "n", 0, 1), ("2", None, None, 1, 0), ("3", "n", "n", 0, 1), ("4", "n", "n", 1, 1)]
OLD = [("1", "o", "o", "z"), ("2", "o", "o", "z"), ("4", "o", "o", "z"), ("5", "o", "o", "z")]
MERGED = {"1": ("n", "z"), "3": ("n", None), "4": ("n", None), "5": ("o", "z")}


def fill(execute, many):
    execute("CREATE TABLE persons (id varchar(9) PRIMARY KEY, x varchar(9), y varchar(9), z varchar(9))")
    execute(f"CREATE TABLE stage (id varchar(9), x varchar(9), y varchar(9), {FLAGS})")
    execute("CREATE TABLE held (id varchar(20), val varchar(40))")
    many("INSERT INTO persons VALUES (?, ?, ?, ?)", OLD)
    many("INSERT INTO stage VALUES (?, ?, ?, ?, ?)", STAGE)


class Texts(jdbc.JdbcSink):
    def __init__(self, dialect):
        connection = jdbc.JdbcConnection(dialect, "jdbc:none", "none")
        super().__init__(connection, SPEC, "held")


@pytest.mark.parametrize("dialect", ["oracle", "snowflake", "db2"])
def test_merge_text_runs(dialect):
    con = duckdb.connect()
    fill(con.execute, con.executemany)
    for text in Texts(dialect).statements("stage", [("shard-1", "5-0"), ("shard-2", "6-1")]):
        con.execute(text)
    rows = con.execute("SELECT id, x, z FROM persons").fetchall()
    assert {r[0]: r[1:] for r in rows} == MERGED
    assert sorted(con.execute("SELECT id, val FROM held").fetchall()) == [("shard-1", "5-0"), ("shard-2", "6-1")]


@pytest.mark.parametrize("dialect, want", [("postgres", MERGED), ("sqlite", {**MERGED, "1": ("n", None)})])
def test_conflict_text_runs(dialect, want):
    with closing(sqlite3.connect(":memory:")) as con:
        fill(con.execute, con.executemany)
        for held, position in (((), "5-0"), (("shard-1",), "7-0"), (("shard-1",), "6-0")):
            for text in Texts(dialect).statements("stage", [("shard-1", position)], held):
                con.execute(text)
        rows = con.execute("SELECT id, x, z FROM persons").fetchall()
        assert {r[0]: r[1:] for r in rows} == want
        assert con.execute("SELECT id, val FROM held").fetchall() == [("shard-1", "7-0")]


def test_texts_of_the_other_dialects():
    assert Texts("mysql").statements("stage", []) == [
        "DELETE FROM persons WHERE id IN (SELECT `id` FROM stage WHERE `cf_gone` = 1)",
        "INSERT INTO persons (id, x, y) SELECT `id`, `x`, `y` FROM stage WHERE `cf_put` = 1 "
        "ON DUPLICATE KEY UPDATE x = VALUES(x), y = VALUES(y)",
    ]
    assert Texts("mssql").statements("stage", [])[1] == (
        "MERGE INTO persons t USING (SELECT [id], [x], [y] FROM stage WHERE [cf_put] = 1) s "
        "ON (t.id = s.[id]) WHEN MATCHED THEN UPDATE SET x = s.[x], y = s.[y] "
        "WHEN NOT MATCHED THEN INSERT (id, x, y) VALUES (s.[id], s.[x], s.[y]);"
    )


def test_connections_ask_functions_when_a_batch_starts():
    asked = []

    def secret():
        asked.append(1)
        return "pw"

    connection = jdbc.mysql(lambda: "me", secret, "host:3306/db")
    assert asked == []
    assert connection.properties() == {"driver": "com.mysql.cj.jdbc.Driver", "user": "me", "password": "pw"}
    assert connection.url() == "jdbc:mysql://host:3306/db"
    urls = [
        jdbc.postgres("u", "p", "h/db").url(),
        jdbc.oracle("u", "p", "h:1521/db").url(),
        jdbc.mssql("u", "p", "db", "h", 1433).url(),
        jdbc.snowflake("u", "p", "acc", "db").url(),
        jdbc.db2("u", "p", lambda: "h:50000/db").url(),
    ]
    assert urls == [
        "jdbc:postgresql://h/db",
        "jdbc:oracle:thin:@//h:1521/db",
        "jdbc:sqlserver://h:1433;databaseName=db",
        "jdbc:snowflake://acc.snowflakecomputing.com/?db=db",
        "jdbc:db2://h:50000/db",
    ]


class RecordingConnection:
    """Notes what a JDBC connection is told, and fails at a given statement."""

    def __init__(self, fail_at=None):
        self.calls, self.fail_at = [], fail_at

    def setAutoCommit(self, on):
        self.calls.append(("auto", on))

    def createStatement(self):
        return self

    def execute(self, text):
        if text == self.fail_at:
            raise OSError(text)
        self.calls.append(text)

    def close(self):
        pass

    def commit(self):
        self.calls.append("commit")

    def rollback(self):
        self.calls.append("rollback")


def test_transaction_commits_all_or_rolls_back():
    good, bad = RecordingConnection(), RecordingConnection(fail_at="b")
    jdbc.run_all(good, ["a", "b"])
    assert good.calls == [("auto", False), "a", "b", "commit"]
    with pytest.raises(OSError):
        jdbc.run_all(bad, ["a", "b"])
    assert bad.calls == [("auto", False), "a", "rollback"]


def test_staged_rows(spark):
    log = log_frame(spark, [put("1", "", 1, "~"), put("1", "n", 2), put("2", "", 1, "~"), put("3", "n", 1)])
    staged = Texts("mysql").staged(fold.net_change(log, SPEC.columns)).collect()
    assert {r["id"]: (r["x"], r["cf_gone"], r["cf_put"]) for r in staged} == {
        "1": ("n", 1, 1),
        "2": (None, 1, 0),
        "3": ("n", 0, 1),
    }


# SQLite


def sqlite_sink(tmp_path, positions="held"):
    path = str(tmp_path / "target.db")
    with closing(sqlite3.connect(path)) as con:
        con.execute("CREATE TABLE persons (id TEXT PRIMARY KEY, x TEXT, y TEXT, z TEXT)")
        con.execute("CREATE TABLE held (id TEXT PRIMARY KEY, val TEXT)")
        con.execute("INSERT INTO persons VALUES ('1', 'o', 'o', 'z1'), ('2', 'o', 'o', 'z2')")
        con.commit()
    return SqliteSink(lambda: path, SPEC, positions), path


def ask(path, text):
    with closing(sqlite3.connect(path)) as con:
        return con.execute(text).fetchall()


def test_sqlite_equals_replay_over_batches(spark, tmp_path):
    sink, path = sqlite_sink(tmp_path)
    log = replay.random_log(21, 80, 600, ("x", "y"))
    for start in (0, 150, 300, 450):
        apply_batch(log_frame(spark, log[max(0, start - 60) : start + 150]), SPEC, sink)
    before = {"1": {"x": "o", "y": "o"}, "2": {"x": "o", "y": "o"}}
    want = replay.merge(before, log, ("x", "y"), replace=True)
    got = ask(path, "SELECT id, x, y FROM persons")
    assert {r[0]: r[1:] for r in got} == {k: (v["x"], v["y"]) for k, v in want.items()}
    held = {(r["shard"], r["ms"], r["n"]) for r in sink.watermark(spark).collect()}
    assert held == {(r["shard"], r["ms"], r["n"]) for r in delivery.positions(log_frame(spark, log)).collect()}
    assert [r[0] for r in ask(path, "SELECT name FROM sqlite_master WHERE type = 'table'")] == ["persons", "held"]


def test_sqlite_rolls_back_rows_and_positions(spark, tmp_path):
    sink, path = sqlite_sink(tmp_path, positions="no_such_table")
    net = fold.net_change(log_frame(spark, [put("1", "n", 5)]), SPEC.columns)
    with pytest.raises(sqlite3.OperationalError):
        sink.apply(net, delivery.positions(log_frame(spark, [put("1", "n", 5)])))
    assert ask(path, "SELECT x FROM persons WHERE id = '1'") == [("o",)]


def test_positions_never_go_back(spark, tmp_path):
    """Batches 1, 2, 3, then 1 and 2 again, as after the loss of a checkpoint."""
    sink, path = sqlite_sink(tmp_path)

    def applied(k):
        log = log_frame(spark, [put("1", f"v{k}", 1)]).withColumn("arrived", F.lit(k).cast("bigint"))
        apply_batch(log, SPEC, sink)
        return ask(path, "SELECT x FROM persons WHERE id = '1'")[0][0], [r["arrived"] for r in sink.watermark(spark).collect()]

    assert [applied(k) for k in (1, 2, 3, 1, 2)] == [("v1", [1]), ("v2", [2]), ("v3", [3]), ("v3", [3]), ("v3", [3])]
    # Also where the writer asks for less than is there by now.
    log = log_frame(spark, [put("1", "v1", 1)]).withColumn("arrived", F.lit(1).cast("bigint"))
    sink.apply(fold.net_change(log.where("false"), SPEC.columns), delivery.positions(log))
    assert [r["arrived"] for r in sink.watermark(spark).collect()] == [3]


# Stores, with clients that keep one JSON file per key


def test_wide_column_store(spark, tmp_path):
    folder = str(tmp_path)

    def connect():
        import json as j
        import os

        class Session:
            def prepare(self, text):
                return text

            def execute_async(self, text, values):
                self.execute(text, values)
                return type("Done", (), {"result": lambda _: None})()

            def execute(self, text, values=()):
                words = text.split()
                if " IF " in text:
                    name, position = values if words[0] == "INSERT" else (values[1], values[0])
                    path = f"{folder}/held.{name}"
                    held = j.load(open(path))["val"] if os.path.exists(path) else ""
                    if not held if words[0] == "INSERT" else held < position:
                        j.dump({"val": position}, open(path, "w"))
                    return None
                if words[0] == "SELECT":
                    names = [f for f in os.listdir(folder) if f.startswith("held.")]
                    return [(f[5:], j.load(open(f"{folder}/{f}"))["val"]) for f in names]
                name = words[1] if words[0] == "UPDATE" else words[2]
                path = f"{folder}/{name}.{values[-1]}"
                if words[0] == "DELETE":
                    if os.path.exists(path):
                        os.remove(path)
                    return None
                row = j.load(open(path)) if os.path.exists(path) else {}
                columns = [w.strip(" ?,") for w in text.split("SET")[1].split("WHERE")[0].split("=")][:-1]
                row.update(zip([c.strip(" ?,") for c in columns], values))
                j.dump(row, open(path, "w"))
                return None

        return Session()

    sink = WideColumnSink(connect, SPEC, "held")
    assert sink.statements() == (
        "UPDATE persons SET x = ?, y = ? WHERE id = ?",
        "DELETE FROM persons WHERE id = ?",
    )
    log = replay.random_log(22, 30, 300, ("x", "y"))
    for start in (0, 100, 200):
        apply_batch(log_frame(spark, log[max(0, start - 40) : start + 100]), SPEC, sink)
    got = {p.name.split(".", 1)[1]: json.loads(p.read_text()) for p in tmp_path.glob("persons.*")}
    assert got == replay.merge({}, log, ("x", "y"))


def test_document_store(spark, tmp_path):
    folder = str(tmp_path)

    def connect():
        import json as j
        import os

        class Collection:
            def __init__(self, name):
                self.name = name

            def path(self, this):
                return f"{folder}/{self.name}.{next(iter(this.values()))}"

            def find(self, _):
                names = [f for f in os.listdir(folder) if f.startswith(self.name + ".")]
                return [j.load(open(f"{folder}/{f}")) for f in names]

            def delete(self, this):
                if os.path.exists(self.path(this)):
                    os.remove(self.path(this))

            def update(self, this, change):
                path = self.path(this)
                doc = j.load(open(path)) if os.path.exists(path) else {}
                if "$max" in change:
                    doc = {**this, "val": max(doc.get("val", ""), change["$max"]["val"])}
                elif "$set" in change:
                    doc = {**doc, **change["$set"]}
                else:
                    doc = change
                j.dump(doc, open(path, "w"))

        class Database:
            def __getitem__(self, name):
                return Collection(name)

            def command(self, verb, name, ordered, updates=(), deletes=()):
                with open(f"{folder}/trips.log", "a") as trips:
                    trips.write(f"{verb} {name}\n")
                for each in updates:
                    Collection(name).update(each["q"], each["u"])
                for each in deletes:
                    Collection(name).delete(each["q"])
                return {"writeErrors": ["refused"]} if any("no" in e["q"].values() for e in updates) else {}

        return Database()

    spec = replace(SPEC, mappings={})
    sink = DocumentStoreSink(connect, spec, "held")
    docs = [
        (1, "1", '{"some": "value", "and another": ["set", "of", "values"]}'),
        (2, "1", '{"some": "it\'s new", "deep": {"a": [1, 2.5, null]}}'),
        (3, "2", '{"a": 1}'),
        (4, "2", None),
        (5, "3", '{"old": true}'),
    ]
    frame = spark.createDataFrame(docs, "ms bigint, pk string, doc string").selectExpr(
        "'persons' AS target", "0 AS shard", "ms", "0L AS n", "pk", "if(doc IS NULL, '~', '=') AS op",
        "from_json(doc, 'map<string,variant>') AS fields",
    )
    apply_batch(frame, spec, sink)
    later = [(6, "3", None), (7, "3", '{"new": true}'), (8, "1", '{"some": null}')]
    frame = spark.createDataFrame(later, "ms bigint, pk string, doc string").selectExpr(
        "'persons' AS target", "0 AS shard", "ms", "0L AS n", "pk", "if(doc IS NULL, '~', '=') AS op",
        "from_json(doc, 'map<string,variant>') AS fields",
    )
    apply_batch(frame, spec, sink)
    got = {p.name.split(".", 1)[1]: json.loads(p.read_text()) for p in tmp_path.glob("persons.*")}
    assert got == {
        "1": {"id": "1", "some": None, "and another": ["set", "of", "values"], "deep": {"a": [1, 2.5, None]}},
        "3": {"id": "3", "new": True},
    }
    assert [tuple(r) for r in sink.watermark(spark).collect()] == [("persons", 0, 0, 8, 0)]
    # One shard and few rows: a trip for updates and one for deletes per task, and one for the positions.
    trips = (tmp_path / "trips.log").read_text().split("\n")
    assert trips.count("update held") == 2
    assert trips.count("update persons") <= 4 and trips.count("delete persons") <= 2
    # An older batch leaves the position where it is.
    sink.apply(fold.net_fields(frame.where("false")), delivery.positions(frame.withColumn("ms", F.lit(1).cast("bigint"))))
    assert [r["ms"] for r in sink.watermark(spark).collect()] == [8]
    refused = frame.where("pk = '1'").withColumn("pk", F.lit("no"))
    with pytest.raises(Exception, match="refused"):
        sink.apply(fold.net_fields(refused), None)


def hash_store(folder):
    def connect():
        import json as j
        import os

        class Client:
            def __init__(self):
                self.waiting = []

            def pipeline(self):
                return Client()

            def delete(self, name):
                self.waiting.append((name, None))

            def hset(self, name, mapping):
                self.waiting.append((name, mapping))

            def eval(self, script, keys, name, field, position):
                assert "HSET" in script and keys == 1
                if self.hgetall(name).get(field, "") < position:
                    self.waiting.append((name, {field: position}))

            def hgetall(self, name):
                path = f"{folder}/{name}"
                return j.load(open(path)) if os.path.exists(path) else {}

            def execute(self):
                for name, mapping in self.waiting:
                    path = f"{folder}/{name}"
                    if mapping is None:
                        if os.path.exists(path):
                            os.remove(path)
                    else:
                        j.dump({**self.hgetall(name), **mapping}, open(path, "w"))
                self.waiting = []

        return Client()

    return connect


def test_hash_store(spark, tmp_path):
    sink = HashStoreSink(hash_store(str(tmp_path)), SPEC, "copy", "held")
    log = replay.random_log(23, 30, 300, ("x", "y"))
    for start in (0, 100, 200):
        apply_batch(log_frame(spark, log[max(0, start - 40) : start + 100]), SPEC, sink)
    got = {p.name.split(":", 1)[1]: json.loads(p.read_text()) for p in tmp_path.glob("copy:*")}
    assert got == replay.merge({}, log, ("x", "y"))


def test_hash_store_takes_whole_hashes(spark, tmp_path):
    spec = replace(SPEC, mappings={}, exactly_once=False)
    sink = HashStoreSink(hash_store(str(tmp_path)), spec, "copy")
    rows = [("persons", 0, 1, 0, "1", "=", {"a": "1"}), ("persons", 0, 2, 0, "1", "=", {"b": "2"})]
    schema = "target string, shard int, ms bigint, n bigint, pk string, op string, fields map<string,string>"
    apply_batch(spark.createDataFrame(rows, schema), spec, sink)
    assert json.loads((tmp_path / "copy:1").read_text()) == {"a": "1", "b": "2"}


def test_exactly_once_needs_a_place_for_positions():
    with pytest.raises(ValueError, match="cluster"):
        HashStoreSink(lambda: None, SPEC, "copy", "held", cluster=True)
    HashStoreSink(lambda: None, replace(SPEC, exactly_once=False), "copy", cluster=True)
    for make in (
        lambda: HashStoreSink(lambda: None, SPEC, "copy"),
        lambda: SqliteSink("x.db", SPEC),
        lambda: MergeSink("t", SPEC),
    ):
        with pytest.raises(ValueError, match="positions"):
            make()


def test_merge_sink_reaches_the_catalog(spark):
    """Plain Parquet tables refuse a merge; getting as far shows that the merge is well formed."""
    spark.sql("CREATE TABLE IF NOT EXISTS merge_target (id string, x string, y string, z string) USING parquet")
    net = fold.net_change(log_frame(spark, [put("1", "n", 5)]), SPEC.columns)
    with pytest.raises(Exception, match="MERGE"):
        MergeSink("merge_target", replace(SPEC, exactly_once=False)).apply(net, None)


def test_dialects_are_complete():
    assert sorted(DIALECTS) == ["db2", "mssql", "mysql", "oracle", "postgres", "snowflake", "sqlite"]


def test_document_table(spark, tmp_path):
    spec = replace(SPEC, mappings={})
    sink = TableSink(table_name(tmp_path, "docs"), spec, "fields")
    old = spark.createDataFrame([("1", '{"keep": 1, "set": 1}'), ("9", '{"a": 1}')], "id string, doc string")
    sink.create(old.select("id", document_fields(F.col("doc")).alias("fields")))
    rows = [(1, "1", '{"set": "it\'s"}'), (2, "9", None), (3, "9", "{}"), (4, "5", '{"n": null}')]
    frame = spark.createDataFrame(rows, "ms bigint, pk string, doc string").selectExpr(
        "'persons' AS target", "0 AS shard", "ms", "0L AS n", "pk", "if(doc IS NULL, '~', '=') AS op",
        "from_json(doc, 'map<string,variant>') AS fields",
    )
    apply_batch(frame, spec, sink)
    got = {r["id"]: json.loads(r["f"]) for r in sink.read(spark).select("id", F.to_json("fields").alias("f")).collect()}
    assert got == {"1": {"keep": 1, "set": "it's"}, "9": {}, "5": {"n": None}}


@pytest.mark.parametrize("dialect", ["oracle", "snowflake", "db2"])
def test_staging_tables_take_what_the_target_takes(dialect):
    """Types come from the target; its constraints do not, as deleted rows have no values."""
    long = "\u4e2d" * 70_000
    with closing(duckdb.connect()) as con:
        con.execute("CREATE TABLE persons (id DECIMAL(30, 0) PRIMARY KEY, x VARCHAR NOT NULL, y DECIMAL(38, 10) NOT NULL DEFAULT 1, z VARCHAR)")
        con.execute("CREATE TABLE held (id VARCHAR PRIMARY KEY, val VARCHAR)")
        con.execute("INSERT INTO persons VALUES (1, 'o', 1, 'z1'), (2, 'o', 1, 'z2')")
        con.execute(DIALECTS[dialect].staging("persons", "stage", "id", ["x", "y"]))
        shape = con.execute("SELECT column_name, data_type, is_nullable FROM information_schema.columns WHERE table_name = 'stage' ORDER BY ordinal_position")
        assert shape.fetchall() == [
            ("id", "DECIMAL(30,0)", "YES"), ("x", "VARCHAR", "YES"), ("y", "DECIMAL(38,10)", "YES"),
            ("cf_gone", "INTEGER", "YES"), ("cf_put", "INTEGER", "YES"),
        ]
        assert con.execute("SELECT count(*) FROM stage").fetchone() == (0,)
        con.executemany("INSERT INTO stage VALUES (?, ?, ?, ?, ?)", [(1, None, None, 1, 0), (10**25, long, "0.0000000001", 0, 1)])
        for text in Texts(dialect).statements("stage", [("shard-1", "5-0")]):
            con.execute(text)
        assert con.execute("SELECT id, x, CAST(y AS VARCHAR), z FROM persons ORDER BY id").fetchall() == [
            (2, "o", "1.0000000000", "z2"), (10**25, long, "0.0000000001", None),
        ]


@pytest.mark.parametrize("dialect", ["postgres", "sqlite"])
def test_staging_tables_of_the_conflict_dialects(dialect):
    with closing(sqlite3.connect(":memory:")) as con:
        con.execute("CREATE TABLE persons (id INTEGER PRIMARY KEY, x TEXT NOT NULL, y REAL NOT NULL)")
        con.execute("INSERT INTO persons VALUES (1, 'o', 1)")
        con.execute(DIALECTS[dialect].staging("persons", "stage", "id", ["x", "y"]))
        con.executemany("INSERT INTO stage VALUES (?, ?, ?, ?, ?)", [(1, None, None, 1, 0), (3, "l" * 9000, 2.5, 0, 1)])
        for text in Texts(dialect).statements("stage", []):
            con.execute(text)
        assert con.execute("SELECT * FROM persons").fetchall() == [(3, "l" * 9000, 2.5)]


def test_staging_texts_of_the_other_dialects():
    source = "FROM persons s LEFT JOIN persons t ON 1 = 0 WHERE 1 = 0"
    assert DIALECTS["mysql"].staging("persons", "stage", "id", ["x"]) == (
        f"CREATE TABLE stage AS SELECT t.id AS `id`, t.x AS `x`, 0 AS `cf_gone`, 0 AS `cf_put` {source}"
    )
    assert DIALECTS["mssql"].staging("persons", "stage", "id", ["x"]) == (
        f"SELECT t.id AS [id], t.x AS [x], 0 AS [cf_gone], 0 AS [cf_put] INTO stage {source}"
    )


def test_staging_tables_are_made_before_the_tasks_write(spark, monkeypatch):
    """The table is made by one statement of its own, and Spark's writer only adds rows to it."""
    steps = []
    monkeypatch.setattr(jdbc.JdbcSink, "_transaction", lambda self, spark, texts: steps.append(texts))
    writer = type(spark.range(1).write)
    monkeypatch.setattr(writer, "jdbc", lambda self, url, table, mode, properties: steps.append((url, table, mode)))
    sink = Texts("postgres")
    sink._stage(sink.staged(fold.net_change(log_frame(spark, [put("1", "n", 5)]), SPEC.columns)), "stage")
    assert steps == [[DIALECTS["postgres"].staging("persons", "stage", "id", ["x", "y"])], ("jdbc:none", "stage", "append")]


def test_staged_keys_have_the_type_of_the_target(spark):
    sink = jdbc.JdbcSink(jdbc.postgres("u", "p", "host/db"), replace(SPEC, types={"id": "int"}), "held")
    rows = sink.staged(fold.net_change(log_frame(spark, [put("7", "n", 5)]), SPEC.columns))
    assert rows.schema["id"].dataType.simpleString() == "int" and rows.first()["id"] == 7


def test_positions_of_several_replications_share_a_table():
    from changeflow.sinks.options import own_positions, position_text, shard_name

    other = replace(SPEC, target="persons2")
    rows = [(shard_name(s, 1), position_text(9, 5, k)) for k, s in enumerate((SPEC, other, replace(SPEC, shards=4)))]
    assert own_positions(SPEC, rows) == [("persons", 1, 9, 5, 0)]
    assert own_positions(other, rows) == [("persons2", 1, 9, 5, 1)]


def test_shards_stay_in_range(spark):
    spec = replace(SPEC, shard_by=lambda pk: F.when(pk != "n", pk.cast("int")))
    rows = spark.createDataFrame([("-7",), ("8",), ("n",)], "pk string").select(spec.shard(F.col("pk")).alias("s")).collect()
    assert [r["s"] for r in rows] == [2, 2, 0]
