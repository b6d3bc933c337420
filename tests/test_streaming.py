"""Whole replications as streams: restarts, repeats, failures, acknowledgements."""

from __future__ import annotations

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from tables import table_name

import changeflow
from changeflow.functions.documents import document_fields
from changeflow.operators import capture, delivery
from changeflow.plans.recipes import WriteBehind
from changeflow.sinks.table import TableSink
from changeflow.sources import changes, log
from changeflow.spec import ReplicationSpec
from changeflow.streaming.apply_log import start_apply
from changeflow.streaming.capture_log import start_capture
from changeflow.streaming.fan_out import acks_folder, log_folder, read_log, start_fan_out

PERSONS = {"first_name": "first", "last_name": "last", "age": "age"}
SPEC = ReplicationSpec(
    target="persons",
    pk="person_id",
    keys_prefix="person",
    mappings=PERSONS,
    types={"age": "int"},
    shards=3,
    retry_seconds=0,
    max_retries=0,
)
NOW = {"availableNow": True}


class Source:
    """A folder of change files; ids ascend from file to file."""

    def __init__(self, spark, path, schema=changes.HASH_CHANGES):
        self.spark, self.path, self.schema, self.n = spark, str(path), schema, 0

    def add(self, *records, event="hset"):
        rows = []
        for key, value in records:
            self.n += 1
            rows.append((self.n, 1000 + self.n, "del" if value is None else event, key, value))
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        read = changes.hash_changes if "fields" in self.schema else changes.document_changes
        return read(self.spark, self.path, stream=True)


def person(first, age, control=None):
    fields = {"first_name": first, "last_name": "bar", "age": str(age)}
    return fields if control is None else {**fields, "#": control}


@pytest.fixture
def behind(spark, tmp_path):
    sink = TableSink(table_name(tmp_path, "target"), SPEC)
    sink.create(spark.createDataFrame([], SPEC.target_schema))
    return Source(spark, tmp_path / "changes"), WriteBehind(SPEC, sink, "persons", str(tmp_path))


def persons(spark, recipe):
    return {r["person_id"]: (r["first"], r["age"]) for r in recipe.sink.read(spark).collect()}


def acks(spark, recipe):
    return sorted((r["ack_key"], r["status"]) for r in spark.read.parquet(recipe.acks_path).collect())


def test_write_behind(spark, behind):
    source, recipe = behind
    source.add(("person:1", person("foo", 22)), ("other:1", person("no", 1)))
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {"1": ("foo", 22)}
    source.add(("person:1", None))
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {}


def test_operations_and_acks(spark, behind):
    source, recipe = behind
    source.add(("person:1", person("foo", 22, "+")), ("person:1", person("foo", 22, "+1")))
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {}
    source.add(("person:1", person("foo", 22, "=2")))
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {"1": ("foo", 22)}
    assert acks(spark, recipe) == [("{person:1}1", "done"), ("{person:1}2", "done")]
    source.add(("person:1", {"#": "-"}), ("person:1", {"#": "-3"}))
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {"1": ("foo", 22)}
    source.add(("person:1", person("foo", 22, "+")), ("person:1", {"#": "~4"}))
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {}
    assert acks(spark, recipe) == [(f"{{person:1}}{i}", "done") for i in (1, 2, 3, 4)]


def test_poison_records_do_not_stop_the_batch(spark, behind):
    source, recipe = behind
    source.add(
        ("person:1", person("foo", 22)),
        ("person:2", person("bar", "old", "=9")),
        ("person:3", {"first_name": "x"}),
        ("person:4", person("baz", 1)),
    )
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {"1": ("foo", 22), "4": ("baz", 1)}
    dead = capture.dead_letters(log.read(spark, recipe.log_path, SPEC))
    assert {r["key"]: r["error"] for r in dead.collect()} == {
        "person:2": "bad value for age",
        "person:3": "missing field last_name",
    }
    failed = delivery.acks_failed(dead, F.current_timestamp()).collect()
    assert [(r["ack_key"], r["status"], r["error"]) for r in failed] == [
        ("{person:2}9", "failed", "bad value for age")
    ]


def test_restart_after_a_crash_behind_the_commit(spark, behind):
    """The target has the batch, the checkpoint does not: the batch comes again."""
    source, recipe = behind
    source.add(("person:1", person("a", 1)), ("person:2", person("b", 2)))
    write = recipe.sink.apply

    def crash(net, positions):
        write(net, positions)
        raise OSError("killed")

    recipe.sink.apply = crash
    recipe.capture(source.stream(), NOW).awaitTermination()
    with pytest.raises(Exception, match="killed"):
        recipe.apply(spark, NOW).awaitTermination()
    recipe.sink.apply = write
    source.add(("person:1", person("c", 3)), ("person:2", None))
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {"1": ("c", 3)}


def test_lost_checkpoint_replays_everything(spark, behind, tmp_path):
    source, recipe = behind
    for i in range(3):
        source.add(("person:1", person(f"v{i}", i)), ("person:2", None if i == 2 else person("b", i)))
        recipe.run_once(source.stream())
    before = persons(spark, recipe)
    changeflow.streaming.apply_log.start_apply(
        spark, SPEC, recipe.log_path, recipe.sink, recipe.acks_path, str(tmp_path / "fresh"), trigger=NOW
    ).awaitTermination()
    recipe.catch_up(spark)
    assert persons(spark, recipe) == before == {"1": ("v2", 2)}


def test_late_files_are_written_and_acknowledged(spark, behind):
    """Even ids come in a later file than odd ones, with the same shards."""
    source, recipe = behind
    records = [(i, 1000 + i, "hset", f"person:{i}", person("a", i, f"=u{i}")) for i in range(40)]
    for half in (1, 0):
        spark.createDataFrame(records[half::2], source.schema).coalesce(1).write.mode("append").parquet(source.path)
        recipe.run_once(source.stream())
    assert len(persons(spark, recipe)) == 40
    assert len(acks(spark, recipe)) == 40


def test_apply_before_the_first_capture_and_two_recipes_on_one_target(spark, behind, tmp_path):
    source, recipe = behind
    recipe.apply(spark, NOW).awaitTermination()
    other = replace_name(recipe, "others")
    source.add(("person:1", person("a", 1)))
    running = recipe.apply(spark, {"processingTime": "1 second"})
    try:
        assert other.apply(spark, NOW).awaitTermination(60)
    finally:
        running.stop()
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {"1": ("a", 1)}


def replace_name(recipe, name):
    return WriteBehind(recipe.spec, recipe.sink, name, recipe.folder)


def test_write_through_takes_late_and_repeated_batches(spark, tmp_path):
    recipe = through(spark, tmp_path)
    recipe.folder = str(tmp_path / "through")
    first = stage(spark, 9, ("person:1", person("a", 1, "=x")), ("person:2", {"first_name": "p", "#": "=y"}))
    for _ in range(2):
        given = {r["ack_key"]: r["status"] for r in recipe.commit(first, 0).collect()}
        assert given == {"{person:1}x": "done", "{person:2}y": "failed"}
    # Lower ids in a later batch are written all the same, to both sides.
    second = stage(spark, 5, ("person:1", person("b", 2, "=z")), ("person:2", person("q", 3, "+")))
    for _ in range(2):
        assert [r["status"] for r in recipe.commit(second, 1).collect()] == ["done"]
        target = {r["person_id"]: r["first"] for r in recipe.sink.read(spark).collect()}
        assert target == {"1": "b"}
        held = {r["key"]: r["fields"]["first_name"] for r in recipe.source.read(spark).collect()}
        assert held == {"person:1": "b", "person:2": "q"}


def test_other_records_under_an_old_number_are_another_batch(spark, tmp_path):
    """As where the checkpoint is lost and the folder is not."""
    recipe = through(spark, tmp_path)
    recipe.folder = str(tmp_path / "through")
    for first in ("a", "b"):
        batch = stage(spark, 9, (f"person:{first}", person(first, 1, f"={first}")), ("person:1", person(first, 1)))
        for _ in range(2):
            assert [r["ack_key"] for r in recipe.commit(batch, 0).collect()] == [f"{{person:{first}}}{first}"]
    assert {r["person_id"]: r["first"] for r in recipe.sink.read(spark).collect()} == {"a": "a", "b": "b", "1": "b"}
    assert recipe.source.read(spark).count() == 3


def test_write_through_as_a_stream(spark, tmp_path):
    recipe = through(spark, tmp_path)
    recipe.folder = str(tmp_path / "through")
    path = str(tmp_path / "staged")
    for i in range(2):
        stage(spark, i, ("person:1", person(f"v{i}", i, f"=u{i}"))).write.mode("append").parquet(path)
        stream = spark.readStream.schema(changes.STAGED_WRITES).parquet(path)
        recipe.start(stream, NOW).awaitTermination()
    assert [r["first"] for r in recipe.sink.read(spark).collect()] == ["v1"]
    assert {r["ack_key"] for r in spark.read.parquet(recipe.acks_path).collect()} == {"{person:1}u0", "{person:1}u1"}


def test_write_through_refuses_targets_without_transactions():
    from changeflow.sinks.stores import WideColumnSink

    sink = WideColumnSink(lambda: None, replace(SPEC, exactly_once=False))
    with pytest.raises(ValueError, match="as a whole"):
        changeflow.plans.recipes.WriteThrough(SPEC, sink, None)


def test_failing_target_stops_the_query_and_loses_nothing(spark, behind):
    source, recipe = behind
    source.add(("person:1", person("a", 1)))
    write, recipe.sink.apply = recipe.sink.apply, lambda *_: (_ for _ in ()).throw(OSError("down"))
    with pytest.raises(Exception, match="down"):
        recipe.run_once(source.stream())
    assert persons(spark, recipe) == {}
    recipe.sink.apply = write
    recipe.run_once(source.stream())
    assert persons(spark, recipe) == {"1": ("a", 1)}


def test_documents(spark, tmp_path):
    recipe = changeflow.document_write_behind(
        keys_prefix="person",
        sink=lambda spec: TableSink(table_name(tmp_path, "docs"), spec, "fields"),
        target="persons",
        pk="person_id",
        name="docs",
        folder=str(tmp_path),
    )
    recipe.sink.create(spark.createDataFrame([], "person_id string, fields map<string,variant>"))
    source = Source(spark, tmp_path / "changes", changes.DOCUMENT_CHANGES)

    def docs():
        rows = recipe.sink.read(spark).select("person_id", F.to_json("fields").alias("f")).collect()
        return {r["person_id"]: json.loads(r["f"]) for r in rows}

    first = {"some": "value", "and another": ["set", "of", "values"]}
    source.add(("person:1", json.dumps(first)), event="json.set")
    recipe.run_once(source.stream())
    assert docs() == {"1": first}
    source.add(("person:1", json.dumps({"some": "other", "new": 1})), event="json.set")
    recipe.run_once(source.stream())
    assert docs() == {"1": {**first, "some": "other", "new": 1}}
    big = {f"field{i}": "x" * 50 for i in range(254)} | {"nested": {"a": [1, {"b": None}]}, "n": 1.5}
    source.add(("person:1", None), ("person:2", json.dumps(big)), ("thing:1", "{}"), event="json.set")
    recipe.run_once(source.stream())
    assert docs() == {"2": big}


def test_fan_out(spark, tmp_path):
    things = replace(SPEC, target="things", keys_prefix="thing", pk="thing_id")
    sinks = []
    for spec in (SPEC, things):
        sink = TableSink(table_name(tmp_path, spec.target), spec)
        sink.create(spark.createDataFrame([], spec.target_schema))
        sinks.append((spec, sink))
    source = Source(spark, tmp_path / "changes")
    for i in range(2):
        source.add(("person:1", person(f"p{i}", i)), ("thing:1", person(f"t{i}", i)), ("thing:2", None))
        start_fan_out(source.stream(), sinks, str(tmp_path / "cp"), NOW).awaitTermination()
        source.add(("thing:3", person("x", "no", "=9")), ("person:2", {"#": "-8"}))
    start_fan_out(source.stream(), sinks, str(tmp_path / "cp"), NOW).awaitTermination()
    got = [[tuple(r) for r in sink.read(spark).collect()] for _, sink in sinks]
    dead = capture.dead_letters(read_log(spark, str(tmp_path / "cp"), things)).collect()
    assert [(r["key"], r["error"]) for r in dead] == [("thing:3", "bad value for age")] * 2
    given = spark.read.parquet(acks_folder(str(tmp_path / "cp"), SPEC)).collect()
    assert [(r["ack_key"], r["status"]) for r in given] == [("{person:2}8", "done")] * 2
    assert got == [[("1", "p1", "bar", 1)], [("1", "t1", "bar", 1)]]


def fan_out_parts(spark, tmp_path):
    things = replace(SPEC, target="things", keys_prefix="thing", pk="thing_id")
    routes = []
    for spec in (SPEC, things):
        sink = TableSink(table_name(tmp_path, spec.target), spec)
        sink.create(spark.createDataFrame([], spec.target_schema))
        routes.append((spec, sink))
    return routes


def test_fan_out_with_a_lost_checkpoint_loses_nothing(spark, tmp_path):
    """Three batches, then a new checkpoint of the capture, whose batches are numbered from 0 again."""
    routes, folder = fan_out_parts(spark, tmp_path), str(tmp_path / "cp")
    for run in (0, 1):
        for part in range(3):
            source = Source(spark, tmp_path / f"changes{run}")
            source.n = 10 * part
            source.add(*[(f"person:{run}-{part}-{i}", person("a", i, f"=u{i}")) for i in range(10)])
            specs = [spec for spec, _ in routes]
            start_capture(source.stream(), specs, log_folder(folder), f"{folder}/capture{run}", trigger=NOW).awaitTermination()
            for spec, sink in routes:
                own = f"{folder}/{spec.target}"
                start_apply(spark, spec, log_folder(folder), sink, f"{own}/acks", f"{own}/apply", trigger=NOW).awaitTermination()
    assert routes[0][1].read(spark).count() == 60
    assert spark.read.parquet(acks_folder(folder, SPEC)).where("status = 'done'").count() == 60


def test_capture_with_a_lost_checkpoint_and_ids_that_step_back(spark, behind):
    """The second capture has lower ids and a checkpoint of its own: nothing is skipped."""
    source, recipe = behind
    for run, ms in ((0, 5000), (1, 1000)):
        rows = [(i, ms, "hset", f"person:{run}-{i}", person("a", i, f"=u{i}")) for i in range(10)]
        path = f"{source.path}{run}"
        spark.createDataFrame(rows, source.schema).write.parquet(path)
        stream = changes.hash_changes(spark, path, stream=True)
        start_capture(stream, SPEC, recipe.log_path, f"{recipe.root}/capture{run}", trigger=NOW).awaitTermination()
        recipe.apply(spark, NOW).awaitTermination()
    assert len(persons(spark, recipe)) == 20 and len(acks(spark, recipe)) == 20


def test_a_repeated_capture_batch_is_in_the_log_once(spark, tmp_path):
    rows = [(i, 1, "hset", f"person:{i}", person("a", i)) for i in range(5)]
    batch = spark.createDataFrame(rows, changes.HASH_CHANGES)
    captured = [(SPEC, capture.capture(batch, SPEC))]
    path = str(tmp_path / "log")
    assert log.LogWriter(path).add(batch, captured, 0) == 1
    assert log.LogWriter(path).add(batch, captured, 0) is None
    other = batch.withColumn("ms", F.lit(2).cast("bigint"))
    writer = log.LogWriter(path)
    assert writer.add(other, [(SPEC, capture.capture(other, SPEC))], 0) == 2
    assert writer.add(batch.limit(0), captured, 1) is None
    # What a broken try wrote beside the log does not count.
    capture.capture(batch, SPEC).drop("target").write.partitionBy("route").parquet(f"{path}/records/persons/arrived=3")
    assert {r["arrived"] for r in log.read(spark, path, SPEC).collect()} == {1, 2}
    assert writer.add(batch, captured, 1) == 3 and log.read(spark, path, SPEC).count() == 15


def test_a_dead_target_holds_up_no_other(spark, tmp_path):
    routes, folder = fan_out_parts(spark, tmp_path), str(tmp_path / "cp")
    source = Source(spark, tmp_path / "changes")
    source.add(("person:1", person("p", 1)), ("thing:1", person("t", 1)))
    write, routes[0][1].apply = routes[0][1].apply, lambda *_: (_ for _ in ()).throw(OSError("down"))
    with pytest.raises(Exception, match="down"):
        start_fan_out(source.stream(), routes, folder, NOW).awaitTermination()
    assert [r["first"] for r in routes[1][1].read(spark).collect()] == ["t"]
    routes[0][1].apply = write
    start_fan_out(source.stream(), routes, folder, NOW).awaitTermination()
    assert [r["first"] for r in routes[0][1].read(spark).collect()] == ["p"]


def test_fan_out_reads_its_source_once(spark, tmp_path):
    routes = fan_out_parts(spark, tmp_path)
    source = Source(spark, tmp_path / "changes")
    source.add(*[(f"person:{i}", person("p", i)) for i in range(7)], ("thing:1", person("t", 1)))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    stream = source.stream()
    start_fan_out(stream.mapInArrow(counted, stream.schema), routes, str(tmp_path / "cp"), NOW).awaitTermination()
    assert reads.value == 8 and [sink.read(spark).count() for _, sink in routes] == [7, 1]


def test_a_batch_of_deletes_only_moves_the_position_of_copies(spark, tmp_path):
    spec = ReplicationSpec(target="copies", pk="key", keys_prefix="key", whole_hashes=True, shards=1)
    sink = TableSink(table_name(tmp_path, "copies"), spec, "fields", new_prefix="copy")
    sink.create(spark.createDataFrame([], "key string, fields map<string,string>"))
    recipe = WriteBehind(spec, sink, "copies", str(tmp_path))
    source = Source(spark, tmp_path / "changes")
    source.add(("key:1", {"#": "~9"}))
    recipe.run_once(source.stream())
    assert acks(spark, recipe) == [("{key:1}9", "done")]


def test_ack_status(spark):
    at = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    rows = spark.createDataFrame([("p:1", "a", "e1"), ("p:2", "b", "e2"), ("p:3", None, None)], "key string, uuid string, error string")
    made = delivery.acks_done(rows.where("key = 'p:1'"), at).unionByName(
        delivery.acks_failed(rows.where("key <> 'p:1'"), at)
    )
    assert sorted(r["ack_key"] for r in made.collect()) == ["{p:1}a", "{p:2}b"]
    asked = spark.createDataFrame([("p:1", "a"), ("p:2", "b"), ("p:3", "c")], "key string, uuid string")

    def status(now):
        out = delivery.ack_status(asked, made, F.to_timestamp(F.lit(now)))
        return {r["key"]: (r["status"], r["error"]) for r in out.collect()}

    assert status("2024-01-01 00:59:59") == {"p:1": ("done", None), "p:2": ("failed", "e2"), "p:3": ("pending", None)}
    assert status("2024-01-01 01:00:00") == {"p:1": ("expired", None), "p:2": ("expired", None), "p:3": ("pending", None)}


def through(spark, tmp_path, documents=False):
    source_spec = ReplicationSpec(target="source", pk="key", keys_prefix="x", exactly_once=False)
    source = TableSink(table_name(tmp_path, "source"), source_spec, "fields")
    value = "variant" if documents else "string"
    source.create(spark.createDataFrame([], f"key string, fields map<string,{value}>"))
    mode = "fields" if documents else "merge"

    def sink(spec):
        made = TableSink(table_name(tmp_path, "target"), replace(spec, retry_seconds=0), mode)
        empty = "person_id string, fields map<string,variant>" if documents else spec.target_schema
        made.create(spark.createDataFrame([], empty))
        return made

    if documents:
        return changeflow.document_write_through("__", sink, source, "persons", "person_id")
    return changeflow.write_through("__", PERSONS, sink, source, "persons", "person_id", {"age": "int"})


def stage(spark, ms, *writes):
    rows = [(i, ms, "hset", f"__{{{key}}}", fields) for i, (key, fields) in enumerate(writes)]
    return spark.createDataFrame(rows, changes.STAGED_WRITES)


def test_write_through(spark, tmp_path):
    recipe = through(spark, tmp_path)

    def both():
        target = {r["person_id"]: (r["first"], r["age"]) for r in recipe.sink.read(spark).collect()}
        return target, {r["key"]: r["fields"] for r in recipe.source.read(spark).collect()}

    full = person("foo", 20)
    given = recipe.commit(stage(spark, 1, ("person:1", {**full, "#": "=a"}))).collect()
    assert [(r["ack_key"], r["status"]) for r in given] == [("{person:1}a", "done")]
    assert both() == ({"1": ("foo", 20)}, {"person:1": full})
    recipe.commit(stage(spark, 2, ("person:1", {"first_name": "foo1"})))
    assert both() == ({"1": ("foo1", 20)}, {"person:1": {**full, "first_name": "foo1"}})
    recipe.commit(stage(spark, 3, ("person:1", {"#": "-b"}), ("person:2", {**full, "#": "+"})))
    assert both() == ({"1": ("foo1", 20)}, {"person:2": full})
    recipe.commit(stage(spark, 4, ("person:1", {"#": "~"})))
    assert both() == ({}, {"person:2": full})


def test_write_through_where_the_target_fails(spark, tmp_path):
    recipe = through(spark, tmp_path)
    recipe.spec = replace(recipe.spec, max_retries=0)

    def down(net, positions):
        raise OSError("cannot connect")

    recipe.sink.apply = down
    given = recipe.commit(
        stage(
            spark,
            1,
            ("person:1", person("foo", 20, "=a")),
            ("person:2", person("foo", 20, "+b")),
            ("person:3", person("foo", "x", "=c")),
        )
    ).collect()
    assert {r["ack_key"]: (r["status"], r["error"]) for r in given} == {
        "{person:1}a": ("failed", "cannot connect"),
        "{person:2}b": ("done", None),
        "{person:3}c": ("failed", "bad value for age"),
    }
    assert recipe.sink.read(spark).count() == 0
    assert [r["key"] for r in recipe.source.read(spark).collect()] == ["person:2"]


def test_document_write_through(spark, tmp_path):
    recipe = through(spark, tmp_path, documents=True)

    def staged(ms, *docs):
        rows = [(i, ms, "json.set", f"__{{{key}}}", doc) for i, (key, doc) in enumerate(docs)]
        return spark.createDataFrame(rows, changes.DOCUMENT_CHANGES)

    recipe.commit(staged(1, ("person:1", '{"a": 1, "b": {"c": 2}}'), ("person:2", "broken")))
    recipe.commit(staged(2, ("person:1", '{"a": "it\'s"}')))
    want = {"a": "it's", "b": {"c": 2}}
    for sink, key in ((recipe.sink, "1"), (recipe.source, "person:1")):
        rows = sink.read(spark).withColumn("f", F.to_json("fields")).collect()
        assert {r[0]: json.loads(r["f"]) for r in rows} == {key: want}
    fields = spark.createDataFrame([('{"a": 1}',)], "d string").select(document_fields(F.col("d"))).first()[0]
    assert fields["a"].toPython() == 1


def test_catch_up_skips_what_all_shards_have_behind_them(spark, behind):
    source, recipe = behind
    for name in ("z", "a"):
        source.add(*[(f"person:{i}", person(name, i)) for i in range(30)])
        recipe.run_once(source.stream())
    source.add(*[(f"person:{i}", person("b", i)) for i in range(30)])
    recipe.capture(source.stream(), NOW).awaitTermination()
    held = recipe.sink.watermark(spark)
    rest = log.read_after(spark, recipe.log_path, SPEC, held)
    assert held.count() == SPEC.shards and rest.count() == 60
    recipe.catch_up(spark)
    assert set(persons(spark, recipe).values()) == {("b", i) for i in range(30)}


def test_whole_hashes_are_copied_without_deletes(spark, tmp_path):
    spec = ReplicationSpec(target="copies", pk="key", keys_prefix="key", whole_hashes=True, shards=2)
    sink = TableSink(table_name(tmp_path, "copies"), spec, "fields", new_prefix="copy")
    sink.create(spark.createDataFrame([], "key string, fields map<string,string>"))
    recipe = WriteBehind(spec, sink, "copies", str(tmp_path))
    source = Source(spark, tmp_path / "changes")
    source.add(("key:1", {"bin1": "a", "bin2": "b", "_x": "no"}), ("key:1", None), ("key:2", {"bin1": "c", "#": "+"}))
    recipe.run_once(source.stream())
    source.add(("key:1", {"bin1": "z"}))
    recipe.run_once(source.stream())
    assert {r["key"]: r["fields"] for r in sink.read(spark).collect()} == {"copy:1": {"bin1": "z", "bin2": "b"}}


def test_mapped_columns_as_prefixed_hashes(spark, tmp_path):
    sink = TableSink(table_name(tmp_path, "hashes"), replace(SPEC, pk="key"), "fields", new_prefix="p")
    sink.create(spark.createDataFrame([("p:1", {"age": "1", "other": "x"})], "key string, fields map<string,string>"))
    recipe = WriteBehind(replace(SPEC, pk="key"), sink, "hashes", str(tmp_path))
    source = Source(spark, tmp_path / "changes")
    source.add(("person:1", person("foo", 22)), ("person:2", person("bar", 3)), ("person:2", None))
    recipe.run_once(source.stream())
    got = {r["key"]: r["fields"] for r in sink.read(spark).collect()}
    assert got == {"p:1": {"first": "foo", "last": "bar", "age": "22", "other": "x"}}
