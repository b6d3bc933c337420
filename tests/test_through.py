"""Write-through against a record-by-record replay."""

from __future__ import annotations

import random

import pytest
import replay
from pyspark.sql import functions as F

from changeflow.functions import states
from changeflow.operators import apply, fold, through
from changeflow.session import stored
from changeflow.spec import ReplicationSpec

SPEC = ReplicationSpec(
    target="persons",
    pk="person_id",
    keys_prefix="__",
    mappings={"f": "first", "l": "last", "a": "age"},
    types={"age": "int"},
    shards=2,
)
STAGED = "ms bigint, n bigint, key string, fields map<string,string>"


def staged_frame(spark, writes):
    rows = [
        (ms, n, key, {**values, "#": op + "u"} if values or op != "~" else None)
        for ms, n, key, op, values in writes
    ]
    return spark.createDataFrame(rows, STAGED)


def source_frame(spark, source):
    return spark.createDataFrame(list(source.items()), "key string, fields map<string,string>")


def random_writes(seed, records, keys, unfit_local):
    rnd = random.Random(seed)
    out = []
    for i in range(records):
        key = "person:hot" if rnd.random() < 0.3 else f"person:{rnd.randrange(keys)}"
        op = rnd.choices("=+-~", [10, 4, 1, 1])[0]
        values = {}
        if op in "=+":
            for name in rnd.sample(["f", "l", "a", "x"], rnd.randint(0, 3)):
                unfit = name == "a" and rnd.random() < 0.2 and (op == "=" or unfit_local)
                values[name] = "old" if unfit else str(i)
        out.append((100 + i // 2, i % 2, key, op, values))
    return out


@pytest.mark.parametrize("rows_per_task", [20, 1_000_000])
@pytest.mark.parametrize("seed, unfit_local", [(1, False), (2, True), (3, True)])
def test_outcomes_equal_replay(spark, seed, unfit_local, rows_per_task):
    writes = random_writes(seed, 1500, 60, unfit_local)
    source = {
        "person:1": {"f": "F", "l": "L", "a": "1", "y": "keep"},
        "person:2": {"f": "F", "a": "none"},
        "person:3": {"l": "L"},
        "person:hot": {"f": "F", "l": "L", "a": "bad"},
    }
    state, target, outcome = replay.write_through(source, writes, SPEC.fields, SPEC.types)
    decided = through.decide(
        staged_frame(spark, writes), source_frame(spark, source), SPEC, rows_per_task=rows_per_task
    )
    got = {(r["ms"], r["n"], r["key"]): r["done"] for r in decided.select("ms", "n", "key", "done").collect()}
    assert got == {(ms, n, key): done for ms, n, key, done in outcome}
    net = fold.net_change(through.replicated_log(decided), SPEC.columns)
    empty = spark.createDataFrame([], SPEC.target_schema)
    rows = apply.upsert_merge(empty, net, SPEC).collect()
    assert {r["person_id"]: (r["first"], r["last"], str(r["age"])) for r in rows} == {
        pk: (v["first"], v["last"], v["age"]) for pk, v in target.items()
    }
    changes = fold.net_fields(through.source_changes(decided), "key").withColumnRenamed("key", "pk")
    after = apply.merge_fields(source_frame(spark, source), changes, "key").collect()
    assert {r["key"]: r["fields"] for r in after} == state


def alternations(spark, monkeypatch, times):
    """Tables that are written to decide on a key whose number of unfit local updates grows."""
    written = []
    for module in (through, states):
        monkeypatch.setattr(module, "stored", lambda df, purpose: written.append(purpose) or stored(df, purpose))
    writes = [(0, 0, "person:1", "=", {"f": "f", "l": "l", "a": "1"})]
    for i in range(1, times + 1):
        writes += [(i, 0, "person:1", "+", {"a": "bad"}), (i, 1, "person:1", "=", {"f": "no"}), (i, 2, "person:1", "=", {"a": str(i)})]
    frame = spark.createDataFrame([(ms, n, key, {**v, "#": op}) for ms, n, key, op, v in writes], STAGED)
    got = through.decide(frame, source_frame(spark, {"q": {}}), SPEC).select("ms", "n", "done").collect()
    assert {(r["ms"], r["n"]): r["done"] for r in got} == {(ms, n): not (ms and n == 1) for ms, n, *_ in writes}
    return written


def test_the_number_of_passes_does_not_depend_on_the_writes(spark, monkeypatch):
    assert alternations(spark, monkeypatch, 4) == alternations(spark, monkeypatch, 80)


def test_states_of_writes_are_not_broadcast(spark, monkeypatch):
    plans = []
    for module in (through, states):
        monkeypatch.setattr(module, "stored", lambda df, purpose: plans.append((purpose, df._jdf.queryExecution().executedPlan().toString())) or stored(df, purpose))
    writes = random_writes(2, 600, 20, True)
    through.decide(staged_frame(spark, writes), source_frame(spark, {"q": {}}), SPEC)
    joined = [plan for purpose, plan in plans if purpose == "states"] + [plans[-1][1]]
    assert plans[-1][0] == "through" and len(joined) >= 2
    assert all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in joined)


@pytest.mark.parametrize("seed", [5, 6])
def test_states_before_equal_a_replay(spark, seed):
    rnd = random.Random(seed)
    kinds, rows, want = [], [], {}
    for key in range(4):
        s = rnd.randrange(16)
        kinds.append((key, s))
        for at in sorted(rnd.sample(range(70_000), (700, 3, 300, 1)[key])):
            kind, x, y = rnd.choice("sgg"), rnd.randrange(16), rnd.randrange(16)
            rows.append((key, at, kind, x, y))
            want[key, at] = s
            s = (s & x) | y if kind == "s" else 0 if s & x == 0 else s
    every = F.lit(15)
    f = F.when(F.col("kind") == "s", states.function(F.col("x"), F.col("y"))).otherwise(states.function(every, F.lit(0), guard=F.col("x")))
    records = spark.createDataFrame(rows, "key int, at long, kind string, x int, y int").select("key", "at", f.alias("f"))
    got = states.states_before(records, spark.createDataFrame(kinds, "key int, s long"), "key").collect()
    assert {(r["key"], r["at"]): r["s"] for r in got} == want


def test_partial_update_takes_the_rest_from_the_record(spark):
    writes = [
        (1, 0, "person:1", "=", {"f": "foo", "l": "bar", "a": "20"}),
        (2, 0, "person:1", "=", {"f": "foo1"}),
    ]
    decided = through.decide(staged_frame(spark, writes), source_frame(spark, {"q": {}}), SPEC)
    last = decided.where("ms = 2").first()
    assert (last["done"], last["first"], last["last"], last["age"]) == (True, "foo1", "bar", 20)


def test_reasons(spark):
    writes = [
        (1, 0, "person:1", "=", {"f": "foo"}),
        (1, 0, "person:2", "=", {"f": "foo", "l": "bar", "a": "x"}),
        (1, 0, "person:3", "?", {"f": "foo"}),
    ]
    decided = through.decide(staged_frame(spark, writes), source_frame(spark, {"q": {}}), SPEC)
    got = {r["pk"]: (r["done"], r["error"]) for r in decided.collect()}
    assert got == {
        "1": (False, "missing field l"),
        "2": (False, "bad value for age"),
        "3": (False, "unknown operation ?"),
    }


def test_nothing_is_replicated_where_the_target_is_down(spark):
    writes = [
        (1, 0, "person:1", "=", {"f": "foo", "l": "bar", "a": "20"}),
        (2, 0, "person:1", "+", {"f": "only here"}),
        (3, 0, "person:2", "~", {}),
        (3, 1, "person:3", "-", {}),
    ]
    source = {"person:2": {"f": "2"}, "person:3": {"f": "3"}}
    decided = through.decide(
        staged_frame(spark, writes), source_frame(spark, source), SPEC, target_up=False
    )
    assert {r["ms"]: r["done"] for r in decided.where("n = 0").collect()} == {1: False, 2: True, 3: False}
    assert through.replicated_log(decided).count() == 0
    changes = fold.net_fields(through.source_changes(decided), "key").withColumnRenamed("key", "pk")
    after = apply.merge_fields(source_frame(spark, source), changes, "key").collect()
    assert {r["key"]: r["fields"] for r in after} == {
        "person:1": {"f": "only here"},
        "person:2": {"f": "2"},
    }


def test_overlay_staged_wins(spark):
    staged = spark.createDataFrame([(1, 0, "p:1", {"a": "new"}), (1, 1, "p:2", {"a": "n"})], STAGED)
    source = source_frame(spark, {"p:1": {"a": "old", "b": "kept"}})
    got = {r["key"]: r["fields"] for r in through.overlay(staged, source).collect()}
    assert got == {"p:1": {"a": "new", "b": "kept"}, "p:2": {"a": "n"}}


def test_staging_keys(spark):
    rows = [(1, 0, "__{person:1}", {}), (1, 1, "__x", {}), (1, 2, "person:1", {})]
    chosen = through.select_staged(spark.createDataFrame(rows, STAGED), SPEC)
    assert sorted((r["n"], r["key"]) for r in chosen.collect()) == [(0, "person:1"), (1, None)]


def test_staged_documents(spark):
    rows = [(1, 0, "p:1", '{"a":1}'), (1, 1, "p:2", "no"), (1, 2, "p:3", None)]
    staged = spark.createDataFrame(rows, "ms bigint, n bigint, key string, doc string")
    got = {r["key"]: (r["op"], r["done"], r["error"]) for r in through.decide_documents(staged, SPEC).collect()}
    assert got == {
        "p:1": ("=", True, None),
        "p:2": ("=", False, "not a JSON object"),
        "p:3": ("~", True, None),
    }


def test_writes_without_a_real_key_are_refused_one_by_one(spark):
    writes = [(i, 0, "__broken", {"f": "x"}) for i in range(300)] + [(1, 1, "__{person:1}", {"f": "F", "l": "L", "a": "1"})]
    staged = through.select_staged(spark.createDataFrame(writes, STAGED), SPEC)
    decided = through.decide(staged, source_frame(spark, {"q": {}}), SPEC, rows_per_task=20)
    got = decided.groupBy("done", "error").count().collect()
    assert sorted(tuple(r) for r in got) == [(False, "no real key in the staging key", 300), (True, None, 1)]
