"""Folds and applies against a record-by-record replay."""

from __future__ import annotations

import random

import pytest
import replay
from pyspark.sql import functions as F

from changeflow.operators import apply, delivery, fold
from changeflow.spec import ReplicationSpec

SPEC = ReplicationSpec(
    target="t", pk="id", keys_prefix="k", mappings={"a": "x", "b": "y"}, shards=3
)
LOG = "target string, shard int, ms bigint, n bigint, pk string, op string, x string, y string"
TARGET = {str(k): {"x": f"ox{k}", "y": None, "z": f"oz{k}"} for k in range(0, 60, 2)}


def log_frame(spark, log):
    rows = [("t", 0, ms, n, pk, op, c.get("x"), c.get("y")) for ms, n, pk, op, c in log]
    return spark.createDataFrame(rows, LOG).withColumn("shard", SPEC.shard(F.col("pk")))


def target_frame(spark, rows):
    data = [(k, v.get("x"), v.get("y"), v.get("z")) for k, v in rows.items()]
    return spark.createDataFrame(data, "id string, x string, y string, z string")


def as_dict(df):
    return {r["id"]: (r["x"], r["y"], r["z"]) for r in df.collect()}


def tuples(rows):
    return {k: (v.get("x"), v.get("y"), v.get("z")) for k, v in rows.items()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "write, replace",
    [
        (apply.upsert_merge, False),
        (apply.upsert_merge_small, False),
        (apply.upsert_replace, True),
    ],
)
def test_upsert_equals_replay(spark, seed, write, replace):
    log = replay.random_log(seed, 60, 1500, ("x", "y"), hot="7")
    net = fold.net_change(log_frame(spark, log), SPEC.columns)
    got = as_dict(write(target_frame(spark, TARGET), net, SPEC))
    assert got == tuples(replay.merge(TARGET, log, ("x", "y"), replace))


def test_log_in_any_file_order_gives_the_same(spark):
    log = replay.random_log(3, 40, 800, ("x", "y"))
    shuffled = log[:]
    random.Random(9).shuffle(shuffled)
    one = fold.net_change(log_frame(spark, log), SPEC.columns)
    other = fold.net_change(log_frame(spark, shuffled).repartition(7), SPEC.columns)
    assert sorted(one.collect()) == sorted(other.collect())


def test_split_and_repeated_batches_equal_replay(spark):
    log = replay.random_log(4, 40, 600, ("x", "y"))
    rnd = random.Random(5)
    target = target_frame(spark, TARGET)
    watermark = spark.createDataFrame([], delivery.WATERMARK)
    start = 0
    while start < len(log):
        # Overlap with what was already applied, as after a crash before the checkpoint.
        batch = log_frame(spark, log[max(0, start - rnd.randint(0, 80)) : start + 150])
        fresh = delivery.skip_applied(batch, watermark)
        merged = apply.upsert_merge(target, fold.net_change(fresh, SPEC.columns), SPEC)
        moved = delivery.advance(watermark, batch)
        target = spark.createDataFrame(merged.collect(), merged.schema)
        watermark = spark.createDataFrame(moved.collect(), moved.schema)
        start += 150
    assert as_dict(target) == tuples(replay.merge(TARGET, log, ("x", "y")))
    assert sorted(r["shard"] for r in watermark.collect()) == [0, 1, 2]


def test_delete_between_old_row_and_update_resets_other_columns(spark):
    log = [(1, 0, "0", "=", {"x": "1", "y": "1"}), (2, 0, "0", "~", {}), (9, 0, "0", "=", {"x": "2", "y": "2"})]
    net = fold.net_change(log_frame(spark, log), SPEC.columns)
    assert as_dict(apply.upsert_merge(target_frame(spark, {"0": TARGET["0"]}), net, SPEC)) == {
        "0": ("2", "2", None)
    }


def test_ids_compare_as_numbers(spark):
    log = [(9, 0, "0", "=", {"x": "late"}), (10, 0, "0", "=", {"x": "later"}), (10, 11, "0", "=", {"x": "last"}), (10, 9, "0", "~", {})]
    assert fold.net_change(log_frame(spark, log), SPEC.columns).first()["x"] == "last"


def test_delete_of_an_absent_key_does_nothing(spark):
    net = fold.net_change(log_frame(spark, [(1, 0, "none", "~", {})]), SPEC.columns)
    target = target_frame(spark, TARGET)
    assert as_dict(apply.delete(target, net, "id")) == as_dict(target)
    assert as_dict(apply.upsert_merge(target, net, SPEC)) == as_dict(target)


def field_log(seed):
    rnd = random.Random(seed)
    log = []
    for ms, n, pk, op, _ in replay.random_log(seed, 30, 1200, (), hot="5"):
        names = rnd.sample(["a", "b", "c", "d", "e"], rnd.randint(0, 3))
        values = {f: rnd.choice([None, f"{f}{ms}.{n}"]) for f in names}
        log.append((ms, n, pk, op, values if op == "=" else None))
    return log


@pytest.mark.parametrize("seed", [11, 12])
def test_field_merge_equals_replay(spark, seed):
    log = field_log(seed)
    target = {str(k): {"a": "old", "z": f"z{k}"} for k in range(0, 40, 3)}
    changes = spark.createDataFrame(
        [(ms, n, pk, op, f) for ms, n, pk, op, f in log],
        "ms bigint, n bigint, pk string, op string, fields map<string,string>",
    )
    before = spark.createDataFrame(list(target.items()), "id string, fields map<string,string>")
    merged = apply.merge_fields(before, fold.net_fields(changes), "id")
    got = {r["id"]: r["fields"] for r in merged.collect()}
    assert got == replay.merge_fields(target, log)


def test_empty_document_stays_a_key(spark):
    changes = spark.createDataFrame(
        [(1, 0, "1", "=", {}), (1, 1, "2", "~", None)],
        "ms bigint, n bigint, pk string, op string, fields map<string,string>",
    )
    got = {r["pk"]: (r["op"], r["fields"]) for r in fold.net_fields(changes).collect()}
    assert got == {"1": ("=", {}), "2": ("~", {})}


def test_drift_tells_the_side(spark):
    source = spark.createDataFrame(
        [("1", "a", "b"), ("2", "a", None), ("3", "a", "b")], "pk string, x string, y string"
    )
    target = target_frame(
        spark, {"2": {"x": "a"}, "3": {"x": "q", "y": "b"}, "4": {"x": "a", "y": "b"}}
    )
    got = {r["id"]: r["state"] for r in apply.drift(source, target, SPEC).collect()}
    assert got == {"1": "source only", "3": "different", "4": "target only"}
