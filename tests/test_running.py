"""Running aggregates, batch numbers and op runs, with and without hot keys."""

from __future__ import annotations

import random

import pytest
import replay
from pyspark.sql import functions as F

from changeflow.functions.running import cut_hot_keys, running, with_order
from changeflow.operators import batches


def rows(seed=1, count=4000, same_ms=False):
    rnd = random.Random(seed)
    out = []
    for i in range(count):
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(50)}"
        ms = 1000 if same_ms else 1000 + i // 3
        out.append((key, ms, i if same_ms else i % 3, rnd.choice([None, rnd.randrange(1000)])))
    return out


@pytest.mark.parametrize("same_ms", [False, True])
@pytest.mark.parametrize("rows_per_task", [10, 1_000_000])
def test_running_equals_a_loop(spark, rows_per_task, same_ms):
    data = rows(same_ms=same_ms)
    frame = spark.createDataFrame(data, "key string, ms bigint, n bigint, v int").repartition(5)
    cut, hot = cut_hot_keys(frame, ["key"], rows_per_task)
    assert hot == (rows_per_task == 10)
    if hot:
        sizes = {(r[0], r[1]): r[2] for r in cut.groupBy("key", "_segment").count().collect()}
        assert {s for k, s in sizes if k != "hot"} == {-1}
        assert max(c for (k, _), c in sizes.items() if k == "hot") < 700
    out = running(
        cut,
        ["key"],
        hot,
        maxima={"top": F.struct("v"), "high": F.col("v")},
        sums={"total": F.col("v"), "seen": F.lit(1)},
        lasts={"latest": F.col("v")},
    )
    fields = ("high", "total", "seen", "latest")
    got = {(r["key"], r["ms"], r["n"]): tuple(r[f] for f in fields) for r in out.collect()}
    state: dict[str, list[int | None]] = {}
    want = {}
    for key, ms, n, v in data:
        before = state.setdefault(key, [])
        known = [x for x in before if x is not None]
        want[(key, ms, n)] = (
            max(known, default=None),
            sum(known),
            len(before),
            known[-1] if known else None,
        )
        before.append(v)
    assert got == want
    order = with_order(cut, ["key"], "at").orderBy("ms", "n").select("key", "at").collect()
    for name in {r["key"] for r in order}:
        places = [r["at"] for r in order if r["key"] == name]
        assert places == sorted(set(places)) and places[0] > 0


@pytest.mark.parametrize("rows_per_task", [10, 1_000_000])
def test_batches_and_runs_equal_a_loop(spark, rows_per_task):
    log = replay.random_log(6, 30, 3000, ())
    frame = spark.createDataFrame(
        [("t", int(pk) % 3, ms, n, pk, op) for ms, n, pk, op, _ in log],
        "target string, shard int, ms bigint, n bigint, pk string, op string",
    ).repartition(6)
    want_batch, want_runs, seen, last = {}, {}, {}, {}
    for ms, n, pk, op, _ in log:
        shard = int(pk) % 3
        want_batch[(shard, ms, n)] = seen.get(shard, 0) // 100
        seen[shard] = seen.get(shard, 0) + 1
        run, before = last.get(shard, (0, None))
        if op != before:
            run += 1
            want_runs[(shard, run)] = [op, 0, (ms, n), None]
        want_runs[(shard, run)][1] += 1
        want_runs[(shard, run)][3] = (ms, n)
        last[shard] = (run, op)
    numbered = batches.number_batches(frame, 100, rows_per_task)
    assert {(r["shard"], r["ms"], r["n"]): r["batch_no"] for r in numbered.collect()} == want_batch
    runs = batches.op_runs(frame, rows_per_task).collect()
    got = {
        (r["shard"], r["run_no"]): [
            r["op"], r["records"], (r["first_ms"], r["first_n"]), (r["last_ms"], r["last_n"])
        ]
        for r in runs
    }
    assert got == want_runs
    counts = batches.count_batches(numbered).collect()
    assert sum(r["records"] for r in counts) == len(log)
    assert max(r["records"] for r in counts) == 100
    assert all(r["keys"] == sorted(set(r["keys"])) for r in batches.changed_keys(numbered).collect())
