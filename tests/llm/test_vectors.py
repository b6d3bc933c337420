"""Grid order join and vector codes against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from corpora import CLASHES
from pyspark.sql import functions as F

from changeflow.llm import grid_join, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def cloud(rng: np.random.Generator, dims: int = 16) -> list[tuple]:
    """Scattered vectors, tight and loose groups, chains at the threshold, copies, and useless rows."""
    rows = []

    def add(v, label) -> None:
        rows.append([None if v is None else [None if x is None else float(np.float32(x)) for x in v], label])

    for v in rng.normal(size=(150, dims)):
        add(v, int(rng.integers(3)))
    for spread, n in ((0.01, 120), (0.08, 60), (0.2, 60)):
        center = rng.normal(size=dims)
        for _ in range(n):
            add((center / np.linalg.norm(center) + rng.normal(size=dims) * spread / math.sqrt(dims) * 2) * rng.uniform(0.5, 3), 1)
    for k in range(40):
        # Neighbours along the arc are linked, others are not.
        at = k * math.acos(0.935)
        add([math.cos(at / 8), math.sin(at / 8), *[0.0] * (dims - 2)], 2)
    same = rng.normal(size=dims)
    for _ in range(30):
        add(same, 0)
    for useless in ([0.0] * dims, [float("nan"), *[1.0] * (dims - 1)], [float("inf"), *[1.0] * (dims - 1)], [None, *[1.0] * (dims - 1)], [], None):
        add(useless, 0)
    add(same, None)
    add(same[: dims - 1], 0)
    add(same[: dims - 1], 0)
    order = rng.permutation(len(rows))
    return [(int(i), *row) for i, row in zip(order, rows, strict=True)]


def brute_links(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    fit = [
        r for r in rows
        if r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])
    ]
    near = {r[0]: set() for r in rows}
    for x in fit:
        for y in fit:
            if x[0] != y[0] and x[2] == y[2] and len(x[1]) == len(y[1]):
                a, b = np.array(x[1]), np.array(y[1])
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93:
                    near[x[0]].add(y[0])
    component = {}
    for i in sorted(near):
        if i in component:
            continue
        component[i], todo = i, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in component:
                    component[j] = i
                    todo.append(j)
    return {i: (len(near[i]), component[i]) for i in near}


@pytest.mark.parametrize(("block", "fan", "sub"), [(2048, 8, 64), (32, 2, 8), (7, 3, 3)])
def test_links_are_those_of_brute_force(spark, monkeypatch, block, fan, sub):
    monkeypatch.setattr(grid_join, "FAN", fan)
    monkeypatch.setattr(grid_join, "SUB", sub)
    rows = cloud(np.random.default_rng(block))
    found = grid_join.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block).collect()
    assert {r["id"]: (r["n_links"], r["component_id"]) for r in found} == brute_links(rows)
    assert len(found) == len(rows)


def test_large_groups_are_settled_without_their_pairs(spark, monkeypatch):
    compared = []
    real = grid_join._compared
    monkeypatch.setattr(grid_join, "_compared", lambda pairs, *rest: compared.append(pairs.count()) or real(pairs, *rest))
    rng = np.random.default_rng(3)
    center = rng.normal(size=32)
    rows = [(i, [float(x) for x in center + rng.normal(size=32) * 0.01], 1) for i in range(3000)]
    found = grid_join.near_vectors(spark.createDataFrame(rows, SCHEMA), block=50).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(2999, 0)}
    assert compared == [0]


def test_rows_without_ids_repeated_rows_and_other_types(spark):
    near, far = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(None, near, "x"), (5, near, "x"), (5, near, "x"), (None, far, "x"), (9, far, "y"), (None, None, None)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found = sorted(((r["id"], r["n_links"], r["component_id"]) for r in grid_join.near_vectors(docs).collect()), key=str)
    assert found == sorted([(None, 2, 5), (5, 2, 5), (5, 2, 5), (None, 0, None), (9, 0, 9), (None, 0, None)], key=str)


def test_grid_join_of_clashing_and_empty_tables(spark):
    rows = cloud(np.random.default_rng(1))[:80]
    docs = spark.createDataFrame(rows, SCHEMA)
    names = [c for c in [*CLASHES, "vector", "weight", "cells", "node"] if c not in ("label",)]
    clashing = docs.select("*", *(F.lit(f"extra {c}").alias(c) for c in names))
    want = sorted(map(tuple, grid_join.near_vectors(docs).collect()))
    assert sorted(map(tuple, grid_join.near_vectors(clashing).collect())) == want
    assert grid_join.near_vectors(docs.limit(0)).collect() == []
    lone = grid_join.near_vectors(docs.where("label is not null").limit(1)).collect()
    assert [r["n_links"] for r in lone] == [0]


def brute_codes(rows: list[tuple], parts: int, entries: int, rounds: int):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    lengths = [len(r[1]) for r in kept]
    length = max(sorted(set(lengths)), key=lengths.count) if kept else 0
    kept = [r for r in kept if len(r[1]) == length]
    ints = [[math.floor(256 * x) for x in r[1]] for r in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    cuts = [(length * p // parts, length * (p + 1) // parts) for p in range(parts)]
    book = [[ints[i][b:e] for i in first] for b, e in cuts]

    def assigned():
        out = []
        for v in ints:
            own = []
            for (b, e), held in zip(cuts, book, strict=True):
                d = [sum((x - y) ** 2 for x, y in zip(v[b:e], c, strict=True)) for c in held]
                own.append((d.index(min(d)), min(d)))
            out.append(own)
        return out

    for _ in range(rounds):
        now = assigned()
        for p, (b, e) in enumerate(cuts):
            for k in range(len(book[p])):
                mine = [v[b:e] for v, own in zip(ints, now, strict=True) if own[p][0] == k]
                if mine:
                    book[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    now = assigned()
    coded = [(r[0], r[2], "".join(f"{k:02x}" for k, _ in own), sum(d for _, d in own)) for r, own in zip(kept, now, strict=True)]
    text = ",".join(str(x) for held in book for c in held for x in c)
    return coded, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(("dims", "parts", "entries", "leaf"), [(16, 4, 16, 64), (14, 4, 5, 3), (16, 16, 64, 8)])
def test_codes_are_those_of_brute_force(spark, monkeypatch, dims, parts, entries, leaf):
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    monkeypatch.setattr(vector_codes, "CHUNK", 50)
    rng = np.random.default_rng(dims + entries)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=dims) * 0.1], int(rng.integers(3)) or None) for i in range(300)]
    rows += [(400 + i, rows[7][1], 2) for i in range(90)] + [(3, rows[9][1], 1), (None, rows[11][1], 1), rows[5]]
    rows += [(-1, None, 1), (-2, [None] * dims, 1), (-3, [float("nan")] * dims, 1), (-4, [], 1), (-5, [1.0], 1), (-6, [float("inf")] * dims, 1)]
    # Ties: integers with few values.
    rows += [(500 + i, [float(x) / 256 for x in rng.integers(-2, 3, dims)], 1) for i in range(200)]
    rng.shuffle(rows)
    want, sha = brute_codes(rows, parts, entries, 2)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    coded, book = vector_codes.vector_codes(docs, parts=parts, entries=entries)
    found = vector_codes.with_label_error(coded).collect()
    assert vector_codes.digest(book) == sha
    assert sorted(((r["id"], r["label"], r["code"], r["error"]) for r in found), key=str) == sorted(want, key=str)
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    assert all(r["label_error"] == sums[r["label"]] for r in found)


def test_a_tree_covers_all_points_in_its_balls():
    rng = np.random.default_rng(2)
    values = np.concatenate((rng.integers(-50, 50, (700, 4)), np.repeat(rng.integers(-50, 50, (1, 4)), 500, axis=0))).astype(np.int32)
    t = vector_codes.tree(values)
    assert sorted(t["rows"].tolist()) == list(range(len(values)))
    assert (t["points"] == values[t["rows"]]).all()
    for k, (b, e) in enumerate(zip(t["begin"], t["end"], strict=True)):
        own = t["points"][b:e].astype(float)
        assert (np.sqrt(((own - t["center"][k]) ** 2).sum(1)) <= t["radius"][k] + 1e-9).all()
        assert (t["sums"][k] == own.sum(0)).all()
        if t["left"][k] >= 0:
            assert (b, e) == (t["begin"][t["left"][k]], t["end"][t["right"][k]])


def test_whole_balls_are_owned_without_their_points():
    rng = np.random.default_rng(4)
    centers = rng.integers(-2000, 2000, (8, 4))
    values = (np.repeat(centers, 400, axis=0) + rng.integers(-3, 4, (3200, 4))).astype(np.int32)
    t = vector_codes.tree(values)
    found = list(vector_codes.owners(t, centers.astype(np.int64)))
    assert all(isinstance(owner, int) for _, owner in found)
    assert len(found) < 100


def test_huge_components_and_empty_tables(spark):
    rows = [(1, [3e38] * 16, 1), (2, [-3e38] * 16, None), (3, [0.0] * 16, None)]
    coded, _ = vector_codes.vector_codes(spark.createDataFrame(rows, SCHEMA))
    assert [r["error"] for r in vector_codes.with_label_error(coded).collect()] == [0, 0, 0]
    coded, book = vector_codes.vector_codes(spark.createDataFrame([], SCHEMA))
    assert vector_codes.with_label_error(coded).collect() == []
    assert vector_codes.digest(book) == hashlib.sha256(b"").hexdigest()


def test_codes_ignore_columns_with_clashing_names(spark):
    rng = np.random.default_rng(6)
    docs = spark.createDataFrame([(i, rng.normal(size=16).tolist(), i % 2) for i in range(70)], SCHEMA)
    names = [c for c in [*CLASHES, "ids", "labels", "code", "error", "of"] if c != "label"]
    clashing = docs.select("*", *(F.lit("extra").alias(c) for c in names))
    results = [sorted(map(tuple, vector_codes.vector_codes(d)[0].collect())) for d in (docs, clashing)]
    assert results[0] == results[1]
