"""Filter interaction audit against one run of the filters per order."""

from __future__ import annotations

import re
from itertools import permutations

from pyspark.sql import functions as F

from changeflow.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def failures(rows: list[tuple]) -> list[set[str]]:
    first: dict[str, int] = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = []
    for i, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append({
            letter for letter, fails in (
                ("A", len(words) < 200),
                ("B", 100 * len(set(words)) < 50 * len(words)),
                ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)),
                ("D", re.search(r"[#$%&*|]", text)),
                ("E", i is not None and first[text] < i),
            ) if fails
        })
    return out


def brute(rows: list[tuple], labels: list[tuple]) -> dict:
    fails = failures(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = [r[2] or "" for r in rows]
    out, shapley = {}, {}
    for order in map("".join, permutations("ABCDE")):
        for part in set(parts):
            own = [k for k, p in enumerate(parts) if p == part]
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                left = [k for k in left if f not in fails[k]]
                failing = [k for k in own if f in fails[k]]
                out[part, order, step] = (
                    len(left), len(gone), len(failing) - len(gone), sum(fails[k] == {f} for k in own),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone),
                )
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def found(docs, labels) -> dict:
    cells = filter_audit.failure_cells(docs, labels)
    rows = filter_audit.audit(cells).collect()
    out = {(r["part"], r["filter_order"], r["step"]): (*(r[m] for m in filter_audit.MEASURES), r["shapley"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_counts_are_those_of_every_order(spark, docs, corpus):
    more = [
        (200, " ".join(f"w{k}" for k in range(250)), "en", "s0", 1),
        (201, " ".join(f"w{k}" for k in range(250)), "de", "s0", 1),
        (202, " ".join(f"W{k}" for k in range(250)), "en", "s0", 1),
        (203, "a b # | " * 60, "", "s0", 1),
        (204, " ".join(f"w{k}" for k in range(250)), "en", "s0", 1),
        (204, " ".join(f"w{k}" for k in range(250)), "en", "s0", 1),
        (199, "\x85\xa0".join(f"w{k}" for k in range(250)), "en", "s0", 1),
    ]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 210, 2)] + [(4, 1, 1), (None, 1, 1), (3, None, 1), (5000, 1, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    rows = corpus + more
    whole = docs.unionByName(spark.createDataFrame(more, docs.schema))
    assert found(whole, spark.createDataFrame(labels, LABELS).repartition(2)) == brute(rows, labels)


def test_clashing_and_empty_tables(spark, docs, clashing, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], LABELS)
    crowded = clashing.select("*", *(F.lit("extra").alias(c) for c in ("part", "digest", "mask", "good", "toxic", "first", "cell")))
    assert found(crowded, labels) == found(docs, labels)
    assert found(empty, labels) == {}
    assert found(docs, labels.limit(0))


def test_other_filters_and_their_number(spark):
    cells = spark.createDataFrame([("p", 0, 5, 0, 0), ("p", 3, 2, 1, 0)], "part string, mask int, n long, good long, toxic long")
    rows = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["good_lost"], r["shapley"]) for r in filter_audit.audit(cells, "XY").collect()}
    assert rows == {("XY", 1): (5, 2, 0, 1, 2), ("XY", 2): (5, 0, 2, 0, 2), ("YX", 1): (5, 2, 0, 1, 2), ("YX", 2): (5, 0, 2, 0, 2)}
