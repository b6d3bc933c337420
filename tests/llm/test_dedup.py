"""Exact dedup, Jaccard join and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpora import words
from pyspark.sql import functions as F

from changeflow.llm import exact_dedup, jaccard, substring_dedup
from changeflow.llm.components import components


def plain(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


def best_of(rows):
    return min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))


def test_exact_dedup_equals_brute_force(docs, corpus):
    groups = defaultdict(list)
    for r in corpus:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    want = Counter()
    for norm, rows in groups.items():
        sha = hashlib.sha256(norm.encode()).hexdigest()
        for r in rows:
            want[(r[0], best_of(rows)[0], len(rows), sha)] += 1
    found = exact_dedup.exact_dedup(docs).collect()
    assert plain((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == want
    assert sum(r["kept"] for r in found) == len(groups)
    assert all(r["id"] == r["keep_id"] for r in found if r["kept"])


@pytest.mark.parametrize("size", [1, 3, 7])
def test_names_of_many_levels_are_equal_for_equal_texts_only(spark, size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = {r["id"]: (r["n_blocks"], r["name"]) for r in exact_dedup.identities(df, size=size).collect()}
    assert len(names) == len(texts)
    by_name, by_text = defaultdict(set), defaultdict(set)
    for i, text in enumerate(texts):
        by_name[names[i]].add(text)
        by_text[text].add(names[i])
    assert all(len(x) == 1 for x in by_name.values()) and all(len(x) == 1 for x in by_text.values())


def test_another_seed_is_taken_when_two_blocks_share_a_key(spark, monkeypatch):
    own = exact_dedup._key
    monkeypatch.setattr(exact_dedup, "_key", lambda b, seed: F.struct(F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2")) if seed == 0 else own(b, seed))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a ")], "doc_id long, text string")
    assert {(r["id"], r["keep_id"]) for r in exact_dedup.exact_dedup(df).collect()} == {(1, 3), (2, 2), (3, 3)}


def test_exact_dedup_stage_keeps_whole_rows(spark, docs, corpus):
    kept = exact_dedup.stage(spark, docs, "").collect()
    groups = defaultdict(list)
    for r in corpus:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    assert plain(kept) == Counter(best_of(rows) for rows in groups.values())


def brute_shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def brute_components(rows):
    sets = [brute_shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = set()
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                links.add((j, i))
                parent[top(i)] = top(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[top(i)].append(r[0])
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return Counter((r[0], len(sets[i]), smallest[top(i)]) for i, r in enumerate(rows)), links, sets


def test_jaccard_join_equals_brute_force(docs, corpus):
    want, _, _ = brute_components(corpus)
    found = jaccard.near_duplicates(docs).select("id", "n_shingles", "component_id").collect()
    assert plain(found) == want


@pytest.mark.parametrize("hot", [3, 16])
def test_groups_and_links_of_near_copies_are_whole(spark, monkeypatch, hot):
    """Chains of edits, a common line, and shingles that are hot in every chunk."""
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "CHUNK_GRAMS", 700)
    monkeypatch.setattr(jaccard, "BUCKET_GRAMS", 900)
    rng = random.Random(hot)
    common = words(rng, 25)
    texts = []
    for _ in range(6):
        base = words(rng, rng.randint(30, 90)).split()
        for _ in range(14):
            parts = list(base)
            for _ in range(rng.randint(0, 4)):
                parts[rng.randrange(len(parts))] = words(rng, 1)
            texts.append(" ".join(parts[: len(parts) - rng.randint(0, 6)]) + (" " + common if rng.random() < 0.4 else ""))
    texts += [common + " " + words(rng, rng.randint(1, 9)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)]
    want, links, sets = brute_components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert plain(jaccard.near_duplicates(df).select("id", "n_shingles", "component_id").collect()) == want
    classes = {r["id"]: r["class"] for r in jaccard.members(df).collect()}
    total = sum(map(len, sets))
    got = {(r["a"], r["b"]) for r in jaccard.links(jaccard.frequent_sets(df, total)).collect()}
    assert got == {tuple(sorted((classes[i], classes[j]))) for i, j in links if classes[i] != classes[j]}


def test_suffix_filter_never_rejects_within_the_slack():
    rng = np.random.default_rng(1)
    for _ in range(500):
        x = np.unique(rng.integers(0, 60, rng.integers(1, 40)))
        y = np.unique(rng.integers(0, 60, rng.integers(1, 40)))
        differ = len(np.setxor1d(x, y))
        assert jaccard._suffix_may(x, y, differ)


def test_jaccard_stage_keeps_one_of_each_group(spark, docs, corpus):
    kept = jaccard.stage(spark, docs, "").collect()
    want, _, sets = brute_components(corpus)
    groups = {c for _, n, c in want if n}
    no_set = len({(r[0], r[1] or "") for r, s in zip(corpus, sets, strict=True) if not s})
    assert len(kept) == len(groups) + no_set
    assert {r["doc_id"] for r in kept if brute_shingles(r["text"])} == groups


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i * 7919 % 101, (i + 1) * 7919 % 101) for i in range(100)]
    star = [(1000, 1001 + i) for i in range(50)]
    ring = [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)]
    found = components(spark.createDataFrame(path + star + ring + [(5, 5)], "a long, b long")).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r["component"]].add(r["node"])
    assert sorted(map(len, groups.values())) == [9, 51, 101]


def brute_lines(rows, unit="sentence"):
    order = sorted({(r[0] is None, r[0], r[1]) for r in rows if r[1] is not None}, key=lambda x: (x[0], x[1] or 0))
    seen, out = set(), {}
    for _, i, text in order:
        lines = []
        for line in text.split("\n"):
            units = re.findall(r"[^.!?]+[.!?]*[ \t\v\f\r]*|[.!?]+[ \t\v\f\r]*", line) if unit == "sentence" else [line]
            kept = []
            for part in units:
                norm = re.sub(r"[\x20\x09-\x0D]+", " ", part.lower()).strip(" ")
                if norm and len(norm.split(" ")) >= 5:
                    if norm in seen:
                        continue
                    seen.add(norm)
                kept.append(part)
            if kept or not units:
                lines.append("".join(kept))
        out[(i, text)] = "\n".join(lines)
    return out


@pytest.mark.parametrize("unit", ["sentence", "line"])
def test_substring_dedup_equals_brute_force(spark, docs, corpus, unit):
    rng = random.Random(8)
    passage = ". ".join(words(rng, 12) for _ in range(5)) + "."
    extra = [(i, f"{words(rng, 9)}! {words(rng, 4)} {passage} {words(rng, 7)}\n{words(rng, 3)}.", "en", "s", 1) for i in range(700, 712)]
    rows = [r for r in corpus if r[0] not in (107, None)] + extra
    more = docs.where("doc_id <> 107").unionByName(spark.createDataFrame(extra, docs.schema))
    want = brute_lines(rows, unit)
    found = substring_dedup.substring_dedup(more, unit=unit).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["clean_text"] == (None if r["text"] is None else want[(r["doc_id"], r["text"])])
        for s in r["removed_spans"] or ():
            piece = r["text"][s["start"] : s["start"] + s["length"]]
            assert "\n" not in piece and len(piece.split()) >= 5
    if unit == "sentence":
        # Of a passage in the middle of a line all whole sentences go but in its first document.
        inner = passage.split(". ")[1:-1]
        assert all(x not in r["clean_text"] for r in found if r["doc_id"] in range(701, 712) for x in inner)


def brute_passages(texts, n):
    """The words of each text that stay: of equal windows of n words the first stays."""
    first, out = {}, {}
    for i, text in sorted(texts.items()):
        own = text.lower().split() if not re.search("[\u4e00-\u9fff]", text) else re.findall(r"[\u4e00-\u9fff]|[^\s\u4e00-\u9fff]+", text.lower())
        lost = set()
        for at in range(len(own) - n + 1):
            where, q = first.setdefault(tuple(own[at : at + n]), (i, at))
            if (where, q) != (i, at):
                lost |= set(range(max(at, q + n) if where == i else at, at + n))
        out[i] = [w for k, w in enumerate(own) if k not in lost]
    return out


def test_passages_in_mid_sentence_go_whole(spark):
    rng = random.Random(12)
    long, short = words(rng, 59), words(rng, 44)
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(80))
    texts = {i: f"{words(rng, 40)} {long if i % 2 else long.upper()} {words(rng, 30)}, {short}\t{words(rng, 7)}" for i in range(8)}
    texts |= {20: f"{words(rng, 9)} {han}", 21: f"{words(rng, 12)} {han}{words(rng, 3)}", 22: "no end " * 200}
    texts |= {23: words(rng, 6) + " " + long.replace(" ", "\n", 30) + "\nİ " + long, 24: words(rng, 2000)}
    texts[25] = " ".join(texts[24].split()[400:1700])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    want = brute_passages(texts, 50)
    clean = {}
    for r in substring_dedup.substring_dedup(df, unit="passage").collect():
        clean[r["doc_id"]] = r["clean_text"]
        # Characters, as the words at both sides of a passage meet where there was no space.
        assert "".join(r["clean_text"].lower().split()) == "".join(want[r["doc_id"]]), r["doc_id"]
        last = -1
        for s in r["removed_spans"] or ():
            assert s["start"] > last
            last = s["start"] + s["length"]
    for r in substring_dedup.stage(spark, df, "").where("doc_id between 1 and 7").collect():
        assert r["text"] == clean[r["doc_id"]] and long.lower() not in r["text"].lower() and short in r["text"]


def test_paragraphs_are_units_too(spark):
    a, b = "first words of a paragraph\nand its second line", "something that stands only here once"
    df = spark.createDataFrame([(1, f"{a}\n\n{b}"), (2, f"{b}s\n \n\n{a}"), (3, a.upper())], "doc_id long, text string")
    found = {r["doc_id"]: r["removed_spans"] for r in substring_dedup.substring_dedup(df, unit="paragraph").collect()}
    assert found[1] is None
    assert [(s["start"], s["length"]) for s in found[2]] == [(len(b) + 5, len(a))]
    assert [(s["start"], s["length"]) for s in found[3]] == [(0, len(a))]


def test_substring_stage_keeps_rows_and_columns(spark, docs, corpus):
    kept = substring_dedup.stage(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == len(corpus)
    for r in kept.where("doc_id between 91 and 99").collect():
        assert r["text"].count("\n") == 1 and r["n_chars"] == len(r["text"])


def test_edge_tables(spark, empty, clashing, corpus):
    for run in (exact_dedup.exact_dedup, jaccard.near_duplicates, substring_dedup.substring_dedup):
        assert run(empty).count() == 0
        assert run(clashing).count() == len(corpus)
    for stage in (exact_dedup.stage, jaccard.stage, substring_dedup.stage):
        assert stage(spark, empty, "").count() == 0
        assert stage(spark, clashing, "").columns == clashing.columns


def test_string_ids(spark):
    df = spark.createDataFrame([("b", "same text of five words"), ("a", "same text of five words")], "doc_id string, text string")
    assert {r["keep_id"] for r in exact_dedup.exact_dedup(df).collect()} == {"a"}
    assert {r["component_id"] for r in jaccard.near_duplicates(df).collect()} == {"a"}
    assert {r["doc_id"]: r["clean_text"] for r in substring_dedup.substring_dedup(df).collect()} == {"a": "same text of five words", "b": ""}
