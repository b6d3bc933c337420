"""Classifiers, rules, licences and sampled segmentations."""

from __future__ import annotations

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpora import words
from pyspark.sql import functions as F

from changeflow.llm import common, licenses, pieces, quality, quality_rules, toxicity

INSULTS = ("grubling", "grublette", "grubler", "snivel")


def labelled(rng: random.Random, n: int):
    """(doc_id, text, quality, toxic): junk has symbols or repeats words, toxic texts have insults."""
    rows = []
    for i in range(n):
        text, good, toxic = words(rng, rng.randint(20, 90)), 1, 0
        if i % 7 == 0:
            good = 0
            text = " ".join(w + rng.choice(["###", "$$$"]) for w in text.split()) if i % 2 else " ".join([words(rng, 1)] * 30)
        elif i % 5 == 0:
            toxic = 1
            parts = text.split()
            for _ in range(3):
                parts.insert(rng.randrange(len(parts)), rng.choice(INSULTS).title() + rng.choice([",", "", "."]))
            text = " ".join(parts)
        rows.append((i, text, good, toxic))
    return rows


@pytest.fixture(scope="module")
def sample(spark):
    rows = labelled(random.Random(3), 600)
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def held(i) -> bool:
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_is_the_crc_of_the_id(spark):
    found = spark.range(200).select("id", common.held_out("id").alias("h")).collect()
    assert all(r["h"] == held(r["id"]) for r in found)


def test_labels_are_learned_from_the_other_folds_only(spark, sample):
    rows, _, labels = sample
    found = [r["sample_id"] for r in common.label_sample(labels.union(labels), "toxic", 10_000).collect()]
    assert sorted(found) == [i for i, *_ in rows if not held(i)]
    assert common.label_sample(labels, "toxic", 7).count() == 7


def test_quality_on_held_out_documents(sample):
    rows, docs, labels = sample
    scores = {r["doc_id"]: r["score"] for r in quality.scored(docs, quality.fit(docs, labels)).collect()}
    assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores.values())
    right = [(scores[i] >= quality.THRESHOLD) == bool(good) for i, _, good, _ in rows if held(i)]
    assert np.mean(right) > 0.95


def test_quality_scores_do_not_depend_on_blocks(sample, monkeypatch):
    rows, docs, labels = sample
    model = quality.fit(docs, labels)
    texts = [t for _, t, _, _ in rows[:40]] + ["", None]
    whole = model.scores(texts)
    alone = [model.scores([t])[0] for t in texts]
    assert np.allclose(alone, whole, atol=1e-6)
    # A text of many blocks loses the repetitions over their borders only.
    long = " ".join(t for t in texts if t)
    once = model.scores([long])[0]
    monkeypatch.setattr(quality, "_BLOCK", 2000)
    assert np.allclose(model.scores(texts), whole, atol=1e-6)
    assert abs(model.scores([long])[0] - once) < 0.02


def test_features_are_words_repetitions_and_ngrams():
    ids, counts = quality.counted_features("ab cd ab")
    # ab twice, cd, one repetition at a distance of two, and the 3- and 4-grams with their borders.
    assert counts.sum() == 3 + 1 + len([" ab", "ab ", " cd", "cd ", " ab", "ab "]) + len([" ab ", " cd ", " ab "])
    assert counts[ids == 2].sum() == 1


def test_toxicity_on_held_out_documents_and_its_spans(sample):
    rows, docs, labels = sample
    found = {r["id"]: r for r in toxicity.tagged(docs, toxicity.fit(docs, labels)).collect()}
    right = [(found[i]["score"] >= 0.5) == bool(toxic) for i, _, _, toxic in rows if held(i)]
    assert np.mean(right) > 0.95
    hits = Counter()
    for i, text, _, toxic in rows:
        for s in found[i]["spans"]:
            hits[(toxic, text[s["start"] : s["start"] + s["length"]].lower() in INSULTS)] += 1
    assert hits[(1, True)] > 0.9 * sum(3 for r in rows if r[3]) and hits[(1, False)] + hits[(0, False)] < 10


def test_forward_backward_equals_enumeration(monkeypatch):
    rng = np.random.default_rng(0)
    t = np.array([[0.9, 0.2], [0.4, 0.8]])
    monkeypatch.setattr(toxicity, "SEGMENT", 3)
    for n in (1, 3, 7):
        e = rng.normal(size=n)
        total, one, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=n):
            steps = list(zip((0, *states), states, strict=False))
            weight = np.prod([t[s] for s in steps]) * np.exp(np.dot(e, states))
            total += weight
            one += weight * np.array(states)
            for s in steps:
                pairs[s] += weight
        p, _ = toxicity.forward_backward(np.concatenate((e, e)), np.array([n, 0, n]), t)
        assert np.allclose(p[:n], one / total) and np.allclose(p[n:], one / total)
        assert np.allclose(toxicity.forward_backward(e, np.array([n]), t, True)[1], pairs / total)


def test_toxicity_of_texts_in_blocks(sample, monkeypatch):
    rows, docs, labels = sample
    field = toxicity.fit(docs, labels)
    texts = [t for _, t, _, _ in rows[:60]] + ["", None, "İ grubling, x"]
    sums, spans = field.sums(texts, True)
    alone = [field.sums([t], True) for t in texts]
    assert np.allclose(sums, [s[0] for s, _ in alone]) and spans == [x[0] for _, x in alone]
    assert [(texts[-1] or "")[a : a + n] for a, n in spans[-1]] == ["grubling"]
    long = " ".join(t for t in texts if t)
    monkeypatch.setattr(toxicity, "_BLOCK", 200)
    for a, n in field.sums([long], True)[1][0]:
        assert re.fullmatch(r"\w+", long[a : a + n])


@pytest.mark.parametrize("label", [None, 0, 1])
def test_models_without_two_classes(spark, sample, label):
    _, docs, _ = sample
    rows = [] if label is None else [(i, label, label) for i in range(50)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for scored in (quality.scored(docs, quality.fit(docs, labels)), toxicity.tagged(docs, toxicity.fit(docs, labels))):
        low, high = scored.agg(F.min("score"), F.max("score")).first()
        assert (low > 0.5 and high > 0.5) if label == 1 else (low < 0.5) if label == 0 else low == high == 0.5


def rules(rows):
    """The rules by hand: per row the statistics, removed lines and words, failed, kept."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x.lower()).strip(" ")
    texts = defaultdict(set)
    for r in rows:
        host, text = r[3] or "", r[1] or ""
        for line in text.split("\n"):
            if split(line):
                texts[(host, norm(line))].add(text)
    out = Counter()
    for r in rows:
        host, text = r[3] or "", r[1] or ""
        w = split(text)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if split(x)]
        lost = [x for x in lines if len(texts[(host, norm(x))]) > 10]
        gone = sum(len(split(x)) for x in lost)
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out[(r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
             len(lost), gone, failed, not failed and len(w) - gone >= 0.5 * len(w))] += 1
    return out


def test_quality_rules_equal_brute_force(spark, corpus):
    rng = random.Random(9)
    rows = list(corpus)
    line = words(rng, 15)
    for i in range(300, 330):
        body = words(rng, rng.choice([15, 60]))
        rows.append((i, f"{line}\n{body}\n {line.upper()}  \n$$ a|b\n\n{body if i % 4 == 0 else ''}", "en", "s7", 1))
    rows.append((400, "a b c " * 40, "en", "s7", 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    names = "id n_words word_chars n_symbols n_dup_lines n_repeat_words n_removed_lines n_removed_words base_failed kept".split()
    found = quality_rules.judged(df).select(*names).collect()
    assert Counter(tuple(r) for r in found) == rules(rows)
    kept = {r["doc_id"]: r["text"] for r in quality_rules.cleaned(df).where("doc_id between 300 and 400").collect()}
    assert kept and all(line not in t and line.upper() not in t for t in kept.values())


def test_lines_are_judged_alike_in_large_and_small_hosts(spark):
    rng = random.Random(13)
    line, rare = words(rng, 12), words(rng, 12)
    rows = [(k, f"{words(rng, 3)} {k}" + f"\n{line}" * (k < 11) + f"\n{rare}" * (k < 10), "large") for k in range(1500)]
    rows += [(2000 + k, f"{words(rng, 3)} {k}" + f"\n{line}\n{rare}" * (k < 11), "small") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found = {r["id"]: r["n_removed_lines"] for r in quality_rules.judged(df).collect()}
    assert found == {k: int(k < 11) for k in range(1500)} | {2000 + k: 2 * (k < 11) for k in range(20)}


def test_license_scan_by_hand(spark):
    mit = licenses.TEMPLATES["MIT"]
    rows = [
        (1, "some words here\nReleased under the MIT License.\nmore words"),
        (2, mit.replace("Software", "Program", 1)),
        (3, mit.replace(". ", ".\n")),
        (4, "Licensed  under the APACHE license -- version 2.0"),
        (5, "all rights are reserved"),
        (6, ""), (7, None), (None, "All rights reserved."), (8, "reserved"),
    ]
    found = {(r["id"], r["line"], r["license_id"]): r["dice"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k[:3] for k in found} == {(1, 2, "MIT-notice"), (2, 1, "MIT"), (3, 0, "MIT"), (4, 1, "Apache-2.0-notice"), (None, 1, "all-rights-reserved")}
    assert found[(3, 0, "MIT")] == 1.0 and 0.9 < found[(2, 1, "MIT")] < 1
    top = licenses.best(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))).where("id = 1").first()
    assert top["license_id"] == "MIT-notice" and top["dice"] == 1.0


def test_wrapped_licences_inside_long_documents(spark):
    import textwrap

    rng = random.Random(14)
    other = lambda: "\n".join(words(rng, 12) for _ in range(30))
    names = ("MIT", "ISC", "GPL-3.0-header", "Apache-2.0-header")
    body = {n: "\n".join("# " + x for x in textwrap.wrap(licenses.TEMPLATES[n], 76)) for n in names}
    rows = [(i, f"{other()}\n{body[n]}\n{other()}") for i, n in enumerate(names)]
    rows += [(8, f"{other()}\n{body['MIT']}\n{other()}\n{body['MIT']}"), (9, other()), (10, None), (11, "")]
    rows += [(12, f"{words(rng, 300)} {licenses.TEMPLATES['ISC']} {words(rng, 300)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((r["id"], r["line"], r["license_id"]) for r in licenses.scan_blocks(df).collect() if r["license_id"] in names)
    last = 31 + len(body["MIT"].split("\n")) + 30
    assert found == [*((i, 31, n) for i, n in enumerate(names)), (8, 31, "MIT"), (8, last, "MIT"), (12, 1, "ISC")]


def test_every_whole_licence_is_its_own_best_match(spark):
    rows = [(name, f"Some title\n\n{text}\n") for name, text in licenses.TEMPLATES.items()]
    rows += [(f"{name} alone", text) for name, text in licenses.TEMPLATES.items()]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    found = {r["id"]: (r["license_id"], r["dice"]) for r in licenses.best(licenses.scan(df)).collect()}
    assert found == {i: (i.removesuffix(" alone"), 1.0) for i, _ in rows}


def test_every_window_near_the_threshold_is_found(spark):
    """Licences with words replaced until they are just at the threshold, in mid-line: every offset by hand."""
    rng = random.Random(5)
    templates = {n: licenses.TEMPLATES[n] for n in ("MIT", "Zlib", "MPL-2.0-header", "all-rights-reserved")}
    templates["of two"] = "two words"
    plain = lambda t: re.sub(r"[\W_]+", " ", t.lower()).split()
    pairs = lambda w: {f"{x} {y}" for x, y in zip(w, w[1:], strict=False)}
    rows = [(0, ""), (1, None), (2, "two"), (3, "two words two words"), (4, "x\n\nTwo\nwords"), (5, "all rights")]
    for i in range(6, 66):
        body = plain(templates[rng.choice(("MIT", "Zlib", "MPL-2.0-header"))])
        if rng.random() < 0.2:
            body = body[rng.randint(0, 9) :]
        for k in rng.sample(range(len(body)), int(len(body) * rng.uniform(0.08, 0.12))):
            body[k] = f"w{rng.randint(0, 999)}"
        before, after = (words(rng, rng.randint(1, 60)) for _ in range(2))
        rows.append((i, f"{before}\n{before} {' '.join(body)}" + (f" {after}" if rng.random() < 0.7 else "")))
    want = {}
    for i, text in rows:
        tagged = [(w, k + 1) for k, x in enumerate((text or "").split("\n")) for w in plain(x)]
        for name, body in templates.items():
            body, size = pairs(plain(body)), len(plain(body))
            scores = {}
            for at in range(len(tagged)):
                part = pairs([w for w, _ in tagged[at : at + size]])
                if part and 2 * len(part & body) / (len(part) + len(body)) >= 0.8:
                    scores[at] = 2 * len(part & body) / (len(part) + len(body))
            if scores:
                want[(i, name)] = (max(scores.values()), {tagged[at][1] for at, x in scores.items() if x == max(scores.values())})
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {}
    for r in licenses.scan_blocks(df, templates).collect():
        key = (r["id"], r["license_id"])
        if key not in found or r["dice"] > found[key][0]:
            found[key] = (r["dice"], r["line"])
    assert 20 < len([k for k, (x, _) in want.items() if x < 0.85])
    assert found.keys() == want.keys()
    for key, (dice, line) in found.items():
        assert dice == pytest.approx(want[key][0]) and line in want[key][1]


def test_blocks_of_empty_tables_and_clashing_columns(spark):
    shape = "doc_id string, text string, words string, line int, at int, license_id string, size int, n int"
    assert licenses.scan_blocks(spark.createDataFrame([], shape)).count() == 0
    row = ("a", f"x\n{licenses.TEMPLATES['ISC']}", "w", 7, 7, "l", 7, 7)
    found = licenses.scan_blocks(spark.createDataFrame([row, row, (None, *row[1:])], shape), {"ISC": licenses.TEMPLATES["ISC"]})
    assert sorted((r["id"] or "", r["line"], r["license_id"], r["dice"]) for r in found.collect()) == [("", 2, "ISC", 1.0), ("a", 2, "ISC", 1.0), ("a", 2, "ISC", 1.0)]


def test_license_sizes_prune_nothing_that_counts(spark):
    """Every pair at every threshold, with and without the bounds."""
    rng = random.Random(2)
    pool = "a b c d e f".split()
    templates = {f"t{k}": " ".join(rng.choice(pool) for _ in range(rng.randint(2, 14))) for k in range(6)}
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 20)))) for i in range(80)]
    pairs = lambda t: {f"{x} {y}" for x, y in zip(t.split(), t.split()[1:], strict=False)}
    for threshold in (0.3, 0.6):
        want = {}
        for i, text in rows:
            for name, body in templates.items():
                a, b = pairs(text), pairs(body)
                if a and (dice := 2 * len(a & b) / (len(a) + len(b))) >= threshold:
                    want[(i, name)] = dice
        df = spark.createDataFrame(rows, "doc_id long, text string")
        found = {(r["id"], r["license_id"]): r["dice"] for r in licenses.scan(df, templates, threshold).collect()}
        assert found == pytest.approx(want)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(pieces.model_path())


def segmentations(text, ids):
    if not text:
        yield ()
    for k in range(1, len(text) + 1):
        if text[:k] in ids:
            for rest in segmentations(text[k:], ids):
                yield (ids[text[:k]], *rest)


def test_samples_follow_the_distribution_without_replacement(vocabulary):
    ids = {b.decode(): i for i, b in enumerate(vocabulary.bytes) if i >= 259}
    text, n = "tion in", 6000
    logs = {s: float(sum(vocabulary.weight[list(s)])) for s in segmentations(pieces.escaped(text), ids)}
    total = np.logaddexp.reduce(list(logs.values()))
    p = {s: np.exp(x - total) for s, x in logs.items()}
    first, second, included = Counter(), Counter(), defaultdict(float)
    for _, rank, found, log_p, value, inclusion in pieces.encode([text] * n, list(range(n)), vocabulary, 2):
        key = tuple(found.tolist())
        assert log_p == pytest.approx(logs[key] - total)
        (second if rank else first)[key] += 1
        included[key] += p[key] / np.exp(inclusion) / n
    for s in sorted(p, key=p.get)[-5:]:
        again = sum(p[q] * p[s] / (1 - p[q]) for q in p if q != s)
        assert first[s] / n == pytest.approx(p[s], abs=0.03)
        assert second[s] / n == pytest.approx(again, abs=0.03)
        # Samples weighed by the inverse of their inclusion estimate their probability.
        assert included[s] == pytest.approx(p[s], abs=0.03)


def test_all_segmentations_come_if_they_are_few(vocabulary):
    ids = {b.decode(): i for i, b in enumerate(vocabulary.bytes) if i >= 259}
    want = set(segmentations(pieces.escaped("a b"), ids))
    found = list(pieces.encode(["a b"], [1], vocabulary, 99))
    assert {tuple(x[2].tolist()) for x in found} == want and len(found) == len(want)
    assert all(x[5] == 0 for x in found)
    values = [x[4] for x in found]
    assert values == sorted(values, reverse=True)


@pytest.mark.parametrize("text", ["th", "the", "of the", "they", "    ", "information", "é of"])
def test_no_segmentation_is_too_unlikely(vocabulary, text):
    ids = {b.decode(): i for i, b in enumerate(vocabulary.bytes) if i >= 259}
    want = set(segmentations(pieces.escaped(text), ids))
    found = list(pieces.encode([text], [1], vocabulary, len(want) + 5))
    assert {tuple(x[2].tolist()) for x in found} == want and len(found) == len(want)
    assert sum(math.exp(x[3]) for x in found) == pytest.approx(1)
    assert all(x[5] == 0 for x in found)


def test_words_are_those_of_the_pattern():
    rnd = random.Random(4)
    texts = ["", " ", "\n", "a", " a", "a \nb", "a\n b\n\nc ", "a  b", "a\0b c", "\u2581a \u2581"]
    texts += ["".join(rnd.choices("ab \n\u2581\0", (9, 9, 5, 2, 1, 1), k=rnd.randrange(30))) for _ in range(500)]
    for text in texts:
        assert pieces.words_of(text) == pieces._WORD.findall(pieces.escaped(text))


def test_lattices_equal_sums_over_segmentations(vocabulary, monkeypatch):
    """Whatever the groups in which words are handled, and with texts that are empty in front."""
    words = ["\u2581the", "\u2581hello", "\u2581a\u00e9\u4e16", "\n", "information"]
    ids = {vocabulary.bytes[i].decode("utf-8", "surrogatepass"): i for i in range(len(vocabulary.bytes)) if i not in vocabulary.byte_ids}
    whole = pieces.Lattices(words, vocabulary)
    monkeypatch.setattr(pieces, "GROUP", 4)
    parts = pieces.Lattices(words, vocabulary)
    for name in ("starts", "first", "counts"):
        assert len(getattr(whole, name)) == len(getattr(parts, name))
    for lattices in (whole, parts):
        for t, word in enumerate(words[:2]):
            at = int(lattices.starts[t])
            begins = [(k, ids[word[:k]]) for k in range(1, len(word) + 1) if word[:k] in ids]
            here = slice(int(lattices.first[at]), int(lattices.first[at] + lattices.counts[at]))
            assert list(zip(lattices.sizes[here].tolist(), lattices.ids[here].tolist(), strict=True)) == begins
            assert np.exp(lattices.log_p[here]).sum() == pytest.approx(1)
            mass = {k: 0.0 for k, _ in begins}
            for s in segmentations(word, ids):
                mass[len(vocabulary.bytes[s[0]].decode())] += float(np.exp(sum(vocabulary.weight[list(s)])))
            assert np.exp(lattices.log_p[here]).tolist() == pytest.approx([m / sum(mass.values()) for m in mass.values()])
    assert [r[:2] for r in pieces.encode(["", None, "the", ""], [1, 2, 3, 4], vocabulary, 2)] == [(0, 0), (1, 0), (2, 0), (2, 1), (3, 0)]


def test_trie_finds_the_pieces_of_every_position(vocabulary):
    """Each by its characters, also where words meet, and single ones that are no piece as bytes."""
    rnd = random.Random(5)
    ids = {vocabulary.bytes[i].decode("utf-8", "surrogatepass"): i for i in range(len(vocabulary.bytes)) if i not in vocabulary.byte_ids and i > 2}
    words = ["".join(rnd.choices("\u2581theingsou\u00e9\u4e16\U0001f600\n", k=rnd.randrange(1, 30))) for _ in range(300)] + list(ids)[::50]
    lattices = pieces.Lattices(words, vocabulary)
    for t, word in enumerate(words):
        for k in range(len(word)):
            at = int(lattices.starts[t]) + k
            here = slice(int(lattices.first[at]), int(lattices.first[at] + lattices.counts[at]))
            want = [(n, ids[word[k : k + n]]) for n in range(1, len(word) - k + 1) if word[k : k + n] in ids]
            found = list(zip(lattices.sizes[here].tolist(), lattices.ids[here].tolist(), strict=True))
            assert [x for x in found if x[0] > 1 or x[1] in ids.values()] == want and found[0][0] == 1


def test_long_words_cost_little_more_than_short_ones(vocabulary):
    """No work on arrays for each character of a word: the CPU time was 50 times that of short words, 9 times now."""
    text = "".join(random.Random(3).choices("etaoinshrd", k=40_000))

    def seconds(words):
        best = math.inf
        for _ in range(3):
            begin = time.process_time()
            pieces.Lattices(words, vocabulary)
            best = min(best, time.process_time() - begin)
        return best

    assert seconds([text]) < 25 * seconds([text[i : i + 10] for i in range(0, len(text), 10)])


def test_sampled_pieces_are_returned(spark, docs, tmp_path, vocabulary):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    texts = {(r["doc_id"], (r["text"] or "").replace("▁", " ")) for r in docs.collect()}
    rows = pieces.op8_sampled_pieces(spark, str(tmp_path)).collect()
    for r in rows:
        assert (r["doc_id"], pieces.decode(np.array(r["ids"], np.int32), vocabulary)) in texts
        assert len(r["ids"]) == r["n_pieces"]


def test_round_trip_and_seeds(spark, docs, corpus, vocabulary):
    found = pieces.sampled(docs).collect()
    assert all(r["round_trip"] for r in found)
    by_row = defaultdict(set)
    for r in found:
        by_row[(r["id"], r["sample"])].add(tuple(r["ids"]))
    rows = Counter(r["sample"] for r in found)
    assert rows[0] == len(corpus)
    other = Counter((r["id"], r["sample"], tuple(r["ids"])) for r in pieces.sampled(docs.repartition(1)).collect())
    assert other == Counter((r["id"], r["sample"], tuple(r["ids"])) for r in found)


def test_edge_tables(spark, empty, clashing, corpus):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(100)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    n = len(corpus)
    for docs, rows in ((empty, 0), (clashing, n)):
        assert quality.scored(docs, quality.fit(docs, labels)).count() == rows
        assert toxicity.tagged(docs, toxicity.fit(docs, labels)).count() == rows
        assert quality_rules.judged(docs).count() == rows
        assert licenses.scan(docs).count() == 0
        assert pieces.sampled(docs, with_ids=False).where("sample = 0").count() == rows
        kept = quality.accepted(docs, quality.fit(docs, labels), 0.0)
        assert kept.columns == docs.columns and kept.count() == rows
        assert quality_rules.cleaned(docs).columns == docs.columns
