"""Substring dedup by hashing lines, their sentences, or paragraphs, and passages of any place.

A text is cut into units: lines (ended by a line feed), the sentences of lines (up to and
including full stops, question and exclamation marks and the white space after them) or
paragraphs (lines between blank lines). Units are normalised (lower case, runs of white space
to one space, ends trimmed) and named by a 128-bit digest. Of all equal units in the corpus
the first stays, in the order of (document id, hash of the text, place); all others are
removed. Units of fewer than ``MIN_WORDS`` words are no passages and stay: they repeat by
chance. Sentences are the default, because passages are quoted in the middle of lines, where
hashes of whole lines do not meet.

The unit ``passage`` loses what sentences lose, and all runs of ``PASSAGE`` words or more that
stand earlier word by word, wherever they begin and end, also across lines: of all equal
windows of ``PASSAGE`` words the first stays, the words of the others go. A window that
overlaps its own first place loses only the words after that. Words are compared in lower
case; in scripts without spaces each character is a word. Not all windows are hashed: of every
35 runs of 16 words in a row the one with the least hash is the anchor of the window that they
fill, so equal windows have equal anchors. The windows in a row that share an anchor are a group with
one name, by which copies are found. Where an anchor has groups of several names, that is at the ends
of passages, runs of windows are named, by 128 bits, and of the first of each name the single windows.
All are treated like units. What a document loses is the difference of two lists, its places
and the first places that lie in it, so a passage in very many documents is no key of a join.

At scale: one scan writes a narrow table of units (six numbers each, no text). Digests are
counted first, combined before the shuffle, so a unit that every document has costs one row
per task; only what occurs twice or more is joined back, by sort-merge joins of stored tables
that adaptive execution can split at hot digests. The text travels once, to meet the spans
that its document loses; offsets are code points of the original text.

Edge cases: a null text stays null and has no units; an empty text stays empty; ties cannot
occur between different documents; repeated rows (same id and text) are one document and
lose the same units; a null id ranks last; extra columns stay as they are; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import code_points, is_space, mix, read, unused
from changeflow.session import stored

MIN_WORDS = 5
PASSAGE = 50
ANCHOR = 16
#: Windows of a run within a group, as a power of two.
RUN_BITS = 3
#: Bits of a length in a long that packs a place and a length.
_LENGTH_BITS = 28
# Scripts without spaces: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han.
_UNSPACED = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SPACES = re.compile(r"[\x20\x09-\x0D]+")
_SENTENCE = re.compile(r"[^.!?]+[.!?]*[\x20\x09\x0B-\x0D]*|[.!?]+[\x20\x09\x0B-\x0D]*")
_PARAGRAPH = re.compile(r"\n[\x20\x09\x0B-\x0D]*(?:\n[\x20\x09\x0B-\x0D]*)+")


def _lines(text: str) -> Iterator[tuple[int, int]]:
    begin = 0
    while (end := text.find("\n", begin)) >= 0:
        yield begin, end
        begin = end + 1
    yield begin, len(text)


def cut(text: str, unit: str = "sentence") -> Iterator[tuple[int, int]]:
    """Begin and end of each unit."""
    if unit == "line":
        yield from _lines(text)
    elif unit == "sentence":
        for begin, end in _lines(text):
            for found in _SENTENCE.finditer(text, begin, end):
                yield found.span()
    else:
        begin = 0
        for gap in _PARAGRAPH.finditer(text):
            yield begin, gap.start()
            begin = gap.end()
        yield begin, len(text)


def normalise(unit: str) -> str:
    return _SPACES.sub(" ", unit.lower()).strip(" ")


def _text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def units(docs: DataFrame, id_col: str, text_col: str, unit: str, min_words: int) -> DataFrame:
    """(id, text_hash, unit, start, length, d1, d2) of every unit that is a passage."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), _text_hash(text_col).alias("text_hash"), F.col(text_col).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place, start, length, digests = [], [], [], [], []
            for i, text in enumerate(batch["text"]):
                text = text.as_py()
                for k, (begin, end) in enumerate(cut(text, unit) if text else ()):
                    plain = normalise(text[begin:end])
                    if plain.count(" ") + 1 >= min_words and plain:
                        row.append(i)
                        place.append(k)
                        start.append(begin)
                        length.append(end - begin)
                        digests.append(md5(plain.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest())
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(rows), batch["text_hash"].take(rows), *(pa.array(x, pa.int64()) for x in (place, start, length, halves[:, 0], halves[:, 1]))],
                ["id", "text_hash", "unit", "start", "length", "d1", "d2"],
            )

    return rows.mapInArrow(describe, f"id {kind}, text_hash long, unit long, start long, length long, d1 long, d2 long")


def tokens(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and its code points in lower case as one array over the text."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    points = code_points(lower)
    alone = np.zeros(len(points), bool)
    if len(points) and points.max() >= _UNSPACED[0][0]:
        for low, high in _UNSPACED:
            alone |= (points >= low) & (points <= high)
    inside = ~is_space(points)
    before = np.concatenate([[False], inside[:-1] & ~alone[:-1]])
    after = np.concatenate([inside[1:] & ~alone[1:], [False]])
    return np.flatnonzero(inside & (alone | ~before)), np.flatnonzero(inside & (alone | ~after)) + 1, points


def _word_hashes(begin: np.ndarray, end: np.ndarray, points: np.ndarray, seed: int) -> np.ndarray:
    if not len(begin):
        return np.zeros(0, np.uint64)
    word = np.repeat(np.arange(len(begin)), end - begin)
    first = np.concatenate([[0], np.cumsum(end - begin)[:-1]])
    offset = np.arange(len(word)) - first[word]
    letters = points[begin[word] + offset].astype(np.uint64)
    return mix(np.add.reduceat(mix((letters << np.uint64(32)) + offset.astype(np.uint64) + np.uint64(seed)), first))


def _run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n words."""
    runs, size, found, done = words, 1, None, 0
    count = max(len(words) - n + 1, 0)
    while True:
        if n & size:
            part = runs[done : done + count]
            found = part if found is None else mix(found * np.uint64(_SEEDS[0]) + part)
            done += size
        if size * 2 > n:
            return found
        runs = mix(runs[: max(len(runs) - size, 0)] * np.uint64(_SEEDS[1]) + runs[size:])
        size *= 2


def _sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` of each n values in a row."""
    size = 1
    while size * 2 <= n:
        values, size = pick(values[:-size], values[size:]), size * 2
    return pick(values[: len(values) - (n - size)], values[n - size :])


def groups(words: np.ndarray, passage: int) -> tuple[np.ndarray, ...]:
    """(start, number, lead, anchor, name) of the windows in a row that have the same anchor.

    ``lead`` is the distance from the first of the windows to the anchor.
    """
    if len(words) < passage:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    runs, w = _run_hashes(words, ANCHOR), passage - ANCHOR + 1
    least = _sliding(runs, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)
    anchors = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), w, np.maximum) == runs)
    # The first run in each window that has the least hash.
    k = np.searchsorted(anchors, np.arange(len(least)))
    while len(ahead := np.flatnonzero(runs[anchors[k]] != least)):
        k[ahead] += 1
    start = np.flatnonzero(np.diff(k, prepend=-1))
    number = np.diff(start, append=len(k))
    windows = _run_hashes(words, passage)
    offset = (np.arange(len(k)) - np.repeat(start, number)).astype(np.uint64)
    name = np.add.reduceat(mix(windows + offset * np.uint64(_SEEDS[1])), start)
    anchor = anchors[k[start]]
    return start, number, anchor - start, runs[anchor], mix(name + (anchor - start).astype(np.uint64))


def _joined(names: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """The name of each run of names, by their order; ``first`` are the places where runs begin."""
    place = np.arange(len(names)) - np.repeat(first, np.diff(np.append(first, len(names))))
    return mix(np.add.reduceat(mix(names + place.astype(np.uint64) * np.uint64(_SEEDS[1]) + np.uint64(seed)), first))


_PLACE = ["id", "text_hash", "at"]


def _place():
    return F.struct(F.col("id").isNull().alias("last"), *_PLACE)


def _runs_of_later(rows: DataFrame, firsts: DataFrame, keys: list[str], passage: int) -> DataFrame:
    """(id, text_hash, runs): the words of the rows (id, text_hash, at, number, keys) that are not the first of their keys.

    A run is a long that packs the place of its first word and the number of its words.

    ``firsts`` holds the keys and the place ``first`` of each name. A document's places and the first places that
    lie in it meet as two lists, so what very many documents share is no hot key, and a document is
    one row. Only a first in the same document is looked up by the keys: a row that overlaps it
    loses the words after it.
    """
    doc = ["id", "text_hash"]

    def packed(at, number):
        return F.shiftleft(at, _LENGTH_BITS).bitwiseOR(number)

    own = rows.groupBy(*doc).agg(F.collect_set(packed(F.col("at"), F.col("number"))).alias("own"))
    at_first = firsts.select("first.id", "first.text_hash", packed(F.col("first.at"), F.col("number")).alias("code"))
    leads = at_first.groupBy(F.col("id").alias("id_"), F.col("text_hash").alias("hash_")).agg(F.collect_set("code").alias("leads"))
    within = firsts.select(*keys, F.col("first.id").alias("id_"), F.col("first.text_hash").alias("hash_"), F.col("first.at").alias("at_"))
    here = [rows[k] == within[k] for k in keys]
    inside = rows.join(within, [*here, rows["id"].eqNullSafe(within["id_"]), rows["text_hash"] == within["hash_"], rows["at"] > within["at_"]])
    begin, end = F.greatest("at", F.col("at_") + passage), F.col("at") + F.col("number") - 1 + passage
    inside = inside.groupBy(rows["id"].alias("id__"), rows["text_hash"].alias("hash__")).agg(
        F.collect_set(packed(F.col("at"), F.col("number"))).alias("inner"), F.collect_set(packed(begin, end - begin)).alias("runs")
    )
    met = own.join(leads, own["id"].eqNullSafe(leads["id_"]) & (own["text_hash"] == leads["hash_"]), "left")
    met = met.join(inside, own["id"].eqNullSafe(inside["id__"]) & (own["text_hash"] == inside["hash__"]), "left")
    none = F.array().cast("array<bigint>")
    later = F.array_except(F.array_except("own", F.coalesce("leads", none)), F.coalesce("inner", none))
    # So many windows in a row are as many words and those of the last window besides.
    runs = F.concat(F.transform(later, lambda x: x + (passage - 1)), F.coalesce("runs", none))
    return stored(met.select("id", "text_hash", runs.alias("runs")).where(F.size("runs") > 0), "later-runs")


def _told_apart(rows: DataFrame, passage: int) -> tuple[DataFrame, DataFrame]:
    """Of rows (id, text_hash, at, number, k1, k2, parts): the runs of what is not the first of its name, and the parts of the firsts.

    The first of each name is found together with its parts, combined before the shuffle. So what
    stands in many documents is looked at part by part in one of them only.
    """
    least = F.min(F.struct(_place().alias("place"), "number", "parts")).alias("least")
    names = stored(rows.groupBy("k1", "k2").agg(least), "first-names")
    firsts = names.select("k1", "k2", F.col("least.place").alias("first"), F.col("least.number").alias("number"))
    parts = names.select("least.place.id", "least.place.text_hash", F.explode("least.parts").alias("part"))
    return _runs_of_later(rows.drop("parts"), firsts, ["k1", "k2"], passage), parts.select("id", "text_hash", "part.*")


def _rows_of(batch: pa.RecordBatch, row: list, columns: dict[str, list[np.ndarray]], sizes: list[np.ndarray], parts: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
    """Arrow rows with the id and text hash of their text, and a list of parts each."""

    def whole(pieces: list[np.ndarray]) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0, np.int64), *(np.asarray(x).view(np.int64) for x in pieces)]))

    own = pa.array(np.concatenate([np.zeros(0, np.int64), *row]))
    offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([whole(x) for x in parts.values()], list(parts)))
    return pa.RecordBatch.from_arrays(
        [batch["id"].take(own), batch["text_hash"].take(own), *map(whole, columns.values()), lists], ["id", "text_hash", *columns, "parts"]
    )


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE) -> DataFrame:
    """(id, text_hash, runs): what each document loses, packed as by ``_runs_of_later``, in order."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), _text_hash(text_col).alias("text_hash"), F.col(text_col).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, parts = [np.zeros(0, np.int64)], [groups(np.zeros(0, np.uint64), passage)]
            for i, text in enumerate(batch["text"]):
                parts.append(groups(_word_hashes(*tokens(text.as_py() or ""), _SEEDS[0]), passage))
                row.append(np.full(len(parts[-1][0]), i))
            own = pa.array(np.concatenate(row))
            values = [pa.array(np.concatenate(x).view(np.int64)) for x in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(own), batch["text_hash"].take(own), *values], ["id", "text_hash", "at", "number", "lead", "h", "g"]
            )

    found = stored(rows.mapInArrow(describe, f"id {kind}, text_hash long, at long, number long, lead long, h long, g long"), "window-groups")
    often = stored(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-anchors")
    again = stored(found.join(often, "h", "left_semi"), "repeated-groups")
    place = _place()
    first = stored(again.groupBy("h", "g").agg(F.min(place).alias("first"), F.min("number").alias("number"), F.min("lead").alias("lead"), F.count("*").alias("n")), "first-groups")
    lost_groups = _runs_of_later(again, first, ["h", "g"], passage)
    # Equal windows have equal anchors. Where all groups of an anchor are equal, all has been said;
    # else the windows of one group of each name are compared, as the others lose theirs.
    mixed = stored(first.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "mixed-anchors")
    here = (
        first.join(mixed, "h", "left_semi")
        .groupBy(F.col("first.id").alias("of"), F.col("first.text_hash").alias("of_hash"))
        .agg(F.collect_list(F.struct("first.at", "number", "lead")).alias("groups"))
    )
    here = stored(here, "groups-of-documents")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, sizes, columns, parts = [], [], {c: [] for c in ("at", "number", "k1", "k2")}, {c: [] for c in ("at", "d1", "d2")}
            for i, (text, own) in enumerate(zip(batch["text"], batch["groups"], strict=True)):
                words = tokens(text.as_py())
                start, number, lead = (own.values.field(x).to_numpy(zero_copy_only=False) for x in ("at", "number", "lead"))
                inner = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
                at = np.repeat(start, number) + inner
                d1, d2 = (_run_hashes(_word_hashes(*words, seed), passage)[at] for seed in _SEEDS)
                # Equal windows lie equally far before their anchor, so they are dealt to runs alike.
                run = np.repeat(lead, number) - inner >> RUN_BITS
                first = np.flatnonzero((inner == 0) | (np.diff(run, prepend=-1) != 0))
                count = np.diff(np.append(first, len(at)))
                for held, values in ((columns, (at[first], count, _joined(d1, first, _SEEDS[0]), _joined(d2, first, _SEEDS[1]))), (parts, (at, d1, d2))):
                    for c, x in zip(held, values, strict=True):
                        held[c].append(x)
                row.append(np.full(len(first), i))
                sizes.append(count)
            yield _rows_of(batch, row, columns, sizes, parts)

    # Repeated rows are one document.
    texts = rows.join(here, rows["id"].eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))).select("id", "text_hash", "text", "groups")
    shape = f"id {kind}, text_hash long, at long, number long, k1 long, k2 long, parts array<struct<at:long,d1:long,d2:long>>"
    runs = stored(texts.mapInArrow(name, shape), "window-runs")
    lost_runs, windows = _told_apart(runs, passage)
    single = windows.withColumn("number", F.lit(1).cast("long"))
    first_windows = stored(single.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.min("number").alias("number")), "first-windows")
    lost = lost_groups.unionByName(lost_runs).unionByName(_runs_of_later(single, first_windows, ["d1", "d2"], passage))
    return lost.groupBy("id", "text_hash").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("runs")))).alias("runs"))


def merged(text: str, spans: list[tuple[int, int]], runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sentences (start, length) and runs of words as spans that do not touch; white space after a run goes with it."""
    begins, ends, _ = tokens(text) if runs else ((), (), ())
    pieces = [(start, start + length) for start, length in spans]
    for begin, end in runs:
        # Up to the next word, but a line feed between lines stays.
        stop = int(ends[end - 1])
        while stop < len(text) and text[stop] in " \t\v\f\r":
            stop += 1
        pieces.append((int(begins[begin]), stop))
    out: list[tuple[int, int]] = []
    for begin, end in sorted(pieces):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return [(begin, end - begin) for begin, end in out]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without spans as ``merged`` gives them; lines that lose all their words go whole."""
    lines, k = [], 0
    for begin, end in _lines(text):
        kept, at = [], begin
        while k < len(spans) and spans[k][0] + spans[k][1] <= begin:
            k += 1
        j = k
        while j < len(spans) and spans[j][0] < end:
            kept.append(text[at : max(spans[j][0], at)])
            at = min(max(spans[j][0] + spans[j][1], at), end)
            j += 1
        kept.append(text[at:end])
        rest = "".join(kept)
        if j == k or rest.strip(" \t\v\f\r"):
            lines.append(rest)
    return "\n".join(lines)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, text_hash, spans): what each document that repeats others, or itself, loses."""
    found = stored(units(docs, id_col, text_col, unit, min_words), "units")
    often = stored(found.groupBy("d1", "d2").agg(F.count("*").alias("n")).where("n > 1").select("d1", "d2"), "digests")
    again = stored(found.join(often, ["d1", "d2"], "left_semi"), "repeated-units")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash", "unit")
    # Stored, so that the join reads two plain exchanges and a frequent unit can be split.
    first = stored(again.groupBy("d1", "d2").agg(F.min(place).alias("first")), "first-places")
    lost = again.join(first, ["d1", "d2"]).where(place != F.col("first"))
    # Repeated rows give the same spans twice.
    return lost.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))


def remove(text: str, spans: list[tuple[int, int]], unit: str = "sentence") -> str:
    """The text without its spans; the line feed of a line that loses all it has goes with it."""
    lost = {start for start, _ in spans}
    if unit == "paragraph":
        out, at = [], 0
        for start, length in spans:
            out.append(text[at:start])
            at = start + length
        return "".join(out) + text[at:]
    lines = []
    for begin, end in _lines(text):
        units = [(begin, end)] if unit == "line" else [m.span() for m in _SENTENCE.finditer(text, begin, end)]
        kept = [text[a:b] for a, b in units if a not in lost]
        if kept or not units:
            lines.append("".join(kept))
    return "\n".join(lines)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with two more columns: ``clean_text`` and ``removed_spans`` (start, length), null if none.

    If ``docs`` has columns of these names already, the new ones take their place.
    """
    text_, id_, hash_, spans_ = (unused(f"span_{c}", docs.columns) for c in ("text", "id", "hash", "spans"))
    runs_ = unused("span_runs", docs.columns)
    spans = repeated_spans(docs, id_col, text_col, "sentence" if unit == "passage" else unit, min_words)
    nothing = F.lit(None).cast("array<bigint>")
    spans = spans.withColumn("runs", nothing)
    if unit == "passage":
        runs = repeated_passages(docs, id_col, text_col).select("id", "text_hash", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), "runs")
        spans = spans.unionByName(runs).groupBy("id", "text_hash").agg(F.first("spans", True).alias("spans"), F.first("runs", True).alias("runs"))
    spans = spans.select(F.col("id").alias(id_), F.col("text_hash").alias(hash_), F.col("spans").alias(spans_), F.col("runs").alias(runs_))
    rows = docs.join(spans, docs[id_col].eqNullSafe(F.col(id_)) & (_text_hash(text_col) == F.col(hash_)), "left")
    kept = [c for c in docs.columns if c not in ("clean_text", "removed_spans")]
    # The texts travel once, also where their column is replaced.
    rows = rows.select(*kept, *([] if text_col in kept else [F.col(text_col).alias(text_)]), spans_, runs_)
    text_ = text_col if text_col in kept else text_

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                text.as_py() if not span.is_valid else remove(text.as_py(), [(s["start"], s["length"]) for s in span.as_py()], unit)
                for text, span in zip(batch[text_], batch[spans_], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(texts, pa.string()), batch[spans_]], [*kept, "clean_text", "removed_spans"]
            )

    def clean_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lost = [], []
            for text, span, run in zip(batch[text_], batch[spans_], batch[runs_], strict=True):
                text, span, run = text.as_py(), span.as_py(), run.as_py()
                if span or run:
                    lost.append(merged(text, [(s["start"], s["length"]) for s in span or ()], [(at := r >> _LENGTH_BITS, at + (r & (1 << _LENGTH_BITS) - 1)) for r in run or ()]))
                    text = without(text, lost[-1])
                else:
                    lost.append(None)
                texts.append(text)
            spans = pa.array([x and [{"start": a, "length": b} for a, b in x] for x in lost], batch[spans_].type)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(texts, pa.string()), spans], [*kept, "clean_text", "removed_spans"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    step = clean_passages if unit == "passage" else clean
    return rows.mapInArrow(step, f"{fields}, clean_text string, removed_spans array<struct<start:bigint,length:bigint>>")


def _described(found: DataFrame) -> DataFrame:
    spans = F.coalesce("removed_spans", F.array())
    return found.select(
        "doc_id",
        F.size(spans).cast("long").alias("n_removed"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["length"]).alias("removed_chars"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["length"])), ",").alias("removed_spans"),
        "clean_text",
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(substring_dedup(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(substring_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), unit="passage"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without what earlier documents or lines have already.

    Where a text became shorter, ``n_chars`` follows it.
    """
    changed = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        length = F.char_length("clean_text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("removed_spans").isNull(), F.col("n_chars")).otherwise(length)
    return substring_dedup(docs, unit="passage").select(*(changed.get(c, F.col(c)).alias(c) for c in docs.columns))


OP2_SQL = r"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
lines AS (
  SELECT doc_id, i AS line, p[i] AS body,
    CAST(coalesce(list_sum(list_transform(p[1:i - 1], lambda x: length(x) + 1)), 0) AS BIGINT) AS start,
    regexp_extract_all(p[i], '[^.!?]+[.!?]*[\x20\x09\x0B-\x0D]*|[.!?]+[\x20\x09\x0B-\x0D]*') AS u
  FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM parts)),
units AS (
  SELECT doc_id, line, k, u[k] AS unit,
    start + CAST(coalesce(list_sum(list_transform(u[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS start,
    trim(regexp_replace(lower(u[k]), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
  FROM (SELECT *, unnest(range(1, len(u) + 1)) AS k FROM lines)),
marked AS (
  SELECT *, len(string_split(norm, ' ')) >= 5
    AND row_number() OVER (PARTITION BY norm ORDER BY doc_id, start) > 1 AS lost
  FROM units),
spans AS (
  SELECT doc_id, count(*) AS n_removed, CAST(sum(length(unit)) AS BIGINT) AS removed_chars,
    string_agg(start || ':' || length(unit), ',' ORDER BY start) AS removed_spans
  FROM marked WHERE lost GROUP BY doc_id),
kept AS (
  SELECT doc_id, line, string_agg(unit, '' ORDER BY k) FILTER (NOT lost) AS body FROM marked GROUP BY doc_id, line),
clean AS (
  SELECT lines.doc_id, string_agg(coalesce(kept.body, ''), chr(10) ORDER BY lines.line) AS clean_text
  FROM lines LEFT JOIN kept ON kept.doc_id = lines.doc_id AND kept.line = lines.line
  WHERE len(lines.u) = 0 OR kept.body IS NOT NULL GROUP BY lines.doc_id)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed_chars, 0) AS removed_chars,
  coalesce(removed_spans, '') AS removed_spans, CASE WHEN d.text IS NOT NULL THEN coalesce(clean_text, '') END AS clean_text
FROM documents d LEFT JOIN spans ON spans.doc_id = d.doc_id LEFT JOIN clean ON clean.doc_id = d.doc_id
"""
