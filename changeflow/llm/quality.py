"""Quality classifier: learned embeddings of hashed words and character n-grams.

A document is the average of the vectors of all its words and of all the n-grams of their
characters (word borders included), and of repetitions of a word at a short distance; a
softmax layer turns it into two class probabilities.
Vectors and layer are learned with numpy by stochastic gradient descent on the driver.

Learning uses at most ``SAMPLE_ROWS`` labelled documents outside the held-out fold; that is
the only bound, and it bounds the driver's memory. Scoring covers every text as a whole.
Because the output layer is linear in the average, a feature adds one number (its vector
times the difference of the class weights), so a scan needs one small table (``BUCKETS``
floats, broadcast: 1 MB) and works on character arrays without a loop over words. No shuffle.

Edge cases: null and empty texts have no features and get the score of the bias alone; texts
of any length are read in pieces of bounded size; a null id is scored and not held out; with
no usable labels every score is 0.5; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import blocks, code_points, held_out, is_space, label_sample, mix, read

SAMPLE_ROWS = 4000
BUCKETS = 1 << 18
DIM = 10
LAGS = 8
EPOCHS = 4
RATE = 0.6
THRESHOLD = 0.3
_BLOCK = 400_000
_ODD = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(256, _ODD, np.uint64), dtype=np.uint64)


def _features(block: str, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and place of each word, repetition and n-gram of 3 and 4 characters.

    A place counts the characters before, and one space in front of the block. ``starts`` are
    the begins of the texts in it, which repetitions do not cross.
    """
    c = np.concatenate(([np.uint32(32)], code_points(block))).astype(np.uint64)
    space = is_space(c)
    c[space] = 32
    begins = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if not len(begins):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    own = np.concatenate((np.zeros(begins[0], np.int64), np.repeat(begins, np.diff(np.append(begins, len(c))))))
    inside = np.arange(len(c)) - own
    weighed = np.where(space, np.uint64(0), (c + np.uint64(1)) * _POWERS[inside & 255])
    words = np.add.reduceat(weighed, begins) + (ends - begins).astype(np.uint64)
    found, places = [mix(words)], [begins]
    owner = np.searchsorted(starts, begins - 1, "right")
    for lag in range(1, LAGS + 1):
        # A word that stood ``lag`` words before has one bucket, whatever the word.
        again = begins[lag:][(words[lag:] == words[:-lag]) & (owner[lag:] == owner[:-lag])]
        found.append(np.full(len(again), lag, np.uint64))
        places.append(again)
    a3 = (c[:-2] * np.uint64(_POWERS[0]) + c[1:-1] * np.uint64(_POWERS[1]) + c[2:] * np.uint64(_POWERS[2])) + np.uint64(3)
    ok3 = np.flatnonzero(~space[1:-1])
    found.append(mix(a3[ok3]))
    places.append(ok3)
    if len(c) > 3:
        a4 = a3[:-1] + c[3:] * np.uint64(_POWERS[3]) + np.uint64(1)
        ok4 = np.flatnonzero(~space[1:-2] & ~space[2:-1])
        found.append(mix(a4[ok4]))
        places.append(ok4)
    ids = (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return ids, np.concatenate(places)


def counted_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and how often each occurs."""
    arrays = [_features(block, np.array([s[1] for s in spans]))[0] for block, spans in blocks([text], _BLOCK)]
    return np.unique(np.concatenate(arrays), return_counts=True)


@dataclass
class Model:
    """The softmax over two classes as one logit: bias + the average of ``table`` over the features."""

    table: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        total = np.zeros(len(texts))
        count = np.zeros(len(texts))
        for block, spans in blocks(texts, _BLOCK):
            which, at, to = (np.array(x) for x in zip(*spans, strict=True))
            ids, places = _features(block, at)
            adds = np.bincount(places, weights=self.table[ids], minlength=len(block) + 1)
            ones = np.bincount(places, minlength=len(block) + 1)
            adds = np.concatenate(([0.0], np.cumsum(adds)))
            ones = np.concatenate(([0], np.cumsum(ones)))
            # An n-gram may begin with the space in front of a text.
            np.add.at(total, which, adds[to + 1] - adds[at])
            np.add.at(count, which, ones[to + 1] - ones[at])
        return 1 / (1 + np.exp(-np.clip(self.bias + total / np.maximum(count, 1), -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Stochastic gradient descent over (buckets, counts, label) in a fixed shuffled order."""
    if len({label for _, _, label in rows}) < 2:
        share = 0.5 if not rows else (0.99 if rows[0][2] else 0.01)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer = np.zeros((2, DIM), np.float32)
    biases = np.zeros(2, np.float32)
    weights = [(n / max(1, n.sum())).astype(np.float32) for _, n, _ in rows]
    # An average over thousands of features moves each of them little, so steps are scaled up.
    steps = [RATE / max(1e-6, float((w * w).sum() * len(w)) ** 0.5) for w in weights]
    done, todo = 0, EPOCHS * len(rows)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            ids, _, label = rows[i]
            w, rate = weights[i], 1 - done / todo
            done += 1
            hidden = w @ vectors[ids] if len(ids) else np.zeros(DIM, np.float32)
            z = layer @ hidden + biases
            p = np.exp(z - z.max())
            p /= p.sum()
            error = -p
            error[label] += 1
            if len(ids):
                back = error @ layer
                vectors[ids] += (rate * steps[i] * w * len(ids) ** 0.5)[:, None] * back[None, :]
            layer += rate * RATE * error[:, None] * hidden[None, :]
            biases += rate * 0.02 * error
    difference = layer[1] - layer[0]
    return Model((vectors @ difference).astype(np.float32), float(biases[1] - biases[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``rows`` labelled documents; tasks count features, the driver learns."""
    chosen = label_sample(labels, label, rows)
    texts = docs.select(F.col("doc_id").alias("sample_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Broadcast: at most ``rows`` rows of two numbers.
    sample = texts.join(F.broadcast(chosen), "sample_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, label_, text in zip(*(batch[c].to_pylist() for c in ("sample_id", "sample_label", "text")), strict=True):
                ids, counts = counted_features(text)
                yield pa.RecordBatch.from_pydict(
                    {"sample_id": [i], "sample_label": [label_], "ids": [ids.astype(np.int32).tobytes()], "counts": [counts.astype(np.int32).tobytes()]},
                    schema=pa.schema([("sample_id", pa.int64()), ("sample_label", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())]),
                )

    found = (
        sample.select(F.col("sample_id").cast("long"), "sample_label", "text")
        .mapInArrow(count, "sample_id long, sample_label int, ids binary, counts binary")
        .limit(rows)
        .collect()
    )
    found.sort(key=lambda r: (r["sample_id"], len(r["ids"])))
    return train(
        [(np.frombuffer(r["ids"], np.int32).astype(np.int64), np.frombuffer(r["counts"], np.int32), r["sample_label"]) for r in found]
    )


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row, by one scan."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = shared.value.scores(batch["text"].to_pylist()) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(choose, docs.schema)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, read(spark, sf_dir, "labels")))
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts."""
    return accepted(docs, fit(docs, read(spark, sf_dir, "labels")))
