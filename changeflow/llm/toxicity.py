"""Toxicity: a linear-chain conditional random field tags toxic tokens.

Tokens are labelled clean or toxic: toxic are the tokens of a toxic document whose word or
beginning is far more common in toxic than in clean documents of the sample (labels mark
documents only). The field has two states, transitions, and emissions from hashed features
of a token (word, beginnings, neighbours); it is learned with numpy by stochastic gradient
steps on the sequence likelihood, expectations by forward-backward. A document's score is a
logistic function, learned on the sample, of two sums over the marginals: the probability
that at least one token is toxic and the expected number of toxic tokens. Tokens with a
marginal of one half or more are the offending spans, as offsets in the original text.

Learning uses at most ``SAMPLE_ROWS`` labelled documents outside the held-out fold. Scoring
takes whole texts by one scan without a shuffle; the field is broadcast (``BUCKETS`` floats,
1 MB). Forward-backward works on segments of all texts of a block at once, so long texts cost
no more per token. A text longer than a block is tagged in blocks; the chain starts anew there.

Edge cases: null and empty texts have no tokens and get the score of no toxic token; a null
id is scored and not held out; with labels of one class only, every score is that class's
bias; repeated rows get equal scores; extra columns play no part; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import blocks, code_points, held_out, label_sample, mix, read

SAMPLE_ROWS = 6000
BUCKETS = 1 << 18
EPOCHS = 3
BATCH = 60
RATE = 0.3
SEGMENT = 32
MARGINAL = 0.5
BEGINNINGS = (4, 5)
# A token is evidence if it is in that many toxic documents, and that many times more likely there.
MIN_DOCUMENTS = 4
RATIO = 12
_BLOCK = 300_000
_ODD = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(256, _ODD, np.uint64), dtype=np.uint64)
_SEPARATOR = np.ones(128, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def tokens(block: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hashed features (a row each) of the runs of letters and digits."""
    c = code_points(lowered(block))
    gap = np.where(c < 128, _SEPARATOR[np.minimum(c, 127)], (c >= 0x2000) & (c < 0x2070) | (c < 0xC0) | (c == 0x3000))
    begins = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    ends = np.flatnonzero(~gap & np.concatenate((gap[1:], [True]))) + 1
    if not len(begins):
        return begins, ends, np.empty((0, 5), np.int64)
    own = np.concatenate((np.zeros(begins[0], np.int64), np.repeat(begins, np.diff(np.append(begins, len(c))))))
    inside = np.arange(len(c)) - own
    weighed = np.where(gap, np.uint64(0), (c.astype(np.uint64) + np.uint64(1)) * _POWERS[inside & 255])
    words = np.add.reduceat(weighed, begins)
    found = [mix(words + np.uint64(1))]
    for k in BEGINNINGS:
        found.append(mix(np.add.reduceat(np.where(inside < k, weighed, np.uint64(0)), begins) + np.uint64(1000 + k)))
    # Neighbours within the block; those of other texts are replaced by the caller's cuts.
    found.append(mix(np.concatenate(([np.uint64(0)], words[:-1])) + np.uint64(2)))
    found.append(mix(np.concatenate((words[1:], [np.uint64(0)])) + np.uint64(3)))
    return begins, ends, (np.stack(found, 1) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _cut(begins: np.ndarray, features: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """How many tokens each span of a block has; tokens at its ends lose the other text's word."""
    at = np.searchsorted(begins, [s[1] for s in spans])
    to = np.searchsorted(begins, [s[2] for s in spans])
    some = to > at
    nothing = int(mix(np.array([2], np.uint64))[0] & np.uint64(BUCKETS - 1)), int(mix(np.array([3], np.uint64))[0] & np.uint64(BUCKETS - 1))
    features[at[some], 3] = nothing[0]
    features[to[some] - 1, 4] = nothing[1]
    return to - at


def forward_backward(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of state 1 for sequences that stand one after the other.

    ``emissions`` are log potentials of state 1 against state 0, ``transitions`` potentials;
    before the first token the state is 0. With ``pairs`` also the expected number of each
    transition. Sequences are cut into segments; products of potentials over all segments are
    taken at once, messages between segments one by one, and then those within all segments.
    """
    n = len(emissions)
    counts = -(-lengths // SEGMENT)
    total = int(counts.sum())
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    if not n:
        return np.empty(0), np.zeros((2, 2)) if pairs else None
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    place = np.arange(n) - np.repeat(starts, lengths)
    row, column = np.repeat(first, lengths) + place // SEGMENT, place % SEGMENT
    x = np.zeros((total, SEGMENT))
    there = np.zeros((total, SEGMENT), bool)
    x[row, column] = np.exp(np.clip(emissions, -30, 30))
    there[row, column] = True
    t = transitions
    product = np.broadcast_to(np.eye(2), (total, 2, 2)).copy()
    for k in range(SEGMENT):
        new = np.empty_like(product)
        new[:, :, 0] = product[:, :, 0] * t[0, 0] + product[:, :, 1] * t[1, 0]
        new[:, :, 1] = (product[:, :, 0] * t[0, 1] + product[:, :, 1] * t[1, 1]) * x[:, k, None]
        new /= new.sum((1, 2), keepdims=True)
        product = np.where(there[:, k, None, None], new, product)
    into, out = np.zeros((total, 2)), np.ones((total, 2))
    carried = np.zeros((len(lengths), 2))
    carried[:, 0] = 1
    for k in range(int(counts.max(initial=0))):
        live = np.flatnonzero(counts > k)
        seg = first[live] + k
        into[seg] = carried[live]
        moved = np.einsum("si,sij->sj", carried[live], product[seg])
        carried[live] = moved / moved.sum(1, keepdims=True)
    carried[:] = 1
    for k in range(int(counts.max(initial=0)) - 1, -1, -1):
        live = np.flatnonzero(counts > k)
        seg = first[live] + k
        out[seg] = carried[live]
        moved = np.einsum("sij,sj->si", product[seg], carried[live])
        carried[live] = moved / moved.sum(1, keepdims=True)
    before, forward = np.empty((total, SEGMENT, 2)), np.empty((total, SEGMENT, 2))
    a = into
    for k in range(SEGMENT):
        before[:, k] = a
        new = np.stack((a[:, 0] * t[0, 0] + a[:, 1] * t[1, 0], (a[:, 0] * t[0, 1] + a[:, 1] * t[1, 1]) * x[:, k]), 1)
        new /= new.sum(1, keepdims=True)
        a = np.where(there[:, k, None], new, a)
        forward[:, k] = a
    backward = np.empty((total, SEGMENT, 2))
    b = out
    for k in range(SEGMENT - 1, -1, -1):
        backward[:, k] = b
        new = np.stack((t[0, 0] * b[:, 0] + t[0, 1] * x[:, k] * b[:, 1], t[1, 0] * b[:, 0] + t[1, 1] * x[:, k] * b[:, 1]), 1)
        new /= new.sum(1, keepdims=True)
        b = np.where(there[:, k, None], new, b)
    both = forward * backward
    marginals = (both[:, :, 1] / both.sum(2))[row, column]
    if not pairs:
        return marginals, None
    end = np.stack((backward[:, :, 0], x * backward[:, :, 1]), 2)
    joint = before[:, :, :, None] * t * end[:, :, None, :]
    joint = joint[row, column]
    return marginals, (joint / joint.sum((1, 2), keepdims=True)).sum(0)


@dataclass
class Field:
    """The learned field and the logistic function over its sums."""

    table: np.ndarray
    bias: float
    transitions: np.ndarray
    weights: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return self.bias + self.table[features].sum(1)

    def sums(self, texts: list[str | None], spans_too: bool = False) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """Per text log P(no toxic token) and the expected number of toxic tokens; and the spans."""
        out = np.zeros((len(texts), 2))
        found: list[list[tuple[int, int]]] = [[] for _ in texts]
        shift = [0] * len(texts)
        for block, spans in blocks(texts, _BLOCK):
            begins, ends, features = tokens(block)
            lengths = _cut(begins, features, spans)
            p = forward_backward(self.emissions(features), lengths, self.transitions)[0]
            which = np.array([s[0] for s in spans])
            owner = np.repeat(np.arange(len(spans)), lengths)
            np.add.at(out[:, 0], which[owner], np.log1p(-np.minimum(p, 1 - 1e-9)))
            np.add.at(out[:, 1], which[owner], p)
            if spans_too:
                moves = []
                for i, at, to in spans:
                    moves.append(shift[i] - at)
                    shift[i] += to - at
                for k in np.flatnonzero(p >= MARGINAL).tolist():
                    j = owner[k]
                    found[spans[j][0]].append((int(begins[k]) + moves[j], int(ends[k] - begins[k])))
        return out, found

    def scores(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(sums) @ self.weights, -30, 30)))


def _design(sums: np.ndarray) -> np.ndarray:
    return np.stack((np.ones(len(sums)), 1 - np.exp(sums[:, 0]), np.log1p(sums[:, 1])), 1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge, so that separable samples have finite weights."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + 0.05 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    return w


def _evidence(documents: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Buckets of words and beginnings that mark toxic tokens."""
    counts, sizes = np.zeros((2, BUCKETS)), np.zeros(2)
    for features, label in documents:
        sizes[label] += 1
        counts[label][np.unique(features[:, : 1 + len(BEGINNINGS)])] += 1
    rate = (counts + 0.5) / (sizes + 1)[:, None]
    return (counts[1] >= MIN_DOCUMENTS) & (rate[1] > RATIO * rate[0])


def train(texts: list[str], labels: list[int], seed: int = 7) -> Field:
    table, transitions = np.zeros(BUCKETS), np.array([[0.9, 0.1], [0.5, 0.5]])
    if len(set(labels)) < 2:
        share = 0.5 if not labels else (0.99 if labels[0] else 0.01)
        return Field(table.astype(np.float32), -10.0, transitions, np.array([np.log(share / (1 - share)), 0, 0]))
    documents = []
    for text, label in zip(texts, labels, strict=True):
        parts = []
        for block, spans in blocks([text], _BLOCK):
            begins, _, features = tokens(block)
            _cut(begins, features, spans)
            parts.append(features)
        documents.append((np.concatenate(parts), label))
    evidence = _evidence(documents)
    rng = np.random.default_rng(seed)
    bias, log_t = -4.0, np.log(transitions)
    squares, bias_square, t_squares = np.full(BUCKETS, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    order = np.arange(len(documents))
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for at in range(0, len(order), BATCH):
            chosen = [documents[i] for i in order[at : at + BATCH]]
            features = np.concatenate([f for f, _ in chosen])
            lengths = np.array([len(f) for f, _ in chosen])
            toxic = np.repeat([label for _, label in chosen], lengths).astype(bool)
            target = (toxic & evidence[features[:, : 1 + len(BEGINNINGS)]].any(1)).astype(float)
            if not len(features):
                continue
            t = np.exp(log_t)
            p, expected = forward_backward(bias + table[features].sum(1), lengths, t, pairs=True)
            error = target - p
            gradient = np.bincount(features.ravel(), np.repeat(error, features.shape[1]), BUCKETS) - 1e-3 * table
            squares += gradient**2
            table += RATE * gradient / np.sqrt(squares)
            bias_square += error.sum() ** 2
            bias += RATE * error.sum() / bias_square**0.5
            before = np.concatenate(([0.0], target[:-1]))
            before[np.concatenate(([0], np.cumsum(lengths)))[:-1][lengths > 0]] = 0
            observed = np.zeros((2, 2))
            np.add.at(observed, (before.astype(int), target.astype(int)), 1)
            step = observed - expected
            t_squares += step**2
            log_t = np.clip(log_t + 0.1 * step / np.sqrt(t_squares), -6, 2)
    field = Field(table.astype(np.float32), float(bias), np.exp(log_t), np.zeros(3))
    field.weights = _logistic(_design(field.sums(texts)[0]), np.array(labels, float))
    return field


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Field:
    """Learn from at most ``rows`` labelled documents, which the driver reads."""
    chosen = label_sample(labels, "toxic", rows)
    texts = docs.select(F.col("doc_id").alias("sample_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Broadcast: at most ``rows`` rows of two numbers.
    found = texts.join(F.broadcast(chosen), "sample_id").select("sample_id", "sample_label", "text").limit(rows).collect()
    found.sort(key=lambda r: (r["sample_id"], r["text"]))
    return train([r["text"] for r in found], [r["sample_label"] for r in found])


def tagged(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, expected_toxic, spans) of every row; spans are (start, length) in the text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, spans = shared.value.sums(batch["text"].to_pylist(), spans_too=True)
            spans = pa.array([[{"start": s, "length": n} for s, n in x] for x in spans], span)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(shared.value.scores(sums)), pa.array(sums[:, 1]), spans], ["id", "score", "expected_toxic", "spans"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tag, f"id {kind}, score double, expected_toxic double, spans array<struct<start:bigint,length:bigint>>")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = tagged(docs, fit(docs, read(spark, sf_dir, "labels")))
    return found.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["length"])), ",").alias("toxic_spans"),
    )
