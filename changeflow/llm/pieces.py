"""SentencePiece encoding and decoding: distinct segmentations sampled without replacement.

A text is escaped as the library does it (a dummy space in front, spaces as U+2581). No piece
spans the border of a word (a run of U+2581 with what follows, or a line feed), so the lattice
of all segmentations is a chain of word lattices. A segmentation has the product of the
weights of its pieces; a piece of rank r among the merges weighs 1 / (r + 1) over the harmonic
sum (Zipf's law: merges are ranked by frequency). Characters without a piece are their bytes.

Gumbel top-k, top down: a set of segmentations with probability exp(m) has as its largest
perturbed value a Gumbel(m). The search holds a queue of such sets with exact masses: the set
on top gives its largest member, which is a sampled segmentation, and falls apart into the
sets that differ from it first at one word; their values are Gumbels truncated at the value of
the whole. The k largest are k distinct segmentations drawn without replacement. The next
value in the queue is the threshold of the inclusion scores, log P(value > threshold).

All random numbers are a hash of the row key, the place and the round, so a row has the same
segmentations in any partition, batch or repeated task. One scan without a shuffle; lattices
are computed for the distinct words of a block, by arrays over all positions. Blocks hold a
bounded number of characters, or one text.

Edge cases: null and empty texts have one segmentation without pieces; texts with fewer than k
segmentations give all of them, with inclusion 1; a null key is a key like any other; repeated
rows get equal samples; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from changeflow.llm.common import code_points, mix, read

SAMPLES = 2
BLOCK = 1_500_000
GROUP = 1 << 17
FEW = 8
_WORD = re.compile("▁*[^▁\n]+|▁+|\n")
_SPACE, _LINE = 0x2581, 0x0A
# In place of an id: no piece.
_NONE = -1
_ODD = 0x9E3779B97F4A7C15
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """The pieces of a model as a trie of their characters, and their log weights."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        texts = [model.id_to_piece(i) for i in range(size)]
        self.bytes = [t.encode() for t in texts]
        self.byte_ids = [0] * 256
        for i in range(size):
            if model.is_byte(i):
                value = int(texts[i][3:-1], 16)
                self.byte_ids[value] = i
                self.bytes[i] = bytes([value])
        self.letters = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.sizes = np.fromiter(map(len, self.bytes), np.int64, size)
        self.begins = np.cumsum(self.sizes) - self.sizes
        ranks = sorted(normal, key=lambda i: (-model.get_score(i), i))
        harmonic = np.log(np.sum(1 / np.arange(1, len(ranks) + 1)))
        self.weight = np.full(size, -np.log(len(ranks) + 1.0) - harmonic)
        self.weight[ranks] = -np.log(np.arange(1, len(ranks) + 1)) - harmonic
        self.byte_weight = float(self.weight.min())
        self._grow([(texts[i], i) for i in normal])

    def _grow(self, pieces: list[tuple[str, int]]) -> None:
        """The trie of the pieces, its rows laid into one another.

        The child of a node by a character is at the node's base plus the code of the character, if that place names the
        node as its parent. Node 0 stands for no node, a base below 0 for no children.
        """
        children: list[dict[str, int]] = [{}, {}]
        ids = [_NONE, _NONE]
        for text, i in pieces:
            node = 1
            for character in text:
                if character not in children[node]:
                    children[node][character] = len(children)
                    children.append({})
                    ids.append(_NONE)
                node = children[node][character]
            ids[node] = i
        self.ids = np.array(ids, np.int32)
        # Frequent characters have small codes, which keeps rows short; 0 is for those of no piece.
        alphabet = {character: code for code, (character, _) in enumerate(Counter(c for row in children for c in row).most_common(), 1)}
        self.codes = np.zeros(0x110000, np.int32)
        self.codes[[ord(c) for c in alphabet]] = list(alphabet.values())
        self.heads = np.zeros(len(alphabet) + 1, np.int64)
        for character, node in children[1].items():
            self.heads[alphabet[character]] = node
        rows = [(node, sorted((alphabet[c], child) for c, child in row.items())) for node, row in enumerate(children) if row and node > 1]
        rows.sort(key=lambda row: -len(row[1]))
        self.base = np.full(len(children), -1, np.int64)
        window, width = 4096, len(alphabet) + 1
        free = np.ones(4 * (len(children) + window + width), bool)
        parents, nodes, at = np.zeros(len(free), np.int64), np.zeros(len(free), np.int64), 0
        for node, row in rows:
            while True:
                fits = free[at + row[0][0] : at + row[0][0] + window].copy()
                for code, _ in row[1:]:
                    fits &= free[at + code : at + code + window]
                place = int(fits.argmax())
                if fits[place]:
                    break
                at += window
                if at + window + width > len(free):
                    more = len(free)
                    free, parents, nodes = np.append(free, np.ones(more, bool)), np.append(parents, np.zeros(more, np.int64)), np.append(nodes, np.zeros(more, np.int64))
            self.base[node] = at + place
            for code, child in row:
                free[at + place + code], parents[at + place + code], nodes[at + place + code] = False, node, child
        size = int(self.base.max(initial=0)) + width
        self.parents, self.nodes = parents[:size].copy(), nodes[:size].copy()


@lru_cache
def vocabulary_of(path: str) -> Vocabulary:
    """The vocabulary, loaded once in a process."""
    return Vocabulary(path)


def escaped(text: str | None) -> str:
    return "▁" + text.replace(" ", "▁") if text else ""


def word_starts(points: np.ndarray) -> np.ndarray:
    """Whether a word, as ``_WORD`` finds them, begins at each character of an escaped text."""
    space, line = points == _SPACE, points == _LINE
    starts = space | line
    starts[1:] &= ~(space[1:] & space[:-1])
    starts[1:] |= line[:-1]
    starts[:1] = True
    return starts


def words_of(text: str | None) -> list[str]:
    """The words of a text, escaped."""
    found = escaped(text)
    cuts = np.append(np.flatnonzero(word_starts(code_points(found))), len(found)).tolist()
    return [found[a:b] for a, b in pairwise(cuts)]


def distinct(points: np.ndarray, starts: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The distinct words among those that begin at ``starts``, as bytes of their characters, and which of them each word is."""
    offsets = np.append(starts, len(points)) * 4
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(points)]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy().astype(np.int64)


class Lattices:
    """The lattices of words that stand one after the other: per position the pieces that begin there, by length.

    ``first`` and ``counts`` say where those of a position are. ``log_p`` is the log probability of a piece at its
    position given that the segmentation passes there, ``cumulative`` the running sum of the probabilities (2 from the
    last piece on, so that a search always ends there); from the exact sums over all continuations. ``likeliest`` has, for
    the likeliest piece of each position, the running sums between which it lies, its log probability, the probability of all
    others, summed without it (it may be far below the last digit of 1), its id (see :func:`_placed`) and its length. Words
    are handled in groups of about ``GROUP`` characters, so that what is needed on the way stays small.
    """

    def __init__(self, words: list[str] | pa.LargeBinaryArray, vocabulary: Vocabulary) -> None:
        if isinstance(words, list):
            words = pa.array([word.encode("utf-32-le", "surrogatepass") for word in words], pa.large_binary())
        borders = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] // 4
        points = np.frombuffer(words.buffers()[2], np.uint32)[borders[0] : borders[-1]]
        self.lengths, ends = np.diff(borders), borders[1:] - borders[0]
        self.starts = ends - self.lengths
        cuts = [0, *(np.flatnonzero(np.diff(ends // GROUP)) + 1).tolist(), len(words)]
        groups = [self._group(points[self.starts[a] : ends[b - 1]], self.lengths[a:b], vocabulary) for a, b in pairwise(cuts)]
        pieces = np.cumsum([0] + [len(g[2]) for g in groups])
        self.first = np.concatenate([g[0] + shift for g, shift in zip(groups, pieces, strict=False)])
        self.counts, self.sizes, self.ids, self.log_p, self.cumulative, self.likeliest = map(np.concatenate, list(zip(*groups, strict=True))[1:])
        self._choices: dict[int, tuple[list[int], list[float]]] = {}

    def choices(self, at: int) -> tuple[list[int], list[float]]:
        """Lengths and probabilities of the pieces that begin at a position."""
        if at not in self._choices:
            first = int(self.first[at])
            here = slice(first, first + int(self.counts[at]))
            self._choices[at] = self.sizes[here].tolist(), [math.exp(x) for x in self.log_p[here].tolist()]
        return self._choices[at]

    @staticmethod
    def _group(points: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
        n = len(points)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)
        codes = vocabulary.codes[points].astype(np.int64)
        # Every character begins something, its bytes if no piece.
        at, node = np.arange(n), vocabulary.heads[codes]
        found_at = [(at, vocabulary.ids[node])]
        counts = np.ones(n, np.int64)
        while True:
            more = np.flatnonzero((vocabulary.base[node] >= 0) & (left[at] > len(found_at)))
            if not len(more):
                break
            at, node = at[more], node[more]
            slots = vocabulary.base[node] + codes[at + len(found_at)]
            there = np.flatnonzero(vocabulary.parents[slots] == node)
            at, node = at[there], vocabulary.nodes[slots[there]]
            found = vocabulary.ids[node]
            here = np.flatnonzero(found >= 0)
            found_at.append((at[here], found[here]))
            counts[at[here]] += 1
        # Positions lie in the order of their number of pieces, then of what is left of the word behind them, so that
        # each number is a table and sums go from the ends of words on.
        longest = int(left.max(initial=0))
        most = int(counts.max(initial=0))
        order = counts * (longest + 1) + left
        order = np.argsort(order.astype(np.uint16) if (most + 1) * (longest + 1) < 1 << 16 else order, kind="stable")
        ends = np.cumsum(counts[order])
        first = np.zeros(n, np.int64)
        first[order] = ends - counts[order]
        size = int(ends[-1]) if n else 0
        sizes, ids = np.zeros(size, np.int16), np.zeros(size, np.int32)
        weight, follows = np.zeros(size), np.zeros(size, np.int64)
        free = first.copy()
        for k, (at, found) in enumerate(found_at):
            slots = free[at]
            free[at] += 1
            sizes[slots], ids[slots], weight[slots] = k + 1, found, vocabulary.weight[found]
            follows[slots] = np.where(left[at] > k + 1, at + k + 1, n)
        unknown = np.flatnonzero(found_at[0][1] < 0)
        slots, points = first[unknown], points[unknown]
        weight[slots] = (1 + (points >= 0x80).astype(int) + (points >= 0x800) + (points >= 0x10000)) * vocabulary.byte_weight
        # One byte is an id; for more, minus the character, until the ids are written.
        single = np.array(vocabulary.byte_ids[:128])
        ids[slots] = np.where(points < 0x80, single[np.minimum(points, 0x7F)], -1 - points.astype(np.int64))
        cuts = np.searchsorted(counts[order], np.arange(1, most + 2)).tolist()
        tables = []
        for number, (a, b) in enumerate(pairwise(cuts), 1):
            if b > a:
                here = slice(int(first[order[a]]), int(ends[b - 1]))
                tables.append((order[a:b], *(np.ascontiguousarray(x[here].reshape(-1, number).T) for x in (weight, follows)), here))
        after = _after(tables, left, n)
        log_p, cumulative = np.zeros(size), np.full(size, 2.0)
        likeliest = np.zeros((n, 6))
        for at, own, behind, here in tables:
            likely, above, to, chosen, besides = first[at], 0.0, 2.0, 0.0, 0.0
            if len(own) > 1:
                values, columns = own + after[behind], np.arange(len(at))
                best, top = np.zeros(len(at), np.int64), values[0].copy()
                for k in range(1, len(values)):
                    best[values[k] > top] = k
                    np.maximum(top, values[k], out=top)
                parts = np.exp(values - top)
                parts[best, columns] = 0
                others = parts.sum(0)
                parts[best, columns] = 1
                values -= top + np.log1p(others)
                log_p[here].reshape(len(at), -1)[:] = values.T
                parts /= 1 + others
                for k in range(1, len(parts)):
                    parts[k] += parts[k - 1]
                parts[parts >= parts[-1]] = 2
                cumulative[here].reshape(len(at), -1)[:] = parts.T
                above, to = np.where(best > 0, parts[best - 1, columns], 0), parts[best, columns]
                likely, chosen, besides = likely + best, values[best, columns], others / (1 + others)
            rows = np.empty((len(at), 6))
            for k, column in enumerate((above, to, chosen, besides, _placed(ids[likely]), sizes[likely])):
                rows[:, k] = column
            likeliest[at] = rows
        return first, counts, sizes, ids, log_p, cumulative, likeliest


def _placed(ids: np.ndarray | int) -> np.ndarray | int:
    """Ids as they stand at the places of a segmentation, where 0 is for no piece."""
    return ids + (ids >= 0)


def _after(tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, slice]], left: np.ndarray, n: int) -> np.ndarray:
    """Log mass of all that can follow from each position to the end of its word, and 0 for the end.

    The tables hold positions in the order of what is left, and by piece and position the log weights and where pieces end.
    """
    after = np.zeros(n + 1)
    # Fewer and fewer words are so long; where they are few, plain numbers are faster than arrays.
    many = int(np.count_nonzero(np.bincount(left) >= FEW))
    borders = [np.searchsorted(left[at], np.arange(1, many + 2)).tolist() for at, *_ in tables]
    for level in range(many):
        for (at, weight, follows, _), cuts in zip(tables, borders, strict=True):
            here = slice(cuts[level], cuts[level + 1])
            if here.start == here.stop:
                continue
            values = weight[:, here] + after[follows[:, here]]
            if len(values) == 1:
                after[at[here]] = values[0]
                continue
            top = values.max(0)
            after[at[here]] = top + np.log(np.exp(values - top).sum(0))
    rest: list[tuple[int, int, list[float], list[int]]] = []
    for (at, weight, follows, _), cuts in zip(tables, borders, strict=True):
        own = at[cuts[-1] :]
        rest += zip(left[own].tolist(), own.tolist(), weight[:, cuts[-1] :].T.tolist(), follows[:, cuts[-1] :].T.tolist(), strict=True)
    for _, at, weight, follows in sorted(rest, key=itemgetter(0)):
        values = [w + float(after[f]) for w, f in zip(weight, follows, strict=True)]
        top = max(values)
        after[at] = top + math.log(sum(math.exp(v - top) for v in values))
    return after


def _uniform(keys: np.ndarray | np.uint64, places: np.ndarray, turn: int) -> np.ndarray:
    """Numbers in (0, 1] that depend on key, place and turn only."""
    return _unit(_places(keys, places, turn))


def _places(keys: np.ndarray | np.uint64, places: np.ndarray, turn: int) -> np.ndarray:
    return keys + places.astype(np.uint64) * np.uint64(_ODD) + np.uint64((turn + 1) * int(_SECOND) % (1 << 64))


def _unit(hashes: np.ndarray) -> np.ndarray:
    return ((mix(hashes) >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)


def _draw(lattices: Lattices, words: np.ndarray, begins: np.ndarray, keys: np.ndarray, starts: np.ndarray, turn: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One segmentation of every token: the piece that begins at each of ``size`` places (0: none), log p, and the log mass of all others.

    The mass of the others is summed where they leave the drawn one, so it is exact however small it is.
    """
    out = np.zeros(size, np.int32)
    log_p, rest = np.zeros(len(words)), np.zeros(len(words))
    for a in range(0, len(words), GROUP):
        own = slice(a, a + GROUP)
        _walk(lattices, words[own], begins[own], _places(keys[own], begins[own] - starts[own], turn), out, log_p[own], rest[own])
    with np.errstate(divide="ignore"):
        return out, log_p, np.log(rest)


def _walk(lattices: Lattices, words: np.ndarray, begins: np.ndarray, hashes: np.ndarray, out: np.ndarray, log_p: np.ndarray, rest: np.ndarray) -> None:
    """Fill the last three for these tokens."""
    p, q, live = lattices.starts[words], begins, np.arange(len(words))
    end = p + lattices.lengths[words]
    while len(live):
        uniform = _unit(hashes)
        above, to, chosen, leaving, found, sizes = lattices.likeliest.take(p, 0).T
        sizes = sizes.astype(np.int64)
        # Most are the likeliest piece; for the others the running sums are gone through.
        other = np.flatnonzero((uniform <= above) | (uniform > to))
        if len(other):
            slots, wanted = lattices.first[p[other]], uniform[other]
            short = np.flatnonzero(lattices.cumulative[slots] < wanted)
            while len(short):
                slots[short] += 1
                short = short[lattices.cumulative[slots[short]] < wanted[short]]
            found[other], sizes[other] = _placed(lattices.ids[slots]), lattices.sizes[slots]
            chosen[other] = lattices.log_p[slots]
            leaving[other] = -np.expm1(chosen[other])
        out[q] = found
        before = log_p[live]
        rest[live] += np.exp(before) * leaving
        log_p[live] = before + chosen
        p = p + sizes
        more = np.flatnonzero(p < end)
        sizes = sizes[more]
        p, q, end, live = p[more], q[more] + sizes, end[more], live[more]
        hashes = hashes[more] + sizes.astype(np.uint64) * np.uint64(_ODD)


class _Others:
    """The segmentations of one word that are none of ``taken`` (piece lengths).

    Masses per node of the tree of the taken ones, from its leaves up, each relative to the node: sums of what leaves
    the tree, without a difference that could lose small ones. ``log_mass`` is that of all.
    """

    def __init__(self, lattices: Lattices, word: int, taken: list[tuple[int, ...]]) -> None:
        self.lattices = lattices
        self.at = int(lattices.starts[word])
        self.end = int(self.at + lattices.lengths[word])
        # Paths that share a beginning are at the same node, named by the first of them.
        nodes: list[tuple[int, int, dict[int, list[int]]]] = []
        stack = [(self.at, 0, list(range(len(taken))))]
        while stack:
            at, depth, here = stack.pop()
            children: dict[int, list[int]] = {}
            for i in here:
                children.setdefault(taken[i][depth], []).append(i)
            nodes.append((at, here[0], children))
            stack += [(at + length, depth + 1, group) for length, group in children.items() if at + length < self.end]
        self.masses: dict[tuple[int, int], tuple[list[float], dict[int, list[int]]]] = {}
        for at, name, children in reversed(nodes):
            sizes, free = lattices.choices(at)
            mass = list(free)
            for length, group in children.items():
                known = self.masses.get((at + length, group[0]))
                mass[sizes.index(length)] *= sum(known[0]) if known else 0.0
            self.masses[at, name] = mass, children
        whole = sum(self.masses[self.at, 0][0])
        self.log_mass = math.log(whole) if whole > 0 else -math.inf

    def draw(self, uniform: np.ndarray) -> tuple[list[int], list[int], float]:
        """Lengths, ids and log p of one of them."""
        at, name, total = self.at, 0, 0.0
        lengths: list[int] = []
        ids: list[int] = []
        while at < self.end:
            mass, children = self.masses[at, name] if name >= 0 else (self.lattices.choices(at)[1], {})
            some = [k for k, m in enumerate(mass) if m]
            sums = list(accumulate(mass[k] for k in some))
            k = some[min(bisect_left(sums, float(uniform[at - self.at]) * sums[-1]), len(some) - 1)]
            slot = int(self.lattices.first[at]) + k
            found, size = int(self.lattices.ids[slot]), int(self.lattices.sizes[slot])
            ids.append(_placed(found))
            total += float(self.lattices.log_p[slot])
            lengths.append(size)
            name = children[size][0] if size in children else -1
            at += size
        return lengths, ids, total


def _truncated(mass: np.ndarray, limit: np.ndarray | float, uniform: np.ndarray) -> np.ndarray:
    """Gumbels with these log masses, truncated at ``limit``."""
    free = mass - np.log(-np.log(uniform * (1 - 1e-16)))
    return np.where(np.isfinite(mass), -np.logaddexp(-limit, -free), -np.inf)


def _first(drawn: tuple[np.ndarray, np.ndarray, np.ndarray], borders: list[int], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest perturbed value of each text, and those of the sets that its first segmentation leaves at each word."""
    _, log_p, rest = drawn
    mass, sizes = np.zeros(len(log_p)), np.diff(borders)
    for a, b in pairwise(borders):
        if b > a:
            np.cumsum(log_p[a : b - 1], out=mass[a + 1 : b])
    mass += rest
    largest = -np.log(-np.log(_uniform(keys, np.zeros(len(keys), np.int64), 999) * (1 - 1e-16)))
    places = np.arange(len(mass)) - np.repeat(borders[:-1], sizes)
    return largest, _truncated(mass, np.repeat(largest, sizes), _uniform(np.repeat(keys, sizes), places, 1000))


def _top(
    lattices: Lattices, words: np.ndarray, begins: np.ndarray, drawn: list[tuple[np.ndarray, np.ndarray, np.ndarray]], key: np.uint64, samples: int, largest: float, values: np.ndarray
) -> list[tuple[np.ndarray, float, float, float]]:
    """(pieces by place, log p, value, log inclusion) of the sampled segmentations of a text; the last two arguments are from :func:`_first`."""
    n = len(words)
    ends = np.append(begins[1:], len(drawn[0][0]))
    queue: list[tuple[float, int]] = []
    leaves: list[dict] = []

    def add(out: np.ndarray, log_p: np.ndarray, rest: np.ndarray, value: float, at: int, taken: list, others: _Others | None, values: np.ndarray) -> None:
        leaves.append({"out": out, "log_p": log_p, "rest": rest, "value": value, "at": at, "taken": taken, "others": others, "values": values})
        push(len(leaves) - 1)

    def left(log_p: np.ndarray, rest: np.ndarray, value: float, at: int, others: _Others) -> np.ndarray:
        sums = np.cumsum(log_p)
        mass = rest[at:].copy()
        mass[1:] += sums[at:-1]
        mass[0] = log_p[:at].sum() + others.log_mass
        return _truncated(mass, value, _uniform(key, np.arange(at, n), 1000 + len(leaves)))

    def push(turn: int) -> None:
        values = leaves[turn]["values"]
        if len(values) and math.isfinite(best := float(values.max())):
            heapq.heappush(queue, (-best, turn))

    def path(out: np.ndarray, t: int) -> tuple[int, ...]:
        places = [i for i, piece in enumerate(out[begins[t] : ends[t]].tolist()) if piece]
        return tuple(b - a for a, b in pairwise([*places, int(ends[t] - begins[t])]))

    add(*drawn[0], largest, 0, [path(drawn[0][0], 0)], None, values)
    while len(leaves) < samples and queue:
        value, turn = heapq.heappop(queue)
        leaf = leaves[turn]
        j = int(leaf["values"].argmax())
        leaf["values"][j] = -np.inf
        t = leaf["at"] + j
        taken = leaf["taken"] if j == 0 else [path(leaf["out"], t)]
        fresh = len(leaves)
        spread = _uniform(key, np.arange(begins[t], ends[t]), 2000 + fresh)
        others = leaf["others"] if j == 0 and leaf["others"] else _Others(lattices, int(words[t]), taken)
        lengths, ids, log_p = others.draw(spread)
        out, more, rest = drawn[fresh]
        own = np.zeros(ends[t] - begins[t], np.int32)
        for i, place in zip(ids, accumulate(lengths[:-1], initial=0), strict=True):
            own[place] = i
        out = np.concatenate((leaf["out"][: begins[t]], own, out[ends[t] :]))
        all_p = np.concatenate((leaf["log_p"][:t], [log_p], more[t + 1 :]))
        all_rest = np.concatenate((leaf["rest"][:t], [-np.inf], rest[t + 1 :]))
        taken = [*taken, tuple(lengths)]
        others = _Others(lattices, int(words[t]), taken)
        add(out, all_p, all_rest, -value, t, taken, others, left(all_p, all_rest, -value, t, others))
        push(turn)
    threshold = -queue[0][0] if queue else -np.inf
    result = []
    for leaf in leaves:
        total = float(leaf["log_p"].sum())
        x = total - threshold
        # log(1 - exp(-exp(x))), which is x itself far below zero.
        inclusion = 0.0 if x > 5 else x if x < -30 else math.log(-math.expm1(-math.exp(x)))
        result.append((leaf["out"], total, leaf["value"], inclusion))
    return result


def _written(out: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The ids of a segmentation, characters without a piece as their bytes."""
    found = out.compress(out != 0)
    unknown = np.flatnonzero(found < 0)
    if len(unknown):
        spelt = [[vocabulary.byte_ids[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")] for i in found[unknown].tolist()]
        sizes = np.ones(len(found), np.int64)
        sizes[unknown] = [len(ids) for ids in spelt]
        at_byte = np.repeat(found < 0, sizes)
        found = np.repeat(found, sizes)
        found[at_byte] = [i + 1 for ids in spelt for i in ids]
    return (found - 1).astype(np.int32)


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of a segmentation."""
    sizes = vocabulary.sizes[ids]
    ends = np.cumsum(sizes)
    letters = vocabulary.letters[np.repeat(vocabulary.begins[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ids) else 0)]
    text = letters.tobytes().decode("utf-8", "surrogatepass")
    return text.replace("▁", " ")[1:]


def encode(texts: list[str | None], keys: list[object], vocabulary: Vocabulary, samples: int = SAMPLES) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """(text, sample, ids, log p, value, log inclusion) of every sample of every text."""
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size < BLOCK):
            size += len(texts[to] or "") + 1
            to += 1
        found = [escaped(text) for text in texts[at:to]]
        starts = np.concatenate(([0], np.cumsum([len(text) for text in found])))
        points = code_points("".join(found))
        begin = word_starts(points)
        begin[starts[:-1][np.diff(starts) > 0]] = True
        begins = np.flatnonzero(begin)
        borders = np.searchsorted(begins, starts).tolist()
        hashes = np.array([xxh3_64_intdigest(repr(keys[i]).encode()) for i in range(at, to)], np.uint64)
        drawn = []
        if len(begins):
            index, words = distinct(points, begins)
            lattices = Lattices(index, vocabulary)
            per_text = np.diff(borders)
            of, first = np.repeat(hashes, per_text), np.repeat(starts[:-1], per_text)
            drawn = [_draw(lattices, words, begins, of, first, s, int(starts[-1])) for s in range(samples)]
            largest, values = _first(drawn[0], borders, hashes)
        for i in range(at, to):
            a, b = borders[i - at], borders[i - at + 1]
            if a == b:
                yield i, 0, np.empty(0, np.int32), 0.0, 0.0, 0.0
                continue
            c, d = starts[i - at], starts[i - at + 1]
            own = [(out[c:d], p[a:b], rest[a:b]) for out, p, rest in drawn]
            for s, (out, total, value, inclusion) in enumerate(_top(lattices, words[a:b], begins[a:b] - c, own, hashes[i - at], samples, float(largest[i - at]), values[a:b])):
                yield i, s, _written(out, vocabulary), total, value, inclusion
        at = to


def sampled(docs: DataFrame, path: str | None = None, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per sample: id, sample, n_pieces, log_prob, value, log_inclusion, ids_crc32, round_trip[, ids].

    ``round_trip`` tells whether the ids decode to the text (with U+2581 read as a space).
    """
    path = path or model_path()
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "sample", "n_pieces", "log_prob", "value", "log_inclusion", "ids_crc32", "round_trip"] + ["ids"] * with_ids

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in batches:
            texts, keys = batch["text"].to_pylist(), batch["id"].to_pylist()
            rows: list[tuple] = []

            def built(rows: list[tuple], batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_()]
                arrays = [batch["id"].take(pa.array(columns[0], pa.int64()))]
                arrays += [pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=False)]
                if with_ids:
                    offsets = np.concatenate(([0], np.cumsum(columns[2]))).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(offsets, np.concatenate(columns[8])))
                return pa.RecordBatch.from_arrays(arrays, names)

            size = 0
            for i, s, ids, total, value, inclusion in encode(texts, keys, vocabulary, samples):
                same = decode(ids, vocabulary) == (texts[i] or "").replace("▁", " ")
                rows.append((i, s, len(ids), total, value, inclusion, zlib.crc32(ids.astype("<u4").tobytes()), same) + ((ids,) if with_ids else ()))
                size += len(ids) * with_ids + 10
                if size > 1_000_000:
                    yield built(rows)
                    rows, size = [], 0
            if rows:
                yield built(rows)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, sample int, n_pieces long, log_prob double, value double, log_inclusion double, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids
    return rows.mapInArrow(sample, schema)


def op8_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
