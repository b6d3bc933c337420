"""Best-fit packing of token sequences, repacked until bounds certify the number of bins.

Every document becomes ids and an end id; documents longer than a sequence are cut into
pieces of full length and a rest. Pieces are dealt to partitions by hash. A partition packs
its pieces best-fit decreasing and bounds the number of bins from below by dual feasible
functions. If the two agree, its number of bins is certified; it then keeps its bins but for
the emptiest. A partition with a gap gives up all bins that are not full. What was given up
is exchanged: it is dealt anew, to as few partitions as hold it, and packed again, until a
round saves nothing. A round that would need more bins than it was given is not used.

At scale: tokens are counted by one scan with a cache of words per process (the encoding of a
text is that of its words between ASCII white space, one after the other; the tests hold
this against whole texts). Only numbers are shuffled, about 60 bytes for each piece. A
partition has about ``PARTITION_PIECES`` pieces, whatever the corpus has; later rounds see
only what was given up. The driver sees two counts a round.

Edge cases: null and empty texts are one piece, the end id; a null id is kept as null;
repeated rows are packed each on its own; extra columns are ignored; an empty table gives an
empty result; texts of any length are read in blocks.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import read
from changeflow.session import stored

SEQUENCE = 4096
END_ID = 1
PARTITION_PIECES = 100_000
MAX_ROUNDS = 6
CACHED_WORDS = 500_000
_BLOCK = 1_000_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers, word by word from a cache.

    The cache has at most twice ``CACHED_WORDS`` words and those of a block.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Words are looked up in the young half; when that is full it becomes the old one,
        # from which words in use come back.
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of these words, which are not in the young half."""
        found = {w: self._old[w] for w in words if w in self._old}
        fresh = [w for w in words if w not in found]
        encoded = self._tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in fresh], add_special_tokens=False)
        for word, encoding in zip(fresh, encoded, strict=True):
            found[word] = array("I", encoding.ids).tobytes()
        return found

    def _block(self, text: bytes) -> bytes:
        # bytes.split cuts at ASCII white space only.
        words = text.split()
        young = self._young
        try:
            return b"".join([young[w] for w in words])
        except KeyError:
            found = self._learn({w for w in words if w not in young})
        young.update(found)
        out = b"".join([young[w] for w in words])
        if len(young) > CACHED_WORDS:
            self._young, self._old = {}, young
        return out

    def ids(self, text: str | None) -> bytes:
        data = (text or "").encode("utf-8", "replace")
        out, begin = [], 0
        while begin < len(data):
            end = min(begin + _BLOCK, len(data))
            if end < len(data):
                cuts = [data.rfind(c, begin, end) for c in (b" ", b"\n", b"\t")]
                end = max(cuts) if max(cuts) > begin else len(data)
            out.append(self._block(data[begin:end]))
            begin = end
        return b"".join(out)


@lru_cache
def encoder_of(path: str) -> Encoder:
    """The encoder of a process; tasks that run one after the other share its cache."""
    return Encoder(path)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every piece of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch["text"]):
                data = encoder.ids(text.as_py()) + end
                for k, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at : at + 4 * size]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            arrays = [batch["doc_id"].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the room that each bin has left."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    room: list[int] = []
    rooms = 0  # bit r is set if some bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            b = open_bins[r].pop()
            if not open_bins[r]:
                rooms ^= 1 << r
        else:
            r, b = size, len(room)
            room.append(size)
        bins[i], offsets[i] = b, size - r
        left = r - n
        room[b] = left
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(room, np.int64)


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """The best of the bounds that dual feasible functions give; no packing has fewer bins."""
    counts = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    x = np.arange(size + 1, dtype=np.int64)
    best = int(-(-(counts * x).sum() // size))
    # Pieces over size - e count as full, pieces under e as nothing.
    count_to, sum_to = np.cumsum(counts), np.cumsum(counts * x)
    e = np.arange(1, size // 2 + 1)
    middle = sum_to[size - e] - sum_to[e - 1]
    large = count_to[size] - count_to[size - e]
    best = max(best, int((large + -(-middle // size)).max()))
    # x counts as floor((k + 1) x / size) / k, where that is no whole number.
    for k in range(1, 33):
        whole = (k + 1) * x % size == 0
        # Scaled by k * size.
        value = np.where(whole, x * k, (k + 1) * x // size * size)
        best = max(best, int(-(-(counts * value).sum() // (k * size))))
    return best


_PACKED = "round int, bucket int, bin long, offset long, given_up boolean"


def _round(rows: DataFrame, number: int, buckets: int, size: int) -> DataFrame:
    """Pack each bucket; ``given_up`` marks the pieces that go to the next round."""
    fields = [f for f in rows.schema.fields if f.name != "bucket"]

    def pack(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        bins, offsets, room = best_fit_decreasing(lengths, size)
        given = np.zeros(len(room), bool)
        if len(room) > lower_bound(lengths, size):
            given = room > 0
        elif room.max() > 0:
            given[room.argmax()] = True
        n = len(lengths)
        out = {f.name: table[f.name] for f in fields}
        out |= {"round": pa.array([number] * n, pa.int32()), "bucket": table["bucket"], "bin": pa.array(bins), "offset": pa.array(offsets), "given_up": pa.array(given[bins])}
        return pa.table(out)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    spread = F.pmod(F.xxhash64("piece_id", F.lit(number)), F.lit(buckets)).cast("int")
    return stored(rows.withColumn("bucket", spread).groupBy("bucket").applyInArrow(pack, f"{schema}, {_PACKED}"), f"packed-{number}")


def pack(rows: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``rows`` (with a length each, at most ``size``) and the sequence_id and offset of each."""
    rows = stored(rows.withColumn("piece_id", F.monotonically_increasing_id()), "pieces")
    columns = [c for c in rows.columns if c != "piece_id"]
    full = rows.where(F.col("length") == size)
    # A full piece is a sequence by itself; negative numbers keep these apart.
    done = [full.select(*columns, (-1 - F.col("piece_id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    number = F.shiftleft(F.col("round").cast("long"), 58) + F.shiftleft(F.col("bucket").cast("long"), 32) + F.col("bin")

    def placed(df: DataFrame) -> DataFrame:
        return df.select(*columns, number.alias("sequence_id"), "offset")

    todo = rows.where(F.col("length") < size)
    buckets = max(1, -(-todo.count() // PARTITION_PIECES))
    packed = _round(todo, 0, buckets, size)
    for step in range(1, MAX_ROUNDS + 1):
        given = packed.where("given_up")
        bins, count = given.agg(F.count_distinct("bucket", "bin"), F.count("*")).first()
        if bins <= 1 or (buckets == 1 and step > 2):
            break
        buckets = max(1, -(-count // PARTITION_PIECES))
        again = _round(given.select(*columns, "piece_id"), step, buckets, size)
        if again.agg(F.count_distinct("bucket", "bin")).first()[0] >= bins:
            break
        done.append(placed(packed.where("not given_up")))
        packed = again
    done.append(placed(packed))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def packed_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with the sequence and the offset where each is placed."""
    return pack(pieces(docs, path or tokenizer_path(), id_col, text_col, size, with_ids), size)


def sequences(docs: DataFrame, path: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves, ids as 32-bit numbers."""
    placed = packed_documents(docs, path, size=size, with_ids=True)
    parts = placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda out, p: F.concat(out, p["ids"])).alias("ids"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that are left."""
    return packed_documents(docs)
