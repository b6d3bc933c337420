"""Archives and packing: round trips, brute force, bounds."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpora import words
from pyspark.sql import functions as F

from changeflow.llm import archives, packing
from changeflow.session import new_dir

PAGES = "page_id long, url string, html string"


def captured(spark, rows, schema=PAGES):
    arc, warc = new_dir(spark, "arc"), new_dir(spark, "warc")
    archives.write_arc(spark.createDataFrame(rows, schema).repartition(3), arc)
    archives.write_warc(archives.convert(archives.read_arc(spark, arc)), warc)
    return arc, warc, archives.resolved(archives.read_warc(spark, warc))


def test_pages_round_trip_through_arc_and_warc(spark):
    rng = random.Random(4)
    same, small = "<p>" + words(rng, 400) + "ü</p>", "<p>short</p>"
    rows = [(i, f"http://h{i % 3}/a b?q={i}", words(rng, 50) + "\r\n\r\nWARC/1.0\r\n\nhttp://x 1.1.1.1 2 text/html 9\n" + "é" * i) for i in range(20)]
    rows += [(i, "http://s/", same) for i in range(20, 30)] + [(i, "http://t/", small) for i in range(30, 34)]
    rows += [(34, None, None), (35, "x", ""), (None, "http://n/", same), (None, None, None), (29, "http://s/", same)]
    arc, warc, found = captured(spark, rows)
    payloads = Counter((r["page_id"], r["payload"].decode()) for r in archives.read_arc(spark, arc).collect())
    assert payloads == Counter((i, html or "") for i, _, html in rows)
    assert {r["version"] for r in archives.read_arc(spark, arc).collect()} == {"1", "2"}
    want = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        want[(i, len(body), hashlib.sha1(body).hexdigest())] += 1
    rows_found = found.collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in rows_found) == want
    copies = [r for r in rows_found if r["payload_digest"] == hashlib.sha1(same.encode()).hexdigest()]
    assert [r["page_id"] for r in copies if r["record_type"] == "response"] == [29]
    assert all(r["refers_to"] == 29 for r in copies if r["record_type"] == "revisit") and len(copies) == 12
    assert all(r["record_type"] == "response" for r in rows_found if r["payload_bytes"] < 1000)


def test_header_lines_by_version():
    def arc(version, fields, line, body):
        block = f"{version} 0 org\n{fields}\n".encode()
        extra = " 200 - - 0 f" if version == "2" else ""
        return f"filedesc://f 0.0.0.0 19970101000000 text/plain{extra} {len(block)}\n".encode() + block + b"\n" + f"{line} {len(body)}\n".encode() + body + b"\n"

    one = arc("1", archives.ARC_FIELDS["1"], "http://a b/c 1.2.3.4 19970203 text/html", b"x\n\ny")
    two = arc("2", archives.ARC_FIELDS["2"], "dns:a 1.2.3.4 1998 text/dns 200 abc http://l 77 f", b"a 1")
    (v1, f1, d1), (v2, f2, d2) = [next(archives.arc_records(x)) for x in (one, gzip.compress(two))]
    assert (v1, f1["URL"], f1["Archive-date"], d1) == ("1", "http://a b/c", "19970203", b"x\n\ny")
    assert (v2, f2["URL"], f2["Checksum"], f2["Location"], f2["Offset"], d2) == ("2", "dns:a", "abc", "http://l", "77", b"a 1")
    assert archives.iso_date("19970203040506") == "1997-02-03T04:05:06Z"
    assert archives.iso_date("1998") == "1998-01-01T00:00:00Z"
    with pytest.raises(ValueError, match="declares"):
        list(archives.arc_records(one[:-4]))


def test_bytes_that_are_no_text_survive(spark):
    records = spark.createDataFrame(
        [("f", 0, "http://a/", "1.1.1.1", "2001", bytearray(b"HTTP/1.1 200 OK\r\n\r\n"), bytearray(bytes(range(256))), "0" * 40, None, None, None, None)],
        "file string, place long, url string, ip string, date string, http binary, payload binary, sha1 string, first_file string, first_place long, first_url string, first_date string",
    ).withColumn("sha1", F.lit(hashlib.sha1(bytes(range(256))).hexdigest()))
    path = new_dir(spark, "warc")
    archives.write_warc(records, path)
    assert archives.read_warc(spark, path).first()["payload_bytes"] == 256


def test_empty_archives(spark):
    _, _, found = captured(spark, [])
    assert found.count() == 0
    extra = [(1, "u", "h", "x")]
    assert captured(spark, extra, PAGES + ", payload string")[2].count() == 1


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.tokenizer_path())


def test_words_encode_as_whole_texts_do(encoder, corpus):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    texts = [r[1] for r in corpus] + ["it's we'll 'S\x0b'll \x1c a\x1cb\x85c ÀÉ é ΟΔΟΣ", "a<|endoftext|>b <|startoftext|>", "12 ٣ 中文!? ﬁ İ"]
    for text in texts:
        want = np.array(whole.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.ids(text) == want


def test_cache_limits_and_blocks_change_nothing(encoder, corpus, monkeypatch):
    texts = [r[1] for r in corpus]
    want = [encoder.ids(t) for t in texts]
    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    monkeypatch.setattr(packing, "_BLOCK", 100)
    small = packing.Encoder(packing.tokenizer_path())
    assert [small.ids(t) for t in texts] == want


@pytest.mark.parametrize("partition", [100_000, 40])
def test_packed_documents(spark, docs, corpus, encoder, monkeypatch, partition):
    monkeypatch.setattr(packing, "PARTITION_PIECES", partition)
    size = 64
    rows = packing.packed_documents(docs, size=size).collect()
    want = Counter()
    for i, text, *_ in corpus:
        data = encoder.ids(text) + (1).to_bytes(4, "little")
        for k in range(0, len(data), 4 * size):
            part = data[k : k + 4 * size]
            want[(i, k // 4 // size, k // 4, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    least = packing.lower_bound(np.array([r["length"] for r in rows]), size)
    assert least <= len(bins) <= least + (2 if partition == 40 else 1)


def test_sequences_hold_the_ids(spark, docs, encoder):
    few = docs.where("doc_id < 20")
    found = packing.sequences(few, size=64).collect()
    total = sum(len(encoder.ids(r["text"])) // 4 + 1 for r in few.collect())
    assert sum(r["length"] for r in found) == total
    assert all(len(r["ids"]) == 4 * r["length"] <= 256 for r in found)


def optimum(lengths, size):
    best = [len(lengths)]

    def place(i, room):
        if len(room) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(room)
            return
        for k in range(len(room)):
            if room[k] >= lengths[i] and room[k] not in room[:k]:
                place(i + 1, room[:k] + [room[k] - lengths[i]] + room[k + 1 :])
        place(i + 1, room + [size - lengths[i]])

    place(0, [])
    return best[0]


def test_bounds_never_exceed_the_optimum():
    rng = random.Random(1)
    for _ in range(150):
        size = rng.choice([10, 24, 30])
        lengths = sorted((rng.randint(1, size) for _ in range(rng.randint(1, 8))), reverse=True)
        best = optimum(lengths, size)
        assert packing.lower_bound(np.array(lengths), size) <= best
        assert len(packing.best_fit_decreasing(np.array(lengths), size)[2]) >= best
    # Three pieces of just over half need three bins; their sum alone says two.
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3


def test_edge_tables(spark, empty, clashing, corpus):
    assert packing.packed_documents(empty).count() == 0
    assert packing.packed_documents(clashing).where("piece = 0").count() == len(corpus)
