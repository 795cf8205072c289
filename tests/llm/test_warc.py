"""Archives: exact round trips, and what the reader says of damage."""

import base64
import hashlib
import io
import random
import struct
from collections import defaultdict
from pathlib import Path

import pytest
import zstandard

from tidemark.llm import warc_zstd as W
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id bigint, url string, html string, row int, payload string, sha1 string, first int, `a.b` string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "p", "s", 2, "dot") for i, u, h in rows], SCHEMA).repartition(3)


LONG = "<p>" + "Grüße " * 40_000 + "</p>"
BODY = "<html>" + "x" * 994
PAGES = [
    (1, "http://a.example/", BODY), (2, "http://b.example/ü?q=1", BODY), (3, None, BODY), (4, "", None), (5, "u", ""),
    (6, "bad\r\nInjected: yes", "short"), (7, " u ", "short"), (8, "l", LONG), (9, "l2", LONG), (9, "l2", LONG),
    (None, "n", BODY), (None, "n", LONG + "!"), (None, "n2", LONG + "!"), (10, "e", "\r\n\r\nWARC/1.1\r\n"),
]


def expected(rows):
    """(page_id, bytes, digest, type, refers) as a sorted list."""
    held = defaultdict(list)
    for i, _, html in rows:
        held[(html or "").encode()].append(i)
    out = []
    for data, ids in held.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha1(data).hexdigest()
        for n, i in enumerate(ids):
            last = n == len(ids) - 1 or len(data) < 1000
            out.append((i, len(data), digest, "response" if last else "revisit", None if last else ids[-1]))
    return sorted(out, key=str)


def seen(rows):
    number = lambda x: None if x is None else int(x)
    return sorted(
        ((number(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in rows), key=str
    )


def test_round_trip(spark):
    made = W.write(frame(spark, PAGES), archive_bytes=3000)
    rows = made.read().collect()
    assert not [r.error for r in rows if r.error] and len(rows) == len(PAGES)
    assert sorted(str((r.headers.get("page-id"), bytes(r.payload))) for r in rows if r.record_type == "response") == sorted(
        str((None if i is None else str(i), (h or "").encode()))
        for (i, _, h), want in zip(*matched()) if want == "response"
    )
    back = W.resolved(made.read()).collect()
    assert seen(back) == expected(PAGES) and all(r.intact for r in back)
    uris = {r.target_uri for r in rows}
    assert {"http://b.example/ü?q=1", "", None, "bad%0D%0AInjected: yes", "%20u%20"} <= uris
    assert made.files.count() > 1 and {r.path for r in made.files.collect()} == {r.archive for r in rows}


def matched():
    """The pages, and the type of record of each."""
    types, left = [], expected(PAGES)
    for i, _, html in PAGES:
        data = (html or "").encode()
        found = next(r for r in left if r[0] == i and r[2] == hashlib.sha1(data).hexdigest())
        left.remove(found)
        types.append(found[3])
    return PAGES, types


def test_files_follow_the_format(spark):
    made = W.write(table(spark, SF, "pages"))
    data = Path(made.files.first().path.removeprefix("file:")).read_bytes()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    words = zstandard.ZstdDecompressor().decompressobj().decompress(data[8 : 8 + size]) if size else b""
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words)) if words else zstandard.ZstdDecompressor()
    frame_, at, n = reader.decompressobj(), 8 + size, 0
    while at < len(data):
        record = frame_.decompress(data[at:])
        assert frame_.eof and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        at, n, frame_ = len(data) - len(frame_.unused_data), n + 1, reader.decompressobj()
    assert n == made.files.first().records


def archive(*records, dictionary=b"", plain=False):
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor()
    head = struct.pack("<II", W.DICTIONARY_MAGIC, len(dictionary)) + dictionary if plain else W.dictionary_frame(dictionary)
    return head + b"".join(packer.compress(r) for r in records)


def read(data):
    return list(W.records(io.BytesIO(data), "x"))


GOOD = W.record("response", "<urn:uuid:1>", "http://a/", "1", b"hello" * 9, None)


def test_dictionary_plain_compressed_or_missing():
    rng = random.Random(1)
    words = [bytes(rng.choices(b"abcdefgh ", k=9)) for _ in range(300)]
    samples = [b"".join(rng.choices(words, k=60)) for _ in range(400)]
    trained = zstandard.train_dictionary(4096, samples).as_bytes()
    for plain in (True, False):
        rows = read(archive(GOOD, GOOD, dictionary=trained, plain=plain))
        assert [r["payload"] for r in rows] == [b"hello" * 9] * 2 and not any(r["error"] for r in rows)
    (row,) = read(zstandard.ZstdCompressor().compress(GOOD))
    assert row["offset"] == 0 and row["error"] is None
    assert read(b"") == [] and read(archive()) == []
    body = archive(GOOD, dictionary=trained)
    without = body[8 + struct.unpack("<I", body[4:8])[0] :]
    assert read(without)[0]["error"] == "frame cannot be decoded"


@pytest.mark.parametrize(
    ("change", "error"),
    [
        (lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), "no WARC version line"),
        (lambda r: r.replace(b"WARC-Date: ", b"X: "), "no warc-date"),
        (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: other"), "type 'other'"),
        (lambda r: r[:-4], "Content-Length 124, but 120 bytes"),
        (lambda r: r + b"x", "Content-Length 124, but 125 bytes"),
        (lambda r: r.replace(b"hellohello", b"hellOhello", 1), "block digest differs"),
        (lambda r: r.replace(b"Content-Length: 124", b"Content-Length: -1"), "Content-Length is no number"),
        (lambda r: r.replace(b"WARC-Date: ", b"no colon\r\nWARC-Date: "), "header line without a name"),
        (lambda r: r.replace(b"sha1:", b"md5:", 1), "digest of another kind: md5"),
        (lambda r: b"", "no WARC version line"),
    ],
)
def test_invalid_records_are_told_and_passed_over(change, error):
    bad, good = read(archive(change(GOOD), GOOD))
    assert bad["error"] == error and bad["payload"] is None
    assert good["error"] is None and good["payload"] == b"hello" * 9


def test_digests_and_lengths_inside():
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 7\r\n\r\nabc"
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Date: d\r\n{}Content-Type: application/http\r\nContent-Length: {}\r\n\r\n"
    make = lambda extra, body: head.format(extra, len(body)).encode() + body + b"\r\n\r\n"
    assert read(archive(make("", block)))[0]["error"] == "HTTP Content-Length 7, but 3 bytes"
    block = block.replace(b"7", b"3")
    wrong = "WARC-Payload-Digest: sha1:" + base64.b32encode(b"0" * 20).decode() + "\r\n"
    assert read(archive(make(wrong, block)))[0]["error"] == "payload digest differs"
    right = "WARC-Payload-Digest: sha1:" + hashlib.sha1(b"abc").hexdigest() + "\r\nFolded: a\r\n b\r\n"
    row = read(archive(make(right, block)))[0]
    assert row["error"] is None and dict(row["headers"])["folded"] == "a b"


def test_cut_archives():
    whole = archive(GOOD, GOOD)
    for at in (3, 9, len(whole) // 2, len(whole) - 1):
        rows = read(whole[:at])
        assert rows[-1]["error"] and all(r["error"] is None for r in rows[:-1])
    assert read(struct.pack("<II", W.DICTIONARY_MAGIC, 100) + b"short")[0]["error"] == "skippable frame is cut off"


def test_missing_and_null_paths(spark, none):
    rows = W.read(spark.createDataFrame([(None,), ("/nowhere/x.warc.zst",)], "path string")).collect()
    assert [r.error.split(":")[0] for r in rows] == ["cannot be opened"]
    made = W.write(frame(spark, []))
    assert made.read().collect() == [] and W.resolved(made.read()).collect() == []


def test_listing(spark, tmp_path):
    made = W.write(frame(spark, PAGES), folder=f"file:{tmp_path}/out")
    (tmp_path / "out" / "other.txt").write_text("x")
    assert W.read(W.list_archives(spark, f"file:{tmp_path}/out")).count() == len(PAGES)
    assert made.read().count() == len(PAGES)


def test_a_revisit_without_its_response_is_not_intact(spark):
    made = W.write(frame(spark, PAGES))
    rows = made.read().where("headers['page-id'] IS NULL OR headers['page-id'] != '3'")
    back = {r.page_id: r for r in W.resolved(rows).collect() if r.payload_bytes == 1000}
    assert not back["1"].intact and not back["2"].intact and back["1"].refers_to is None
