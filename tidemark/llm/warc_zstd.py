"""WARC archives compressed with Zstandard: a writer and a reader.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, plain or itself a Zstandard frame. Each record is one frame after
it. The reader loads the dictionary, decodes frame by frame from a stream, so
that it holds one record at a time, and validates each: version line, header
fields, lengths and digests.

``write`` deals the rows over tasks; a task writes files of a bounded size under
names that no other attempt uses, and returns what it wrote. The list of these
files is a table that Spark commits, so files of lost or repeated attempts are
never read. Equal payloads are stored once: later copies are revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_value, col, freed, least_hashed, settled, shared_dir, stored, whole

by_value(__name__)

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
PLAIN_TYPES = ("response", "revisit", "resource", "request", "metadata", "warcinfo", "conversion", "continuation")

#: Bytes that the reader takes from a stream at a time.
CHUNK = 1 << 20
RECORD = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("error", T.StringType()),
])


class Damaged(ValueError):
    """What is wrong with a frame or a record."""


# -- one record


def digest32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def bare_digest(label: str) -> str:
    """A labelled SHA-1 in base 32 or 16 as lower-case hex."""
    kind, _, value = label.partition(":")
    if kind.lower() != "sha1":
        raise Damaged(f"digest of another kind: {kind}")
    try:
        raw = bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())
    except ValueError:
        raise Damaged("digest is no SHA-1") from None
    if len(raw) != 20:
        raise Damaged("digest is no SHA-1")
    return raw.hex()


def field(value: str) -> str:
    """A header's value: control characters and blanks at the ends, which no address has, as %XX."""
    return re.sub(r"[\x00-\x1f\x7f]|^ +| +$", lambda m: "".join(f"%{ord(c):02X}" for c in m[0]), value)


def record(
    kind: str, record_id: str, url: str | None, page: str | None, payload: bytes, refers: str | None
) -> bytes:
    """A response or revisit record; a revisit has the headers of the payload without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {field(url)}")
    if page is not None:
        lines.append(f"Page-ID: {field(page)}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {refers}"]
    lines += [
        f"WARC-Payload-Digest: {digest32(payload)}",
        f"WARC-Block-Digest: {digest32(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    """Fields by lower-case name; a repeated field's values are joined by line feeds, folded lines by blanks."""
    out: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t"):
            if last is None:
                raise Damaged("first header line is folded")
            out[last] += " " + line.strip(" \t")
            continue
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise Damaged("header line without a name")
        last = name.lower()
        value = value.strip(" \t")
        out[last] = f"{out[last]}\n{value}" if last in out else value
    return out


def length_of(headers: dict[str, str]) -> int:
    value = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]+", value):
        raise Damaged("Content-Length is no number")
    return int(value)


def parsed(data: bytes) -> dict:
    """The record in a frame's bytes, or ``Damaged``."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    first, _, lines = head.partition(b"\r\n")
    if not blank or not re.fullmatch(rb"WARC/1\.[01]", first):
        raise Damaged("no WARC version line")
    headers = headers_of(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise Damaged(f"no {name}")
    kind = headers["warc-type"]
    if kind not in PLAIN_TYPES:
        raise Damaged(f"type {kind!r}")
    size = length_of(headers)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise Damaged(f"Content-Length {size}, but {max(len(rest) - 4, 0)} bytes")
    block = rest[:size]
    if "warc-block-digest" in headers and bare_digest(headers["warc-block-digest"]) != hashlib.sha1(block).hexdigest():
        raise Damaged("block digest differs")
    payload, length = block, size
    if headers.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        http, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            raise Damaged("no end of the HTTP headers")
        own = headers_of(http.partition(b"\r\n")[2]) if b"\r\n" in http else {}
        length = length_of(own) if "content-length" in own else len(payload)
        if kind != "revisit" and length != len(payload):
            raise Damaged(f"HTTP Content-Length {length}, but {len(payload)} bytes")
    if kind == "revisit":
        if "warc-refers-to" not in headers or "warc-payload-digest" not in headers:
            raise Damaged("revisit without reference or digest")
        if payload:
            raise Damaged("revisit with a payload")
        digest = bare_digest(headers["warc-payload-digest"])
    else:
        digest = hashlib.sha1(payload).hexdigest()
        if "warc-payload-digest" in headers and bare_digest(headers["warc-payload-digest"]) != digest:
            raise Damaged("payload digest differs")
    return {
        "record_type": kind,
        "record_id": headers["warc-record-id"],
        "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"),
        "headers": list(headers.items()),
        "payload": None if kind == "revisit" else payload,
        "payload_bytes": length,
        "payload_digest": digest,
    }


# -- one archive


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading skippable frame, with the dictionary compressed."""
    body = zstandard.ZstdCompressor(level=19).compress(dictionary) if dictionary else b""
    return struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body


class Frames:
    """The frames of a stream, one at a time."""

    def __init__(self, stream):
        self.stream, self.held, self.offset = stream, b"", 0
        self.dictionary = self._leading()

    def _more(self) -> bool:
        chunk = self.stream.read(CHUNK)
        self.held += chunk
        return bool(chunk)

    def _upto(self, n: int) -> bool:
        while len(self.held) < n:
            if not self._more():
                return False
        return True

    def _skip(self) -> bytes:
        """The content of the skippable frame that comes next."""
        size = struct.unpack("<I", self.held[4:8])[0]
        if not self._upto(8 + size):
            raise Damaged("skippable frame is cut off")
        body, self.held = self.held[8 : 8 + size], self.held[8 + size :]
        self.offset += 8 + size
        return body

    def _leading(self) -> zstandard.ZstdCompressionDict | None:
        if not self._upto(8) or struct.unpack("<I", self.held[:4])[0] != DICTIONARY_MAGIC:
            return None
        body = self._skip()
        if body.startswith(FRAME_MAGIC):
            try:
                body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
            except zstandard.ZstdError:
                raise Damaged("dictionary cannot be decoded") from None
        return zstandard.ZstdCompressionDict(body) if body else None

    def __iter__(self) -> Iterator[tuple[int, int, bytes | None, str | None]]:
        """Offset, compressed length, bytes, and what is wrong: after a frame that cannot be decoded nothing follows."""
        decoder = zstandard.ZstdDecompressor(dict_data=self.dictionary) if self.dictionary else zstandard.ZstdDecompressor()
        while self._upto(1):
            start = self.offset
            if self._upto(8) and self.held[1:4] == b"\x2a\x4d\x18" and self.held[0] & 0xF0 == 0x50:
                try:
                    self._skip()
                except Damaged as e:
                    yield start, len(self.held), None, str(e)
                    return
                continue
            frame, parts, took = decoder.decompressobj(), [], 0
            try:
                while not frame.eof:
                    if not self.held and not self._more():
                        raise Damaged("frame is cut off")
                    parts.append(frame.decompress(self.held))
                    took += len(self.held) - len(frame.unused_data)
                    self.held = frame.unused_data
            except (zstandard.ZstdError, Damaged) as e:
                why = str(e) if isinstance(e, Damaged) else "frame cannot be decoded"
                yield start, took + len(self.held), None, why
                return
            self.offset += took
            yield start, took, b"".join(parts), None


def records(stream, archive: str) -> Iterator[dict]:
    """Every record of an archive; one that is not valid has nulls and ``error``."""
    empty = dict.fromkeys(RECORD.names)
    try:
        frames = Frames(stream)
    except Damaged as e:
        yield empty | {"archive": archive, "offset": 0, "error": str(e)}
        return
    for offset, length, data, error in frames:
        row = empty | {"archive": archive, "offset": offset, "length": length, "error": error}
        if data is not None:
            try:
                row |= parsed(data)
            except Damaged as e:
                row["error"] = str(e)
        yield row


# -- tables


def train_dictionary(pages: DataFrame, id_col: str, text_col: str, *, sample: int = 400, size: int = 32_768) -> bytes:
    """A dictionary from the first 16 kB of ``sample`` pages with the least hashes; empty if they are too few.

    Its content matters for the size of the archives alone.
    """
    texts = pages.select(
        col(id_col).cast("string").alias("id"), F.substring(F.encode(whole(col(text_col)), "UTF-8"), 1, 16_384).alias("text")
    )
    drawn = [bytes(r.text) for r in least_hashed(texts, sample, "id", seed=12).select("text").collect()]
    drawn = [t for t in drawn if len(t) >= 8]
    if len(drawn) < 16 or sum(map(len, drawn)) < 10 * size:
        return b""
    try:
        return zstandard.train_dictionary(size, drawn).as_bytes()
    except zstandard.ZstdError:
        return b""


@dataclass(frozen=True)
class Archives:
    """Archives that were written: their folder, and the table of their files (path, records, bytes)."""

    folder: str
    files: DataFrame

    def read(self) -> DataFrame:
        return read(self.files.select("path"))


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def copies(rows: DataFrame, least_bytes: int) -> DataFrame:
    """(row, first, first_page): rows whose payload another one holds, and that one.

    Of equal payloads of at least ``least_bytes`` bytes the largest identifier
    holds it; a null one is the least, and of rows that repeat the identifier
    that with the largest number. Payloads are equal if SHA-256, SHA-1 and
    length are.
    """
    key = ["sha256", "sha1", "payload_bytes"]
    long = rows.where(F.col("payload_bytes") >= least_bytes).select("row", "page_id", *key)
    holders = long.groupBy(*key).agg(F.max(F.struct("page_id", "row")).alias("holder"), F.count(F.lit(1)).alias("n"))
    holders = holders.where("n > 1").select(*key, "holder")
    return long.join(holders, key).where("row != holder.row").select("row", F.col("holder.row").alias("first"))


def write(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    *,
    folder: str | None = None,
    least_bytes: int = 1000,
    archive_bytes: int = 256 << 20,
    level: int = 3,
    dictionary: bytes | None = None,
) -> Archives:
    """One record per row of ``pages``, its payload the text in UTF-8; null as empty.

    Of rows with equal payloads of at least ``least_bytes`` bytes, that with
    the largest identifier (see ``copies``) is a response and the others
    revisit it; all else are responses. A record carries the identifier as
    text (no field where it is null), and no address where that is null.
    Repeated rows are records of their own. An empty table gives no archive.
    Other columns are not read. ``folder`` is one that all executors share;
    by default a new one under the session's checkpoint folder. A file ends
    with the record that reaches ``archive_bytes`` (compressed).
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    if dictionary is None:
        dictionary = train_dictionary(pages, id_col, text_col)
    payload = F.encode(whole(col(text_col)), "UTF-8")
    rows = pages.select(
        col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).select(
        F.monotonically_increasing_id().alias("row"),
        "*",
        F.unhex(F.sha2("payload", 256)).alias("sha256"),
        F.unhex(F.sha1("payload")).alias("sha1"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )
    rows = stored(rows, "warc-pages", "zstd")  # numbers that stay the same, and digests reckoned once
    revisits = copies(rows, least_bytes)
    # Rows move by their own number, so no payload is a hot key.
    chosen = rows.join(revisits, "row", "left").select(
        "row", F.col("page_id").cast("string").alias("page"), "url", "payload", "first"
    )
    run_id = uuid.uuid4().hex

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _filesystem(folder)
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=True)
        system.create_dir(base, recursive=True)
        out, name, count, size, done = None, "", 0, 0, []
        named = lambda row: f"<urn:uuid:{uuid.uuid5(uuid.UUID(run_id), str(row))}>"
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    row, page, url, data, first = (c[i].as_py() for c in batch.columns)
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.zst"
                        out = system.open_output_stream(f"{base}/{name}", compression=None)  # frames are made here
                        head = dictionary_frame(dictionary)
                        out.write(head)
                        count, size = 0, len(head)
                    kind = "response" if first is None else "revisit"
                    refers = None if first is None else named(first)
                    frame = packer.compress(record(kind, named(row), url, page, data, refers))
                    out.write(frame)
                    count, size = count + 1, size + len(frame)
                    if size >= archive_bytes:
                        out.close()
                        out = None
                        done.append((f"{folder}/{name}", count, size))
        finally:
            if out is not None:
                out.close()
                done.append((f"{folder}/{name}", count, size))
        names = ["path", "records", "bytes"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names
        )

    files = chosen.mapInArrow(put, "path string, records bigint, bytes bigint")
    return Archives(folder, stored(files, "warc-files"))


def read(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """The records of every archive named in ``paths``, a row each (see ``RECORD``).

    An archive is read by one task, a record at a time. A record that breaks a
    rule has nulls and says what is wrong in ``error``; where a frame cannot be
    decoded, it is the archive's last row. A path that is null gives no rows;
    one that cannot be opened gives a row with ``error``. Repeated paths are
    read repeatedly.
    """
    batch_rows, batch_bytes = 200, 4 << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([
            pa.field(f.name, pa.map_(pa.string(), pa.string()) if f.name == "headers" else
                     {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()])
            for f in RECORD
        ])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                if path is None:
                    continue
                rows, held = [], 0
                for row in _opened(path):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= batch_rows or held >= batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, shape)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, shape)

    names = settled(paths.select(col(path_col).cast("string").alias("path")))
    # A task per file, up to a number that a cluster can run; small files too are worth a task.
    return names.repartition(max(1, min(names.count(), 10_000))).mapInArrow(run, RECORD)


def _opened(path: str) -> Iterator[dict]:
    try:
        system, name = _filesystem(path)
        stream = system.open_input_stream(name, compression=None)
    except (OSError, ValueError, pa.ArrowException) as e:
        yield dict.fromkeys(RECORD.names) | {"archive": path, "offset": 0, "error": f"cannot be opened: {type(e).__name__}"}
        return
    with stream:
        yield from records(stream, path)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the archives in a folder and those below it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true")
    return files.load(folder).select("path")


def resolved(rows: DataFrame) -> DataFrame:
    """Records with the page each belongs to, and for revisits the page whose payload they repeat.

    page_id (text), payload_bytes, payload_digest, record_type, refers_to
    (page_id of the response, as text), and ``intact``: the record is valid
    and a revisit's response is there with the digest and length it states.
    """
    narrow = settled(rows.select(
        "record_id", "record_type", "payload_bytes", "payload_digest", "error",
        F.col("headers")["page-id"].alias("page_id"), F.col("refers_to").alias("target"),
    ))
    responses = narrow.where("record_type = 'response'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("of"),
        F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("sum"),
    )
    wanted = narrow.where("record_type = 'revisit'").select("target").distinct()
    found = narrow.join(responses.join(wanted, "target", "left_semi"), "target", "left")
    same = (F.col("n") == F.col("payload_bytes")) & (F.col("sum") == F.col("payload_digest"))
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("of").alias("refers_to"),
        (F.isnull("error") & (F.isnull("target") | F.coalesce(same, F.lit(False)))).alias("intact"),
    )
