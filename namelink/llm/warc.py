"""WARC archives of web pages, each record compressed on its own with a shared dictionary.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds a Zstandard
dictionary built from the archive's own records; every record is a Zstandard frame that
needs it. A page whose payload another archived page has too becomes a revisit record,
which keeps the headers and names the page that has the payload.
"""

import base64
import hashlib
import io
import random
import struct
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from .shared import filesystem, new_folder, staged

DICTIONARY_MAGIC = 0x184D2A5D
#: Bytes of records an archive's dictionary is built from, and its size.
SAMPLE_BYTES, DICTIONARY_BYTES = 4 << 20, 64 << 10
#: An archive is closed at this many uncompressed bytes.
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
SALTS = 32
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RESULT = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
)
_RESULT = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
])


def record_uri(page_id):
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(uri):
    number = uri.strip("<>").rsplit(":", 1)[1]
    return int(number) if number else None


def digest_of(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value):
    return "".join(c for c in value if c not in "\r\n")


def build_record(page_id, url, payload, refers_to=None):
    """One record: a response with its payload, or a revisit that refers to another page."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_uri(page_id)),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", _clean(url))] if url is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + digest_of(payload)),
        *([("WARC-Refers-To", record_uri(refers_to)), ("WARC-Profile", PROFILE)] if revisit else []),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw):
    """(WARC headers, HTTP headers, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


class ArchiveWriter:
    """Builds the dictionary from its first records, then compresses each on its own."""

    def __init__(self, out, level=LEVEL):
        self.out, self.level, self.held, self.size, self.packer = out, level, [], 0, None

    def add(self, record):
        self.size += len(record)
        if self.packer is None:
            self.held.append(record)
            if self.size >= SAMPLE_BYTES:
                self._start()
        else:
            self.out.write(self.packer.compress(record))

    def _dictionary(self):
        import zstandard

        pieces = [r[at:at + 16384] for r in self.held for at in range(0, len(r), 16384)]
        random.Random(4).shuffle(pieces)
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, pieces)
        except zstandard.ZstdError:  # too few records to train on: their bytes are the dictionary
            return zstandard.ZstdCompressionDict(b"".join(pieces)[-DICTIONARY_BYTES:] or b"WARC/1.1")

    def _start(self):
        import zstandard

        dictionary = self._dictionary()
        raw = dictionary.as_bytes()
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        self.packer = zstandard.ZstdCompressor(level=self.level, dict_data=dictionary, write_checksum=True)
        for record in self.held:
            self.out.write(self.packer.compress(record))
        self.held = []

    def close(self):
        if self.packer is None:
            self._start()
        self.out.close()


def read_archive(source, chunk=1 << 16):
    """Records of an archive, one at a time; ``source`` is read forward in pieces."""
    import zstandard

    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no leading dictionary frame")
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(source.read(size)))
    frame, record, left = unpacker.decompressobj(), io.BytesIO(), b""
    while piece := left or source.read(chunk):
        record.write(frame.decompress(piece))
        left = b""
        if frame.eof:
            yield record.getvalue()
            left = frame.unused_data
            frame, record = unpacker.decompressobj(), io.BytesIO()
    if record.tell():
        raise ValueError("the archive ends inside a record")


def _writer(folder, level):
    def write(batches):
        writer, paths = None, []
        for batch in batches:
            for page_id, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                if writer is not None and writer.size >= ARCHIVE_BYTES:
                    writer.close()
                    writer = None
                if writer is None:
                    fs, base = filesystem(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"pages-{uuid.uuid4().hex}.warc.zst"
                    paths.append(f"{folder}/{name}")
                    writer = ArchiveWriter(fs.open_output_stream(f"{base}/{name}", compression=None), level)
                writer.add(build_record(page_id, url, html.encode(), refers))
        if writer is not None:
            writer.close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], ["path"])

    return write


def mark_revisits(pages, least_bytes=0):
    """page_id, url, html and ``refers_to``: the page of equal payload to refer to, or null.

    Of pages with equal payloads of at least ``least_bytes`` bytes the smallest page_id is
    the response; rows that repeat that id are responses too, and so are rows without id
    if no row of theirs has one. A payload that many pages share is spread over salts.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    keyed = rows.withColumn("key", F.unhex(F.sha2("html", 256))).withColumn("long", F.octet_length("html") >= least_bytes)
    firsts = keyed.filter("long").groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    spread = firsts.select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return salted.join(spread, ["key", "salt"], "left").select(
        "page_id", "url", "html",
        F.when(F.col("long") & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def write_archives(pages, folder, least_bytes=0, level=LEVEL):
    """Write a record for every page and return the table of the archives written.

    Every task attempt writes archives of its own names and only those of committed tasks
    are in the table, so lost executors leave no half-written archive in use.
    """
    rows = mark_revisits(pages, least_bytes)
    return staged(rows.mapInArrow(_writer(folder, level), "path string"), "archives")


def _read(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, name = filesystem(path)
            rows = []
            with fs.open_input_file(name) as source:
                for raw in read_archive(source):
                    headers, http, payload = parse_record(raw)
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = headers["WARC-Type"] == "revisit"
                    if not revisit and digest_of(payload) != digest:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
                    rows.append((
                        page_of(headers["WARC-Record-ID"]), int(http["Content-Length"]), digest, headers["WARC-Type"],
                        page_of(headers["WARC-Refers-To"]) if revisit else None, headers.get("WARC-Target-URI"),
                    ))
                    if len(rows) == 5000:
                        yield _batch(rows)
                        rows = []
            yield _batch(rows)


def _batch(rows):
    columns = zip(*rows) if rows else [()] * len(_RESULT)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _RESULT)], schema=_RESULT)


def read_archives(archives):
    """One row per record, read from the files; payloads are checked against their digests."""
    return archives.repartition(max(1, archives.count())).mapInArrow(_read, RESULT)


def warc_round_trip(pages):
    folder = new_folder(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, folder)).drop("url")
