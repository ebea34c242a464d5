"""Token-ID files: independent Zstandard frames with a trailing seek table.

A file holds, one after another:

* frames, each a Zstandard frame of its own over some documents: the number of documents
  (u32), for each its id (i64), whether it has one (u8) and its number of ids (u32), then
  all ids (u32), everything little-endian;
* a skippable frame (magic 0x184D2A50) with a row for each frame: its first document's id
  and whether it has one, and how many documents and ids of the file stand before it;
* the seek table of the public Zstandard seekable format: a skippable frame with the
  compressed size, the decompressed size and a checksum (low 32 bits of XXH64 of the
  content) for each frame, and the footer.

Any Zstandard decoder reads the whole file; a reader that wants some documents finds their
frames in the two tables and decompresses only those.
"""

import os
import struct
import uuid
import zlib
from array import array
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .bpe_words import PartCache, parts_of
from .shared import filesystem, new_folder, pieces, staged, text_rows

INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
FRAME_BYTES = 1 << 18
ENTRY, INDEX, DOC = struct.Struct("<III"), struct.Struct("<qBQQ"), np.dtype([("id", "<i8"), ("has", "u1"), ("n", "<u4")])
END_ID = 0
#: Documents whose new parts are encoded in one call.
ENCODE_DOCS = 64
#: New parts that are encoded as one string, and the sign of a space in the vocabulary.
JOINED_PARTS, SPACE = 200, "\u0120"

MANIFEST = "path string, first_id bigint, n_docs bigint, n_tokens bigint"


def checksum(content):
    import xxhash

    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes documents (id or None, ids as little-endian u32 bytes) in the order given."""

    def __init__(self, out, level=3, frame_bytes=FRAME_BYTES):
        import zstandard

        self.out, self.frame_bytes = out, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level)
        self.docs, self.parts, self.held = [], [], 0
        self.entries, self.index = [], []
        self.n_docs = self.n_tokens = 0
        self.first_id = None

    def add(self, doc_id, ids):
        if self.held and self.held + len(ids) > self.frame_bytes:
            self._flush()
        self.docs.append((doc_id or 0, doc_id is not None, len(ids) // 4))
        self.parts.append(ids)
        self.held += len(ids)

    def _flush(self):
        table = np.array(self.docs, dtype=DOC)
        content = b"".join([struct.pack("<I", len(table)), table.tobytes(), *self.parts])
        packed = self.packer.compress(content)
        self.out.write(packed)
        if not self.entries:
            self.first_id = self.docs[0][0] if self.docs[0][1] else None
        self.entries.append(ENTRY.pack(len(packed), len(content), checksum(content)))
        self.index.append(INDEX.pack(self.docs[0][0], self.docs[0][1], self.n_docs, self.n_tokens))
        self.n_docs += len(table)
        self.n_tokens += int(table["n"].sum(dtype="u8"))
        self.docs, self.parts, self.held = [], [], 0

    def close(self):
        if self.docs:
            self._flush()
        index = b"".join(self.index)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        seek = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(seek)) + seek)
        self.out.close()


class TokenFile:
    """Random access to one file; ``source`` is a seekable binary file."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        size = source.seek(0, 2)
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != FOOTER_MAGIC or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums")
        seek_bytes, index_bytes = n * ENTRY.size + 17, n * INDEX.size + 8
        source.seek(size - seek_bytes - index_bytes)
        raw = source.read(seek_bytes + index_bytes)
        self.index = list(INDEX.iter_unpack(raw[8:index_bytes]))
        self.entries = list(ENTRY.iter_unpack(raw[index_bytes + 8:-9]))
        self.offsets = np.cumsum([0, *(e[0] for e in self.entries)]).tolist()

    def __len__(self):
        return len(self.entries)

    def frame(self, k):
        """(document table, all ids as bytes) of one frame, its checksum verified."""
        packed_size, size, expected = self.entries[k]
        self.source.seek(self.offsets[k])
        content = self.unpacker.decompress(self.source.read(packed_size), max_output_size=size)
        if checksum(content) != expected:
            raise ValueError(f"frame {k} does not match its checksum")
        n = struct.unpack_from("<I", content)[0]
        return np.frombuffer(content, DOC, n, 4), memoryview(content)[4 + n * DOC.itemsize:]

    def read(self, doc_id):
        """Ids of every document with this id, decompressing only the frames that may hold it."""
        key = (doc_id is not None, doc_id or 0)
        keys = [(bool(has), first) for first, has, _, _ in self.index]
        found = []
        for k in range(max(0, bisect_left(keys, key) - 1), len(keys)):
            if keys[k] > key:
                break
            table, ids = self.frame(k)
            ends = np.cumsum(table["n"], dtype="i8") * 4
            for row in np.flatnonzero((table["id"] == key[1]) & (table["has"] == key[0])):
                found.append(np.frombuffer(ids[ends[row] - 4 * int(table["n"][row]):ends[row]], "<u4"))
        return found


@lru_cache(maxsize=4)
def _encoder(tokenizer_file):
    """A function from texts to their ids as bytes; text parts are remembered across tasks.

    A text that holds the string of a special token is encoded as a whole, since the library
    cuts texts there before it looks for words.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
    tokenizer = Tokenizer.from_file(tokenizer_file)
    special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    starts = np.zeros(tokenizer.get_vocab_size(), bool)
    starts[[i for token, i in tokenizer.get_vocab().items() if token.startswith(SPACE)]] = True

    def each(parts):
        return [array("I", x.ids).tobytes() for x in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def encode(parts):
        # Parts with no space but a leading one can stand in one string: only the first
        # token of each starts with a space, which tells where to cut the ids again.
        single = [p for p in parts if p.rfind(" ") == 0 and len(p) > 1]
        found = dict(zip(others := [p for p in parts if p.rfind(" ") != 0 or len(p) == 1], each(others)))
        for at in range(0, len(single), JOINED_PARTS):
            own = single[at:at + JOINED_PARTS]
            ids = np.array(tokenizer.encode_batch_fast(["".join(own)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(starts[ids])
            if len(cuts) != len(own):
                found.update(zip(own, each(own)))
                continue
            raw, ends = ids.tobytes(), (4 * np.append(cuts, len(ids))).tolist()
            found.update(zip(own, [raw[a:b] for a, b in zip(ends, ends[1:])]))
        return [found[p] for p in parts]

    cache = PartCache(encode)

    def encode_texts(texts):
        whole = [k for k, text in enumerate(texts) if any(x in text for x in special)]
        found = cache.of_all([parts_of("" if k in whole else text) for k, text in enumerate(texts)])
        for k, ids in zip(whole, each([texts[k] for k in whole])):
            found[k] = ids
        return found

    return encode_texts


def _writer(folder, tokenizer_file, end_id, level, frame_bytes):
    end = struct.pack("<I", end_id)

    def write(batches):
        encode_texts, writer, path = _encoder(tokenizer_file), None, None
        for batch in pieces(batches):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for at in range(0, len(texts), ENCODE_DOCS):
                encoded = encode_texts(texts[at:at + ENCODE_DOCS])
                if writer is None:
                    fs, base = filesystem(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"tokens-{uuid.uuid4().hex}.zst"
                    path = f"{folder}/{name}"
                    writer = TokenFileWriter(fs.open_output_stream(f"{base}/{name}", compression=None), level, frame_bytes)
                for doc_id, own in zip(ids[at:at + ENCODE_DOCS], encoded):
                    writer.add(doc_id, own + end)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "first_id": writer.first_id, "n_docs": writer.n_docs, "n_tokens": writer.n_tokens}],
                pa.schema([("path", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )

    return write


def write_token_files(docs, folder, tokenizer_file, end_id=END_ID, level=3, frame_bytes=FRAME_BYTES):
    """Encode every whole text and write the ids in ascending doc_id order; the manifest.

    Documents are dealt to tasks by ranges of doc_id and sorted in each, so files follow
    one another without overlap. Every task attempt writes a file of its own name, and
    only files of committed tasks are in the manifest, so a lost executor or a repeated
    task leaves no half-written file in use. Null ids come first; rows of equal id are
    ordered by text.
    """
    ordered = text_rows(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_writer(folder, tokenizer_file, end_id, level, frame_bytes), MANIFEST)
    return staged(rows, "token-manifest")


def _reader(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
            fs, name = filesystem(path)
            with fs.open_input_file(name) as source:
                file = TokenFile(source)
                for k in range(len(file)):
                    table, ids = file.frame(k)
                    ends = np.cumsum(table["n"], dtype="i8")
                    starts = ends - table["n"]
                    sums = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(table["id"], pa.int64(), mask=table["has"] == 0),
                        pa.array(starts + base + file.index[k][3], pa.int64()),
                        pa.array(table["n"].astype("i8"), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ], schema=schema)


def read_token_files(manifest):
    """One row per document read back from the files: start, n_tokens, ids_crc32.

    The window sums one row per file, never one per document.
    """
    before = Window.orderBy(F.asc_nulls_first("first_id")).rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return files.repartition(max(1, manifest.count())).mapInArrow(
        _reader, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_file_round_trip(docs, tokenizer_file):
    """Write token files for all documents and read them back."""
    folder = new_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer_file))
