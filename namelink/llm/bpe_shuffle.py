"""Byte-level BPE by a global shuffle of distinct words; decoding by the token-byte table.

Texts are cut into blocks of whole documents. A block names each distinct pre-token once
and keeps the documents as positions packed into runs of those local numbers. The distinct
pre-tokens of all blocks meet by hash, each is encoded once, and the ids go back to the
blocks, where the documents are put together again by position. Only distinct words of a
block cross the shuffle as text.
"""

import base64
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .bpe_words import parts_of
from .shared import pieces, text_rows

#: Characters of the texts in one block; a longer text is a block of its own.
BLOCK_CHARS = 8_000_000
#: Characters of corpus for one bucket of distinct words, and the least number of buckets.
BUCKET_CHARS, LEAST_BUCKETS = 32_000_000, 64
DOCS_ROW = -1

PACKED = "block string, bucket int, payload binary"
_PACKED = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("payload", pa.binary())])
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])


def pack(*arrays):
    """Little-endian u32 arrays and byte strings as one compressed byte string."""
    import zstandard

    parts = []
    for x in arrays:
        if isinstance(x, bytes):
            kind, raw = b"b", x
        else:  # byte planes: the high bytes are mostly zero and cost nothing
            kind, raw = b"u", np.asarray(x, "<u4").view("u1").reshape(-1, 4).T.tobytes()
        parts.append(kind + len(raw).to_bytes(8, "little") + raw)
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(packed):
    import zstandard

    raw, at, found = zstandard.ZstdDecompressor().decompress(packed), 0, []
    while at < len(raw):
        size = int.from_bytes(raw[at + 1:at + 9], "little")
        part = raw[at + 9:at + 9 + size]
        if raw[at:at + 1] == b"u":
            part = np.frombuffer(part, "u1").reshape(4, -1).T.copy().view("<u4").ravel()
        found.append(part)
        at += 9 + size
    return found


@lru_cache(maxsize=4)
def load_ranks(ranks_file):
    """Token bytes by rank, and the encoder of a single pre-token."""
    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return ranks, table


@lru_cache(maxsize=4)
def _encoding(ranks_file, pattern):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(ranks_file)[0], special_tokens={})


class _Words(dict):
    """Local numbers of a block's pre-tokens, by text part."""

    def __init__(self, pattern):
        import regex

        super().__init__()
        self.find, self.numbers = regex.compile(pattern).findall, {}

    def __missing__(self, part):
        numbers = self.numbers
        self[part] = found = [numbers.setdefault(w, len(numbers)) for w in self.find(part)]
        return found


def _block_rows(name, doc_ids, texts, pattern, n_buckets):
    """The packed rows of one block: its documents, and its distinct words by bucket."""
    words = _Words(pattern)
    runs = [np.fromiter(chain.from_iterable([words[p] for p in parts_of(t)]), "<u4") for t in texts]
    ids = np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    known = bytes(x is not None for x in doc_ids)
    rows = [(name, DOCS_ROW, pack(ids, known, [len(r) for r in runs], np.concatenate(runs)))]
    buckets = {}
    for word, number in words.numbers.items():
        raw = word.encode()
        numbers, raws = buckets.setdefault(zlib.crc32(raw) % n_buckets, ([], []))
        numbers.append(number)
        raws.append(raw)
    for bucket, (numbers, raws) in buckets.items():
        # Local numbers rise within a bucket: their steps are small and compress well.
        rows.append((name, bucket, pack(np.diff(numbers, prepend=0), [len(r) for r in raws], b"".join(raws))))
    return _packed(rows)


def _packed(rows):
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _PACKED)], schema=_PACKED)


def _explode(pattern, n_buckets, block_chars):
    def explode(batches):
        from pyspark import TaskContext

        part, k, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in pieces(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if held and held + len(text) > block_chars:
                    yield _block_rows(f"{part}-{k}", ids, texts, pattern, n_buckets)
                    k, ids, texts, held = k + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
        if ids:
            yield _block_rows(f"{part}-{k}", ids, texts, pattern, n_buckets)

    return explode


def _split(raw, lengths):
    ends = np.cumsum(lengths, dtype="i8").tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def _words_only(batches):
    """Drop the documents of a block; a filter would be moved below the shuffle they share."""
    import pyarrow.compute as pc

    for batch in batches:
        yield batch.filter(pc.not_equal(batch.column("bucket"), DOCS_ROW))


def _encode_bucket(ranks_file, pattern):
    """Encode each distinct word of a bucket once, and answer every block that has it."""

    def encode(table):
        encoder, known, rows = _encoding(ranks_file, pattern), {}, []
        for block, bucket, payload in zip(*(table.column(c).to_pylist() for c in ("block", "bucket", "payload"))):
            _, lengths, raw = unpack(payload)
            found = []
            for word in _split(raw, lengths):
                ids = known.get(word)
                if ids is None:
                    known[word] = ids = encoder.encode_ordinary(word.decode())
                found.append(ids)
            flat = np.fromiter(chain.from_iterable(found), "<u4")
            rows.append((block, bucket, pack([len(x) for x in found], flat)))
        return pa.Table.from_batches([_packed(rows)])

    return encode


def _assemble(table, answers):
    """The documents of one block from their positions and the ids of its words."""
    docs, numbers_of, lengths, at, ids = None, {}, [], [], []
    for bucket, payload in zip(table.column("bucket").to_pylist(), table.column("payload").to_pylist()):
        if bucket == DOCS_ROW:
            docs = unpack(payload)
        else:
            numbers_of[bucket] = np.cumsum(unpack(payload)[0], dtype="i8")
    for bucket, payload in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist()):
        n, flat = unpack(payload)
        at.append(numbers_of[bucket])
        lengths.append(n)
        ids.append(flat)
    doc_ids, known, n_words, run = docs
    size = np.zeros(sum(map(len, at)), "i8")
    starts = np.zeros(len(size), "i8")
    flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    offset = 0
    for numbers, n in zip(at, lengths):
        ends = np.cumsum(n, dtype="i8") + offset
        size[numbers], starts[numbers] = n, ends - n
        offset = int(ends[-1]) if len(ends) else offset
    out = []
    for words in np.split(run, np.cumsum(n_words, dtype="i8")[:-1]):
        n = size[words]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        out.append(flat[np.arange(total) + np.repeat(starts[words] - ends + n, n)].tobytes())
    unknown = np.frombuffer(known, "u1") == 0
    return pa.Table.from_arrays(
        [pa.array(np.frombuffer(doc_ids, "<i8"), pa.int64(), mask=unknown), pa.array(out, pa.binary())], schema=_ENCODED
    )


def encode(docs, ranks_file, pattern, block_chars=BLOCK_CHARS, bucket_chars=BUCKET_CHARS):
    """(doc_id, ids as little-endian u32 bytes) of every whole text.

    A null text counts as empty and has no ids; repeated rows come back as often as they
    are there. The number of buckets grows with the corpus, so a bucket's distinct words
    stay within a task's memory.
    """
    rows = text_rows(docs)
    chars = rows.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()[0]
    n_buckets = max(LEAST_BUCKETS, chars // bucket_chars + 1)
    packed = rows.mapInArrow(_explode(pattern, n_buckets, block_chars), PACKED).repartition("block")
    answers = packed.mapInArrow(_words_only, PACKED).groupBy("bucket").applyInArrow(
        _encode_bucket(ranks_file, pattern), PACKED
    )
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_assemble, "doc_id bigint, ids binary")


def decode(encoded, ranks_file):
    """Add ``decoded``, the bytes of ``ids`` by the token-byte table; null where ids are null."""

    def join(batches):
        table = load_ranks(ranks_file)[1]
        for batch in pieces(batches):
            found = [
                None if ids is None else b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())], schema=batch.schema.append(pa.field("decoded", pa.binary()))
            )

    return encoded.select("doc_id", "ids").mapInArrow(join, "doc_id bigint, ids binary, decoded binary")


def bpe_round_trip(docs, ranks_file, pattern):
    """Per document the number of ids, their hash and the hash of the decoded bytes."""
    return decode(encode(docs, ranks_file, pattern), ranks_file).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
