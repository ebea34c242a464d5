"""Cross-tokenizer alignment, each distinct text once.

Texts are shuffled whole, so that equal ones become one row with a count. Each distinct text
is tokenised by both tokenizers and aligned by byte offsets in one place, word by word. Its links are kept
packed, next to the links of the other texts of its block; the block's distinct id pairs
leave as rows, weighted by how many documents hold them. The counts of all documents come
back to the blocks, where every text gets its measures, and these are joined to the
documents by the texts' digests.
"""

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import pieces, staged

#: Code points of the texts of one block, and texts tokenised in one call.
BLOCK_CHARS, CALL_TEXTS = 4_000_000, 64
#: New parts that are encoded as one text, and the most parts and characters that a worker remembers.
JOINED_PARTS, MOST_PARTS, MOST_CHARS = 500, 300_000, 4_000_000
_CUT, _CUT_BEFORE = re.compile(r"[^\s\x1c-\x1f] "), re.compile(r"(?<=[^\s\x1c-\x1f])(?= )")
_ODD = re.compile(r"[\s\x1c-\x1f] | $")
#: Share of all documents that one task may read for one text.
SPREAD = 10_000
PAIR = 1 << 32

ALIGNED = (
    "digest binary, n_docs bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "block string, pairs binary, times binary"
)
_ALIGNED = pa.schema([
    ("digest", pa.binary()), *[(x, pa.int64()) for x in ("n_docs", "n_a", "n_b", "n_groups", "n_links")],
    ("groups_sha256", pa.string()), ("block", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
])
_PAIRS = pa.schema([("block", pa.string()), ("pair", pa.int64()), ("n", pa.int64())])
_MEASURED = pa.schema([("digest", pa.binary()), ("n_docs", pa.int64()), *[
    (x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", pa.string())])
MEASURED = (
    "digest binary, n_docs bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def _byte_of_sign():
    """Bytes that a byte-level vocabulary shows as other signs: printable ones stand for themselves."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers, their tokens' bytes, and the alignment of one text."""

    def __init__(self, byte_file, piece_file):
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_file)
        self.first.encode_special_tokens = True  # their strings in a text are plain text
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        signs = _byte_of_sign()
        self.bytes_a = [b""] * self.first.get_vocab_size(with_added_tokens=True)
        for token, number in self.first.get_vocab(with_added_tokens=True).items():
            known = all(c in signs for c in token)
            self.bytes_a[number] = bytes(signs[c] for c in token) if known else token.encode()
        self.bytes_b = []
        for number in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(number)
            byte = self.second.is_byte(number)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        self.size_a = np.array([len(x) for x in self.bytes_a], "i8")
        self.size_b = np.array([len(x) for x in self.bytes_b], "i8")
        # How an id is written inside its group and at the end of its side.
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        self.written = [f"{i}{end}" for end, n in ((",", n_a), ("|", n_a), (",", n_b), (";", n_b)) for i in range(n)]

        # A space after another character starts a new token of either vocabulary.
        if any(_CUT.search(x.decode(errors="replace")) for x in (*self.bytes_a, *self.bytes_b)):
            raise ValueError("a token of one of the vocabularies spans several words")
        self.known, self.held = {}, 0

    def _ids(self, raw):
        """Token ids of both tokenizers for a text after its leading space."""
        first = self.first.encode(raw, add_special_tokens=False).ids
        # the second tokenizer adds the space itself, but not to an empty text
        second = self.second.encode(raw[1:]) if len(raw) > 1 else [self.second.piece_to_id("▁")]
        return first, second

    def _aligned(self, parts):
        """What each of some parts gives, which are encoded as one text; None if its bytes differ."""
        raw = "".join(parts)
        a, b = self._ids(raw)
        whole = raw.encode()
        if b"".join([self.bytes_a[i] for i in a]) != whole or b"".join([self.bytes_b[i] for i in b]) != whole:
            return [None] if len(parts) == 1 else [self._aligned([p])[0] for p in parts]
        a, b = np.array(a, "i8"), np.array(b, "i8")
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # Two tokens overlap in exactly one stretch between neighbouring ends of either side.
        last_a, last_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        ends = np.union1d(ends_a, ends_b)
        pairs = a[np.searchsorted(ends_a, ends)] * PAIR + b[np.searchsorted(ends_b, ends)]
        order = self._order(a, b, last_a, last_b)
        upto = np.cumsum([len(p.encode()) for p in parts])
        n_a, n_b, n_links = (np.searchsorted(e, upto, "right") for e in (ends_a, ends_b, ends))
        n_groups = np.searchsorted(ends_a[last_a], upto, "right")
        found, at, link, before = [], 0, 0, (0, 0, 0)
        for k in range(len(parts)):
            now = int(n_a[k]), int(n_b[k]), int(n_groups[k])
            written = "".join([self.written[i] for i in order[at:now[0] + now[1]]])
            # three counts of a part in one number, which add up without carrying over
            counts = sum((y - x) << (42 * i) for i, (x, y) in enumerate(zip(before, now)))
            found.append((counts, written, pairs[link:n_links[k]].tobytes()))
            at, link, before = now[0] + now[1], n_links[k], now
        return found

    def _order(self, a, b, last_a, last_b):
        """Ids in order, group by group, A before B, as places in ``written``."""
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before = np.searchsorted(group_b, group_a)  # B tokens of earlier groups
        upto = np.searchsorted(group_a, group_b, "right")  # A tokens of the same and earlier groups
        order = np.empty(len(a) + len(b), "i8")
        order[np.arange(len(a)) + before] = a + n_a * last_a
        order[np.arange(len(b)) + upto] = 2 * n_a + b + n_b * last_b
        return order.tolist()

    def align_all(self, texts):
        """(n_a, n_b, n_groups, written groups, link pairs) of each text, None if its bytes differ.

        Tokens end where words end, so a text's alignment is that of its parts, and a part
        that was met before is not encoded again.
        """
        if len(self.known) > MOST_PARTS or self.held > MOST_CHARS:
            self.known.clear()
            self.held = 0
        lists = [_parts(" " + t) if t else [] for t in texts]
        new = [p for p in dict.fromkeys(chain.from_iterable(lists)) if p not in self.known]
        self.held += sum(map(len, new))
        # parts that end in white space stand last in their texts, so they are encoded alone
        joined = [p for p in new if not p[-1].isspace()]
        for k in range(0, len(joined), JOINED_PARTS):
            group = joined[k:k + JOINED_PARTS]
            self.known.update(zip(group, self._aligned(group)))
        self.known.update((p, self._aligned([p])[0]) for p in new if p[-1].isspace())
        return [self._joined([self.known[p] for p in parts]) for parts in lists]

    @staticmethod
    def _joined(found):
        if not found or None in found:
            return None
        counts, written, pairs = zip(*found)
        total = sum(counts)
        low = (1 << 42) - 1
        return total & low, total >> 42 & low, total >> 84, "".join(written)[:-1], np.frombuffer(b"".join(pairs), "<i8")


def _parts(raw):
    """Parts of a text between which no token of a word vocabulary reaches: word by word.

    A part starts where a space follows a character that no library takes for white space.
    """
    if _ODD.search(raw):
        return _CUT_BEFORE.split(raw)
    return [" " + word for word in raw[1:].split(" ")]


@lru_cache(maxsize=2)
def aligner(byte_file, piece_file):
    return Aligner(byte_file, piece_file)


def _pack(numbers, kind):
    return np.ascontiguousarray(numbers, kind).tobytes()


def _align_texts(byte_file, piece_file, block_chars):
    """Align distinct texts; texts of one task share blocks of at most ``block_chars`` characters."""
    import hashlib

    def run(batches):
        from pyspark import TaskContext

        tools, part, k, held = aligner(byte_file, piece_file), TaskContext.get().partitionId(), 0, 0
        for batch in pieces(batches, CALL_TEXTS):
            texts = batch.column("text").to_pylist()
            columns = {f.name: [] for f in _ALIGNED if f.name not in ("digest", "n_docs")}
            for text, found in zip(texts, tools.align_all(texts)):
                if held and held + len(text) > block_chars:
                    k, held = k + 1, 0
                held += len(text)
                if found is None:
                    n_a = n_b = n_groups = n_links = 0
                    digest, pairs, times = "", b"", b""
                else:
                    n_a, n_b, n_groups, written, links = found
                    digest, n_links = hashlib.sha256(written.encode()).hexdigest(), len(links)
                    pairs, times = np.unique(links, return_counts=True)
                    pairs, times = _pack(pairs, "<i8"), _pack(times, "<u4")
                row = (n_a, n_b, n_groups, n_links, digest, f"{part}-{k}", pairs, times)
                for column, value in zip(columns.values(), row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").cast(pa.binary()), batch.column("n_docs").cast(pa.int64()),
                 *[pa.array(v, _ALIGNED.field(c).type) for c, v in columns.items()]], schema=_ALIGNED
            )

    return run


def _block_pairs(batches):
    """The distinct pairs of each block, with the documents that hold them."""
    block, pairs, weights, held = None, [], [], 0

    def rows():
        found, place = np.unique(np.concatenate(pairs), return_inverse=True)
        n = np.zeros(len(found), "i8")
        np.add.at(n, place, np.concatenate(weights))
        return pa.RecordBatch.from_arrays([pa.array([block] * len(found)), pa.array(found), pa.array(n)], schema=_PAIRS)

    for batch in pieces(batches):
        for name, n_docs, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "n_docs", "pairs"))):
            if name != block:
                if pairs:
                    yield rows()
                block, pairs, weights = name, [], []
            own = np.frombuffer(packed, "<i8")
            pairs.append(own)
            weights.append(np.full(len(own), n_docs, "i8"))
    if pairs:
        yield rows()


def _measure(texts, counts):
    """n_best and count_sum of every text of one block, from the counts of its pairs."""
    keys = counts.column("pair").combine_chunks().to_numpy(zero_copy_only=False)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    n = counts.column("n").combine_chunks().to_numpy(zero_copy_only=False)[order]
    best = counts.column("best").combine_chunks().to_numpy(zero_copy_only=False)[order]
    n_best, count_sum = [], []
    for packed, times in zip(texts.column("pairs").to_pylist(), texts.column("times").to_pylist()):
        at = np.searchsorted(keys, np.frombuffer(packed, "<i8"))
        times = np.frombuffer(times, "<u4").astype("i8")
        n_best.append(int((times * best[at]).sum()) if len(at) else 0)
        count_sum.append(int((times * n[at]).sum()) if len(at) else 0)
    found = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    return pa.Table.from_arrays([found.get(f.name, None) or texts.column(f.name) for f in _MEASURED], schema=_MEASURED)


def distinct_texts(docs):
    """Each distinct text once, with its digest and the number of documents that have it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(text.alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("n_docs")).select(
        F.unhex(F.sha2("text", 256)).alias("digest"), "n_docs", "text"
    )


def pair_counts(block_pairs):
    """(pair, n, best): documents that hold a pair linked, and whether its A id has none higher."""
    counts = block_pairs.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.floor(F.col("pair") / F.lit(PAIR)))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def align_texts(docs, byte_file, piece_file, block_chars=BLOCK_CHARS):
    """The measures of each distinct text (digest, n_docs, n_a … count_sum, groups_sha256)."""
    aligned = staged(
        distinct_texts(docs).mapInArrow(_align_texts(byte_file, piece_file, block_chars), ALIGNED), "aligned-texts"
    )
    held = staged(
        aligned.select("block", "n_docs", "pairs").mapInArrow(_block_pairs, "block string, pair bigint, n bigint"),
        "block-pairs",
    )
    counts = held.select("block", "pair").join(pair_counts(held), "pair").select("block", "pair", "n", "best")
    return aligned.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_measure, MEASURED)


def align_documents(docs, byte_file, piece_file, block_chars=BLOCK_CHARS):
    """The measures of every row of ``docs`` by its doc_id; repeated rows come back as often.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte,
    have no tokens: zeros and an empty groups_sha256. Such a text still counts as one
    document of the corpus; it holds no pairs. Other columns of ``docs`` are not read.
    """
    measured = staged(align_texts(docs, byte_file, piece_file, block_chars), "text-measures")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")
    )
    return _spread_join(rows, measured).drop("digest", "n_docs", "slot")


def _spread_join(rows, measured):
    """Join rows to their text's measures; a text with many rows meets them in several tasks.

    Texts with more than a ten-thousandth of all rows are fewer than ten thousand, so the
    list of them is small whatever the input.
    """
    total = measured.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    share = max(1000, total // SPREAD + 1)
    slots = F.ceil(F.col("n_docs") / share).cast("int")
    often = measured.filter(F.col("n_docs") > share).select("digest", slots.alias("slots"))
    slot = F.when(F.col("slots").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("slots"))).cast("int")
    dealt = rows.join(F.broadcast(often), "digest", "left").withColumn("slot", slot).drop("slots")
    copies = measured.withColumn("slot", F.explode(F.sequence(F.lit(0), slots - 1)))
    return dealt.join(copies, ["digest", "slot"])


def alignment_report(docs, byte_file, piece_file):
    return align_documents(docs, byte_file, piece_file).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
