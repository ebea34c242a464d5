"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are word windows of benchmark items. For each pattern length there is one table:
a shift for every block of words that ends somewhere inside a pattern, the patterns
bucketed by their last block, and a default shift for all other blocks. The search jumps
by shifts and compares window and text directly wherever the shift is zero.
"""



import pyarrow as pa
from pyspark.sql import functions as F

from .shared import pieces

WINDOW = 10
BLOCK_WORDS = 3
#: Benchmark text in one block of patterns, in characters; a block is held by each worker.
BLOCK_CHARS = 8_000_000

RESULT = (
    "doc_id bigint, text string, n_words bigint, n_hit bigint, "
    "hit_ranges array<bigint>, items array<string>"
)


def _word_table():
    keep = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
    upper = {c: c + 32 for c in range(0x41, 0x5B)}
    return bytes(upper.get(c, c if c in keep else 0x20) for c in range(256))


_TABLE = _word_table()


def words_of(utf8):
    """Words of a UTF-8 text: letters A-Z lower-cased, runs of digits, a-z and non-ASCII."""
    return utf8.translate(_TABLE).split()


class WuManber:
    """Shift table and suffix buckets for patterns of one length."""

    def __init__(self, length, patterns):
        self.length = length
        self.block = min(BLOCK_WORDS, length)
        self.default = length - self.block + 1
        self.shift, self.buckets = {}, {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                block = pattern[end - self.block:end]
                shift = length - end
                if shift < self.shift.get(block, self.default):
                    self.shift[block] = shift
            self.buckets.setdefault(pattern[length - self.block:], []).append((pattern, items))

    def search(self, words):
        """(start, items) of every occurrence in a tuple of words."""
        length, block, shift, default = self.length, self.block, self.shift, self.default
        end, n, found = length, len(words), []
        while end <= n:
            key = words[end - block:end]
            jump = shift.get(key, default)
            if jump:
                end += jump
                continue
            window = words[end - length:end]
            for pattern, items in self.buckets.get(key, ()):
                if pattern == window:
                    found.append((end - length, items))
            end += 1
        return found


def build_tables(items, window=WINDOW):
    """One table per pattern length of (item id, UTF-8 text) rows."""
    by_length = {}
    for item_id, text in items:
        words = tuple(words_of(text or b""))
        size = min(window, len(words))
        if not size:
            continue
        for start in range(len(words) - size + 1):
            pattern = words[start:start + size]
            ids = by_length.setdefault(size, {}).setdefault(pattern, set())
            if item_id is not None:
                ids.add(item_id)
    return [WuManber(size, patterns) for size, patterns in sorted(by_length.items())]


def merge_ranges(ranges):
    merged = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged




def _searcher(block):
    """A function over Arrow batches that adds one block's hits to each document."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
        ("hit_ranges", pa.list_(pa.int64())), ("items", pa.list_(pa.string())),
    ])

    def search(batches):
        tables = build_tables(block.value)
        for batch in pieces(batches):
            texts = batch.column("text")
            n_words, n_hit, all_ranges, all_items = [], [], [], []
            earlier = zip(batch.column("hit_ranges").to_pylist(), batch.column("items").to_pylist())
            for text, (old_ranges, old_items) in zip(texts.cast(pa.binary()).to_pylist(), earlier):
                words = tuple(words_of(text))
                ranges = list(zip(old_ranges[::2], old_ranges[1::2]))
                items = set(old_items)
                for table in tables:
                    for start, ids in table.search(words):
                        ranges.append((start, start + table.length))
                        items.update(ids)
                ranges = merge_ranges(ranges)
                n_words.append(len(words))
                n_hit.append(sum(end - start for start, end in ranges))
                all_ranges.append([x for pair in ranges for x in pair])
                all_items.append(sorted(items))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), texts, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(all_ranges, pa.list_(pa.int64())), pa.array(all_items, pa.list_(pa.string()))],
                schema=schema,
            )

    return search


def pattern_blocks(benchmark, item="item_id", text="text", block_chars=BLOCK_CHARS):
    """The benchmark's (id, UTF-8 text) rows in broadcast blocks of bounded size.

    Items are dealt to blocks by a hash, so that each holds about ``block_chars``
    characters, whatever the size of the benchmark; only one block is on the driver at a
    time.
    """
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).filter(
        F.col("text").isNotNull()
    )
    chars = rows.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()[0]
    n = chars // block_chars + 1
    for k in range(n):
        mine = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield spark.sparkContext.broadcast(
            [(r["item"], r["text"].encode()) for r in mine.collect()]
        )


def decontaminate(docs, benchmark, block_chars=BLOCK_CHARS):
    """One row per document with the words that occur in benchmark windows.

    Columns: doc_id, text, n_words, n_hit, hit_ranges (word positions, start and end in
    turn), items (sorted ids). All blocks of patterns are searched one after another in
    one narrow stage; nothing is shuffled. A null text has no words; items without text
    match nothing, items without id hit words but are not listed; an empty benchmark
    leaves every document clean.
    """
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<bigint>").alias("hit_ranges"),
        F.array().cast("array<string>").alias("items"),
    )
    for block in pattern_blocks(benchmark, block_chars=block_chars):
        found = found.mapInArrow(_searcher(block), RESULT)
    return found


def drop_contaminated(docs, benchmark, block_chars=BLOCK_CHARS):
    """Rows of ``docs`` in which no benchmark window occurs; nothing is shuffled."""

    def dropper(block):
        def drop(batches):
            tables = build_tables(block.value)
            for batch in pieces(batches):
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                clean = [not any(t.search(tuple(words_of(x or b""))) for t in tables) for x in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return drop

    for block in pattern_blocks(benchmark, block_chars=block_chars):
        docs = docs.mapInArrow(dropper(block), docs.schema)
    return docs


def contamination_report(docs, benchmark, block_chars=BLOCK_CHARS):
    """The digest per document: counts of words, hits and items, and the items' hash."""
    return decontaminate(docs, benchmark, block_chars).select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
