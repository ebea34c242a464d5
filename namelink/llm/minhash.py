"""Near-dedup by b-bit MinHash: bands of full minima propose, packed low bits estimate,
full shingle sets confirm.

Documents with equal sets are one node from the start. Nodes that share a band are first
compared with one pivot of that band, another pivot in each, which joins groups of copies
with a few links per node. What is left are nodes that share a band with another component;
they are paired by exact prefix and position filters and confirmed on full sets too, so no
link between different texts is lost to the estimate or to the choice of pivots.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .components import components
from .shared import key_filter, let_through, pieces, staged, text_rows

SHINGLE_WORDS = 4
SIMILARITY = 80
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BITS = 2
LONGS = HASHES * BITS // 64
#: Positions of 128 whose low bits may differ. At a similarity of 0.8 the mean is 19.2 and
#: the standard deviation 4.0: more than 38 come up twice in a million links.
MAX_MISMATCHES = 38
#: Partners of one pivot that a task confirms at a time; groups of copies are cut by this.
CHUNK = 256
SALTS = 32
#: Turns of linking nodes to pivots before all remaining pairs are sought.
PIVOT_TURNS = 3
#: Slots of the table that orders shingles by rarity.
RARITY_SLOTS = 1 << 20
#: Bits of the parities that bound from below how many shingles two sets do not share.
PARITY_BITS = 512

FEATURES = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, bits array<bigint>"
_FEATURES = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
    ("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())),
])


def _mix(x):
    """Spread the bits of u64 values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(utf8, size=SHINGLE_WORDS):
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = utf8.lower().split()
    if not words:
        return np.zeros(0, "u8")
    hashes = np.fromiter(map(xxh64_intdigest, words), "u8", len(words))
    n = max(1, len(words) - size + 1)
    found = np.full(n, min(size, len(words)), "u8")
    for k in range(min(size, len(words))):
        found = _mix(found + hashes[k:k + n])
    return np.unique(found)


def _permutations():
    random = np.random.default_rng(20)
    return (
        random.integers(0, 1 << 32, HASHES, dtype="u4") | np.uint32(1),
        random.integers(0, 1 << 32, HASHES, dtype="u4"),
    )


_TIMES, _PLUS = (x[:, None] for x in _permutations())


def minima(hashes):
    """The least value of each permutation over a set of hashes."""
    least = np.full(HASHES, 0xFFFFFFFF, "u4")
    for at in range(0, len(hashes), 2048):
        x = (hashes[at:at + 2048] >> np.uint64(32)).astype("u4")
        np.minimum(least, (_TIMES * x + _PLUS).min(axis=1), out=least)
    return least


def band_keys(least):
    """A 64-bit key per band of a matrix of minima (documents x permutations)."""
    rows = least.reshape(len(least), BANDS, ROWS).astype("u8")
    keys = np.broadcast_to(np.arange(BANDS, dtype="u8"), rows.shape[:2])
    for k in range(ROWS):
        keys = _mix(keys + rows[:, :, k] * np.uint64(0xD6E8FEB86659FD93))
    return keys.view("i8")


def low_bits(least):
    """The low bits of mixed minima, packed into longs."""
    mixed = _mix(least.astype("u8")) & np.uint64((1 << BITS) - 1)
    per_long = 64 // BITS
    shifts = (np.arange(per_long, dtype="u8") * np.uint64(BITS))
    packed = (mixed.reshape(len(least), LONGS, per_long) << shifts).sum(axis=2, dtype="u8")
    return packed.view("i8")


def _features(batches):
    from xxhash import xxh128_digest

    for batch in pieces(batches):
        sizes, keys, least = [], [], np.zeros((len(batch), HASHES), "u4")
        for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            hashes = shingle_set(text)
            sizes.append(len(hashes))
            keys.append(xxh128_digest(hashes.tobytes()))
            least[row] = minima(hashes)

        def lists(matrix):
            offsets = np.arange(len(matrix) + 1, dtype="i4") * matrix.shape[1]
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))

        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             lists(band_keys(least)), lists(low_bits(least))], schema=_FEATURES,
        )


def _sets(batches):
    for batch in pieces(batches):
        sets = [shingle_set(t).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["node", "shingles"])


def _may_match(a, b):
    """Sizes within the ratio and low bits that agree often enough, as a column."""
    small, large = F.least(a["n"], b["n"]), F.greatest(a["n"], b["n"])
    return (100 * small >= SIMILARITY * large) & (_mismatches(a, b) <= MAX_MISMATCHES)


def _mismatches(a, b):
    total = F.lit(0)
    for k in range(LONGS):
        x = a["bits"][k].bitwiseXOR(b["bits"][k])
        odd = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        total = total + F.bit_count(odd)
    return total


def estimated_similarity(mismatches):
    """Similarity from differing positions, corrected for low bits that agree by chance."""
    chance = 2.0 ** -BITS
    return (1 - mismatches / F.lit(float(HASHES)) - chance) / (1 - chance)


def _confirm(batches):
    """Compare partners with the pivot that stands before them; rows come sorted."""
    current, pivots = None, []
    for batch in batches:
        found = []
        columns = (batch.column(c).to_pylist() for c in ("a", "chunk", "b", "shingles"))
        for a, chunk, b, shingles in zip(*columns):
            hashes = np.frombuffer(shingles, "u8")
            if (a, chunk) != current:
                current, pivots = (a, chunk), []
            if b is None:
                pivots.append(hashes)
                continue
            for pivot in pivots:
                both = len(np.intersect1d(pivot, hashes, assume_unique=True))
                if both and 100 * both >= SIMILARITY * (len(pivot) + len(hashes) - both):
                    found.append((a, b))
                    break
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"]
        )


def confirmed(pairs, sets):
    """Pairs (a, b) whose full sets are similar enough.

    The set of a pivot ``a`` goes once to each chunk of its partners, so neither a pivot
    with many partners nor its partners' sets meet in one task.
    """
    group = Window.partitionBy("a")
    cut = pairs.withColumn("chunk", F.pmod(
        F.xxhash64("b"), F.ceil(F.count(F.lit(1)).over(group) / CHUNK)
    ).cast("int"))
    cut = staged(cut, "pairs")
    partners = cut.join(sets.withColumnRenamed("node", "b"), "b").select("a", "chunk", "b", "shingles")
    pivots = cut.select("a", "chunk").distinct().join(sets.withColumnRenamed("node", "a"), "a").select(
        "a", "chunk", F.lit(None).cast("bigint").alias("b"), "shingles"
    )
    rows = partners.unionByName(pivots).repartition("a", "chunk").sortWithinPartitions(
        "a", "chunk", F.asc_nulls_first("b")
    )
    return rows.mapInArrow(_confirm, "a bigint, b bigint").distinct()


def _shared_bands(nodes):
    """(key, node, n, bits) of nodes that share a band with another node."""
    group = Window.partitionBy("key")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = (
        keyed.withColumn("least", F.min("node").over(group)).withColumn("most", F.max("node").over(group))
        .filter("least != most").select("key", "node")
    )
    return shared.join(nodes.select("node", F.struct("n", "bits").alias("s")), "node")


def _star_pairs(shared, found, turn):
    """Each node with the most alike of its bands' pivots in other components."""
    placed = shared.join(found, "node", "left").withColumn("c", F.coalesce("component", "node"))
    pivots = placed.groupBy("key").agg(
        F.min_by(F.struct("node", "s", "c"), F.xxhash64("key", "node", F.lit(turn))).alias("pivot")
    )
    met = placed.join(pivots, "key").filter(
        (F.col("c") != F.col("pivot.c")) & _may_match(F.col("s"), F.col("pivot.s"))
    )
    far = _mismatches(F.col("s"), F.col("pivot.s"))
    return met.groupBy("node").agg(F.min(F.struct(far.alias("far"), F.col("pivot.node").alias("pivot"))).alias("best")).select(
        F.col("best.pivot").alias("a"), F.col("node").alias("b")
    )


def _star_links(shared, sets):
    """Links to pivots, in a few turns with other pivots each, and their components."""
    spark = shared.sparkSession
    links = spark.createDataFrame([], "a bigint, b bigint")
    found = spark.createDataFrame([], "node bigint, component bigint")
    for turn in range(PIVOT_TURNS):
        links = links.unionByName(staged(confirmed(_star_pairs(shared, found, turn), sets), "links"))
        found = components(links)
    return links, found


def _open_nodes(shared, found):
    """(node, c) of nodes that share a band with a node of another component."""
    placed = shared.join(found.select("node", "component"), "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("c")
    )
    split = placed.groupBy("key").agg(F.min("c").alias("least"), F.max("c").alias("most")).filter("least != most")
    return placed.join(split.select("key"), "key", "left_semi").select("node", "c").distinct()


def _slot_counts(batches):
    counts = np.zeros(RARITY_SLOTS, "i8")
    for batch in batches:
        for shingles in batch.column("shingles").to_pylist():
            np.add.at(counts, (np.frombuffer(shingles, "u8") % np.uint64(RARITY_SLOTS)).astype("i8"), 1)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], ["slot", "n"])


def rarity(sets):
    """How often shingles of each hash slot occur: a bounded table, whatever the corpus."""
    rows = sets.mapInArrow(_slot_counts, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(RARITY_SLOTS, "i8")
    counts[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return sets.sparkSession.sparkContext.broadcast(counts)


def parities(hashes):
    """One bit per slot: whether an odd number of the hashes fall into it.

    Every element that two sets do not share flips one bit, so sets differ in at least as
    many elements as their parities differ in bits.
    """
    slots = ((hashes >> np.uint64(20)) % np.uint64(PARITY_BITS)).astype("i8")
    odd = (np.bincount(slots, minlength=PARITY_BITS) & 1).astype("u1")
    return np.packbits(odd, bitorder="little").view("<i8")


def _prefixes(counts):
    def cut(batches):
        table = counts.value
        for batch in batches:
            nodes, components_, tokens, positions, sizes, odd = [], [], [], [], [], []
            for node, c, shingles in zip(*(batch.column(x).to_pylist() for x in ("node", "c", "shingles"))):
                hashes = np.frombuffer(shingles, "u8")
                n = len(hashes)
                order = np.lexsort((hashes, table[(hashes % np.uint64(RARITY_SLOTS)).astype("i8")]))
                kept = n - -(-SIMILARITY * n // 100) + 1
                tokens.append(hashes[order[:kept]].view("i8"))
                positions.append(np.arange(kept))
                nodes.append(np.full(kept, node))
                components_.append(np.full(kept, c))
                sizes.append(np.full(kept, n))
                odd.append(np.broadcast_to(parities(hashes), (kept, PARITY_BITS // 64)))
            columns = [np.concatenate(x) if x else np.zeros(0, "i8") for x in (tokens, nodes, components_, sizes, positions)]
            offsets = np.arange(len(columns[0]) + 1, dtype="i4") * (PARITY_BITS // 64)
            flat = np.concatenate(odd).ravel() if odd else np.zeros(0, "i8")
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x.astype("i8"), pa.int64()) for x in columns),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["token", "node", "c", "n", "pos", "odd"]
            )

    return cut


def _open_pairs(open_nodes, sets):
    """Pairs of different components that may still be similar enough, by exact filters.

    Shingles are ordered by rarity. Two sets that are similar enough share one of their
    rarest fifth, from the first that they share on enough shingles are left in both, and
    their parities differ in no more bits than the sets may differ in elements. Sets that
    differ a little too much fail there without being paired, which keeps groups of almost
    similar texts from giving all their pairs.
    """
    rows = sets.join(open_nodes, "node").select("node", "c", "shingles").mapInArrow(
        _prefixes(rarity(sets)), "token bigint, node bigint, c bigint, n bigint, pos bigint, odd array<bigint>"
    )
    a, b = rows.alias("a"), rows.alias("b")
    left = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    total = F.col("a.n") + F.col("b.n")
    fits = (left * (100 + SIMILARITY) >= SIMILARITY * total) & (
        100 * F.least("a.n", "b.n") >= SIMILARITY * F.greatest("a.n", "b.n")
    )
    differ = sum((F.bit_count(F.col("a.odd")[k].bitwiseXOR(F.col("b.odd")[k])) for k in range(PARITY_BITS // 64)), F.lit(0))
    fits = fits & ((100 + SIMILARITY) * differ <= (100 - SIMILARITY) * total)
    return a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.c") < F.col("b.c")) & fits).select(
        F.col("a.node").alias("a"), F.col("b.node").alias("b")
    ).distinct()


def near_dedup(docs):
    """(doc_id, n_shingles, component_id, kept) for every row.

    Rows of one doc_id are one document. Rows without id, and rows without words, are
    linked with nothing and kept; the component of a row without id is null.
    """
    rows = text_rows(docs)
    features = staged(rows.mapInArrow(_features, FEATURES), "minhash")
    linked = features.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    groups = linked.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = linked.join(groups.select("set_key", F.col("node").alias("doc_id")), ["set_key", "doc_id"], "left_semi").select(
        F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "bands", "bits"
    )
    shared = staged(_shared_bands(nodes), "shared-bands")
    wanted = shared.select("node").distinct()
    near_rows = let_through(rows, "doc_id", key_filter(wanted, "node"))
    sets = staged(
        near_rows.join(wanted.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi").mapInArrow(
            _sets, "node bigint, shingles binary"
        ), "shingle-sets",
    )
    links, stars = _star_links(shared, sets)
    open_nodes = staged(_open_nodes(shared, stars), "open-nodes")
    more = confirmed(_open_pairs(open_nodes, sets), sets)
    found = components(links.unionByName(more))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    placed = groups.join(found, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component_id"),
        F.explode(F.when(F.col("copies") > 1, F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))
                  .otherwise(F.array(F.pmod(F.xxhash64("node"), F.lit(SALTS))))).alias("salt"),
    )
    return (
        features.select("doc_id", "n_shingles", "set_key", salt.alias("salt"))
        .join(placed, ["set_key", "salt"], "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component_id", "doc_id"))
            .otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
