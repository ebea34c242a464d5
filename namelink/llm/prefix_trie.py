"""Conversation prefix trie by burst tries.

A conversation is the sequence of its turns' ids (digest of role and text, and the number
of code points). Equal conversations are one sequence with a count. At first one container
under the root holds every sequence. A container with too many turns bursts: its head
becomes a node of the trie above, and its sequences move one turn down, into containers by
their next turn id; this moves no rows between tasks. Containers that are small enough are
dealt out by head, sorted, and swept in one pass each into nodes. What the heads above
need is added up from the containers' totals.

The least size that bursts grows with the input, so that at most ``MOST_HEADS`` heads burst
in a round: their list is small whatever the input.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from .shared import new_folder, pieces, staged

#: Turns in a container beyond which it bursts, and the most containers that may burst a round.
BURST_TURNS, MOST_HEADS = 2_000, 10_000
#: Bytes of a turn id: 16 of its digest, 8 of its number of code points.
UNIT = 24
#: Conversations a base conversation lends its first turns to, and the most turns it lends.
FAMILY, MOST_SHARED = 100, 5
#: Ids of one range of this size are joined to one text before their hash is taken.
ID_RANGE = 4096

SEQUENCE = "path binary, head binary, n bigint, first_id bigint, ends string"
NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, head binary"
)
_NODE = pa.schema([
    *[(x, pa.int64()) for x in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends_sha256", pa.string()), ("head", pa.binary()),
])
NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversation_units(conversations):
    """(conv_id, units): the turn ids of each conversation in order.

    Turns are ordered by number, those without one first; turns of one number by digest.
    Rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    unit = F.unhex(F.concat(digest, F.lpad(F.hex(F.length(text)), 16, "0")))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), unit.alias("unit")).alias("t")
    ).filter(F.col("conv_id").isNotNull())
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.col("t.unit").alias("units")
    )


def rebuilt_paths(units):
    """(conv_id, path): first turns of the base conversation, then the conversation's own."""
    base_id = F.col("conv_id") - F.col("conv_id") % FAMILY
    lent = units.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("units", 1, MOST_SHARED).alias("lent")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    none = F.array().cast("array<binary>")
    turns = F.concat(
        F.slice(F.coalesce("lent", none), F.lit(1), F.col("h")),
        F.slice("units", F.col("h") + 1, F.greatest(F.size("units"), F.lit(1))),
    )
    return units.withColumn("base_id", base_id).withColumn("h", h).join(lent, "base_id", "left").select(
        "conv_id", F.unhex(F.array_join(F.transform(turns, F.hex), "")).alias("path")
    )


def _stream_hash(batches):
    """SHA-256 per sequence of its id texts, which come sorted; only the state is held."""
    seq, state, done = None, None, []
    for batch in batches:
        for key, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist()):
            if key != seq:
                if seq is not None:
                    done.append((seq, state.hexdigest()))
                seq, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _hashes(done)
        done = []
    yield _hashes([] if seq is None else [(seq, state.hexdigest())])


def _hashes(done):
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["seq", "ends"]
    )


def distinct_sequences(paths):
    """One row per distinct path: how many conversations have it, the least id, the hash of all ids.

    Ids are joined range by range first, so one task reads an id text per range and not a
    row per conversation, however many conversations are equal.
    """
    rows = paths.select("conv_id", "path", F.unhex(F.md5("path")).alias("seq"))
    ranges = rows.groupBy("seq", F.floor(F.col("conv_id") / ID_RANGE).alias("range")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    ends = ranges.repartition("seq").sortWithinPartitions("seq", "range").select("seq", "ids").mapInArrow(
        _stream_hash, "seq binary, ends string"
    )
    counted = rows.groupBy("seq", "path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first_id"))
    return counted.join(ends, "seq").select("path", F.lit(b"").alias("head"), "n", "first_id", "ends")


def _turns():
    """Turns of a sequence below its head, and one for the sequence itself."""
    return ((F.length("path") - F.length("head")) / UNIT).cast("long") + 1


def _with_head(paths, heads):
    return paths.join(F.broadcast(heads), "head", "left")


def burst(sequences, burst_turns=BURST_TURNS, most_heads=MOST_HEADS):
    """Sequences under the heads of containers that need not burst, and those that end at a head above.

    Returns (settled, ended): both have the columns of ``sequences``; ``head`` is the path
    of the head. A container of one sequence never bursts.
    """
    spark = sequences.sparkSession
    total = sequences.agg(F.coalesce(F.sum(_turns()), F.lit(0))).first()[0]
    limit = max(burst_turns, total // most_heads)
    folders = {name: new_folder(spark, f"trie-{name}") for name in ("settled", "ended")}
    for folder in folders.values():
        sequences.limit(0).write.parquet(folder)
    live = sequences
    while True:
        heads = staged(
            live.groupBy("head").agg(F.sum(_turns()).alias("turns"), F.count(F.lit(1)).alias("n_sequences"))
            .filter((F.col("turns") > limit) & (F.col("n_sequences") > 1)).select("head", F.lit(True).alias("bursts")),
            "trie-heads",
        )
        placed = _with_head(live, heads)
        columns = sequences.columns
        placed.filter("bursts is null").select(columns).write.mode("append").parquet(folders["settled"])
        if heads.isEmpty():
            return tuple(spark.read.schema(sequences.schema).parquet(folders[x]) for x in ("settled", "ended"))
        inside = placed.filter("bursts").select(columns)
        ends_here = F.length("path") == F.length("head")
        inside.filter(ends_here).write.mode("append").parquet(folders["ended"])
        deeper = F.substring("path", F.lit(1), F.length("head") + UNIT)
        live = staged(inside.filter(~ends_here).withColumn("head", deeper).select(columns), "trie-live")


class _Container:
    """The nodes of one container, built from its sequences in order of their paths."""

    def __init__(self, head):
        self.head, self.open, self.last = head, [], head
        self.columns = {c: [] for c in ("conv", "depth", "up", "n", "children", "leaves", "saved", "chars", "ends")}
        self._push(len(head) // UNIT, int.from_bytes(head[-8:], "big") if head else 0)

    def _push(self, depth, chars):
        c = self.columns
        number, up = len(c["conv"]), self.open[-1] if self.open else None
        for name, value in (("conv", None), ("depth", depth), ("up", up), ("n", 0), ("children", 0), ("leaves", 0),
                            ("saved", 0), ("chars", chars), ("ends", NO_ENDS)):
            c[name].append(value)
        self.open.append(number)

    def _pop(self):
        c, k = self.columns, self.open.pop()
        c["leaves"][k] += not c["children"][k]
        c["saved"][k] += (c["n"][k] - 1) * c["chars"][k]
        up = c["up"][k]
        if up is not None:
            c["n"][up] += c["n"][k]
            c["children"][up] += 1
            c["leaves"][up] += c["leaves"][k]
            c["saved"][up] += c["saved"][k]
            if c["conv"][up] is None or c["conv"][k] < c["conv"][up]:
                c["conv"][up] = c["conv"][k]

    def add(self, path, n, first_id, ends):
        at, both = len(self.head), min(len(path), len(self.last))
        while at < both and path[at:at + UNIT] == self.last[at:at + UNIT]:
            at += UNIT
        while len(self.open) > (at - len(self.head)) // UNIT + 1:
            self._pop()
        for end in range(at + UNIT, len(path) + 1, UNIT):
            self._push(end // UNIT, int.from_bytes(path[end - 8:end], "big"))
        c, k = self.columns, self.open[-1]
        c["n"][k] += n
        c["ends"][k] = ends
        c["conv"][k] = first_id if c["conv"][k] is None else min(first_id, c["conv"][k])
        self.last = path

    def batch(self):
        while self.open:
            self._pop()
        c = self.columns
        parents = [None if up is None else c["conv"][up] for up in c["up"]]
        heads = [self.head, *[None] * (len(parents) - 1)]
        values = (c["conv"], c["depth"], parents, c["n"], c["children"], c["leaves"], c["saved"], c["ends"], heads)
        return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(values, _NODE)], schema=_NODE)


def _sweep(batches):
    """Nodes of containers, whose sequences come sorted by head and path."""
    container = None
    for batch in pieces(batches):
        rows = zip(*(batch.column(c).to_pylist() for c in ("path", "head", "n", "first_id", "ends")))
        for path, head, n, first_id, ends in rows:
            if container is None or container.head != head:
                if container is not None:
                    yield container.batch()
                container = _Container(head)
            container.add(path, n, first_id, ends)
    if container is not None:
        yield container.batch()


def _above(head, with_self):
    """The heads above a head, the root included."""
    depth = (F.length(head) / UNIT).cast("int")
    last = depth if with_self else depth - 1
    steps = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.explode(F.transform(steps, lambda d: F.substring(head, F.lit(1), d * UNIT)))


def _head_nodes(tops, ended):
    """The burst heads as nodes, from the totals of the containers below and what ends at them."""
    zero = F.lit(0).cast("long")
    below = tops.select(
        _above(F.col("head"), False).alias("burst"), "conv_id", "n_convs", "n_leaves", "saved_tokens",
        F.lit(None).cast("string").alias("ends"),
    )
    here = ended.select(
        _above(F.col("head"), True).alias("burst"), F.col("first_id").alias("conv_id"), F.col("n").alias("n_convs"),
        zero.alias("n_leaves"), zero.alias("saved_tokens"), "ends", "head",
    ).withColumn("ends", F.when(F.col("head") == F.col("burst"), F.col("ends"))).drop("head")
    parts = below.unionByName(here)
    chars = F.conv(F.hex(F.substring("burst", -8, 8)), 16, 10).cast("long")
    counted = staged(
        parts.groupBy("burst").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("below"), F.coalesce(F.max("ends"), F.lit(NO_ENDS)).alias("ends_sha256"),
        ).withColumn("own", F.when(F.length("burst") > 0, (F.col("n_convs") - 1) * chars).otherwise(0)),
        "trie-burst",
    )
    above = counted.select(_above(F.col("burst"), True).alias("burst"), "own").groupBy("burst").agg(F.sum("own").alias("own_below"))
    child = F.substring("head", F.lit(1), F.length("head") - UNIT)
    children = tops.select("head").unionByName(counted.select(F.col("burst").alias("head"))).filter(
        F.length("head") > 0
    ).groupBy(child.alias("burst")).agg(F.count(F.lit(1)).alias("n_children"))
    return counted.join(above, "burst").join(children, "burst").select(
        "conv_id", (F.length("burst") / UNIT).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", (F.col("below") + F.col("own_below")).alias("saved_tokens"), "ends_sha256",
        F.col("burst").alias("head"),
    )


def trie_nodes(paths, burst_turns=BURST_TURNS, most_heads=MOST_HEADS):
    """The nodes of the trie over (conv_id, path); ids must be distinct. See :func:`prefix_trie`."""
    settled, ended = burst(staged(distinct_sequences(staged(paths, "trie-paths")), "trie-sequences"), burst_turns, most_heads)
    swept = staged(
        settled.repartition("head").sortWithinPartitions("head", "path").mapInArrow(_sweep, NODE), "trie-nodes"
    )
    heads = staged(_head_nodes(swept.filter("head is not null"), ended), "trie-head-nodes")
    # Nodes at a head know their parent's path only; it burst, and few heads burst.
    parents = heads.select(F.col("head").alias("up"), F.col("conv_id").alias("up_id"))
    up = F.when(F.length("head") > 0, F.substring("head", F.lit(1), F.length("head") - UNIT))
    at_head = swept.filter("head is not null").unionByName(heads).withColumn("up", up).join(F.broadcast(parents), "up", "left")
    columns = [f.name for f in swept.schema if f.name != "head"]
    return swept.filter("head is null").select(columns).unionByName(
        at_head.withColumn("parent_conv_id", F.col("up_id")).select(columns)
    )


def prefix_trie(conversations, burst_turns=BURST_TURNS, most_heads=MOST_HEADS):
    """The nodes of the trie over all rebuilt conversations.

    A node is a distinct sequence of first turns (role and text; null counts as empty),
    from the root, which has none. conv_id is its smallest member, parent_conv_id its
    parent's. Rows without conv_id are left out; repeated rows are turns of their own;
    other columns are not read; an empty table has no nodes, not even a root. A
    conversation's turn ids (24 bytes each) must fit in the memory of a task.
    """
    return trie_nodes(rebuilt_paths(conversation_units(conversations)), burst_turns, most_heads)
