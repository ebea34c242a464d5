"""Line dedup: equal lines by hash, lines a few edits apart by a segment-partition join.

All of it is DataFrame functions. A line is cut into threshold + 1 segments. If another is
within the threshold, some segment i of the line occurs in it unchanged, with at most i edits
before and at most threshold - i after it: this limits how far the segment may be shifted. A
line indexes its own segments under its length, and probes those of lines as long or up to
threshold letters shorter. Where many lines share a segment, what lies beside it is cut again
and again before lines are paired, and lines already found near an earlier one are not asked again.
Pairs are confirmed by Spark's ``levenshtein`` with a threshold, which fills only the band
of the matrix around the diagonal.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import key_filter, let_through, staged

MIN_CHARS = 30
MAX_EDITS = 1
#: Lines of one segment, still to be found near another, above which the rest of the line is cut again.
HOT_LINES = 64
POSITIONS = 1 << 31

LINE_BREAK = "\n"


def _doc_key():
    """A sortable key: the id, or for rows without one a key after all ids by their text."""
    unknown = F.xxhash64("text").cast("decimal(38,0)") + F.lit(str(2**64)).cast("decimal(38,0)")
    return F.coalesce(F.col("doc_id").cast("decimal(38,0)"), unknown.cast("decimal(38,0)"))


def _lines(docs, min_chars):
    """(doc_key, pos, line) of every line of at least ``min_chars`` characters."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return (
        rows.select(_doc_key().alias("doc_key"), F.posexplode(F.split("text", LINE_BREAK, -1)).alias("pos", "line"))
        .filter(F.length("line") >= min_chars)
    )


def _line_hash(line="line"):
    return F.unhex(F.md5(F.col(line) if isinstance(line, str) else line))


def _shifts(edits, piece, more):
    """Shifts at which a piece of a text cut into ``edits`` + 1 may occur in one ``more`` letters longer."""
    return [x for x in range(-piece, piece + 1) if abs(more - x) <= edits - piece]


def _cut(size, edits, piece):
    """(start, length) of a piece of a text of ``size`` letters cut into ``edits`` + 1."""
    start = F.floor(size * piece / (edits + 1)).cast("int")
    return start, F.floor(size * (piece + 1) / (edits + 1)).cast("int") - start


def _segment_keys(line, min_chars, max_edits):
    """Keys of the segments of a line: (key, probe, side, less, shift, length of the indexed line)."""
    size = F.length(line)

    def keys(less):
        length = size - less
        for side in range(max_edits + 1):
            start, n = _cut(length, max_edits, side)
            for shift in _shifts(max_edits, side, less):
                part = F.substring(line, start + 1 + shift, n)
                yield F.struct(
                    F.xxhash64(length, F.lit(side), part).alias("key"), F.lit(bool(less or shift)).alias("probe"),
                    F.lit(side).alias("side"), F.lit(less).alias("less"), F.lit(shift).alias("shift"),
                    length.alias("length"),
                )

    own = F.array(*keys(0))
    shorter = [F.when(size >= min_chars + less, F.array(*keys(less))).otherwise(F.slice(own, 1, 0))
               for less in range(1, max_edits + 1)]
    return F.concat(own, *shorter)


def _open(*regions):
    """Regions that can be cut: a region has a length ``n`` in the indexed line, starts at ``at``
    in the own line, is ``more`` letters longer there, and holds at most ``budget`` edits."""
    found = F.array(*[F.struct(n.alias("n"), at.alias("at"), more.alias("more"), budget.alias("budget"))
                      for n, at, more, budget in regions])
    return F.filter(found, lambda r: r["n"] > r["budget"])


def _beside_segment(max_edits):
    """The open regions before and after a segment: at most ``side`` edits before it, the others after."""
    side, length, shift = F.col("side"), F.col("length"), F.col("shift")
    start, n = _cut(length, max_edits, side)
    return _open((start, F.lit(0), shift, side),
                 (length - start - n, start + n + shift, F.col("less") - shift, max_edits - side))


def _finer(rows, max_edits):
    """Rows (h, line, key, probe, regions) under finer keys: the longest open region cut like a line."""
    longest = F.array_max(F.transform("regions", lambda r, i: F.struct(r["n"].alias("n"), (-i).alias("i"))))
    chosen = rows.withColumn("i", -longest["i"]).withColumn("r", F.get("regions", F.col("i"))).withColumn(
        "others", F.filter("regions", lambda r, i: i != F.col("i")))
    n, at, more = F.col("r.n"), F.col("r.at"), F.col("r.more")

    def keys(budget):
        for piece in range(budget + 1):
            start, size = _cut(n, budget, piece)
            for x in range(-piece, piece + 1):
                part = F.substring("line", at + start + 1 + x, size)
                beside = _open((start, at, F.lit(x), F.lit(piece)),
                               (n - start - size, at + start + size + x, more - x, F.lit(budget - piece)))
                yield F.when(F.abs(more - x) <= budget - piece, F.struct(
                    F.xxhash64("key", F.lit(piece), part).alias("key"), (F.col("probe") | F.lit(x != 0)).alias("probe"),
                    F.concat("others", beside).alias("regions")))

    found = F.coalesce(*[F.when(F.col("r.budget") == budget, F.array_compact(F.array(*keys(budget))))
                         for budget in range(1, max_edits + 1)])
    return chosen.select("h", F.explode(found).alias("s")).select("h", "s.*")


def _maybe_near(lines, min_chars, max_edits):
    """Distinct lines that may share a segment with another: (h, line, first)."""
    segments = F.explode(_segment_keys(F.col("line"), min_chars, max_edits)["key"]).alias("key")
    shared = lines.select(F.xxhash64("line").alias("x"), segments).groupBy("key").agg(
        F.min("x").alias("least"), F.max("x").alias("most")
    ).filter("least != most")
    near = let_through(lines.select("*", segments), "key", key_filter(shared, "key"))
    return near.groupBy("line").agg(F.min(F.struct("doc_key", "pos")).alias("first")).withColumn("h", _line_hash())


def _pairs(rows, key):
    """(a, b) of lines that meet on a key, at least one of them indexed there."""
    left = rows.filter(~F.col("probe")).select(F.col(key).alias("k"), F.col("h").alias("a"))
    right = rows.select(F.col(key).alias("k"), F.col("h").alias("b"), "probe")
    met = left.join(right, "k").filter((F.col("a") != F.col("b")) & (F.col("probe") | (F.col("a") < F.col("b"))))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _among_many(rows, lines, max_edits):
    """Lines near an earlier one where many share a segment: hashes found, and pairs (a, b) to be compared.

    Round by round every line is compared with the earliest line indexed under its key. Of
    those found near it nothing more is asked, but they may show others to be near. Where at
    most HOT_LINES lines are left to be found, these are paired with all lines of the key; the
    other lines get finer keys, until no region of a line can be cut any more.
    """
    lines = staged(lines.join(rows.select("h").distinct(), "h", "left_semi").select("h", "line", "first"), "hot-lines")
    found, pairs = lines.select("h").limit(0), lines.select(F.col("h").alias("a"), F.col("h").alias("b")).limit(0)
    group, order = Window.partitionBy("key"), F.struct("first", "h")
    while True:
        head = F.min(F.when(~F.col("probe"), F.struct(order.alias("order"), "line"))).over(group)
        met = staged(
            rows.join(lines, "h").withColumn("n", F.count(F.lit(1)).over(group))
            .withColumn("least", F.min("h").over(group)).withColumn("most", F.max("h").over(group))
            .withColumn("head", head).filter(F.col("head").isNotNull() & (F.col("least") != F.col("most")))
            .withColumn("near", (F.col("head.order") < order) & (F.levenshtein("head.line", "line", max_edits) >= 0))
            .select("h", "first", "key", "probe", "regions", "n", "near"),
            "hot-segments",
        )
        if met.isEmpty():
            return found, pairs
        found = staged(found.unionByName(met.filter("near").select("h")).distinct(), "hot-found")
        asked = staged(
            met.drop("near").join(found.withColumn("done", F.lit(True)), "h", "left")
            .withColumn("asked", F.count(F.when(F.col("done").isNull(), 1)).over(group)).filter("asked > 0"),
            "hot-asked",
        )
        last = (F.col("n") <= HOT_LINES) | (F.col("asked") <= HOT_LINES) | (F.size("regions") == 0)
        few = asked.filter(~last).agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0] <= HOT_LINES * lines.count()
        last = last | F.lit(few)
        left = asked.filter(last & F.col("done").isNull()).select(
            "key", F.col("h").alias("a"), F.col("first").alias("a_first"), F.col("probe").alias("a_probe"))
        right = asked.filter(last).select(
            "key", F.col("h").alias("b"), F.col("first").alias("b_first"), F.col("probe").alias("b_probe"))
        later = F.struct("a_first", "a") > F.struct("b_first", "b")
        met_pairs = left.join(right, "key").filter(later & ~(F.col("a_probe") & F.col("b_probe")))
        pairs = pairs.unionByName(met_pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        rows = _finer(asked.filter(~last).join(lines.select("h", "line"), "h"), max_edits)


def near_lines(docs, min_chars=MIN_CHARS, max_edits=MAX_EDITS):
    """Hashes ``h`` of distinct lines at most ``max_edits`` away from a line that occurs earlier."""
    if max_edits < 1 or min_chars < (max_edits + 1) ** 2:
        raise ValueError("lines are too short for so many edits: a piece of a segment would be empty")
    lines = staged(_maybe_near(_lines(docs, min_chars), min_chars, max_edits), "near-lines")
    keyed = lines.select("h", F.explode(_segment_keys(F.col("line"), min_chars, max_edits)).alias("s")).select("h", "s.*")
    group = Window.partitionBy("key")
    met = staged(
        keyed.withColumn("n", F.count(F.lit(1)).over(group)).withColumn("least", F.min("h").over(group))
        .withColumn("most", F.max("h").over(group)).filter("least != most").drop("least", "most"),
        "near-line-segments",
    )
    hot = met.filter(F.col("n") > HOT_LINES).select("h", "key", "probe", _beside_segment(max_edits).alias("regions"))
    found, hot_pairs = _among_many(hot, lines, max_edits)
    pairs = _pairs(met.filter(F.col("n") <= HOT_LINES), "key").unionByName(hot_pairs).distinct()

    def side(name):
        return lines.select(F.col("h").alias(name), F.col("line").alias(f"{name}_line"), F.col("first").alias(f"{name}_first"))

    near = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        F.levenshtein("a_line", "b_line", max_edits) >= 0
    )
    later = F.struct("a_first", "a") > F.struct("b_first", "b")
    return near.select(F.when(later, F.col("a")).otherwise(F.col("b")).alias("h")).unionByName(found).distinct()


def dedup_lines(docs, min_chars=MIN_CHARS, max_edits=MAX_EDITS, min_equal=None):
    """Keep the first occurrence of every line and drop lines a few edits from an earlier line.

    Lines of at least ``min_chars`` characters are compared within ``max_edits``; equal lines
    are dropped from ``min_equal`` characters on (``min_chars`` if not given, never more),
    shorter ones always stay. Occurrences are ordered by doc_id and position; rows without id
    come last, rows that repeat an id and a text keep the same lines. A line is dropped if a
    distinct line within ``max_edits`` occurs first before it, whether or not that one is
    dropped itself.

    Returns one row per row of ``docs``: ``doc``, the whole row as a struct with the
    remaining text, and n_lines, n_dropped_equal and n_dropped_near. A null text stays
    null and has no lines; a text all of whose lines are dropped becomes empty.
    """
    min_equal = min_chars if min_equal is None else min(min_equal, min_chars)
    dropped = staged(near_lines(docs, min_chars, max_edits), "dropped-lines").withColumn("near", F.lit(True))
    order = F.col("doc_key") * F.lit(POSITIONS).cast("decimal(12,0)") + F.col("pos")
    firsts = _lines(docs, min_equal).select(_line_hash().alias("h"), order.cast("decimal(38,0)").alias("o")).groupBy("h").agg(
        F.min("o").alias("o")
    )
    pos = F.pmod(F.col("o"), F.lit(POSITIONS).cast("decimal(38,0)"))
    marks = (
        firsts.join(dropped, "h", "left")
        .select(
            ((F.col("o") - pos) / F.lit(POSITIONS)).cast("decimal(38,0)").alias("doc_key"),
            F.struct(pos.cast("int").alias("pos"), F.xxhash64("h").alias("x"),
                     F.when(F.col("near"), "n").otherwise("k").alias("state")).alias("mark"),
        )
        .groupBy("doc_key").agg(F.collect_list("mark").alias("marks"))
    )
    whole = docs.select(F.struct("*").alias("doc"))
    keyed = whole.select(
        "doc", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").alias("text")
    ).select("doc", "text", _doc_key().alias("doc_key"))
    joined = keyed.join(marks, "doc_key", "left").withColumn("lines", F.split("text", LINE_BREAK, -1))
    marked = joined.withColumn("own", F.sort_array(F.filter(
        F.coalesce("marks", F.array().cast("array<struct<pos:int,x:bigint,state:string>>")),
        lambda m: F.xxhash64(_line_hash(F.get("lines", m["pos"]))) == m["x"],
    )))
    # One letter per line: k keep, n near an earlier line, x not the first of its kind.
    gap = F.transform("own", lambda m, i: F.concat(
        F.repeat(F.lit("x"), m["pos"] - F.coalesce(F.get("own", i - 1)["pos"], F.lit(-1)) - 1), m["state"]
    ))
    last = F.coalesce(F.get("own", F.size("own") - 1)["pos"], F.lit(-1))
    letters = F.concat(F.array_join(gap, ""), F.repeat(F.lit("x"), F.size("lines") - last - 1))
    lettered = marked.withColumn("letters", F.split(letters, ""))

    def count(letter):
        return F.size(F.filter("lines", lambda x, i: (F.length(x) >= min_equal) & (F.get("letters", i) == letter)))

    kept = F.filter("lines", lambda x, i: (F.length(x) < min_equal) | (F.get("letters", i) == "k"))
    has_text = F.col("text").isNotNull()
    return lettered.select(
        F.col("doc").withField("text", F.when(has_text, F.array_join(kept, LINE_BREAK))).alias("doc"),
        F.when(has_text, F.size("lines")).otherwise(0).cast("long").alias("n_lines"),
        F.when(has_text, count("x")).otherwise(0).cast("long").alias("n_dropped_equal"),
        F.when(has_text, count("n")).otherwise(0).cast("long").alias("n_dropped_near"),
    )


def line_dedup_report(docs, min_chars=MIN_CHARS, max_edits=MAX_EDITS, min_equal=None):
    """The digest per document: counts of lines and the hash of the remaining text."""
    return dedup_lines(docs, min_chars, max_edits, min_equal).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped_equal", "n_dropped_near",
        F.sha2(F.coalesce("doc.text", F.lit("")), 256).alias("text_sha256"),
    )
