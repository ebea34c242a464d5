"""Exact dedup: a tree-merge of sorted digest runs, by DataFrame functions alone.

Every input partition is a run: one entry per distinct text with its digest, how many rows
have it and which of them stays. In each round ``FAN_IN`` neighbouring runs exchange their
entries and become one run, until a single run is left (two runs a round make the binomial
tree). The row that stays is a struct, so Spark merges entries by a sort aggregate: a round
leaves its runs sorted by digest. Entries are merged only if SHA-256, length in bytes and a
second hash of the whole text agree, at every level anew.

The answers go down the same tree: a run tells the runs it was made of, and those tell their
rows. A text that a third of all rows share is thus never joined in one place: going up or
down, a key meets at most ``FAN_IN`` entries, and at the leaves only rows of one partition.
"""

from pyspark.sql import functions as F

from .shared import staged

#: Runs that are merged into one in each round.
FAN_IN = 16
KEY = ["digest", "n_bytes", "proof"]


def _text():
    return F.coalesce(F.col("text"), F.lit(""))


def _key_columns():
    return [F.unhex(F.sha2(_text(), 256)).alias("digest"), F.octet_length(_text()).alias("n_bytes"),
            F.xxhash64(_text()).alias("proof")]


def _leaf_rows(docs):
    """One small row per document: its run, its place in the input, its id, what its text is."""
    return docs.select(
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("place"),
        F.col("doc_id").cast("long").alias("doc_id"), *_key_columns(),
    )


def _merged(entries):
    """Entries of the same run and text as one: the row that stays, and how many rows there are."""
    return entries.groupBy("run", *KEY).agg(F.max("stays").alias("stays"), F.sum("n").alias("n"))


def _parent(fan_in):
    return F.floor(F.col("run") / fan_in).cast("int")


def merge_runs(rows, fan_in=FAN_IN):
    """The entries of every level of the tree, leaves first; the last level is one run."""
    # An id beats none, a larger id a smaller one, and the earlier of two rows with one id the later.
    stays = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", (-F.col("place")).alias("before"))
    last = rows.agg(F.max("run")).first()[0] or 0
    levels = [staged(_merged(rows.select("run", *KEY, stays.alias("stays"), F.lit(1).cast("long").alias("n"))), "runs")]
    while last:
        levels.append(staged(_merged(levels[-1].withColumn("run", _parent(fan_in))), "runs"))
        last //= fan_in
    return levels


def answers(levels, fan_in=FAN_IN):
    """(run, key, stays, n) at the leaves, of texts that more than one row has."""
    found = levels[-1].filter("n > 1").select("run", *KEY, "stays", "n")
    for level in reversed(levels[:-1]):
        below = level.select("run", *KEY, _parent(fan_in).alias("parent"))
        found = below.join(found.withColumnRenamed("run", "parent"), ["parent", *KEY]).select("run", *KEY, "stays", "n")
    return found


def exact_groups(docs, fan_in=FAN_IN):
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when they are identical; null counts as empty. Of equal texts the row
    with the largest doc_id stays; rows without an id stay only where none of their group
    has one, and of several rows with that id the first in the input stays. No row gives no
    rows; other columns of ``docs`` are not read.
    """
    if fan_in < 2:
        raise ValueError("a round must merge at least two runs")
    rows = staged(_leaf_rows(docs), "digests")
    known = answers(merge_runs(rows, fan_in), fan_in)
    return rows.join(known, ["run", *KEY], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("stays.before") == -F.col("place"), F.lit(True)).alias("kept"),
        "digest",
    )


def drop_copies(docs, fan_in=FAN_IN):
    """The whole rows that stay. Of rows equal in id and text one stays, whatever else they hold."""
    kept = exact_groups(docs, fan_in).filter("kept").select("doc_id", "digest")
    doc_id, digest = F.col("doc.doc_id").cast("long"), F.unhex(F.sha2(F.coalesce("doc.text", F.lit("")), 256))
    rows = docs.select(F.struct("*").alias("doc")).select("doc", doc_id.alias("row_id"), digest.alias("row_digest"))
    same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_digest") == F.col("digest"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["row_id", "row_digest"]).select("doc.*")


def exact_dedup(docs, fan_in=FAN_IN):
    """The verdict per document, with the hash of its text."""
    return exact_groups(docs, fan_in).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
