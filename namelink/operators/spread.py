"""Joins to a table of keys that knows how many rows each key has."""

from pyspark.sql import functions as F

#: A task reads about this share of all rows at most, however many of them have one key.
SPREAD = 10_000
LEAST_SHARE = 1_000
#: Pairs of a key that one task makes at least, before the key is dealt out.
LEAST_PAIRS = 1_000_000
#: Line and column of the grid that the pairs of one key are dealt to.
CELL = ("_slot_line", "_slot_column")


def spread_join(rows, per_key, keys, count, total, spread_by, how="inner"):
    """Join ``rows`` to ``per_key``, one row per key with the number of its rows in ``count``.

    Keys with more than a share of the rows are dealt to several tasks by ``spread_by``, and
    their row of ``per_key`` to each of them. ``total``, a number or a scalar column, is at
    least the sum of the counts, so fewer than ``SPREAD`` keys are dealt out and the list
    that is broadcast is short. A key that ``per_key`` lacks is taken for a rare one: with
    ``how="left"`` it may hold only the common keys.
    """
    share = F.greatest(F.lit(LEAST_SHARE), F.floor(F.lit(total) / F.lit(SPREAD)) + 1)
    counted = per_key.withColumn("_slots", F.ceil(F.col(count) / share).cast("int"))
    often = counted.filter("_slots > 1").select(*keys, "_slots")
    dealt = F.pmod(F.xxhash64(spread_by), F.col("_slots")).cast("int")
    placed = rows.join(F.broadcast(often), keys, "left").withColumn("_slot", F.coalesce(dealt, F.lit(0)))
    copies = counted.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)))
    return placed.drop("_slots").join(copies.drop("_slots"), [*keys, "_slot"], how).drop("_slot")


def dealt_pairs(left, right, keys, least=LEAST_PAIRS):
    """Both sides of :func:`spread_pairs` with the cells (``CELL``) that their rows go to."""
    def counts(rows, name):
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    pairs = F.col("_left") * F.col("_right")
    per_key = counts(left, "_left").join(counts(right, "_right"), keys).withColumn("_pairs", pairs)
    total = per_key.agg(F.coalesce(F.sum(F.col("_pairs").cast("double")), F.lit(0.0))).scalar()
    tasks = F.ceil(F.col("_pairs") / F.col("_share"))
    # as many times more lines than columns as left than right rows: the fewest copies
    lines = F.least(tasks, F.greatest(F.lit(1), F.ceil(F.sqrt(tasks * F.col("_left") / F.col("_right")))))
    often = per_key.withColumn("_share", F.greatest(F.lit(float(least)), total / SPREAD)).filter(
        F.col("_pairs") > F.col("_share")
    ).select(*keys, lines.cast("int").alias("_lines"), F.ceil(tasks / lines).cast("int").alias("_columns"))

    def placed(rows, own, of, other, across):
        size, width = F.coalesce(F.col(of), F.lit(1)), F.coalesce(F.col(across), F.lit(1))
        return rows.join(F.broadcast(often), keys, "left").withColumn(
            own, F.pmod(F.xxhash64(*rows.columns), size).cast("int")
        ).withColumn(other, F.explode(F.sequence(F.lit(0), width - 1))).drop("_lines", "_columns")

    line, column = CELL
    return placed(left, line, "_lines", column, "_columns"), placed(right, column, "_columns", line, "_lines")


def spread_pairs(left, right, keys, least=LEAST_PAIRS):
    """Inner join on ``keys``, where the pairs of one key may be most of the result.

    A key with more than a ten-thousandth of all pairs is dealt to a grid of tasks: its left
    rows by their hash to the lines, its right rows to the columns. A row is copied along one
    line or column only, so copies grow with the root of the number of tasks, and no task
    makes many more pairs than that share. Fewer than ``SPREAD`` keys are dealt out, and
    their list is broadcast.
    """
    dealt, copies = dealt_pairs(left, right, keys, least)
    return dealt.join(copies, [*keys, *CELL]).drop(*CELL)
