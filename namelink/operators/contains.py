"""Containment ("the query code contains the index fragment") as an equi join.

Substrings of a query code become *probes* that meet the index on plain equality; no
nested-loop or cross join is planned. Only substrings of lengths that the index has, by
first letter, are probed: its *directory* of lengths is a small table. A fragment longer
than ``KEY_LETTERS`` is met by its first letters and then compared whole. So a code of n
letters gives at most n * ``KEY_LETTERS`` short probes, however long it is.

The planner does not see how many rows an explode adds, so it must not decide by itself to
send the probes whole: both sides are shuffled and sort-merged, where adaptive execution
splits the partitions of very common fragments on both sides.
"""

from pyspark.sql import functions as F

#: Letters of a fragment that take part in the join; longer ones are compared afterwards.
KEY_LETTERS = 32
#: Classes of first letters in a directory, so that it stays small in any alphabet.
LETTER_CLASSES = 128


def _letter_class(text):
    return F.pmod(F.ascii(text), F.lit(LETTER_CLASSES))


def fragment_key(fragment):
    """What a fragment is joined by: all of it, or the first letters of a long one."""
    return F.left(fragment, F.lit(KEY_LETTERS))


def fragment_lengths(index, fragment="phonetic_name"):
    """(letter, lengths): the lengths of the keys that start with each class of letters.

    At most LETTER_CLASSES rows of KEY_LETTERS numbers. The empty fragment is not listed.
    """
    key = fragment_key(F.col(fragment))
    return index.filter(F.length(fragment) > 0).groupBy(_letter_class(key).alias("letter")).agg(
        F.sort_array(F.collect_set(F.length(key))).alias("lengths")
    )


def as_directory(lengths):
    """The rows of :func:`fragment_lengths` as one map column, computed where it is used."""
    return lengths.agg(F.map_from_entries(F.collect_list(F.struct("letter", "lengths")))).scalar()


def length_directory(index, fragment="phonetic_name"):
    """A map column: class of first letter -> lengths of the index keys that start so."""
    return as_directory(fragment_lengths(index, fragment))


def substrings(code, directory=None, keep_empty=False):
    """Distinct probes of a code column; ``''`` only with ``keep_empty``.

    Without a directory every substring of up to KEY_LETTERS letters is a probe.
    """
    n = F.length(code)
    every = F.sequence(F.lit(1), F.lit(KEY_LETTERS))

    def starting(start):
        room = n - start + 1
        lengths = every if directory is None else F.coalesce(
            F.try_element_at(directory, _letter_class(F.substring(code, start, F.lit(1)))),
            F.array().cast("array<int>"),
        )
        return F.transform(F.filter(lengths, lambda k: k <= room), lambda k: F.substring(code, start, k))

    pieces = F.flatten(F.transform(F.sequence(F.lit(1), n), starting))
    none = F.array().cast("array<string>")
    pieces = F.when(n > 0, F.array_distinct(pieces)).otherwise(none)
    return F.array_union(pieces, F.array(F.lit(""))) if keep_empty else pieces


def join_probes(probes, index, on):
    """Inner join of probes with the index."""
    return probes.hint("merge").join(index, on)


def _probes(queries, code, directory):
    # a column first: a subquery cannot stand inside the lambdas of the probes
    return queries.withColumn("_directory", directory).withColumn(
        "_fragment", F.explode(substrings(F.col(code), F.col("_directory")))
    ).drop("_directory")


def _whole(code):
    """The rest of a long fragment is compared after the join."""
    short = F.length("phonetic_name") <= KEY_LETTERS
    return short | F.contains(F.col(code), F.col("phonetic_name"))


def contains_join(queries, index, code="code", directory=None):
    """Pair each query with every index row whose fragment its code contains.

    ``queries`` needs the code column; all columns of both sides are kept. An empty
    fragment meets no query. ``directory`` is that of an index with the same fragments, for
    an ``index`` that is costly to read twice.
    """
    probes = _probes(queries, code, length_directory(index) if directory is None else directory)
    met = join_probes(probes, index, F.col("_fragment") == fragment_key(F.col("phonetic_name")))
    return met.filter(_whole(code)).drop("_fragment")


def contains_stored(queries, stored, code="code"):
    """The same join with a published index: only the probes are shuffled.

    A probe of a common fragment visits all its slices.
    """
    probes = _probes(queries, code, as_directory(stored.lengths)).withColumnRenamed("_fragment", "probe")
    slices = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
    dealt = probes.join(F.broadcast(stored.common), "probe", "left").withColumn("slice", F.explode(slices)).drop("slices")
    return join_probes(dealt, stored.rows, ["probe", "slice"]).filter(_whole(code)).drop("probe", "slice")
