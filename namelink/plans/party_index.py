"""Incremental refresh of the phonetic index of parties."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nysiis
from ..operators import eligible_parties, encode_once, fragment_union
from ..operators.index_diff import KEY
from ..schemas import PARTY_INDEX, WEIGHT
from ..storage import durable


def encode_parties(parties):
    return parties.select(
        "party_id",
        nysiis("first_name").alias("first_code"),
        nysiis("last_name").alias("last_code"),
    )


def expected_party_rows(parties, relationships, members, by_name=False):
    """The eight index rows every eligible party should have; empty codes included.

    With ``by_name`` each distinct name is encoded once.
    """
    eligible = eligible_parties(parties, relationships, members)
    if by_name:
        encoded = encode_once(eligible, "party_id", {"first_code": "first_name", "last_code": "last_name"})
    else:
        encoded = encode_parties(eligible)
    return fragment_union(encoded, "party_id", "first_code", "last_code")


def build_party_index(parties, relationships, members, user_id):
    return _stamped(expected_party_rows(parties, relationships, members), user_id)


def _stamped(rows, user_id):
    user = F.lit(user_id).cast("int")
    return rows.select(
        "*", user.alias("created_by"), user.alias("modified_by")
    ).select(*PARTY_INDEX.names)


def compare_party_index(expected, existing):
    """Every stored and every missing row with what a refresh does to it.

    ``action`` is untouched (party outside the run), keep, update, delete or insert.
    Where a key is stored more than once, the row that already holds the expected code
    survives and the others are deleted.

    Both sides are stacked and shuffled once, by party; a party has some eight rows a
    side, and all comparisons are windows inside that partitioning.
    """
    wanted = expected.select(
        *KEY,
        F.col("phonetic_name").alias("new_code"),
        F.col("weight").alias("new_weight"),
        *[F.lit(None).cast(PARTY_INDEX[c].dataType).alias(c)
          for c in ("phonetic_name", "weight", "created_by", "modified_by")],
        F.lit(1).alias("is_wanted"),
    )
    stored = existing.select(
        *KEY,
        F.lit(None).cast("string").alias("new_code"),
        F.lit(None).cast(WEIGHT).alias("new_weight"),
        "phonetic_name", "weight", "created_by", "modified_by",
        F.lit(0).alias("is_wanted"),
    )
    party, key = Window.partitionBy("party_id"), Window.partitionBy(*KEY)
    copies = key.orderBy(
        "is_wanted", F.desc("is_same"), "phonetic_name", "weight", "created_by", "modified_by"
    )
    both = (
        wanted.unionByName(stored)
        .withColumn("in_run", F.max("is_wanted").over(party))
        .withColumns({
            "new_code": F.max("new_code").over(key),
            "new_weight": F.max("new_weight").over(key),
            "n_stored": F.sum(1 - F.col("is_wanted")).over(key),
        })
        .withColumn("is_same", F.col("phonetic_name").eqNullSafe(F.col("new_code"))
                    & F.col("weight").eqNullSafe(F.col("new_weight")))
        .withColumn("copy", F.row_number().over(copies))
    )
    action = (
        F.when(F.col("in_run") == 0, "untouched")
        .when(F.col("is_wanted") == 1, "insert")
        .when(F.col("new_code").isNull() | (F.col("copy") > 1), "delete")
        .when(F.col("is_same"), "keep")
        .otherwise("update")
    )
    answered = (F.col("is_wanted") == 1) & (F.col("n_stored") > 0)
    return both.filter(~answered).withColumn("action", action)


def party_index_changes(compared, user_id):
    """The change set of the run's parties: insert, update, keep and delete.

    Updated rows keep their user stamps, inserted rows get ``user_id``.
    """
    return compared.filter(F.col("action") != "untouched").select(
        "action",
        "party_id",
        F.when(F.col("action") != "delete", F.col("new_code")).alias("phonetic_name"),
        "name_field_id",
        "variant",
        F.when(F.col("action") == "delete", F.col("weight")).otherwise(F.col("new_weight"))
        .alias("weight"),
        _stamp("created_by", user_id),
        _stamp("modified_by", user_id),
        F.col("phonetic_name").alias("old_phonetic_name"),
    )


def _stamp(column, user_id):
    user = F.lit(user_id).cast("int")
    return F.when(F.col("action") == "insert", user).otherwise(F.col(column)).alias(column)


def merge_party_index(compared, user_id):
    """New index: untouched rows as they are, and every surviving row of the run."""
    untouched = F.col("action") == "untouched"
    return compared.filter(F.col("action") != "delete").select(
        "party_id",
        F.when(untouched, F.col("phonetic_name")).otherwise(F.col("new_code"))
        .alias("phonetic_name"),
        "name_field_id",
        "variant",
        F.when(untouched, F.col("weight")).otherwise(F.col("new_weight")).alias("weight"),
        _stamp("created_by", user_id),
        _stamp("modified_by", user_id),
    )


def refresh_party_index(parties, relationships, members, existing, user_id):
    """(new index, change set) of a refresh run by ``user_id``."""
    compared = compare_party_index(
        expected_party_rows(parties, relationships, members), existing
    )
    return merge_party_index(compared, user_id), party_index_changes(compared, user_id)


# --- a stored index, refreshed in place -------------------------------------------

#: Partitions of a stored party index; a refresh rewrites those that hold a change.
PARTS = 64


def _with_part(rows, parts):
    return rows.withColumn("part", F.pmod(F.xxhash64("party_id"), F.lit(parts)).cast("int"))


def store_party_index(index, folder, parts=PARTS):
    """Write a whole index into a new folder, partitioned by a hash of party_id."""
    given = _with_part(index.select(*PARTY_INDEX.names), parts)
    given.repartition(parts, "part").write.partitionBy("part").parquet(folder)


def read_party_index(spark, folder):
    schema = T.StructType([*PARTY_INDEX, T.StructField("part", T.IntegerType())])
    return spark.read.schema(schema).parquet(folder).select(*PARTY_INDEX.names)


def refresh_stored_index(parties, relationships, members, folder, user_id, parts=PARTS):
    """Refresh a stored index in place and return the change set of the run.

    Only partitions with an inserted, updated or deleted row are rewritten; the others keep
    their files. The new rows are written down before the first file is replaced, and a
    repeated refresh finds nothing left to change. ``parts`` is that of the stored index. A
    partition never becomes empty: a party of the run has expected rows, and others keep
    theirs.
    """
    spark = parties.sparkSession
    existing = read_party_index(spark, folder)
    compared = durable(_with_part(compare_party_index(
        expected_party_rows(parties, relationships, members), existing
    ), parts))
    differs = F.col("action").isin("insert", "update", "delete")
    touched = compared.filter(differs).select("part").distinct()
    rewritten = compared.join(F.broadcast(touched), "part", "left_semi")
    rows = _with_part(merge_party_index(rewritten, user_id), parts)
    rows.repartition(parts, "part").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("part").parquet(folder)
    return party_index_changes(compared, user_id)
