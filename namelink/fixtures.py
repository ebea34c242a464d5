"""Linkage inputs derived from the sample tables (see FIXTURES.md).

Entities, parties and claims take their names from the documents, memberships from the
orders. Every table is used whole.
"""

from pyspark.sql import functions as F

from .plans.party_index import encode_parties
from .operators import eligible_parties, fragment_union
from .schemas import CLAIM, ENTITY, MEMBER, PARTY, PARTY_INDEX, RELATIONSHIP, WEIGHT
from .sources import conform, load_table

WORD = "[A-Za-z]+"
OLD_USER = 7
NEW_USER = 5150


# Declared, so that building a query starts no job to look into the files.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark, sf_dir, name):
    return load_table(spark, f"{sf_dir}/{name}.parquet", TABLES[name])


def two_words(text):
    """The two distinct words of a whole text that have the smallest hashes."""
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    ranked = F.sort_array(F.transform(words, lambda w: F.struct(F.md5(w).alias("h"), w.alias("w"))))
    return F.transform(F.slice(ranked, 1, 2), lambda x: x["w"])


def names(spark, sf_dir):
    """Two words of each document, chosen by their hashes from all words of its text."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", two_words("text").alias("words")
    ).select("doc_id", "lang", F.get("words", F.lit(0)).alias("w1"), F.get("words", F.lit(1)).alias("w2"))


def entities(spark, sf_dir, named=None):
    """``named`` saves deriving the names again where they are at hand."""
    named = names(spark, sf_dir) if named is None else named
    no_second = F.col("doc_id") % 7 == 0
    rows = named.filter(F.col("w1").isNotNull()).select(
        F.col("doc_id").alias("entity_id"),
        F.col("lang").alias("entity_type"),
        F.col("w1").alias("entity_value1"),
        F.when(~no_second, F.col("w2")).alias("entity_value2"),
        F.lit("documents").alias("source_table"),
        F.col("doc_id").alias("source_key"),
    )
    return conform(rows, ENTITY)


def terms(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.array_join(two_words("text"), " ").alias("search_term")
    )


def parties(spark, sf_dir):
    n_documents = table(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_id"),
        (F.col("c_custkey") % n_documents).alias("doc_id"),
    )
    birth = F.date_add(F.lit("1940-01-01").cast("date"),
                       (F.col("party_id") * 7919 % 25000).cast("int"))
    rows = customers.join(names(spark, sf_dir), "doc_id").select(
        "party_id",
        F.col("w1").alias("first_name"),
        F.col("w2").alias("last_name"),
        F.when(F.col("party_id") % 11 != 0, birth).alias("dob"),
    )
    return conform(rows, PARTY)


def relationships(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("relationship_id"), F.col("o_custkey").alias("party_from_id")
    )
    return conform(rows, RELATIONSHIP)


def members(spark, sf_dir, status="F"):
    rows = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status).select(
        F.col("o_orderkey").alias("relationship_id")
    )
    return conform(rows, MEMBER)


def claims(spark, sf_dir, everyone=None):
    """One claim per party: some swapped, misspelt, aliased, with a wrong or no DOB.

    ``everyone`` saves deriving the parties again where they are at hand.
    """
    everyone = parties(spark, sf_dir) if everyone is None else everyone
    pid = F.col("party_id")
    first, last, dob = F.col("first_name"), F.col("last_name"), F.col("dob")
    rows = everyone.select(
        (pid + 1000000).alias("claim_id"),
        F.concat(F.lit("PC"), F.lpad(pid.cast("string"), 7, "0")).alias("stamp_number"),
        F.when(pid % 200 == 33, F.lit("FEDERAL BUREAU"))
        .when(pid % 40 == 3, first)
        .when(pid % 40 == 13, F.concat(F.substring(last, 1, 1), F.substring(last, 3, 200)))
        .otherwise(last).alias("patient_last_name"),
        F.when(pid % 40 == 3, last).otherwise(first).alias("patient_first_name"),
        F.when(pid % 80 == 73, F.lit(None).cast("date"))
        .when(pid % 40 == 23, F.date_add(dob, 1))
        .otherwise(dob).alias("patient_dob"),
    )
    return conform(rows, CLAIM)


def old_party_index(spark, sf_dir, everyone=None):
    """An index to refresh: other members, other names, retired and repeated rows."""
    pid = F.col("party_id")
    renamed = pid % 5 == 0
    everyone = parties(spark, sf_dir) if everyone is None else everyone
    old = everyone.withColumn(
        "first_name", F.when(renamed, F.col("last_name")).otherwise(F.col("first_name"))
    )
    covered = (relationships(spark, sf_dir), members(spark, sf_dir, "O"))
    coded = encode_parties(eligible_parties(old, *covered))
    current = fragment_union(coded, "party_id", "first_code", "last_code")
    retired = coded.select(
        "party_id",
        F.left("first_code", F.lit(3)).alias("phonetic_name"),
        F.lit(1).alias("name_field_id"),
        F.lit("left3").alias("variant"),
        F.lit("0.300").cast(WEIGHT).alias("weight"),
    )
    corrected = encode_parties(eligible_parties(everyone, *covered)).select(
        "party_id",
        F.col("first_code").alias("phonetic_name"),
        F.when(renamed, F.lit(1)).otherwise(F.lit(3)).alias("name_field_id"),
        F.lit("full").alias("variant"),
        F.lit("1.000").cast(WEIGHT).alias("weight"),
    )
    rows = current.unionByName(retired).unionByName(corrected)
    user = F.lit(OLD_USER).cast("int")
    return conform(rows.select("*", user.alias("created_by"), user.alias("modified_by")), PARTY_INDEX)


def alias_rules(spark, sf_dir, everyone=None):
    """A rule per party with a last name: a prefix of two to six letters stands for the party."""
    everyone = parties(spark, sf_dir) if everyone is None else everyone
    return everyone.filter(F.col("last_name").isNotNull()).select(
        F.left("last_name", (F.col("party_id") % 5 + 2).cast("int")).alias("prefix"), "first_name", "last_name"
    )
