"""Encode each distinct name once, where names repeat heavily."""

from pyspark.sql import functions as F

from ..functions import nysiis
from ..storage import durable
from .spread import spread_join


def name_dictionary(frame, columns):
    """(name, code, n): every distinct value of some columns with its code and how often it stands there."""
    names = frame.select(F.explode(F.array(*columns)).alias("name")).filter(F.col("name").isNotNull())
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).select("name", nysiis("name").alias("code"), "n")


def encode_once(frame, key, codes):
    """``key`` and a code column per name column (``codes``: code column -> name column).

    The dictionary is written down and joined to each name column; a name that many rows
    have is dealt to several tasks. A missing name has the empty code.
    """
    dictionary = durable(name_dictionary(frame, list(codes.values())))
    total = dictionary.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = frame.select(key, *codes.values())
    for code, name in codes.items():
        entry = dictionary.select(F.col("name").alias(name), F.col("code").alias(code), "n")
        rows = spread_join(rows, entry, [name], "n", total, key, "left").drop("n")
    return rows.select(key, *[F.coalesce(code, F.lit("")).alias(code) for code in codes])
