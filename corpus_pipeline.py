"""The corpus pipeline: language, lines, near copies, benchmark passages, token ids.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is
written to the shared folder before the next one reads it. All but the last keep the
columns of ``documents``; the last gives the token ids of each document.
"""

import public_tokenizers
from pyspark.sql import functions as F

from namelink.llm.bpe_shuffle import decode, encode
from namelink.llm.decontaminate import drop_contaminated
from namelink.llm.langid import fitted, keep_languages
from namelink.llm.line_dedup import dedup_lines
from namelink.llm.minhash import near_dedup
from namelink.llm.queries import benchmark, documents
from namelink.llm.shared import ship_package, staged

#: A document goes if it has no letters, or its words' own best probabilities have a mean below this.
LEAST_LANGUAGE_SCORE = 0.4

#: Lines at most so many edits from an earlier one go.
LINE_EDITS = 2


def _keep(docs, verdicts):
    """Rows of ``docs`` whose doc_id has a kept row in ``verdicts``; rows without id stay.

    ``verdicts`` has doc_id and kept, one row per row of ``docs``; documents that share an
    id share their fate, and are kept if one of them is.
    """
    good = verdicts.filter("kept").select("doc_id").distinct()
    known = docs.filter(F.col("doc_id").isNotNull()).join(good, "doc_id", "left_semi")
    return known.unionByName(docs.filter(F.col("doc_id").isNull())).select(docs.columns)


def language_stage(spark, docs, sf_dir):
    """Drop documents without a language: no letters, or no language that fits."""
    ship_package(spark)
    return keep_languages(docs, fitted(docs), LEAST_LANGUAGE_SCORE)


def line_stage(spark, docs, sf_dir):
    """Drop repeated and almost repeated lines; a text of nothing else goes as a whole."""
    found = dedup_lines(docs, max_edits=LINE_EDITS)

    def stays(row):
        empty = F.coalesce(F.trim(row["doc"]["text"]), F.lit("")) == ""
        return ~(empty & (row["n_dropped_equal"] + row["n_dropped_near"] > 0))

    # as an array, not a filter: a filter would be moved down and repeat the work on the lines
    kept = F.filter(F.array(F.struct(*found.columns)), stays)
    return found.select(F.inline(kept)).select("doc.*").select(docs.columns)


def near_copy_stage(spark, docs, sf_dir):
    """Keep one document of each group of near copies."""
    return _keep(docs, near_dedup(docs).select("doc_id", "kept"))


def benchmark_stage(spark, docs, sf_dir):
    """Drop documents that hold a passage of a benchmark item."""
    return drop_contaminated(docs, benchmark(spark, sf_dir))


def token_stage(spark, docs, sf_dir):
    """Token ids per document, with the hash of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return decode(encode(docs, ranks, public_tokenizers.PATTERN), ranks).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_copy_stage),
    ("decontaminate", benchmark_stage),
    ("bpe", token_stage),
]

#: A network of word labels and a global encoder have no SQL form; tests hold the rows
#: against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to the documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
