"""The registered query of each corpus operator, with production parameters."""

import public_tokenizers

from ..sources import load_table
from .bpe_shuffle import bpe_round_trip
from .decontaminate import contamination_report
from .exact_dedup import exact_dedup
from .langid import language_id
from .line_dedup import line_dedup_report
from .minhash import near_dedup
from .pii import pii_report
from .prefix_trie import prefix_trie
from .quality import quality_rules
from .secrets import secret_report
from .shared import ship_package
from .token_align import alignment_report
from .token_files import token_file_round_trip
from .warc import warc_round_trip

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BENCHMARK = "item_id bigint, text string"
PAGES = "page_id bigint, url string, html string"
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def documents(spark, sf_dir):
    ship_package(spark)
    return load_table(spark, f"{sf_dir}/documents.parquet", DOCUMENTS)


def benchmark(spark, sf_dir):
    return load_table(spark, f"{sf_dir}/benchmark.parquet", BENCHMARK)


def op1_secrets(spark, sf_dir):
    return secret_report(documents(spark, sf_dir))


def op2_token_files(spark, sf_dir):
    return token_file_round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_pii(spark, sf_dir):
    return pii_report(documents(spark, sf_dir))


def op4_warc(spark, sf_dir):
    ship_package(spark)
    return warc_round_trip(load_table(spark, f"{sf_dir}/pages.parquet", PAGES))


def op5_language_id(spark, sf_dir):
    return language_id(documents(spark, sf_dir))


def op6_decontaminate(spark, sf_dir):
    return contamination_report(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op7_bpe_shuffle(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op8_quality_rules(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir))


def op9_near_dedup(spark, sf_dir):
    return near_dedup(documents(spark, sf_dir))


def op10_line_dedup(spark, sf_dir):
    return line_dedup_report(documents(spark, sf_dir))


def op11_prefix_trie(spark, sf_dir):
    ship_package(spark)
    return prefix_trie(load_table(spark, f"{sf_dir}/conversations.parquet", CONVERSATIONS))


def op12_token_align(spark, sf_dir):
    first, second = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment_report(documents(spark, sf_dir), first, second)


def op13_exact_dedup(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir))


QUERIES = {
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_align": op12_token_align,
    "op13_exact_dedup": op13_exact_dedup,
    "op9_near_dedup": op9_near_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op1_secrets": op1_secrets,
    "op2_token_files": op2_token_files,
    "op3_pii": op3_pii,
    "op4_warc": op4_warc,
    "op5_language_id": op5_language_id,
    "op6_decontaminate": op6_decontaminate,
    "op7_bpe_shuffle": op7_bpe_shuffle,
    "op8_quality_rules": op8_quality_rules,
}
