"""Quality rules: a threshold table compiled into one projection of text ratios."""

from pyspark.sql import functions as F

from .shared import SPACE_CLASS, SPACES

# Frequent function words of the corpus languages.
STOP_WORDS = {
    "en": "the be to of and that have with is in for it was this from by are on as at or not a",
    "de": "der die das und ist von zu den mit sich auf für nicht ein eine im dem des als auch in",
    "fr": "le la les de des et en un une du dans que est pour qui sur pas au avec ce il",
    "es": "el la los las de que y en un una es por con para del se no al lo como su",
}

# Fixed values: (ratio, least, most, words a text needs for the rule to apply); None leaves
# a side open. A text outside any row fails.
RULES = (
    ("n_words", 10, None, 0),
    ("mean_word_chars", 2.0, 14.0, 10),
    ("symbols_per_word", None, 0.2, 0),
    ("stop_word_share", 0.02, None, 50),
    ("dup_line_share", None, 0.5, 0),
    ("bullet_line_share", None, 0.9, 50),
    ("ellipsis_line_share", None, 0.3, 50),
    ("repeat_word_share", None, 0.2, 0),
)


def _share(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _windows(words, size):
    return F.sequence(F.lit(0), F.size(words) - F.lit(size))


def _count_repeats(words, size):
    """Words covered by windows of ``size`` words that occur twice or more.

    Hashes tell first whether any window can repeat; only then are the windows themselves
    sorted, so that equal ones are neighbours, and the covered words counted from their
    positions. No hash collision can change the count.
    """
    hashes = F.transform(
        _windows(words, size),
        lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))),
    )
    ordered = F.sort_array(F.transform(
        _windows(words, size),
        lambda i: F.struct(F.array_join(F.slice(words, i + 1, size), " ").alias("w"), i.alias("i")),
    ))

    def marked(pairs):
        def same(k, other):
            return F.coalesce(F.get(pairs, k)["w"] == F.get(pairs, other)["w"], F.lit(False))

        found = F.transform(
            F.sequence(F.lit(0), F.size(pairs) - 1),
            lambda k: F.when(same(k, k - 1) | same(k, k + 1), F.get(pairs, k)["i"]),
        )
        return F.sort_array(F.filter(found, lambda x: x.isNotNull()))

    def covered(starts):
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")),
            lambda a, x: F.struct(
                (a["n"] + F.least(F.lit(size), x - a["last"])).alias("n"), x.alias("last")
            ),
            lambda a: a["n"],
        )

    def bound(value, use):
        return F.element_at(F.transform(F.array(value), use), 1)

    heavy = bound(bound(ordered, marked), covered)
    repeats = bound(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when((F.size(words) > size) & repeats, heavy).otherwise(F.lit(0))


def measure(docs, key="doc_id", text="text"):
    """Counts and ratios of every whole text; a null text counts as having no words."""
    raw = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(raw, F.lit(SPACES))
    lines = F.filter(F.split(raw, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    known = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    staged = docs.select(
        F.col(key),
        raw.alias("_text"),
        F.when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, SPACE_CLASS + "+", -1)).alias("_words"),
        lines.alias("_lines"),
    )
    words, lines = F.col("_words"), F.col("_lines")
    # Unlike translate, this scans the text once and only counts.
    symbols = F.regexp_count("_text", F.lit("[#*$%&|<>]"))
    counted = staged.select(
        F.col(key),
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _count_repeats(words, 5).cast("long").alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: w.isin(known))).alias("_stop"),
        F.size(lines).alias("_n_lines"),
        F.size(F.filter(lines, lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•"))).alias("_bullets"),
        F.size(F.filter(lines, lambda x: x.endswith("...") | x.endswith("…"))).alias("_ellipses"),
    )
    n, n_lines = F.col("n_words"), F.col("_n_lines")
    return counted.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _share(F.col("word_chars"), n).alias("mean_word_chars"),
        _share(F.col("n_symbols"), n).alias("symbols_per_word"),
        _share(F.col("_stop"), n).alias("stop_word_share"),
        _share(F.col("n_dup_lines"), n_lines).alias("dup_line_share"),
        _share(F.col("_bullets"), n_lines).alias("bullet_line_share"),
        _share(F.col("_ellipses"), n_lines).alias("ellipsis_line_share"),
        _share(F.col("n_repeat_words"), n).alias("repeat_word_share"),
    )


def compile_rules(rules=RULES):
    """(passes, failed rule names) as columns over the ratios of ``measure``."""
    checks = []
    for ratio, least, most, from_words in rules:
        bad = F.lit(False)
        if least is not None:
            bad = bad | (F.col(ratio) < least)
        if most is not None:
            bad = bad | (F.col(ratio) > most)
        if from_words:
            bad = bad & (F.col("n_words") >= from_words)
        checks.append((ratio, bad))
    failed = F.filter(
        F.array(*(F.when(bad, F.lit(name)) for name, bad in checks)), lambda x: x.isNotNull()
    )
    passes = F.lit(True)
    for _, bad in checks:
        passes = passes & ~bad
    return passes, failed


def quality_rules(docs, rules=RULES, key="doc_id", text="text"):
    """One row per document: counts, ratios, ``base_failed``, ``failed_rules`` and ``kept``.

    Null and empty texts have no words and fail. Repeated rows give repeated results; an
    empty table gives none. Other columns of ``docs`` are not read.
    """
    passes, failed = compile_rules(rules)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measure(docs, key, text).select(
        "*", base.alias("base_failed"), failed.alias("failed_rules"), (~base & passes).alias("kept")
    )
