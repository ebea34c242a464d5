"""Text helpers. All are built-in Spark expressions; nothing leaves the JVM."""

import re

from pyspark.sql import functions as F

from ..schemas import NAME_ALIASES

# Generational and title suffixes, each after a blank.
SUFFIX_PATTERN = r"(?i)(?: I| II| III| IV| VI| JR| SR| MD| PHD| JR\.| SR\.)\z"


def _column(value):
    return F.col(value) if isinstance(value, str) else value


def bind(value, body):
    """``body`` of an expression that is evaluated once and used several times.

    Without it each use would repeat the whole expression, and the generated method
    would outgrow what the JVM compiles.
    """
    return F.transform(F.array(value), body)[0]


def _split_literal(values, delimiter):
    """The token rules of :func:`split_tokens` for a plain Python text."""
    if not values:
        return []
    if delimiter == "":
        return list(values)
    if delimiter is None or len(delimiter) > 1:
        return [values]
    tokens = values.split(delimiter)
    return tokens[:-1] if tokens[-1] == "" else tokens


def remove_special_chars(text, allowed=None, delimiter="|"):
    """Keep ASCII letters, digits and the single-character tokens of ``allowed``.

    ``allowed`` is None, a Python text, or a Column holding one list per row.
    """
    text = _column(text)
    if allowed is None:
        return F.regexp_replace(text, "[^A-Za-z0-9]", "")
    if isinstance(allowed, str):
        singles = sorted({t for t in _split_literal(allowed, delimiter) if len(t) == 1})
        extra = "".join("\\x{%x}" % ord(t) for t in singles)
        return F.regexp_replace(text, f"[^A-Za-z0-9{extra}]", "")
    tokens = F.coalesce(split_tokens(allowed, delimiter), F.array().cast("array<string>"))
    kept = F.filter(
        F.split(text, ""),
        lambda c: c.rlike("^[A-Za-z0-9]$") | F.array_contains(tokens, c),
    )
    return F.array_join(kept, "")


def strip_name_suffix(name):
    """Remove one trailing suffix such as `` III`` or `` Jr.``; a comma stays."""
    return F.regexp_replace(_column(name), SUFFIX_PATTERN, "")


def split_tokens(values, delimiter):
    """Array of the texts between delimiters.

    Leading and inner empty tokens stay, a trailing delimiter adds none, empty text
    gives no token, the delimiter ``''`` splits into characters, and a longer
    delimiter never matches.
    """
    values = _column(values)
    if delimiter == "":
        tokens = F.filter(F.split(values, ""), lambda t: t != "")
    elif len(delimiter) > 1:
        tokens = F.array(values)
    else:
        parts = F.split(values, re.escape(delimiter), -1)
        ends_open = F.element_at(parts, -1) == ""
        tokens = F.slice(parts, 1, F.size(parts) - ends_open.cast("int"))
    return F.when(values == "", F.array().cast("array<string>")).otherwise(tokens)


def dob_text(dob):
    return F.date_format(_column(dob), "yyyy.MM.dd")


def dob_parts(dob):
    """(year, month, day of month) columns."""
    dob = _column(dob)
    return F.year(dob), F.month(dob), F.dayofmonth(dob)


def display_name(value1, value2):
    return F.concat_ws(" ", _column(value1), _column(value2))


def name_alias(last_name, first_name, aliases=None):
    """(last, first) after replacing names whose last name starts with an alias."""
    last_name, first_name = _column(last_name), _column(first_name)
    new_last, new_first = last_name, first_name
    for prefix, (first, last) in (NAME_ALIASES if aliases is None else aliases).items():
        hit = F.upper(last_name).startswith(prefix.upper())
        new_last = F.when(hit, F.lit(last)).otherwise(new_last)
        new_first = F.when(hit, F.lit(first)).otherwise(new_first)
    return new_last, new_first


def upper_letters(text):
    """Upper case letter by letter; a letter whose upper case is several letters stays."""
    text = _column(text)
    whole = F.upper(text)
    each = F.transform(F.split(text, ""), lambda c: F.when(F.length(F.upper(c)) == 1, F.upper(c)).otherwise(c))
    return F.when(F.length(whole) == F.length(text), whole).otherwise(F.array_join(each, ""))
