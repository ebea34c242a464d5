"""Edit distances and match scores over the built-in ``levenshtein``."""

from pyspark.sql import functions as F

from ..schemas import SCORE, WEIGHT
from .text import _column, dob_text, upper_letters


def levenshtein_sql(left, right):
    """Lenient edit distance: an empty or NULL left side costs nothing, an empty or
    NULL right side costs the left length; case and trailing blanks do not count."""
    left, right = (upper_letters(F.rtrim(_column(x))) for x in (left, right))
    return (
        F.when(left.isNull() | (left == ""), F.lit(0))
        .when(right.isNull(), F.length(left))
        .when(right == "", F.length(left))
        .otherwise(F.levenshtein(left, right))
    )


def compared_text(text):
    """What the lenient distance compares: upper case, no trailing blanks, '' for NULL."""
    return F.coalesce(upper_letters(F.rtrim(_column(text))), F.lit(""))


def levenshtein_compared(left, right):
    """The lenient distance of two texts from :func:`compared_text`."""
    left, right = _column(left), _column(right)
    return F.when(left == "", F.lit(0)).otherwise(F.levenshtein(left, right))


def letter_set(text):
    """A long with a bit for each letter that occurs; letters 63 apart share a bit."""
    return F.aggregate(
        F.split(_column(text), ""), F.lit(0).cast("long"),
        lambda found, c: found.bitwiseOR(F.when(c == "", 0).otherwise(
            F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(63))))),
    )


def least_distance(left, left_letters, right, right_letters):
    """A lower bound of :func:`levenshtein_compared` from lengths and letter sets alone.

    An edit changes the length by one at most, takes away one letter that the other text
    lacks at most, and brings in one that it has at most.
    """
    left, right, mine, other = map(_column, (left, right, left_letters, right_letters))
    lacking = F.bit_count(mine.bitwiseAND(F.bitwise_not(other)))
    extra = F.bit_count(other.bitwiseAND(F.bitwise_not(mine)))
    return F.when(left == "", F.lit(0)).otherwise(
        F.greatest(F.abs(F.length(left) - F.length(right)), lacking, extra)
    )


def levenshtein_strict(left, right):
    """Symmetric, case-sensitive edit distance; NULL is an error."""
    left, right = _column(left), _column(right)
    return F.when(
        left.isNull() | right.isNull(),
        F.raise_error(F.lit("levenshtein_strict: both texts must be given")).cast("int"),
    ).otherwise(F.levenshtein(left, right))


def name_distance(first, last, other_first, other_last):
    """Smaller of the direct and the swapped distance of two full names."""
    direct = levenshtein_sql(first, other_first) + levenshtein_sql(last, other_last)
    swapped = levenshtein_sql(first, other_last) + levenshtein_sql(last, other_first)
    return F.least(direct, swapped)


def dob_distance(dob, other_dob):
    return levenshtein_sql(dob_text(dob), dob_text(other_dob))


def match_score(weight, types, hits):
    """weight * (distinct name fields + matched index rows)."""
    counted = (_column(types) + _column(hits)).cast("decimal(10,0)")
    return (_column(weight).cast(WEIGHT) * counted).cast(SCORE)


def total_distance(names, dobs, score):
    """Name distance + 2 * date distance + (10 - score); may be negative."""
    base = (_column(names) + 2 * _column(dobs) + 10).cast("decimal(18,0)")
    return (base - _column(score)).cast(SCORE)
