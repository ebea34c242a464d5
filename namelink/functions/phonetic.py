"""Modified NYSIIS code as one chain of built-in string expressions.

The code is defined as a walk over the letters in which every letter is rewritten
in place and later rules see the rewritten letter before them. The same result is
reached here without a loop:

* Digraphs first. Their results are written as lower-case letters; the text itself
  is upper case, so a rewritten digraph is never read as input again. No two digraphs
  overlap except ``YW`` with ``WR``, and ``YW`` is replaced first because it starts
  further left.
* A rewritten vowel is always ``A``. So "W or H after a vowel" means "after an A or
  after other dropped W/H", and one pattern removes the whole run.
* A dropped letter repeats its predecessor, and repeats are never added to the code;
  hence dropping it and collapsing runs at the end is the same.
"""

from pyspark.sql import functions as F

from ..schemas import VARIANT_WEIGHTS
from .text import SUFFIX_PATTERN, _column, bind

# Endings and their replacements, each applied once.
_ENDINGS = [
    (r"([IE])X\z", "$1C"),
    (r"(?:YE|EE|IE)\z", "Y"),
    (r"[RN]*(?:DT|RT|RD|NT|ND)\z", "D"),
]
_ANY_END = r"\A(?:MAC|PF|EV)|(?:[IE]X|YE|EE|IE|DT|RT|RD|NT|ND)\z"
# Digraphs and their results (lower case = already rewritten).
_DIGRAPHS = [
    ("DG", "g"), ("PH", "f"), ("KN", "n"), ("SH", "s"), ("SCH", "s"), ("YW", "y"), ("WR", "r"),
]
# Single letters rewritten anywhere, and only after the first letter.
_LETTERS = [("E", "A"), ("I", "A"), ("O", "A"), ("U", "A"), ("K", "C")]
_LATER_LETTERS = [("M", "N"), ("Q", "G"), ("Z", "S")]


def _replace_all(text, pairs):
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def cleaned_name(name, max_length=None):
    """Upper-case letters and digits of a name, suffix removed.

    Suffix and special characters go in one pattern; what remains is ASCII, so
    upper-casing cannot turn another letter into an ASCII one.
    """
    text = F.coalesce(_column(name), F.lit(""))
    if max_length is not None:
        text = F.left(text, F.lit(max_length))
    return F.upper(F.regexp_replace(text, f"{SUFFIX_PATTERN}|[^A-Za-z0-9]", ""))


def _rewrite_ends(text):
    """Starts and endings; most names have none of them and skip the rewriting."""

    def rewritten(text):
        ends = F.regexp_replace(text, r"\AMAC", "MCC")
        ends = F.regexp_replace(ends, r"\APF", "F")
        for pattern, replacement in _ENDINGS:
            ends = F.regexp_replace(ends, pattern, replacement)
        ends = F.regexp_replace(ends, r"\AEV(.*)\z", "$1AF")
        return F.when(text.rlike(_ANY_END), ends).otherwise(text)

    return bind(F.rtrim(text, F.lit("SZ")), rewritten)


def _rewrite_letters(text):
    """Letter codes of a text in which digraphs are already rewritten."""
    head = _replace_all(F.left(text, F.lit(1)), _LETTERS)
    tail = F.substring(text, F.lit(2), F.length(text))
    tail = F.regexp_replace(tail, "H(?=[AEIOU])", "")  # judged on the unchanged vowel
    tail = F.regexp_replace(tail, "Y(?=.)", "A")  # a final Y stays
    tail = _replace_all(tail, _LETTERS + _LATER_LETTERS)
    codes = F.regexp_replace(F.concat(head, tail), "(?<=A)[WH]+", "")
    return F.regexp_replace(F.upper(codes), r"(.)\1+", "$1")


def _code_of(cleaned):
    code = bind(_replace_all(_rewrite_ends(cleaned), _DIGRAPHS), _rewrite_letters)
    code = F.rtrim(F.regexp_replace(code, r"AY\z", "Y"), F.lit("A"))
    first = F.left(cleaned, F.lit(1))
    return bind(
        code,
        lambda code: F.when(
            first.isin("A", "E", "I", "O", "U"),
            F.concat(first, F.substring(code, F.lit(2), F.length(code))),
        ).otherwise(code),
    )


def nysiis(name, max_length=None):
    """Phonetic code of a name; never NULL, ``''`` when nothing is left.

    The whole name counts unless ``max_length`` says how many characters do.
    """
    return bind(cleaned_name(name, max_length), _code_of)


def fragment_columns(code):
    """variant name -> fragment column, in the order of the index variants."""
    code = _column(code)
    pieces = {
        "full": code,
        "left6": F.left(code, F.lit(6)),
        "left4": F.left(code, F.lit(4)),
        "right4": F.right(code, F.lit(4)),
    }
    return {variant: pieces[variant] for variant in VARIANT_WEIGHTS}
