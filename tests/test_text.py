import datetime

from pyspark.sql import functions as F

from namelink.functions import (
    display_name,
    dob_parts,
    dob_text,
    name_alias,
    remove_special_chars,
    split_tokens,
    strip_name_suffix,
)
from namelink.operators import apply_alias_rules

from helpers import rows


def one(spark, expression, **values):
    schema = ", ".join(
        f"{k} {'date' if isinstance(v, datetime.date) else 'string'}" for k, v in values.items()
    )
    frame = spark.createDataFrame([tuple(values.values())], schema or "x string")
    return frame.select(expression.alias("out")).first()["out"]


def test_remove_special_chars(spark):
    def clean(text, *args):
        return one(spark, remove_special_chars("t", *args), t=text)

    assert clean("o'malley") == "omalley"
    assert clean("pate-terry") == "pateterry"
    assert clean("' or 1=1; --") == "or11"
    assert clean("o'malley | test | hello, world!", "|^ ^,", "^") == "omalley | test | hello, world"
    assert clean("a-b]c\\d^e", "-|]|\\|^", "|") == "a-b]c\\d^e"
    assert clean("a;b", ";x", "|") == "ab"  # two characters are no single token
    assert clean("é1", None) == "1"
    assert clean(None) is None


def test_remove_special_chars_by_column(spark):
    frame = spark.createDataFrame(
        [("o'malley, x", ",| "), ("a.b", None), ("", "."), (None, ".")], "t string, ok string"
    )
    got = [r[0] for r in frame.select(remove_special_chars("t", F.col("ok"), "|")).collect()]
    assert got == ["omalley, x", "ab", "", None]


def test_split_tokens(spark):
    def split(text, delimiter):
        return one(spark, split_tokens("t", delimiter), t=text)

    assert split("8675309", ",") == ["8675309"]
    assert split("james,1234,5150", ",") == ["james", "1234", "5150"]
    assert split(",a,,b,", ",") == ["", "a", "", "b"]
    assert split("a.b", ".") == ["a", "b"]
    assert split("abc", "") == ["a", "b", "c"]
    assert split("a--b", "--") == ["a--b"]
    assert split("a b", " ") == ["a", "b"]
    assert split("", ",") == []
    assert split("", "") == []


def test_strip_name_suffix(spark):
    def strip(text):
        return one(spark, strip_name_suffix("t"), t=text)

    assert strip("Kluepfel III") == "Kluepfel"
    assert strip("Klappel, Sr.") == "Klappel,"
    assert strip("A JR III") == "A JR"
    assert strip("XI") == "XI"
    assert strip("Smith JR ") == "Smith JR "
    assert strip("Smith JR\n") == "Smith JR\n"


def test_dates_and_names(spark):
    day = datetime.date(1960, 2, 9)
    assert one(spark, dob_text("d"), d=day) == "1960.02.09"
    assert one(spark, F.array(*dob_parts("d")), d=day) == [1960, 2, 9]
    assert one(spark, display_name("a", "b"), a="Cook", b=None) == "Cook"
    assert one(spark, display_name("a", "b"), a="Corbyn", b="Dallas") == "Corbyn Dallas"
    last, first = name_alias("a", "b")
    assert one(spark, F.array(last, first), a="Federal Bureau", b=None) == ["JAMES", "JESSE"]
    assert one(spark, F.array(last, first), a="Moon", b="Austyn") == ["Moon", "Austyn"]


def test_alias_rules_take_the_longest_prefix(spark):
    rules = [("fed", "A", "Short"), ("FEDERAL", "Jesse", "James"), ("Federal", "Zed", "James"), ("", "no", "no"),
             (None, "no", "no"), ("éa", None, "Accent"), ("x" * 40, "Long", "Prefix")]
    rules += [(f"r{n:05d}", f"first{n}", f"last{n}") for n in range(10_000)]
    claims = [(1, "Federal Bureau", "x"), (2, "FEDORA", "y"), (3, "Fe", "z"), (4, None, "n"), (5, "Éamon", "e"),
              (6, "R09999 and more", None), (7, "r1234", "short"), (8, "X" * 41, "l"), (9, "", "")]
    claims += [(100 + n, "federal office", str(n)) for n in range(3000)]
    frame = spark.createDataFrame(claims, "claim_id bigint, last string, first string")
    done = apply_alias_rules(frame, spark.createDataFrame(rules, "prefix string, first_name string, last_name string"), "last", "first")
    assert done.columns == frame.columns
    got = {r["claim_id"]: (r["last"], r["first"]) for r in done.collect()}
    assert len(got) == len(claims)
    assert {got[n] for n in range(100, 3100)} == {("James", "Jesse")}
    assert [got[n] for n in range(1, 10)] == [
        ("James", "Jesse"), ("Short", "A"), ("Fe", "z"), (None, "n"), ("Accent", None), ("last9999", "first9999"),
        ("r1234", "short"), ("Prefix", "Long"), ("", ""),
    ]
    none = apply_alias_rules(frame, spark.createDataFrame([], "prefix string, first_name string, last_name string"), "last", "first")
    assert rows(none) == rows(frame)
