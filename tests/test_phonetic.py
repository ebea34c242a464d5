import random

from pyspark.sql import functions as F

from namelink.functions import fragment_columns, nysiis

from helpers import walked_codes

GOLDEN = {
    "Klueppel": "CLAPAL", "A": "A", "Chandwani": "CANDWAN", "Kluepfel III": "CLAPFAL", "D": "D",
    "James": "JAN", "Knopfel": "NAPFAL", "theodore": "TADAR", "Severance": "SAVARANC",
    "Klappel, Sr.": "CLAPAL", "Austin Dallas": "ASTANDAL", "Seever": "SAVAR",
    "Culpepper, MD": "CALPAPAR", "Corbyn": "CARBAN", "Sulaiman": "SALANAN", "Rudolph": "RADALF",
    "Dallas": "DAL", "Auston": "ASTAN", "Austyn": "ASTAN", "ULYSSIS": "ULAS", "Shawn": "SAN",
    "Matthew": "MAT", "SANCHEZ": "SANC", "Moon": "MAN", "Robert": "RABAD",
    "Sanchez-Romero": "SANCASRANAR", "Cook": "CAC", "Duvall": "DAVAL", "Duval": "DAVAL",
    "Rivera": "RAVAR", "Romero": "RANAR", "REINHARDT": "RANAD", None: "", "": "", "S": "",
    "Macdonald": "MCDANALD", "Pfister": "FASTAR", "Evans": "ENAF", "Evrard": "EADAF",
    "Knight": "NAGHT", "Schmidt": "SNAD", "Lawson": "LASAN", "Oy": "O", "Dodge": "DAG",
    "Mahmoud": "MANAD", "3M": "3N", "Mack": "MC", "JoseFelix": "JASAFALAC",
    "Customer#000000100": "CASTANAR010",
}


def encode(spark, names):
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    return {r["name"]: r["code"] for r in frame.select("name", nysiis("name").alias("code")).collect()}


def test_golden_codes(spark):
    assert encode(spark, GOLDEN) == GOLDEN


def test_agrees_with_the_letter_walk_on_random_names(spark):
    """Letters that take part in rules, in every order, with suffixes and odd characters."""
    rng = random.Random(1)
    letters = "AEIOUHWYSZCKNMQDGPRTXVBLaehwykn13 -'.,é"
    starts = ["", "", "", "MAC", "PF", "EV", "H", "W", "Y", "SCH", "KN"]
    ends = ["", "", "IX", "EX", "YE", "EE", "IE", "NDT", "RRT", "SZ", " JR", ", Sr.", " III", "AY"]
    names = {
        rng.choice(starts) + "".join(rng.choices(letters, k=rng.randint(0, 12))) + rng.choice(ends)
        for _ in range(6000)
    }
    names |= {"".join(rng.choices("AHWYSCKR", k=rng.randint(1, 7))) for _ in range(4000)}
    names |= {"".join(rng.choices(letters, k=60)) for _ in range(200)}
    assert encode(spark, names) == walked_codes(sorted(names))


def test_code_properties(spark, sf_dir):
    words = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.explode(F.split("text", "[ \n]+")).alias("name")
    ).distinct()
    codes = words.select(nysiis("name").alias("code"))
    assert codes.filter(F.col("code").isNull() | F.col("code").rlike("[^A-Z0-9]")).isEmpty()
    # only the final AY -> Y can leave a repeat, and only a lone vowel can end a code
    assert codes.filter(F.col("code").rlike(r"(.)\1") & ~F.col("code").endswith("YY")).isEmpty()
    assert codes.filter(F.col("code").rlike("..*[AEIOU]$")).isEmpty()


def test_fragments(spark):
    frame = spark.createDataFrame([("SAVARANC",), ("DAL",), ("",)], "code string")
    got = [tuple(r) for r in frame.select(*fragment_columns("code").values()).collect()]
    assert got == [
        ("SAVARANC", "SAVARA", "SAVA", "RANC"), ("DAL", "DAL", "DAL", "DAL"), ("", "", "", ""),
    ]
