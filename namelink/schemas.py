"""Table schemas and the fixed values shared by index builders and searches."""

from decimal import Decimal

from pyspark.sql import types as T

WEIGHT = T.DecimalType(18, 3)
SCORE = T.DecimalType(29, 3)

ENTITY = T.StructType([
    T.StructField("entity_id", T.LongType(), False),
    T.StructField("entity_type", T.StringType(), False),
    T.StructField("entity_value1", T.StringType(), False),
    T.StructField("entity_value2", T.StringType(), True),
    T.StructField("source_table", T.StringType(), False),
    T.StructField("source_key", T.LongType(), False),
])

ENTITY_INDEX = T.StructType([
    T.StructField("phonetic_name", T.StringType(), False),
    T.StructField("name_field_id", T.IntegerType(), False),
    T.StructField("weight", WEIGHT, False),
    T.StructField("entity_id", T.LongType(), False),
])

PARTY = T.StructType([
    T.StructField("party_id", T.LongType(), False),
    T.StructField("first_name", T.StringType(), True),
    T.StructField("last_name", T.StringType(), True),
    T.StructField("dob", T.DateType(), True),
])

RELATIONSHIP = T.StructType([
    T.StructField("relationship_id", T.LongType(), False),
    T.StructField("party_from_id", T.LongType(), False),
])

MEMBER = T.StructType([
    T.StructField("relationship_id", T.LongType(), False),
])

PARTY_INDEX = T.StructType([
    T.StructField("party_id", T.LongType(), False),
    T.StructField("phonetic_name", T.StringType(), False),
    T.StructField("name_field_id", T.IntegerType(), False),
    T.StructField("variant", T.StringType(), False),
    T.StructField("weight", WEIGHT, False),
    T.StructField("created_by", T.IntegerType(), True),
    T.StructField("modified_by", T.IntegerType(), True),
])

CLAIM = T.StructType([
    T.StructField("claim_id", T.LongType(), False),
    T.StructField("stamp_number", T.StringType(), True),
    T.StructField("patient_last_name", T.StringType(), True),
    T.StructField("patient_first_name", T.StringType(), True),
    T.StructField("patient_dob", T.DateType(), True),
])

# Fragment variants of a phonetic code and their weights.
VARIANT_WEIGHTS = {
    "full": Decimal("1.000"),
    "left6": Decimal("0.900"),
    "left4": Decimal("0.500"),
    "right4": Decimal("0.500"),
}
FIRST_FIELD = 1
SECOND_FIELD = 2

# Fixed value: a search returns this many parties.
DEFAULT_QUANTITY = 10

# Last-name prefix that stands for a known person (first, last).
NAME_ALIASES = {"FEDERAL": ("JESSE", "JAMES")}

# The eleven seed entities (type, value 1, value 2, table, key).
SEED_ENTITIES = [
    ("Loan Officer", "Corbyn", "Dallas", "DimUser", 123),
    ("Loan Officer", "Shawn", "Chandwani", "DimUser", 124),
    ("Loan Officer", "James", "Severance", "DimUser", 125),
    ("Loan Officer", "Seever", "Sulaiman", "DimUser", 126),
    ("Loan Officer", "Auston", "Matthew", "DimUser", 127),
    ("Loan Officer", "Austyn", "Moon", "DimUser", 128),
    ("Loan Officer", "Robert", "Duvall", "DimUser", 129),
    ("County", "Dallas", None, "DimCounty", 123),
    ("County", "Cook", None, "DimCounty", 234),
    ("County", "James", None, "DimCounty", 345),
    ("County", "Duval", None, "DimCounty", 456),
]
