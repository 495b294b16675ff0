"""Declared schemas, the section dimension and the range rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTENCES = T.StructType([
    T.StructField("docID", T.StringType()),
    T.StructField("sentenceID", T.LongType()),
    T.StructField("section", T.IntegerType()),
    T.StructField("sentence", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("cik", T.StringType()),
    T.StructField("tickers", T.ArrayType(T.StringType())),
    T.StructField("filingDate", T.DateType()),
    T.StructField("reportDate", T.DateType()),
    T.StructField("sentenceCount", T.LongType()),
    T.StructField("sentenceStartIdx", T.LongType()),
    T.StructField("sentenceEndIdx", T.LongType()),
])

# Columns that carry nothing for later steps and are dropped by the enrichment.
UNUSED_SENTENCE_COLUMNS = ["sentenceCount", "sentenceStartIdx", "sentenceEndIdx", "filingDate"]

# Section code, name, priority, note.
SECTIONS = [
    (0, "Business", "high", None),
    (1, "Risk Factors", "high", None),
    (2, "Unresolved Comments", "low", "often empty"),
    (3, "Properties", "medium", None),
    (4, "Legal Proceedings", "medium", None),
    (5, "Mine Safety", "low", None),
    (6, "Market for Stock", "medium", None),
    (7, "Reserved", "low", "usually empty"),
    (8, "MD&A", "high", None),
    (9, "Financial Statements", "high", None),
    (10, "Notes to Financials", "highest", None),
    (11, "Market Risk", "medium", None),
    (12, "Controls", "medium", None),
    (13, "Unknown", "low", "fragments"),
    (19, "Exhibits", "low", None),
]

SECTION_SCHEMA = "section int, name string, priority string, note string"

WINE_FEATURES = [
    "fixed_acidity", "volatile_acidity", "citric_acid", "residual_sugar", "chlorides",
    "free_sulfur_dioxide", "total_sulfur_dioxide", "density", "pH", "sulphates", "alcohol",
]

WINE_RECORD = T.StructType([T.StructField(name, T.DoubleType()) for name in WINE_FEATURES])

WINE_TABLE = T.StructType(
    WINE_RECORD.fields + [T.StructField("quality", T.IntegerType()), T.StructField("Id", T.LongType())]
)

WINE_REQUEST = T.StructType([T.StructField("wines", T.ArrayType(WINE_RECORD))])

# Inclusive bounds a scoring request must satisfy.
REQUEST_RULES = [
    ("fixed_acidity", 0.0, 20.0),
    ("volatile_acidity", 0.0, 2.0),
    ("citric_acid", 0.0, 2.0),
    ("residual_sugar", 0.0, 50.0),
    ("chlorides", 0.0, 1.0),
    ("free_sulfur_dioxide", 0.0, 100.0),
    ("total_sulfur_dioxide", 0.0, 300.0),
    ("density", 0.9, 1.1),
    ("pH", 2.5, 4.5),
    ("sulphates", 0.0, 3.0),
    ("alcohol", 8.0, 16.0),
]

# The narrower ranges an interactive form offers.
FORM_RULES = [
    ("fixed_acidity", 4.6, 15.9),
    ("volatile_acidity", 0.12, 1.58),
    ("citric_acid", 0.0, 1.0),
    ("residual_sugar", 0.9, 15.5),
    ("chlorides", 0.012, 0.611),
    ("free_sulfur_dioxide", 1.0, 72.0),
    ("total_sulfur_dioxide", 6.0, 289.0),
    ("density", 0.99007, 1.00369),
    ("pH", 2.74, 4.01),
    ("sulphates", 0.33, 2.0),
    ("alcohol", 8.4, 14.9),
]

# Category label per predicted quality.
QUALITY_LABELS = {
    3: "Very Poor (3)",
    4: "Poor (4)",
    5: "Below Average (5)",
    6: "Average (6)",
    7: "Above Average (7)",
    8: "Good (8)",
}


def section_dimension(spark: SparkSession) -> DataFrame:
    """The section dimension as a DataFrame (15 rows, fixed).

    Inline values have a known size, so lookups broadcast them in every session.
    """
    def literal(value):
        return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + value.replace("'", "\\'") + "'"

    schema = T.StructType.fromDDL(SECTION_SCHEMA)
    rows = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in SECTIONS)
    columns = [F.col(f.name).cast(f.dataType) for f in schema.fields]
    names = ", ".join(schema.fieldNames())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})").select(*columns)


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail early, naming every missing or differently typed column."""
    actual = {field.name: field.dataType for field in df.schema.fields}
    problems = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        f"got {actual[field.name].simpleString() if field.name in actual else 'nothing'}"
        for field in expected.fields
        if actual.get(field.name) != field.dataType
    ]
    if problems:
        raise ValueError("schema mismatch: " + "; ".join(problems))
    return df.select(*[F.col(f"`{field.name}`") for field in expected.fields])
