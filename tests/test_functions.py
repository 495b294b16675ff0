import math

from pyspark.sql import functions as F

from textlab.functions import numeric, vector
from textlab.functions import text as tx


def column(spark, values, type_name, expression):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, s {type_name}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_counts(spark):
    texts = ["", "a  b ", None, "é😀"]
    assert column(spark, texts, "string", tx.word_count("s")) == [1, 4, None, 1]
    assert column(spark, texts, "string", tx.char_count("s")) == [0, 5, None, 2]
    assert column(spark, texts, "string", tx.avg_word_length("s")) == [0.0, 1.25, None, 2.0]


def test_word_count_equals_split(spark):
    texts = [" ", "  ", "a b", " a", "a ", "a\tb", "one two  three"]
    assert column(spark, texts, "string", tx.word_count("s")) == [len(t.split(" ")) for t in texts]


def test_estimated_tokens_equal_blank_separated_words(spark):
    texts = ["", "   ", "a  b\t\nc", "x y", "x y z", "a\x1fb", "tail "]
    assert column(spark, texts, "string", tx.estimated_tokens("s")) == [len(t.split()) for t in texts]


def test_flags_are_strict(spark):
    texts = ["x" * 1000, "x" * 1001, "x" * 19, "x" * 20]
    assert column(spark, texts, "string", tx.is_long_text("s")) == [False, True, False, False]
    assert column(spark, texts, "string", tx.is_fragment("s")) == [False, False, True, False]


def test_likely_table(spark):
    texts = ["1 22  333", "1 2", "a1 2\t3b", "١ ٢ ٣", None]
    assert column(spark, texts, "string", tx.likely_table("s", unicode=True)) == [True, False, True, True, None]
    assert column(spark, texts, "string", tx.likely_table("s")) == [True, False, True, False, None]


def test_preview(spark):
    texts = ["x" * 200, "x" * 201, "short"]
    assert column(spark, texts, "string", tx.preview("s")) == ["x" * 200, "x" * 200 + "...", "short"]
    assert column(spark, texts, "string", tx.preview("s", 3, always=True)) == ["xxx...", "xxx...", "sho..."]


def test_pretty_name(spark):
    assert column(spark, ["free_sulfur_dioxide", "pH"], "string", tx.pretty_name("s")) == ["Free Sulfur Dioxide", "Ph"]


def test_finite_or_zero(spark):
    values = [math.nan, math.inf, -math.inf, None, 2.5]
    assert column(spark, values, "double", numeric.finite_or_zero("s")) == [0.0, 0.0, 0.0, 0.0, 2.5]


def test_l2_normalize(spark):
    values = [[3.0, 4.0], [0.0, 0.0], None]
    assert column(spark, values, "array<double>", vector.l2_normalize("s")) == [[0.6, 0.8], [0.0, 0.0], None]


def test_dot(spark):
    assert column(spark, [[1.0, 2.0]], "array<float>", vector.dot("s", vector.literal([3.0, 4.0]))) == [11.0]


def test_hash_buckets_follow_md5(spark):
    import hashlib

    words = ["alpha", "é", "beta"]
    expected = [str(int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64) for w in words]
    assert column(spark, [" alpha  é beta "], "string", vector.hash_buckets(F.col("s"), 64)) == [expected]
