import pytest
from pyspark.sql import functions as F

from basketry.functions import checks, dates, hashing, scores, text
from tests.conftest import rows


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else (
        spark.range(1))
    return frame.select(column.alias("x")).first()[0]


def java_hash(s):
    h = 0
    for c in s:
        h = (h * 31 + ord(c)) % (1 << 32)
    return h - (1 << 32) if h >= 1 << 31 else h


@pytest.mark.parametrize("name", ["abc", "a", "", "polygenelubricants", "Customer#000000001"])
def test_username_id(spark, name):
    assert one(spark, hashing.username_id(F.col("n")), n=name) == java_hash(name)


def test_username_id_known_and_negative(spark):
    assert java_hash("abc") == 96354
    assert java_hash("polygenelubricants") == -(1 << 31)


@pytest.mark.parametrize("value", ["260008", "9223372036854775807", "0", ""])
def test_poly_hash_equals_masked_hash(spark, value):
    h = 0
    for c in value:
        h = h * 61 + ord(c)
    assert one(spark, hashing.poly_hash(F.col("v")), v=value) == h & ((1 << 29) - 1)


def test_year_month(spark):
    assert one(spark, dates.year_month_of_text(F.col("d")), d="2009-03-19") == "200903"
    assert one(spark, dates.year_month(F.timestamp_seconds(F.lit(1578830898)))) == "202001"
    dates.register_change_date(spark)
    assert spark.sql("SELECT changeDate('2009-03-19')").first()[0] == "200903"


def test_duration():
    assert dates.duration_seconds("2 minutes") == 120
    assert dates.duration_seconds("1 hour 5 minutes") == 3900


@pytest.mark.parametrize(("page", "score"), [(5.0, 2.5), (3.33, 1.67), (10.0, 5.0), (0.01, 0.01)])
def test_half_score(spark, page, score):
    assert one(spark, checks.half_score(F.col("s")), s=page) == score


@pytest.mark.parametrize(
    ("value", "ok"),
    [("2147483646", True), ("2147483647", False), ("x", False), (None, False), ("-5", True)],
)
def test_valid_id(spark, value, ok):
    frame = spark.createDataFrame([(value,)], "v string")
    assert frame.select(checks.valid_id(F.col("v"))).first()[0] is ok


@pytest.mark.parametrize(
    ("tags", "words"),
    [
        ("A|b", ["a", "b"]), ("a||b", ["a", "", "b"]), ("a|", ["a"]), ("", [""]), ("|", []),
        (None, [""]),
    ],
)
def test_tag_words(spark, tags, words):
    frame = spark.createDataFrame([(tags,)], "t string")
    assert frame.select(text.tag_words(F.col("t"))).first()[0] == words


@pytest.mark.parametrize("tags", ["A|b", "a||b", "a|", "|", "x|Y z|  "])
def test_tag_words_as_the_tokenizer(spark, tags):
    from pyspark.ml.feature import Tokenizer

    frame = spark.createDataFrame([(tags,)], "t string").withColumn(
        "s", F.translate("t", "|", " "))
    ml = Tokenizer(inputCol="s", outputCol="w").transform(frame).first()["w"]
    assert frame.select(text.tag_words(F.col("t"))).first()[0] == ml


def test_rating_payload(spark):
    lines = [
        ("2020-01-12 INFO x : PRODUCT_RATING_PREFIX:96354|183679|5.0|1578830898 ",),
        ("2020-01-12 INFO nothing here",),
        ("tail PRODUCT_RATING_PREFIX:",),
    ]
    got = spark.createDataFrame(lines, "value string").select(
        text.extract_rating_payload(F.col("value"))
    ).collect()
    assert [r[0] for r in got] == ["96354|183679|5.0|1578830898", None, ""]


def test_rating_log_line(spark):
    line = text.rating_log_line(
        F.lit(1).cast("long"), F.lit(2).cast("long"), F.lit(4.5), F.timestamp_seconds(F.lit(7))
    )
    assert one(spark, line) == "PRODUCT_RATING_PREFIX:1|2|4.5|7"


def test_redecode(spark):
    broken = "鼠标".encode().decode("latin-1")
    assert one(spark, text.redecode(F.col("q")), q=broken) == "鼠标"


def test_cosine_of_zero_vector_is_null(spark):
    frame = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [2.0, 2.0])], "a array<double>, b array<double>")
    got = [r[0] for r in frame.select(scores.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] is None
    assert got[1] == pytest.approx(1.0)


def test_cooccurrence_score_does_not_overflow(spark):
    big = F.lit(1 << 40).cast("long")
    assert one(spark, scores.cooccurrence_score(F.lit(1 << 40), big, big)) == 1.0


def test_ranked_line(spark):
    got = rows(spark.range(1).select(text.ranked_line(F.lit(1), F.lit(7), F.lit(9))))
    assert got == [("NO1: product=7 count=9",)]
