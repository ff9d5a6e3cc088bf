import pytest
from pyspark.sql import functions as F

from assayer.functions.hashing import row_hash, row_hash_strict
from assayer.functions.numbers import fixed_point, rounded
from assayer.functions.text import with_burstiness, with_readability, with_stylometrics
from assayer.operators.staging import cast_declared, cast_failures


@pytest.mark.parametrize(
    "text, as_long, as_double",
    [
        ("3", 3, 3.0),
        (" 3 ", 3, 3.0),
        ("3.0", 3, 3.0),
        ("3.5", None, 3.5),
        ("1e3", 1000, 1000.0),
        ("-.5", None, -0.5),
        ("9007199254740993", 9007199254740993, 9007199254740992.0),
        ("99999999999999999999", None, 1e20),
        ("abc", None, None),
        ("1d", None, None),
        ("2f", None, None),
        ("0x1p3", None, None),
        ("NaN", None, None),
        ("N/A", None, None),
        ("", None, None),
        (None, None, None),
        ("inf", None, float("inf")),
    ],
)
def test_bad_text_is_null(spark, text, as_long, as_double):
    df = spark.createDataFrame([(text, text)], "n string, x string")
    found = cast_declared(df, {"n": "bigint", "x": "double", "absent": "bigint"}).first()
    assert (found.n, found.x) == (as_long, as_double)


def test_failures_count_present_values_only(spark):
    df = spark.createDataFrame([("3.5", "a"), ("N/A", None), ("4", "1.5")], "n string, x string")
    found = {r.column_name: r.failures for r in cast_failures(df, {"n": "bigint", "x": "double"}).collect()}
    assert found == {"n": 1, "x": 1}


def test_nan_in_a_double_column_is_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,)], "x double")
    assert [r.x for r in cast_declared(df, {"x": "double"}).collect()] == [None, 1.5]


def test_numbers_are_not_parsed_again(spark):
    df = spark.createDataFrame([(2**60 + 1, 3.0, 7), (None, 3.5, None)], "a bigint, b double, c int")
    typed = cast_declared(df, {"a": "bigint", "b": "bigint", "c": "double"})
    assert [tuple(r) for r in typed.collect()] == [(2**60 + 1, 3, 7.0), (None, None, None)]
    assert {r.column_name: r.failures for r in cast_failures(df, {"a": "bigint", "b": "bigint", "c": "double"}).collect()} == {"a": 0, "b": 1, "c": 0}


def test_hash_marks_missing_values(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "<NA>")], "x string, y string")
    hashes = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_strict_hash_sees_the_column_boundary(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x string, y string")
    loose = {r[0] for r in df.select(row_hash(["x", "y"])).collect()}
    strict = {r[0] for r in df.select(row_hash_strict(["x", "y"])).collect()}
    assert (len(loose), len(strict)) == (1, 2)


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (-0.00000001,)], "x double")
    assert [r[0] for r in df.select(rounded(F.col("x"), 2)).collect()] == [0.13, 2.68, 0.0]
    assert [r[0] for r in df.select(fixed_point(F.col("x"), 2)).collect()] == ["0.13", "2.68", "0.00"]


def test_text_features_of_edge_texts(spark):
    texts = ["", "   ", "One two. Two!", "no end", "...", "A banana banana tomato.\nIs here?"]
    df = spark.createDataFrame(list(enumerate(texts)), "_row_key int, text_content string")
    out = with_burstiness(with_readability(with_stylometrics(df))).orderBy("_row_key").collect()
    assert [r.word_count for r in out] == [0, 0, 3, 2, 1, 6]
    assert [r.sentence_count for r in out] == [1, 1, 2, 1, 1, 2]
    assert out[0].lexical_diversity is None and out[0].punctuation_ratio is None and out[0].flesch_reading_ease is None
    assert out[2].lexical_diversity == 1.0 and out[2].avg_sentence_length == 1.5
    assert out[2].avg_word_length == 11 / 3 and out[2].punctuation_ratio == 2 / 13
    # banana, banana and tomato. have three vowel runs.
    assert out[5].gunning_fog_index == pytest.approx(0.4 * (3 + 100 * 3 / 6))
    assert out[2].burstiness == pytest.approx(0.5 / 1.5) and out[3].burstiness == 0.0 and out[1].burstiness is None
