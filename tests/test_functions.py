from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kinspan.functions import numbers as N
from kinspan.functions import text as X
from kinspan.functions import times as M


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "sep", "trimmed"),
    [
        ("abc", ",", ["abc"]),
        ("a,b,c,d", ",", ["a", "b", "c", "d"]),
        ("a,,b,,", ",", ["a", "", "b"]),
        (",,", ",", []),
        ("", ",", [""]),
        (",a", ",", ["", "a"]),
        ("a||b||||", "||", ["a", "b"]),
        ("a.b.", ".", ["a", "b"]),
        ("a\\b\\", "\\", ["a", "b"]),
    ],
)
def test_split(spark, text, sep, trimmed):
    column = F.lit(text)
    assert value(spark, X.split_trimmed(column, sep)) == trimmed
    assert value(spark, X.split_all(column, sep)) == text.split(sep)
    pieces = X.split_all(column, sep)
    assert value(spark, X.trimmed_size(pieces, column, sep)) == len(trimmed)


def test_split_limits(spark):
    assert value(spark, X.split_limit(F.lit("a,b,c,d"), ",", 2)) == ["a", "b,c,d"]
    assert value(spark, X.split_limit(F.lit("a,b,,"), ",", 100)) == ["a", "b", "", ""]


def test_printf(spark):
    assert value(spark, X.printf("Nr. %08d – Straße", F.lit(2718))) == "Nr. 00002718 – Straße"
    assert value(spark, X.printf("%2$s before %1$s", F.lit("noon"), F.lit("dawn"))) == "dawn before noon"


def test_lengths_and_positions(spark):
    city = F.lit("北京市海淀区")
    assert value(spark, X.char_count(F.lit("哈"))) == 1
    assert value(spark, X.byte_count(F.lit("哈"))) == 3
    assert value(spark, X.after_first(city, "市")) == "海淀区"
    assert value(spark, X.after_first(F.lit("abc"), "市")) == "abc"
    assert value(spark, X.after_first(F.lit("a市b市c"), "市")) == "b市c"
    assert value(spark, X.from_position(city, 3)) == "海淀区"
    assert value(spark, X.code_point(F.lit("市"))) == 24066


def test_case(spark):
    assert value(spark, X.upper_case(F.lit("grüßen"))) == "GRÜSSEN"
    assert value(spark, X.lower_case(F.lit("ὈΔΥΣΣΕΎΣ"))) == "ὀδυσσεύς"


def test_delimiter_and_row_keys(spark):
    assert value(spark, X.swap_delimiter(F.lit("a\u0001b"))) == "a\tb"
    key = F.lit("a_b:c:l_1451703845000")
    assert value(spark, X.id_of_row_key(key)) == "a_b:c:l"
    assert value(spark, X.millis_of_row_key(key)) == 1451703845000


def test_null_literals(spark):
    assert [value(spark, X.null_if_literal(F.lit(t))) for t in ("NULL", "null", "x")] == [None, None, "x"]


def test_overflow_is_shown(spark):
    assert value(spark, N.negated(F.lit(-(2**31)))) == 2**31
    big = F.lit(2**62)
    assert value(spark, N.product_or_null(big, F.lit(2))) is None
    assert value(spark, N.product_or_null(F.lit(3), F.lit(4))) == 12


def test_times(spark):
    assert value(spark, M.parse_millis(F.lit("2016-01-02 03:04:05.123"))) == 1451703845000
    assert value(spark, M.parse_millis(F.lit("2016-13-02 03:04:05"))) is None
    assert value(spark, M.parse_millis(F.lit("bad"))) is None
