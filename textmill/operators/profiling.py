"""Profiling: null counts, descriptions, cross tables, frequent words, outliers, pattern counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t


def nulls(df: DataFrame) -> DataFrame:
    """``column``, ``type``, ``nulls``, ``n``, from one scan."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"c{i}") for i, f in enumerate(df.schema.fields)))
    return one.select("n", F.explode(F.array(*(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("nulls")) for i, f in enumerate(df.schema.fields)))).alias("x")).select("x.*", "n")


def describe(df: DataFrame, value: Column, *by: str) -> DataFrame:
    """Count, mean, deviation, least, quartiles and greatest of a value per group."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75), F.lit(0.99)))
    r = lambda c: F.round(c, 6)
    return df.groupBy(*by).agg(F.count(value).alias("n"), r(F.avg(value)).alias("mean"), r(F.stddev_samp(value)).alias("std"), F.min(value).alias("least"), q.alias("q"), F.max(value).alias("greatest")).select(
        *by, "n", "mean", "std", "least", *(r(F.col("q")[i]).alias(c) for i, c in enumerate(("q25", "q50", "q75", "q99"))), "greatest")


def cross_cube(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of all pairs with the margins; a margin has 'ALL' where it sums over a column, null values are 'NULL'."""
    rows = df.select(F.coalesce(F.col(a), F.lit("NULL")).alias("a"), F.coalesce(F.col(b), F.lit("NULL")).alias("b"))
    c = rows.cube("a", "b").agg(F.count(F.lit(1)).alias("n"), F.grouping("a").alias("ga"), F.grouping("b").alias("gb"))
    return c.select(F.when(F.col("ga") == 1, "ALL").otherwise(F.col("a")).alias(a), F.when(F.col("gb") == 1, "ALL").otherwise(F.col("b")).alias(b), "n")


def row_percent(df: DataFrame, a: str, b: str, values: list[str]) -> DataFrame:
    """One row per value of ``a`` with the percentage of every value of ``b``."""
    total = F.count(F.lit(1))
    return df.groupBy(a).agg(*(F.round(F.count_if(F.col(b) == v) * 100 / total, 4).alias(f"pct_{v}") for v in values))


def top_words(df: DataFrame, text: str, by: str, k: int = 20, longer_than: int = 2) -> DataFrame:
    """The ``k`` most frequent words per group (ties by word), of words longer than ``longer_than``."""
    from pyspark.sql import Window

    words = df.select(by, F.explode(t.words(F.col(text))).alias("word")).where(F.length("word") > longer_than)
    counts = words.groupBy(by, "word").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "word"))).where(F.col("rank") <= k)


def above_quantile(df: DataFrame, value: Column, name: str, p: float = 0.99) -> DataFrame:
    """Rows whose value is above the exact quantile, with the value and the limit."""
    limit = df.agg(F.percentile(value, F.lit(p)).alias("limit"))
    return df.withColumn(name, value).crossJoin(F.broadcast(limit)).where(F.col(name) > F.col("limit"))


def length_bands(df: DataFrame, text: str) -> DataFrame:
    """One row: null, blank, very short, short and single-word texts."""
    c = F.col(text)
    n = F.length(t.strip(c))
    return df.agg(F.count_if(c.isNull()).alias("null_text"), F.count_if(n == 0).alias("blank"), F.count_if((n > 0) & (n < 10)).alias("below_10"), F.count_if((n >= 10) & (n < 20)).alias("from_10_to_19"), F.count_if(F.size(t.words(c)) == 1).alias("single_word"))


def patterns(df: DataFrame, text: str) -> DataFrame:
    """One row: how many texts have each pattern."""
    c = F.col(text)
    emoji_free = F.regexp_replace(F.regexp_replace(c, t.EMOJI_BLOCKS, ""), t.ASTRAL, "")
    return df.where(c.isNotNull()).agg(
        F.count_if(c.rlike(t.ARABIC)).alias("arabic"), F.count_if(t.has_latin(c)).alias("latin"), F.count_if(c.rlike(t.EMOJI_BLOCKS)).alias("emoji"),
        F.count_if(t.has_diacritics(c)).alias("diacritics"), F.count_if(t.has_elongation(c)).alias("elongated"), F.count_if(c.rlike("[0-9]")).alias("digits"),
        F.count_if(F.regexp_count(c, F.lit(t.PUNCTUATION)) > 10).alias("much_punctuation"), F.count_if((t.strip(emoji_free) == "") & (t.strip(c) != "")).alias("only_emoji"))


def conflicting(df: DataFrame, key: Column, label: str) -> DataFrame:
    """Keys that carry more than one label, with how many rows and labels."""
    return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(label).alias("labels")).where("labels > 1")
