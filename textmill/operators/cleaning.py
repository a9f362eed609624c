"""Cleaning: flags, normalisation, exact deduplication, and the counts of every step."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..sources.store import written
from . import similarity


def flags(df: DataFrame, text: str, near_empty_below: int = 10) -> DataFrame:
    """``df`` with the noise flags of the raw text."""
    c = F.col(text)
    return df.withColumns({
        "is_near_empty": t.near_empty(c, near_empty_below), "has_latin": t.has_latin(c), "has_diacritics": t.has_diacritics(c),
        "has_elongation": t.has_elongation(c), "has_emoji": t.has_emoji(c)})


def noise_percentages(df: DataFrame, text: str) -> DataFrame:
    """One row: percent of rows with each kind of noise, before normalisation.  Null texts are left out."""
    c = F.col(text)
    pct = lambda p: F.round(F.avg(p.cast("int")) * 100, 4)
    return df.where(c.isNotNull()).agg(
        pct(t.has_latin(c)).alias("latin"), pct(t.has_diacritics(c)).alias("diacritics"), pct(t.has_elongation(c)).alias("elongated"), pct(t.has_emoji(c)).alias("emoji"))


def normalized(df: DataFrame, text: str, *keep: str, near_empty_below: int = 10) -> DataFrame:
    """Kept columns, the normalised ``text`` and ``is_near_empty`` of the raw one; null texts are dropped."""
    c = F.col(text)
    return df.where(c.isNotNull()).select(*keep, t.normalize(c).alias("text"), t.near_empty(c, near_empty_below).alias("is_near_empty"))


def keep_first(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The first row of every key in the given order.

    A minimum per key comes before the rows meet again, so a key with a third of all rows is
    combined on the map side and never gathered in one task."""
    keys = [key] if isinstance(key, str) else key
    other = [c for c in df.columns if c not in (*keys, order)]
    row = F.min_by(F.struct(*other), F.col(order)).alias("__r") if other else None
    out = df.groupBy(*keys).agg(F.min(order).alias(order), *([row] if row is not None else []))
    return out.select(*[F.col(f"__r.{c}").alias(c) if c in other else F.col(c) for c in df.columns])


def funnel(df: DataFrame, text: str, order: str) -> DataFrame:
    """One row of counts up to exact deduplication: raw rows, null texts, exact duplicates removed, rows left, near-empty ones of them.

    ``pipeline`` counts all steps."""
    n = normalized(df, text, order)
    counts = df.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(F.col(text).isNull()).alias("null_text"))
    per = n.groupBy("text").agg(F.count(F.lit(1)).alias("c"), F.min_by("is_near_empty", order).alias("e"))
    after = per.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("final_rows"), F.coalesce(F.sum(F.col("e").cast("long")), F.lit(0)).alias("final_near_empty"))
    return counts.crossJoin(after).select("raw_rows", "null_text", (F.col("rows") - F.col("final_rows")).alias("exact_removed"), "final_rows", "final_near_empty")


def pipeline(df: DataFrame, text: str, order: str, threshold: float = 0.9) -> DataFrame:
    """One row of counts of the whole cleaning: raw rows, null texts, near-empty raw texts, exact and near duplicates removed, rows left.

    Null texts are left out before all steps, so they count as nothing but null."""
    n = written(normalized(df, text, order), "normalized")
    first = written(keep_first(n.select(F.col(order).alias("id"), "text"), "text", "id"), "first")
    kept = similarity.fuzzy_keep_first(first, threshold)
    raw = df.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(F.col(text).isNull()).alias("null_text"))
    noted = n.agg(F.count(F.lit(1)).alias("texts"), F.count_if("is_near_empty").alias("near_empty_flagged"))
    counts = raw.crossJoin(noted).crossJoin(first.agg(F.count(F.lit(1)).alias("exact_rows"))).crossJoin(kept.agg(F.count(F.lit(1)).alias("final_rows")))
    return counts.select(
        "raw_rows", "null_text", "near_empty_flagged", (F.col("texts") - F.col("exact_rows")).alias("exact_removed"), (F.col("exact_rows") - F.col("final_rows")).alias("near_removed"), "final_rows")


def light_duplicates(df: DataFrame, text: str, label: str) -> DataFrame:
    """One row: duplicates by exact text, by light key, and light groups whose labels conflict."""
    rows = df.where(F.col(text).isNotNull()).select(F.col(text).alias("t"), F.md5(t.light_key(F.col(text))).alias("k"), F.col(label).alias("l"))
    by_text = rows.groupBy("t").count().agg(F.sum(F.col("count") - 1).alias("exact_duplicates"))
    by_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("l").alias("a"), F.max("l").alias("b")).agg(
        F.sum(F.col("n") - 1).alias("light_duplicates"), F.count_if((F.col("n") > 1) & (F.col("a") != F.col("b"))).alias("conflicting_groups"))
    return by_text.crossJoin(by_key)
