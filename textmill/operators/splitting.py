"""Stratified splits, deterministic samples, and proportions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ordering_hash


def ranked(df: DataFrame, stratum: str, key: Column, parts: int = 256) -> DataFrame:
    """``df`` with ``rank`` (from 1) and ``size`` of its row in the stratum, in the order of ``key``.

    ``key`` is a uniform hexadecimal hash.  Its first two digits cut every stratum into 256 ranges; counts of
    the ranges give each one's offset, so a stratum with most of the rows is ranked by many tasks."""
    rows = df.withColumn("__k", key).withColumn("__part", F.substring("__k", 1, 2))
    per = rows.groupBy(stratum, "__part").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(stratum)
    offsets = per.select(F.col(stratum).alias("__s"), F.col("__part").alias("__p"), F.sum("__n").over(w).alias("size"),
                         F.coalesce(F.sum("__n").over(w.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    local = rows.withColumn("__r", F.row_number().over(Window.partitionBy(stratum, "__part").orderBy("__k")))
    joined = local.join(offsets, local[stratum].eqNullSafe(offsets["__s"]) & (local["__part"] == offsets["__p"]))
    return joined.withColumn("rank", F.col("__r") + F.col("__before")).drop("__k", "__part", "__r", "__before", "__s", "__p")


def stratified(df: DataFrame, label: str, key: str, test: float = 0.2, val: float = 0.1, seed: int = 42) -> DataFrame:
    """``df`` with ``part``: test, val or train, each with its share of every label; null labels are left out."""
    r = ranked(df.where(F.col(label).isNotNull()), label, ordering_hash(seed, F.col(key)))
    tests = F.round(F.col("size") * test)
    vals = F.round((F.col("size") - tests) * (val / (1 - test)))
    return r.withColumn("part", F.when(F.col("rank") <= tests, "test").when(F.col("rank") <= tests + vals, "val").otherwise("train")).drop("rank", "size")


def proportions(df: DataFrame, by: str | None, column: str, digits: int = 5) -> DataFrame:
    """Share of each value, within ``by`` if given; null values count under their own row."""
    groups = [by] if by else []
    counts = df.groupBy(*groups, column).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*groups) if groups else Window.partitionBy()  # over the groups' counts only
    return counts.select(*groups, column, "n", F.round(F.col("n") / F.sum("n").over(w), digits).alias("share"))


def domain_shares(df: DataFrame, column: str, domain: tuple[str, ...], digits: int = 6) -> DataFrame:
    """Share of every value of a domain among the rows that hold one, 0 for those that don't occur."""
    one = df.agg(*(F.count_if(F.col(column) == v).alias(f"c{i}") for i, v in enumerate(domain)))
    pairs = F.explode(F.array(*(F.struct(F.lit(v).alias("value"), F.col(f"c{i}").alias("n")) for i, v in enumerate(domain)))).alias("x")
    total = sum((F.col(f"c{i}") for i in range(1, len(domain))), F.col("c0"))
    return one.select(pairs, total.alias("t")).select("x.value", "x.n", F.round(F.coalesce(F.try_divide("x.n", "t"), F.lit(0.0)), digits).alias("share"))


def daily_sample(df: DataFrame, key: str, day: str, n: int, least: int = 0) -> DataFrame:
    """``n`` rows drawn for a day, the same for the same day; raises if there are fewer than ``least``."""
    if least and df.limit(least).count() < least:
        raise ValueError(f"fewer than {least} rows to sample from")
    return df.select(F.lit(day).alias("day"), "*").orderBy(ordering_hash(day, F.col(key))).limit(n)


def fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """One row, whatever the order of the rows: their number and a sum of hashes of their content.

    Pieces of 48 bits pass a long after about 65,536 rows, so they are summed as decimals; ``content`` is that
    sum in 64 bits with a sign (modulo 2**64), the plain sum as long as a long holds it."""
    row = F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns)), 256)
    piece = F.conv(F.substring(row, 1, 12), 16, 10).cast("decimal(20,0)")
    half = F.lit(Decimal(2**63))
    content = (F.pmod(F.sum(piece) + half, F.lit(Decimal(2**64))) - half).cast("long")
    return df.agg(F.count(F.lit(1)).alias("rows"), content.alias("content"))
