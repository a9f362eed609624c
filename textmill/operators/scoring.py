"""Batch scoring with a pluggable scorer, and what is derived from its probabilities."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import LABELS


def softmax(scores: Column) -> Column:
    """Stable soft-max of an array column."""
    shifted = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x)
    return F.transform(shifted, lambda x: x / total)


def with_decision(df: DataFrame, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """``df`` (one probability column per label) with ``predicted_label`` (first of the highest) and ``predicted_score``."""
    p = F.array(*(F.col(x) for x in labels))
    best = F.array_position(p, F.array_max(p))
    return df.withColumns({"predicted_label": F.element_at(F.array(*map(F.lit, labels)), best.cast("int")), "predicted_score": F.array_max(p)})


def scored(df: DataFrame, text: str, make_scorer: Callable[[], Callable[[list[str]], np.ndarray]], labels: tuple[str, ...] = LABELS) -> DataFrame:
    """``df`` with a probability per label from a scorer that is made once per worker.

    The scorer takes a list of texts and returns a matrix of one row per text; another number of
    rows is an error.  Null text is scored as an empty one."""
    schema = T.StructType([T.StructField(x, T.DoubleType()) for x in labels])

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = make_scorer()
        for s in batches:
            m = np.asarray(score([t or "" for t in s.tolist()]), dtype=float)
            if m.shape != (len(s), len(labels)):
                raise ValueError(f"scorer gave {m.shape} for {len(s)} texts and {len(labels)} labels")
            yield pd.DataFrame(m, columns=list(labels))

    return with_decision(df.withColumn("__p", run(F.col(text))).select("*", "__p.*").drop("__p"), labels)


def expression_scored(df: DataFrame, text: str, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """``df`` with probabilities from a fixed expression over the text's length and words: a stand-in
    model that stays in the JVM and can be said in SQL."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    logits = [(n % 7) / 7.0, (n % 5) / 5.0, (n % 3) / 3.0]
    return with_decision(df.withColumn("__s", softmax(F.array(*logits))).withColumns({x: F.round(F.col("__s")[i], 9) for i, x in enumerate(labels)}).drop("__s"), labels)


def summary(df: DataFrame, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """One row: rows, mean and median confidence, and the share of every predicted label."""
    share = [F.round(F.coalesce(F.try_divide(F.count_if(F.col("predicted_label") == x), F.count(F.lit(1))), F.lit(0.0)), 6).alias(f"share_{x}") for x in labels]
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("predicted_score"), 6).alias("mean_score"), F.round(F.percentile("predicted_score", F.lit(0.5)), 6).alias("median_score"), *share)


def class_counts(df: DataFrame, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """``label``, ``n``, ``share`` of every predicted label, 0 for those that don't occur."""
    one = df.agg(F.count(F.lit(1)).alias("all_n"), *(F.count_if(F.col("predicted_label") == x).alias(f"c{i}") for i, x in enumerate(labels)))
    cells = F.array(*(F.struct(F.lit(x).alias("label"), F.col(f"c{i}").alias("n")) for i, x in enumerate(labels)))
    return one.select("all_n", F.explode(cells).alias("x")).select("x.*", F.round(F.coalesce(F.try_divide("x.n", "all_n"), F.lit(0.0)), 6).alias("share"))
