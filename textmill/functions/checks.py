"""Checks that come out as rows, and small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import LABELS


def missing_from_domain(df: DataFrame, column: str, domain: tuple[str, ...]) -> DataFrame:
    """The values of a domain that no row holds: empty if the domain is complete."""
    all_ = df.sparkSession.createDataFrame([(v,) for v in domain], "value string")
    return all_.join(df.select(F.col(column).alias("value")).distinct(), "value", "left_anti")


def response_violation(label: Column, score: Column, floor: float = 0.0) -> Column:
    """What is wrong with a prediction, or null: its label, or its score outside [floor, 1]."""
    return F.when(label.isNull() | ~label.isin(*LABELS), "label").when(score.isNull() | F.isnan(score), "score_missing").when((score < 0) | (score > 1), "score_range").when(score < floor, "score_floor")


def encode(label: Column, domain: tuple[str, ...] = LABELS) -> Column:
    """The place of a label in its domain, null for others."""
    return F.nullif(F.array_position(F.array(*map(F.lit, domain)), label), F.lit(0)) - 1


def same_labels(a: Column, b: Column) -> Column:
    """Whether two lists of (label, score) name the same labels in the same order."""
    return F.transform(a, lambda x: x["label"]) == F.transform(b, lambda x: x["label"])


def soft_loss(student: Column, teacher: Column, truth: Column, alpha: float, temperature: float) -> Column:
    """Per-row distillation loss: alpha * cross entropy + (1 - alpha) * T^2 * KL(teacher || student) of logits."""
    from ..operators.scoring import softmax

    warm = lambda c: softmax(F.transform(c, lambda x: x / temperature))
    ce = -F.log(F.element_at(softmax(student), truth.cast("int") + 1))
    kl = F.aggregate(F.zip_with(warm(teacher), warm(student), lambda p, q: p * F.log(p / q)), F.lit(0.0), lambda a, x: a + x)
    return ce * alpha + kl * ((1 - alpha) * temperature**2)


def noise(*p95: Column) -> Column:
    """How far repeated measurements lie apart, relative to the least."""
    return F.try_divide(F.greatest(*p95) - F.least(*p95), F.least(*p95))


def newest_per(df: DataFrame, by: str, order: str, keep: int) -> DataFrame:
    """The last ``keep`` rows of every group: a bounded history."""
    from pyspark.sql import Window

    return df.withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(order)))).where(F.col("__r") <= keep).drop("__r")


def label_ids(df: DataFrame, column: str, id2label: dict[int, str] | None = None) -> DataFrame:
    """``label``, ``id``: of a given map in the order of its ids, else the labels that occur, numbered in the order of their text from 0.

    The labels that occur are few; a label a map lacks has no row."""
    spark = df.sparkSession
    if id2label:
        return spark.createDataFrame([(v, int(k)) for k, v in sorted(id2label.items(), key=lambda x: int(x[0]))], "label string, id int")
    from pyspark.sql import Window

    seen = df.where(F.col(column).isNotNull()).select(F.col(column).alias("label")).distinct()
    return seen.select("label", (F.row_number().over(Window.orderBy("label")) - 1).cast("int").alias("id"))
