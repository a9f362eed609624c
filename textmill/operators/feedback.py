"""Human feedback: ids, votes per text, agreement, capped and idempotent merging, error rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

# The column order of merged feedback.
MERGED = ("text", "label", "company", "is_near_empty", "dialect", "dialect_confidence", "source", "guideline_version", "model_label",
          "model_version", "captured_at", "override_id", "qa_status", "corroborated_by")


def with_ids(df: DataFrame) -> DataFrame:
    """``df`` with the content id recomputed from text, model label, corrected label and agent."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    return df.withColumn("content_id", t.content_id(t.strip(c("text")), c("model_label"), c("corrected_label"), c("agent_id")))


def keyed(df: DataFrame) -> DataFrame:
    """``df`` with ``norm`` (normalised text) and ``key``, and the coerced labels."""
    return df.withColumn("norm", t.normalize(F.coalesce(F.col("text"), F.lit("")))).withColumns({"key": t.text_key(F.col("norm")), "lab": t.coerce_label(F.col("corrected_label"))})


def votes(df: DataFrame, least: int = 2) -> DataFrame:
    """One row per ``key``: ``agents``, ``consistent_agents``, ``agreed_label`` (held by at least ``least`` agents who
    never contradict themselves there; first by name, '' if none) and its ``voters`` joined by ';'.

    Two levels of combining aggregates: first per (key, agent), so a key with a third of all rows is
    reduced to its agents before anything is gathered."""
    said = df.where((F.trim("agent_id") != "") & (F.col("lab") != "")).groupBy("key", F.trim("agent_id").alias("agent")).agg(F.min("lab").alias("a"), F.max("lab").alias("b"))
    per_label = said.groupBy("key", F.when(F.col("a") == F.col("b"), F.col("a")).alias("lab")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("agent")), ";").alias("voters"))
    agreed = F.min(F.when(F.col("lab").isNotNull() & (F.col("n") >= least), F.struct("lab", "voters")))
    return per_label.groupBy("key").agg(F.sum("n").alias("agents"), F.sum(F.when(F.col("lab").isNotNull(), F.col("n")).otherwise(0)).alias("consistent_agents"), agreed.alias("x")).select(
        "key", "agents", "consistent_agents", F.coalesce("x.lab", F.lit("")).alias("agreed_label"), F.coalesce("x.voters", F.lit("")).alias("voters"))


def rulings(df: DataFrame) -> DataFrame:
    """``key``, ``ruling``: the one label its rulings name, '' if none or several."""
    lab = t.coerce_label(F.lower("adjudicated_label"))
    return df.groupBy("key").agg(F.min(F.when(lab != "", lab)).alias("a"), F.max(F.when(lab != "", lab)).alias("b")).select("key", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise("").alias("ruling"))


def one_per_key(df: DataFrame, order: list[str]) -> DataFrame:
    """The first row of every key in the given order, found by a combining aggregate."""
    other = [c for c in df.columns if c != "key"]
    return df.groupBy("key").agg(F.min_by(F.struct(*other), F.struct(*order)).alias("r")).select("key", "r.*")


def capped(df: DataFrame, label: str, capped_label: str, most: int, order: list[str]) -> DataFrame:
    """``df`` with at most ``most`` rows of one label, the first in the given order; a negative ``most`` means no cap."""
    if most < 0:
        return df
    few = df.where(F.col(label) == capped_label).orderBy(*order).limit(most)
    return df.where(~F.col(label).eqNullSafe(F.lit(capped_label))).unionByName(few)


def not_yet_merged(new: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of ``new`` whose text key is not held, with ``key``."""
    key = lambda d: t.text_key(t.normalize(F.coalesce(d["text"], F.lit(""))))
    return new.withColumn("key", key(new)).join(held.select(key(held).alias("key")).distinct(), "key", "left_anti")


def merged(held: DataFrame, new: DataFrame, order: tuple[str, ...] = ("captured_at", "override_id")) -> DataFrame:
    """Held rows, and of every text key that is not held the first new row, in the fixed columns: merging twice changes nothing.

    A column that ``new`` lacks is '' where it is text, else null."""
    empty = lambda c: F.lit("") if held.schema[c].dataType.simpleString() == "string" else F.lit(None).cast(held.schema[c].dataType)
    fill = lambda d: d.select(*(F.col(c) if c in d.columns else empty(c).alias(c) for c in MERGED))
    return fill(held).unionByName(fill(one_per_key(not_yet_merged(new, held), list(order))))


def error_rates(df: DataFrame, predicted: str, corrected: str, domain: tuple[str, ...] = t.LABELS) -> DataFrame:
    """``label`` (of the model, and 'all'), ``n``, ``wrong``, ``error_rate`` (null where nothing was seen)."""
    one = df.agg(*(a for i, x in enumerate(domain) for a in (F.count_if(F.col(predicted) == x).alias(f"n{i}"), F.count_if((F.col(predicted) == x) & ~F.col(corrected).eqNullSafe(F.col(predicted))).alias(f"w{i}"))))
    cells = [F.struct(F.lit(x).alias("label"), F.col(f"n{i}").alias("n"), F.col(f"w{i}").alias("wrong")) for i, x in enumerate(domain)]
    total = F.struct(F.lit("all").alias("label"), sum((F.col(f"n{i}") for i in range(1, len(domain))), F.col("n0")).alias("n"), sum((F.col(f"w{i}") for i in range(1, len(domain))), F.col("w0")).alias("wrong"))
    return one.select(F.explode(F.array(*cells, total)).alias("x")).select("x.*", F.round(F.try_divide("x.wrong", "x.n"), 5).alias("error_rate"))


def first_per_day(df: DataFrame, day: str, key: str, order: str) -> DataFrame:
    """Repeats of an id within a day dropped: the first in order stays."""
    other = [c for c in df.columns if c not in (day, key)]
    return df.groupBy(day, key).agg(F.min_by(F.struct(*other), F.col(order)).alias("r")).select(day, key, "r.*")
