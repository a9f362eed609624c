"""Reviewed feedback merged into accumulated training rows, and the report over it."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from . import dialect
from .feedback import MERGED

# Statuses of reviewed rows in their order, those that train, and the source of merged rows.
STATUSES = ("corroborated", "adjudicated", "disputed", "single_agent", "confirmation", "leak", "duplicate", "near_empty")
TRAINABLE = ("corroborated", "adjudicated")
SOURCE = "customer_service_feedback"
NEUTRAL_CAP = 50


def key_of(text: Column) -> Column:
    """The key two texts share that differ in white space, vowel marks, runs and case only; '' for null."""
    return t.text_key(t.normalize(F.coalesce(text, F.lit(""))))


def final_label(adjudicated: Column, corrected: Column) -> Column:
    """The adjudicated label where it is one of the domain, else the corrected one."""
    ruled = t.coerce_label(F.lower(adjudicated))
    return F.when(ruled != "", ruled).otherwise(corrected)


def with_merged(reviewed: DataFrame, held: DataFrame) -> DataFrame:
    """``reviewed`` with ``key`` and ``merged``: whether a held row has the same key.  A held key counts once, however often it is held."""
    keys = held.select(key_of(F.col("text")).alias("key")).distinct().withColumn("merged", F.lit(True))
    return reviewed.withColumn("key", key_of(F.col("text"))).join(keys, "key", "left").withColumn("merged", F.coalesce("merged", F.lit(False)))


def candidates(reviewed: DataFrame, held: DataFrame) -> DataFrame:
    """Reviewed rows whose key is not held and whose status trains, with ``final``."""
    fresh = with_merged(reviewed, held).where(~F.col("merged") & F.col("status").isin(*TRAINABLE))
    return fresh.withColumn("final", final_label(F.col("adjudicated_label"), F.col("corrected_label")))


def one_a_key(eligible: DataFrame) -> DataFrame:
    """The first row of every key by ``captured_at`` and ``override_id``, by a combining minimum."""
    other = [c for c in eligible.columns if c != "key"]
    return eligible.groupBy("key").agg(F.min_by(F.struct(*other), F.struct("captured_at", "override_id")).alias("r")).select("key", "r.*")


def capped(rows: DataFrame, cap: int = NEUTRAL_CAP) -> DataFrame:
    """At most ``cap`` neutral rows, the first by ``captured_at`` and ``override_id``; a negative cap is none."""
    if cap < 0:
        return rows
    neutral = rows.where("final = 'neutral'").orderBy("captured_at", "override_id").limit(cap)  # a bounded sort: each task keeps its first ``cap``
    return rows.where("final <> 'neutral' OR final IS NULL").unionByName(neutral)


def fresh_rows(reviewed: DataFrame, held: DataFrame, cap: int = NEUTRAL_CAP) -> DataFrame:
    """The rows a merge adds, in the fixed columns, with variety and provenance; nothing where all is held."""
    rows = capped(one_a_key(candidates(reviewed, held)), cap)
    tagged = dialect.tagged(rows, "text")
    made = {"label": F.col("final"), "is_near_empty": F.lit(False), "source": F.lit(SOURCE), "qa_status": F.col("status"), "corroborated_by": F.col("corroborating_agents")}
    return tagged.withColumns(made).select(*MERGED)


def merge(reviewed: DataFrame, held: DataFrame, cap: int = NEUTRAL_CAP) -> DataFrame:
    """Held rows and the fresh ones: merging again adds nothing, held rows are never changed."""
    return held.select(*MERGED).unionByName(fresh_rows(reviewed, held, cap))


def merge_summary(reviewed: DataFrame, held: DataFrame, cap: int = NEUTRAL_CAP) -> DataFrame:
    """One row: candidates not yet held, eligible ones, rows collapsed to one a key, put out by the cap, accepted, shares of the labels, and all rows after."""
    seen = with_merged(reviewed, held).where(~F.col("merged"))
    first = one_a_key(candidates(reviewed, held))
    counts = seen.agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("status").isin(*TRAINABLE)).alias("eligible"))
    ones = first.agg(F.count(F.lit(1)).alias("ones"), F.count_if(F.col("final") == "neutral").alias("neutral"), *(F.count_if(F.col("final") == x).alias(f"n_{x}") for x in t.LABELS))
    over = F.greatest(F.col("neutral") - cap, F.lit(0)) if cap >= 0 else F.lit(0)
    kept = {x: F.col(f"n_{x}") - (over if x == "neutral" else 0) for x in t.LABELS}
    accepted = F.col("ones") - over
    total = reduce(add, kept.values())
    return counts.crossJoin(ones).crossJoin(held.agg(F.count(F.lit(1)).alias("held"))).select(
        "candidates", "eligible", (F.col("eligible") - F.col("ones")).alias("collapsed"), over.cast("long").alias("suppressed"), accepted.cast("long").alias("accepted"),
        *(F.round(F.coalesce(F.try_divide(kept[x], total), F.lit(0.0)), 6).alias(f"share_{x}") for x in t.LABELS), (F.col("held") + accepted).cast("long").alias("cumulative"))


def pending(reviewed: DataFrame, held: DataFrame) -> DataFrame:
    """One row: trainable rows, those whose key is not held yet, and whether there is anything to merge."""
    return with_merged(reviewed, held).where(F.col("status").isin(*TRAINABLE)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("merged")).alias("pending")).withColumn("has_new", F.col("pending") > 0)


def status_counts(reviewed: DataFrame) -> DataFrame:
    """``status``, ``n`` over the whole domain, 0 for those that don't occur."""
    one = reviewed.agg(*(F.count_if(F.col("status") == s).alias(f"c{i}") for i, s in enumerate(STATUSES)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(s).alias("status"), F.col(f"c{i}").alias("n")) for i, s in enumerate(STATUSES)))).alias("x")).select("x.*")


def report(raw: DataFrame, reviewed: DataFrame, held: DataFrame, cap: int = NEUTRAL_CAP) -> DataFrame:
    """One row: what was captured and corrected, what the review counts, error rates of the model, and the merge's summary.

    An empty capture has null rates.  Everything is one aggregate a table; the tables of one row each are put side by side."""
    model, corrected = t.coerce_label(F.col("model_label")), t.coerce_label(F.col("corrected_label"))
    seen = raw.select(model.alias("m"), corrected.alias("c"))
    wrong = F.col("m") != F.col("c")
    per = [a for x in t.LABELS for a in (F.count_if(F.col("m") == x).alias(f"n_{x}"), F.count_if((F.col("m") == x) & wrong).alias(f"wrong_{x}"))]
    captured = seen.agg(F.count(F.lit(1)).alias("n_raw"), *per)
    all_n, all_wrong = reduce(add, [F.col(f"n_{x}") for x in t.LABELS]), reduce(add, [F.col(f"wrong_{x}") for x in t.LABELS])
    captured = captured.select(
        "n_raw", all_wrong.alias("n_corrections"), (F.col("n_raw") - all_wrong).alias("n_confirmations"),
        *(F.round(F.try_divide(f"n_{x}", all_n), 6).alias(f"mix_{x}") for x in t.LABELS),
        *(F.round(F.try_divide(f"wrong_{x}", f"n_{x}"), 5).alias(f"error_{x}") for x in t.LABELS), F.round(F.try_divide(all_wrong, all_n), 5).alias("error_overall"))
    qa = reviewed.agg(*(F.count_if(F.col("status") == s).alias(f"status_{s}") for s in STATUSES), F.count_if(F.col("status").isin(*TRAINABLE)).alias("n_trainable"),
                      F.count_if(F.col("route") == "adjudicate_first").alias("n_adjudicate_first"))
    return captured.crossJoin(qa).crossJoin(merge_summary(reviewed, held, cap))
