"""Queries of the training-data operators, each over its whole tables with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import consensus, crosssplit, history, langid, lookalike, mixing, neardup, oracle, packing, pii, sharedspans, tokens
from ..sources.store import shared_folder, written


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


DAY = "datediff(try_cast({} as date), date'1970-01-01')"  # null where it is no day


def _consensus(spark: SparkSession, d: str) -> consensus.Consensus:
    feedback, overrides = _read(spark, d, "feedback"), _read(spark, d, "overrides")
    item = F.col("review_id").alias("item")
    raw = feedback.select(item, F.col("agent_id").alias("agent"), F.col("corrected_label").alias("label")).unionByName(
        overrides.select(item, F.col("second_agent_id").alias("agent"), F.col("second_label").alias("label")))
    return consensus.Consensus(consensus.votes_of(raw, overrides.select(item, F.col("adjudicated_label").alias("label"))))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _consensus(spark, d).items().where("agents >= 3 AND labels > 1").select(F.col("item").alias("review_id"), "label")


def p1_consensus(spark: SparkSession, d: str) -> DataFrame:
    return _consensus(spark, d).items().withColumns({c: F.round(c, 6) for c in ("probability", "agreement")}).withColumnRenamed("item", "review_id")


def p1_agreement(spark: SparkSession, d: str) -> DataFrame:
    return _consensus(spark, d).items().select(F.col("item").alias("review_id"), "agents", F.col("labels").cast("long").alias("labels"), F.round("agreement", 6).alias("agreement"), "ruled")


def p1_agents(spark: SparkSession, d: str) -> DataFrame:
    return _consensus(spark, d).agents().withColumns({c: F.round(c, 6) for c in ("accuracy", "error_bound", "weight", "confidence")}).withColumnRenamed("agent", "agent_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.lookalike_pairs(_read(spark, d, "final_data"), "review_id", "review_description")


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.lookalike_groups(_read(spark, d, "final_data"), "review_id", "review_description")


def p2_unified(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.unified(_read(spark, d, "final_data").select("review_id", "review_description"), "review_description").select("review_id", "unified")


def p2_confusable_tokens(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.token_report(_read(spark, d, "final_data"), "review_id", "review_description")


def _languages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(documents with their segments, splits with their language), each beside the given label."""
    docs, splits = _read(spark, d, "documents"), _read(spark, d, "splits")
    profiles = langid.fit(docs, "text", "lang", "doc_id")
    return langid.detect_lines(docs, "doc_id", "text", profiles, "lang"), langid.detect(splits, "row_id", "text", profiles, "dialect", "text")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    docs, splits = _languages(spark, d)
    named = langid.canonical_label(F.col("given"))
    wrong = docs.where((F.col("seg_no") > 0) | named.isNull() | (named != F.col("lang")))
    blank = F.trim(F.coalesce("dialect", F.lit(""))) == ""
    meant = F.when(F.lower(F.trim("dialect")) == "arabizi", "ar-latn").otherwise("ar")
    words = F.size(F.filter(F.split("text", r"(?U)\s+"), lambda w: w != ""))
    off = splits.where((words >= 5) & (blank | (meant != F.col("lang"))))
    known = F.col("lang").isin(*langid.LANGS)
    return wrong.where(known).select(F.lit("documents").alias("origin"), "record_id", "seg_no", "lang").unionByName(
        off.where(known).select(F.lit("splits").alias("origin"), "record_id", F.lit(0).cast("long").alias("seg_no"), "lang"))


def p3_languages(spark: SparkSession, d: str) -> DataFrame:
    docs, splits = _languages(spark, d)
    return docs.select(F.lit("documents").alias("origin"), "record_id", "seg_no", "lang", F.round("confidence", 6).alias("confidence")).unionByName(
        splits.select(F.lit("splits").alias("origin"), "record_id", F.lit(0).cast("long").alias("seg_no"), "lang", F.round("confidence", 6).alias("confidence")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_pairs(_read(spark, d, "final_data"), "review_id", "review_description")


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_groups(_read(spark, d, "final_data"), "review_id", "review_description")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.found_kinds(_read(spark, d, "feedback"), "feedback_row", "text", "note")


def p5_spans(spark: SparkSession, d: str) -> DataFrame:
    return pii.found_spans(_read(spark, d, "feedback"), "feedback_row", "text", "note")


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redacted(_read(spark, d, "feedback").select("feedback_row", "text", "note"), "text", "note")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return crosssplit.cross_pairs(_read(spark, d, "splits"), "row_id", "text", "split = 'train'")


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    return crosssplit.cross_counts(_read(spark, d, "splits"), "row_id", "text", "split", "source")


def _history(spark: SparkSession, d: str) -> history.HistoryIndex:
    """The accepted history in an index of its own, in the order of its days."""
    index = history.HistoryIndex(spark, f"{shared_folder(spark)}/history-{uuid.uuid4().hex}")
    index.add(_read(spark, d, "train_feedback"), "override_id", "text", DAY.format("substr(captured_at, 1, 10)"))
    return index


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    found = _history(spark, d).check(_read(spark, d, "feedback"), "feedback_row", "text", DAY.format("batch_day"))
    return found.select("feedback_row", F.col("held").alias("override_id"))


def p7_repeats(spark: SparkSession, d: str) -> DataFrame:
    found = _history(spark, d).repeats(_read(spark, d, "feedback"), "feedback_row", "text", DAY.format("batch_day"))
    return found.select("feedback_row", "repeats", F.col("held").alias("override_id"), F.round("similarity", 6).alias("similarity"))


def _sizes(spark: SparkSession, d: str, *keep: str) -> DataFrame:
    counted = tokens.token_counts(_read(spark, d, "documents"), "text", "doc_id", *keep)
    return written(counted.withColumnRenamed("doc_id", "id"), "tokens")


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    kinds = _read(spark, d, "containers").select(F.col("container_kind").alias("kind"), F.col("capacity_tokens").alias("capacity"))
    return packing.packed(_sizes(spark, d), kinds), kinds


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)[0].select(F.col("kind").alias("container_kind"), "container", F.col("id").alias("doc_id"), F.col("piece").alias("piece_no"), F.col("length").alias("tokens"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    filled, kinds = _packed(spark, d)
    return packing.containers(filled, kinds).withColumnRenamed("kind", "container_kind")


def p8_unused(spark: SparkSession, d: str) -> DataFrame:
    filled, kinds = _packed(spark, d)
    per = packing.containers(filled, kinds).groupBy("kind").agg(F.count(F.lit(1)).alias("containers"), F.sum("pieces").alias("pieces"), F.sum("used").alias("used_tokens"), F.sum("unused").alias("unused_tokens"))
    return per.select(F.col("kind").alias("container_kind"), "containers", "pieces", "used_tokens", "unused_tokens", F.round(F.col("unused_tokens") / (F.col("used_tokens") + F.col("unused_tokens")), 6).alias("unused_part"))


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per kind what must be 0: tokens lost, tokens twice, containers over their capacity, documents split that would fit, numbers left out."""
    sizes = _sizes(spark, d)
    kinds = _read(spark, d, "containers").select(F.col("container_kind").alias("kind"), F.col("capacity_tokens").alias("capacity"))
    filled = written(packing.packed(sizes, kinds), "filled")
    per_doc = filled.groupBy("kind", "id").agg(F.sum("length").alias("placed"), F.count(F.lit(1)).alias("pieces"), F.countDistinct("piece").alias("numbers"))
    wanted = sizes.where("tokens > 0").crossJoin(F.broadcast(kinds))  # kinds: a parameter table
    docs = wanted.join(per_doc.hint("merge"), ["kind", "id"], "left").groupBy("kind").agg(
        F.sum(F.greatest(F.col("tokens") - F.coalesce("placed", F.lit(0)), F.lit(0))).alias("lost"), F.sum(F.greatest(F.coalesce("placed", F.lit(0)) - F.col("tokens"), F.lit(0))).alias("twice"),
        F.count_if((F.col("tokens") <= F.col("capacity")) & (F.col("pieces") > 1)).alias("split"), F.count_if(F.col("pieces") != F.col("numbers")).alias("renumbered"))
    full = packing.containers(filled, kinds).groupBy("kind").agg(F.count_if(F.col("unused") < 0).alias("over"), (F.max("container") + 1 - F.count(F.lit(1))).alias("gaps"))
    joined = kinds.select("kind").join(docs, "kind", "left").join(full, "kind", "left")
    return joined.select(F.col("kind").alias("container_kind"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("lost", "twice", "split", "renumbered", "over", "gaps")))


def _mix(spark: SparkSession, d: str) -> mixing.Mix:
    return mixing.Mix(_sizes(spark, d, "source"), _read(spark, d, "mix_targets"))


def p9_draw(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).draw().withColumnRenamed("id", "doc_id")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).shares()


def p9_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per target source what must be 0: documents over their repeats or of another source; and whether the draw is within one document of what was wanted."""
    sizes = _sizes(spark, d, "source")
    mix = mixing.Mix(sizes, _read(spark, d, "mix_targets"))
    targets = _read(spark, d, "mix_targets").select("source", "max_repeats")
    largest = sizes.groupBy("source").agg(F.max("tokens").alias("largest"))
    over = mix.draw().join(F.broadcast(targets), "source").groupBy("source").agg(F.count_if(F.col("repeats") > F.col("max_repeats")).alias("over"))  # targets: a parameter table
    out = mix.shares().join(over, "source", "left").join(largest, "source", "left")
    near = F.abs(F.col("drawn_tokens") - F.col("wanted_tokens")) <= F.coalesce("largest", F.lit(0))
    return out.select("source", F.coalesce("over", F.lit(0)).alias("over_repeats"), near.alias("as_wanted"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sharedspans.Shared(_read(spark, d, "documents"), "doc_id", "text").pairs()


def p10_coverage(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents")
    return sharedspans.Shared(docs, "doc_id", "text").coverage(docs, "text")


def p10_spans(spark: SparkSession, d: str) -> DataFrame:
    return sharedspans.Shared(_read(spark, d, "documents"), "doc_id", "text").spans().withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
