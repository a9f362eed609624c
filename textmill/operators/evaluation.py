"""Classification evaluation, parity of two score sets, latency statistics, metric comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LABELS, numeric_or_null


def confusion(df: DataFrame, truth: str, predicted: str, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """``truth``, ``predicted``, ``n`` over the whole domain squared."""
    spark = df.sparkSession
    cells = spark.createDataFrame([(a, b) for a in labels for b in labels], "truth string, predicted string")
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    return cells.join(counts, ["truth", "predicted"], "left").select("truth", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def class_report(df: DataFrame, truth: str, predicted: str, labels: tuple[str, ...] = LABELS, digits: int = 6) -> DataFrame:
    """``label``, ``precision``, ``recall``, ``f1``, ``support``; 0 where a denominator is 0."""
    one = df.agg(*(a for i, x in enumerate(labels) for a in (
        F.count_if((F.col(truth) == x) & (F.col(predicted) == x)).alias(f"tp{i}"), F.count_if(F.col(truth) == x).alias(f"t{i}"), F.count_if(F.col(predicted) == x).alias(f"p{i}"))))
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    rows = F.explode(F.array(*(F.struct(
        F.lit(x).alias("label"), F.round(zero(F.col(f"tp{i}"), F.col(f"p{i}")), digits).alias("precision"), F.round(zero(F.col(f"tp{i}"), F.col(f"t{i}")), digits).alias("recall"),
        F.round(zero(F.col(f"tp{i}") * 2, F.col(f"t{i}") + F.col(f"p{i}")), digits).alias("f1"), F.col(f"t{i}").alias("support")) for i, x in enumerate(labels)))).alias("x")
    return one.select(rows).select("x.*")


def overall(df: DataFrame, truth: str, predicted: str, by: str | None = None, digits: int = 6) -> DataFrame:
    """Rows, accuracy, macro-F1 (over labels that occur in truth or prediction) and weighted F1, within ``by`` if given.

    A slice of fewer than two rows or true labels has only its count."""
    keys = [by] if by else []
    pairs = df.groupBy(*keys, F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    per = pairs.select(*keys, F.explode(F.array(F.struct(F.col("t").alias("label"), F.lit(True).alias("is_t")), F.struct(F.col("p").alias("label"), F.lit(False).alias("is_t")))).alias("x"), (F.col("t") == F.col("p")).alias("hit"), "n")
    counts = per.groupBy(*keys, "x.label").agg(
        F.sum(F.when(F.col("x.is_t"), F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(~F.col("x.is_t"), F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("x.is_t") & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"))
    f1 = F.coalesce(F.try_divide(F.col("tp") * 2, F.col("t") + F.col("p")), F.lit(0.0))
    out = counts.groupBy(*keys).agg(F.sum("t").alias("n"), F.count_if(F.col("t") > 0).alias("true_labels"), F.sum("tp").alias("tp"), F.avg(f1).alias("macro"), F.sum(f1 * F.col("t")).alias("weighted"))
    enough = (F.col("n") >= 2) & (F.col("true_labels") >= 2) if by else F.lit(True)
    when = lambda c: F.when(enough, F.round(c, digits))
    return out.select(*keys, "n", when(F.try_divide("tp", "n")).alias("accuracy"), when(F.col("macro")).alias("f1_macro"), when(F.try_divide("weighted", "n")).alias("f1_weighted"))


def parity(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """One row: largest and mean absolute difference of two sets of score columns, and how often the highest agrees."""
    gaps = F.array(*(F.abs(F.col(a) - F.col(b)) for a, b in zip(left, right)))
    arg = lambda cols: F.array_position(F.array(*map(F.col, cols)), F.greatest(*map(F.col, cols)))
    mean = F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x) / len(left)
    return df.agg(F.round(F.max(F.array_max(gaps)), 6).alias("max_abs_diff"), F.round(F.avg(mean), 6).alias("mean_abs_diff"), F.round(F.avg((arg(left) == arg(right)).cast("int")), 6).alias("agreement"))


def percentiles(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Exact p50, p95 and p99 (linear interpolation) of a value per group."""
    p = F.percentile(value, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), p.alias("p")).select(*by, "n", *(F.round(F.col("p")[i], 6).alias(c) for i, c in enumerate(("p50", "p95", "p99"))))


def metric_diff(base: DataFrame, work: DataFrame, tolerance: float = 0.005, ignore: str | None = None) -> DataFrame:
    """``path``, ``metric``, ``old``, ``new``, ``diff``, ``status`` (ok, changed, added, removed, new_path) of two long tables.

    A path that only ``work`` has is new as a whole.  Keys that match ``ignore`` are left out."""
    paths = base.select("path").distinct().withColumn("known", F.lit(True))
    both = base.withColumnRenamed("value", "old").withColumn("b", F.lit(True)).join(work.withColumnRenamed("value", "new").withColumn("w", F.lit(True)), ["path", "metric"], "full")
    if ignore:
        both = both.where(~F.col("path").rlike(ignore) & ~F.col("metric").rlike(ignore))
    out = both.join(paths, "path", "left")
    diff = F.col("new") - F.col("old")
    status = F.when(F.col("known").isNull(), "new_path").when(F.col("b").isNull(), "added").when(F.col("w").isNull(), "removed").when(F.abs(diff) > tolerance, "changed").otherwise("ok")
    return out.select("path", "metric", F.round("old", 6).alias("old"), F.round("new", 6).alias("new"), F.round(diff, 6).alias("diff"), status.alias("status"))


def metric_gate(base: DataFrame, work: DataFrame, tolerance: float = 0.005, fail_on_new: bool = False, ignore: str | None = None) -> DataFrame:
    """``path``, ``metric``, ``old``, ``new``, ``diff``, ``status`` (PASS, FAIL, NEW), ``reason`` of two tables of metrics as text.

    A metric that one side lacks, or whose values are no numbers (true and false are none), fails; a path of which the base has nothing
    is NEW, or fails with ``fail_on_new``.  Metrics whose path or name matches ``ignore`` are left out."""
    rows = metric_changes(base, work, ignore).where(~F.col("ignored"))
    number = lambda c: numeric_or_null(F.col(c))
    diff = number("new") - number("old")
    reason = (
        F.when(~F.col("known"), "new_file").when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(diff.isNull(), "malformed")
        .when(F.abs(diff) > tolerance, "drift").otherwise("")
    )
    status = F.when(reason == "", "PASS").when(reason == "new_file", "FAIL" if fail_on_new else "NEW").otherwise("FAIL")
    return rows.select("path", "metric", "old", "new", F.round(diff, 6).alias("diff"), status.alias("status"), reason.alias("reason"))


def metric_changes(base: DataFrame, work: DataFrame, ignore: str | None = None) -> DataFrame:
    """Both tables of ``path``, ``metric``, ``value`` side by side, with ``known`` (the base has the path) and ``ignored``."""
    both = base.withColumnRenamed("value", "old").join(work.withColumnRenamed("value", "new"), ["path", "metric"], "full")
    out = both.join(base.select("path").distinct().withColumn("known", F.lit(True)), "path", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return out.withColumn("ignored", F.col("path").rlike(ignore) | F.col("metric").rlike(ignore) if ignore else F.lit(False))


def gate_summary(base: DataFrame, work: DataFrame, tolerance: float = 0.005, fail_on_new: bool = False, ignore: str | None = None) -> DataFrame:
    """One row: metrics compared, failed, new and ignored, and whether all passed."""
    n = metric_gate(base, work, tolerance, fail_on_new, ignore).agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col("status") == "FAIL").alias("failed"), F.count_if(F.col("status") == "NEW").alias("new"))
    left = metric_changes(base, work, ignore).agg(F.count_if("ignored").alias("ignored"))
    return n.crossJoin(left).withColumn("passed", F.col("failed") == 0)


def call_stats(calls: DataFrame, size: int, serial_seconds: float | None = None, overhead_seconds: float = 0.0) -> DataFrame:
    """One row over calls of ``items``, ``drain``, ``score`` (seconds): how full they were, how many items shared a call, items a second
    of work, and the speed against a serial run with the same overhead a call.  Without calls all but the counts are null."""
    work = F.sum(F.col("drain") + F.col("score"))
    one = calls.agg(F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"), F.avg(F.col("items") / size).alias("f"), F.percentile(F.col("items") / size, F.lit(0.5)).alias("p"), work.alias("w"))
    out = one.select("batches", "items", F.round("f", 6).alias("fill_ratio"), F.round("p", 6).alias("fill_p50"), F.round(F.try_divide("items", "batches"), 6).alias("amortization"), F.round("w", 6).alias("work_seconds"), F.round(F.try_divide("items", "w"), 6).alias("per_second"))
    if serial_seconds is None:
        return out
    spent = F.col("work_seconds") + F.col("batches") * overhead_seconds
    return out.withColumns({"speedup": F.round(F.try_divide(F.lit(serial_seconds), F.col("work_seconds")), 6), "speedup_with_overhead": F.round(F.try_divide(serial_seconds + F.col("items") * overhead_seconds, spent), 6)})


def throughput(df: DataFrame, seconds: str, *by: str) -> DataFrame:
    """Calls, seconds, and calls a second per group; null where no time passed."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("calls"), F.round(F.sum(seconds), 6).alias("seconds")).withColumn("per_second", F.round(F.try_divide("calls", "seconds"), 6))
