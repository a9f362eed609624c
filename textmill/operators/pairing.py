"""Pairing the answers of two workers to one request, and what a roll-out is judged by."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pairs(events: DataFrame, ttl_seconds: int = 30) -> DataFrame:
    """``key``, ``outcome`` (agree, disagree, gap_stable, gap_candidate), from ``events(key, worker, label, ts)``.

    The first answer of either worker counts; two answers more than ``ttl_seconds`` apart do not meet, and the
    later one's worker is the gap.  Two combining minima per key, no row is compared with another."""
    first = lambda w: F.min(F.when(F.col("worker") == w, F.struct("ts", "label")))
    g = events.where(F.coalesce(F.col("key"), F.lit("")) != "").groupBy("key").agg(first("stable").alias("s"), first("candidate").alias("c"))
    apart = F.abs(F.unix_micros(F.col("s.ts")) - F.unix_micros(F.col("c.ts"))) > ttl_seconds * 1_000_000
    outcome = (
        F.when(F.col("s").isNull(), "gap_stable").when(F.col("c").isNull(), "gap_candidate")
        .when(apart, F.when(F.col("s.ts") <= F.col("c.ts"), "gap_candidate").otherwise("gap_stable"))
        .when(F.col("s.label").eqNullSafe(F.col("c.label")), "agree").otherwise("disagree")
    )
    return g.select("key", outcome.alias("outcome"))


def agreement(paired: DataFrame) -> DataFrame:
    """One row: pairs, agreement among them, and the gaps."""
    n = F.count_if(F.col("outcome").isin("agree", "disagree"))
    return paired.agg(n.alias("pairs"), F.round(F.try_divide(F.count_if(F.col("outcome") == "agree"), n), 6).alias("agreement"), F.count_if(F.col("outcome").startswith("gap")).alias("gaps"))


def window_metrics(events: DataFrame, ts: Column, is_error: Column, latency: Column, minutes: int, *by: str) -> DataFrame:
    """Requests, error rate and p95 latency per time window and group."""
    w = F.window(ts, f"{minutes} minutes")
    g = events.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("requests"), F.round(F.avg(is_error.cast("int")), 6).alias("error_rate"), F.round(F.percentile(latency, F.lit(0.95)), 6).alias("p95"))
    return g.select(F.col("w.start").alias("window_start"), *by, "requests", "error_rate", "p95")


# Upper bounds of the latency histogram's buckets.
BUCKETS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0)


def histogram_quantile(q: float, counts: list[Column], bounds: tuple[float, ...] = BUCKETS) -> Column:
    """A quantile from bucket counts (one a bound, and one above all), in proportion within its bucket; the last
    bound where it lies above all, null without samples."""
    total = reduce(lambda a, b: a + b, counts)
    rank, below, out = total * q, F.lit(0), F.lit(bounds[-1])
    cases = []
    for i, hi in enumerate(bounds):
        lo = bounds[i - 1] if i else 0.0
        upto = below + counts[i]
        cases.append((rank <= upto, lo + (hi - lo) * F.try_divide(rank - below, counts[i])))
        below = upto
    for when, value in reversed(cases):
        out = F.when(when, value).otherwise(out)
    return F.when(total > 0, out)


def bucket_counts(latency: Column, bounds: tuple[float, ...] = BUCKETS) -> list[Column]:
    lows = (None, *bounds)
    return [F.count_if((latency <= hi) if lo is None else (latency > lo) & (latency <= hi)) for lo, hi in zip(lows, bounds)] + [F.count_if(latency > bounds[-1])]


def worker_counters(events: DataFrame, is_error: Column, latency: Column, bounds: tuple[float, ...] = BUCKETS) -> DataFrame:
    """``worker``, ``ingested``, ``errors``, ``latency_count``, ``latency_sum`` and cumulative bucket counts ``le_0``, ``le_1``, ...; negative latencies are not observed."""
    seen = F.when(latency >= 0, latency)
    le = [F.count_if(seen <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    return events.groupBy("worker").agg(F.count(F.lit(1)).alias("ingested"), F.count_if(is_error).alias("errors"), F.count(seen).alias("latency_count"), F.round(F.sum(seen), 6).alias("latency_sum"), *le)


def trailing_metrics(events: DataFrame, ts: Column, is_error: Column, latency: Column, minutes: int = 5, every: int = 1, bounds: tuple[float, ...] = BUCKETS) -> DataFrame:
    """``at``, ``worker``, ``requests``, ``error_rate``, ``p95``: what each worker did in the ``minutes`` before every instant (of ``every`` minutes);
    the percentile comes from the histogram."""
    w = F.window(ts, f"{minutes} minutes", f"{every} minutes")
    counts = [c.alias(f"b{i}") for i, c in enumerate(bucket_counts(latency, bounds))]
    g = events.groupBy(w.alias("w"), "worker").agg(F.count(F.lit(1)).alias("requests"), F.count_if(is_error).alias("errors"), *counts)
    p95 = histogram_quantile(0.95, [F.col(f"b{i}") for i in range(len(counts))], bounds)
    return g.select(F.col("w.end").alias("at"), "worker", "requests", F.round(F.try_divide("errors", "requests"), 6).alias("error_rate"), F.round(p95, 6).alias("p95"))


def instant(events: DataFrame, ts: Column, at: str, minutes: int, *names: str, by: str) -> DataFrame:
    """One row: how many events of each name there were in the ``minutes`` up to an instant, null where there was none."""
    until = F.lit(at).cast("timestamp")
    inside = (ts <= until) & (ts > until - F.expr(f"INTERVAL {minutes} MINUTES"))
    return events.where(inside).agg(*(F.nullif(F.count_if(F.col(by) == n), F.lit(0)).alias(n) for n in names))
