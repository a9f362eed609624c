"""Queries of evaluation, parity, latency and metric comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import evaluation as ev
from ..operators import pairing, scoring
from ..streaming.pairing import replayed
from .catalog import query
from .panels import SCORE
from .tables import read

_DEC = SCORE.format(t="text", f="splits")


def _panel(spark, d):
    return scoring.expression_scored(read(spark, d, "splits"), "text")


@query("confusion_matrix", f"WITH {_DEC}, l AS (SELECT unnest(['positive', 'negative', 'neutral']) AS x) SELECT a.x AS truth, b.x AS predicted, (SELECT count(*) FROM decided WHERE label = a.x AND predicted_label = b.x) AS n FROM l a, l b".replace(", l AS", ", dom AS").replace("FROM l a, l b", "FROM dom a, dom b"))
def confusion_matrix(spark, d):
    return ev.confusion(_panel(spark, d), "label", "predicted_label")


_PER = "tp AS (SELECT x, (SELECT count(*) FROM decided WHERE label = x AND predicted_label = x) AS tp, (SELECT count(*) FROM decided WHERE label = x) AS t, (SELECT count(*) FROM decided WHERE predicted_label = x) AS p FROM (SELECT unnest(['positive', 'negative', 'neutral']) AS x))"


@query("class_report", f"WITH {_DEC}, {_PER} SELECT x AS label, round(coalesce(tp / nullif(p, 0), 0), 6) AS precision, round(coalesce(tp / nullif(t, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(t + p, 0), 0), 6) AS f1, t AS support FROM tp")
def class_report(spark, d):
    return ev.class_report(_panel(spark, d), "label", "predicted_label")


def _overall(by: str | None) -> str:
    k, g = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    cut = (lambda x: f"CASE WHEN sum(t) >= 2 AND count(*) FILTER (WHERE t > 0) >= 2 THEN {x} END") if by else (lambda x: x)
    return f"""WITH {_DEC}, u AS (SELECT {k}label AS x, 1 AS t, 0 AS p, (label = predicted_label)::INT AS hit FROM decided UNION ALL SELECT {k}predicted_label, 0, 1, 0 FROM decided),
c AS (SELECT {k}x, sum(t) AS t, sum(p) AS p, sum(hit) AS tp FROM u GROUP BY {k}x)
SELECT {k}sum(t)::BIGINT AS n, {cut("round(sum(tp) / sum(t), 6)")} AS accuracy, {cut("round(avg(2 * tp / (t + p)), 6)")} AS f1_macro, {cut("round(sum(2 * tp / (t + p) * t) / sum(t), 6)")} AS f1_weighted FROM c {g}"""


@query("overall_eval", _overall(None))
def overall_eval(spark, d):
    return ev.overall(_panel(spark, d), "label", "predicted_label")


@query("eval_by_dialect", _overall("dialect"))
def eval_by_dialect(spark, d):
    return ev.overall(_panel(spark, d), "label", "predicted_label", "dialect")


@query("score_parity", f"""WITH {_DEC}, r AS (SELECT *, round(positive, 2) AS p2, round(negative, 2) AS n2, round(neutral, 2) AS u2 FROM decided),
a AS (SELECT *, CASE WHEN p2 = greatest(p2, n2, u2) THEN 'positive' WHEN n2 = greatest(p2, n2, u2) THEN 'negative' ELSE 'neutral' END AS l2 FROM r)
SELECT round(max(greatest(abs(positive - p2), abs(negative - n2), abs(neutral - u2))), 6) AS max_abs_diff, round(avg((abs(positive - p2) + abs(negative - n2) + abs(neutral - u2)) / 3), 6) AS mean_abs_diff, round(avg((predicted_label = l2)::INT), 6) AS agreement FROM a""")
def score_parity(spark, d):
    rough = _panel(spark, d).withColumns({f"{x}_r": F.round(x, 2) for x in t.LABELS})
    return ev.parity(rough, list(t.LABELS), [f"{x}_r" for x in t.LABELS])


@query("latency_percentiles", "SELECT event_type, count(value) AS n, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events WHERE value IS NOT NULL GROUP BY event_type")
def latency_percentiles(spark, d):
    return ev.percentiles(read(spark, d, "events"), "value", "event_type")


@query("throughput", "SELECT event_type, count(*) AS calls, round(sum(value), 6) AS seconds, round(count(*) / round(sum(value), 6), 6) AS per_second FROM events GROUP BY event_type")
def throughput(spark, d):
    return ev.throughput(read(spark, d, "events"), "value", "event_type")


_LONG = "SELECT company AS path, lower(trim(rating)) AS metric, count(*)::DOUBLE AS value FROM final_data WHERE company IS NOT NULL AND rating IS NOT NULL AND review_id % 2 = {r} {more} GROUP BY 1, 2"


@query("metric_diff", f"""WITH b AS ({_LONG.format(r=0, more="AND company <> 'Qafzet'")}), w AS ({_LONG.format(r=1, more="AND lower(trim(rating)) <> 'neutral'")}),
f AS (SELECT coalesce(b.path, w.path) AS path, coalesce(b.metric, w.metric) AS metric, b.value AS old, w.value AS new FROM b FULL JOIN w ON b.path = w.path AND b.metric = w.metric)
SELECT path, metric, round(old, 6) AS old, round(new, 6) AS new, round(new - old, 6) AS diff,
  CASE WHEN path NOT IN (SELECT path FROM b) THEN 'new_path' WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'removed' WHEN abs(new - old) > 0.005 THEN 'changed' ELSE 'ok' END AS status FROM f""")
def metric_diff(spark, d):
    rows = read(spark, d, "final_data").where("company IS NOT NULL AND rating IS NOT NULL").select("review_id", F.col("company").alias("path"), F.lower(F.trim("rating")).alias("metric"))
    side = lambda df: df.groupBy("path", "metric").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return ev.metric_diff(side(rows.where("review_id % 2 = 0 AND path <> 'Qafzet'")), side(rows.where("review_id % 2 = 1 AND metric <> 'neutral'")))


_EV = """SELECT event_id, user_id::VARCHAR || '-' || strftime(date_trunc('hour', ts), '%Y%m%d%H') AS key, CASE WHEN event_id % 2 = 0 THEN 'stable' ELSE 'candidate' END AS worker, event_type AS label, ts,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE '["' || event_type || '"]' END AS said, event_id % 5 <> 0 AS shadow, event_id % 3 = 0 AS has_id FROM events"""


def telemetry(events):
    """Answers of two workers, made of the events: by parity of the event; a few without labels, not shadowed, or without a request id."""
    ts, n = F.col("ts").cast("timestamp"), F.col("event_id")
    key = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format(ts, "yyyyMMddHH"))
    labels = F.when(n % 11 == 0, F.array().cast("array<string>")).otherwise(F.array("event_type"))
    return events.select(
        key.alias("key"), F.when(n % 2 == 0, "stable").otherwise("candidate").alias("worker"), F.col("event_type").alias("label"), labels.alias("labels"), (n % 5 != 0).alias("shadow"),
        F.when(n % 3 == 0, key).otherwise("").alias("request_id"), ts.alias("ts"))


@query("paired_answers", f"""WITH e AS ({_EV}), g AS (SELECT key, min({{'ts': ts, 'label': label}}) FILTER (WHERE worker = 'stable') AS s, min({{'ts': ts, 'label': label}}) FILTER (WHERE worker = 'candidate') AS c FROM e GROUP BY key)
SELECT key, CASE WHEN s IS NULL THEN 'gap_stable' WHEN c IS NULL THEN 'gap_candidate' WHEN abs(epoch_us(s.ts) - epoch_us(c.ts)) > 1800000000 THEN CASE WHEN s.ts <= c.ts THEN 'gap_candidate' ELSE 'gap_stable' END
  WHEN s.label = c.label THEN 'agree' ELSE 'disagree' END AS outcome FROM g""")
def paired_answers(spark, d):
    return pairing.pairs(telemetry(read(spark, d, "events")), 1800)


# the state machine, one answer of every key at a time
REPLAY = f"""WITH RECURSIVE e AS (SELECT *, epoch_ms(ts) AS ms, row_number() OVER (PARTITION BY key ORDER BY epoch_ms(ts), worker, said) AS i FROM ({_EV}) WHERE shadow OR has_id),
m AS (SELECT max(ms) AS final_ms FROM e),
st(key, i, created, s, c, sh, closed, out) AS (
  SELECT key, 0::BIGINT, NULL::BIGINT, NULL::VARCHAR, NULL::VARCHAR, false, NULL::VARCHAR, NULL::VARCHAR FROM e WHERE i = 1
  UNION ALL
  SELECT key, i, CASE WHEN full_ THEN NULL ELSE created END, CASE WHEN full_ THEN NULL ELSE s END, CASE WHEN full_ THEN NULL ELSE c END, CASE WHEN full_ THEN false ELSE sh END, closed,
    CASE WHEN full_ AND sh AND s <> '' AND c <> '' THEN CASE WHEN s = c THEN 'agree' ELSE 'disagree' END END
  FROM (SELECT *, s IS NOT NULL AND c IS NOT NULL AS full_ FROM (
    SELECT e.key, e.i, CASE WHEN st.created IS NULL OR e.ms - st.created >= 1800000 THEN e.ms ELSE st.created END AS created,
      CASE WHEN e.worker = 'stable' THEN e.said WHEN e.ms - st.created < 1800000 THEN st.s END AS s, CASE WHEN e.worker = 'candidate' THEN e.said WHEN e.ms - st.created < 1800000 THEN st.c END AS c,
      e.shadow OR (coalesce(e.ms - st.created < 1800000, false) AND st.sh) AS sh,
      CASE WHEN e.ms - st.created >= 1800000 AND st.sh THEN CASE WHEN st.c IS NULL THEN 'gap_candidate' ELSE 'gap_stable' END END AS closed
    FROM st JOIN e ON e.key = st.key AND e.i = st.i + 1))),
o AS (SELECT key, closed AS outcome FROM st WHERE closed IS NOT NULL UNION ALL SELECT key, out FROM st WHERE out IS NOT NULL
  UNION ALL SELECT st.key, CASE WHEN c IS NULL THEN 'gap_candidate' ELSE 'gap_stable' END FROM st JOIN (SELECT key, max(i) AS i FROM e GROUP BY key) z ON st.key = z.key AND st.i = z.i, m WHERE created + 1800000 <= final_ms AND sh)"""


@query("replayed_pairs", REPLAY + " SELECT key, outcome FROM o")
def replayed_pairs(spark, d):
    return replayed(telemetry(read(spark, d, "events")), 1800)


@query("window_metrics", "SELECT time_bucket(INTERVAL 60 MINUTES, ts) AS window_start, event_type, count(*) AS requests, round(avg((value > 100)::INT), 6) AS error_rate, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1, 2")
def window_metrics(spark, d):
    m = pairing.window_metrics(read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), F.col("ts"), F.col("value") > 100, F.col("value"), 60, "event_type")
    return m.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
