"""Queries of checks, calendars and small numeric expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import checks
from ..operators import scoring, splitting
from .catalog import query
from .panels import SCORE
from .tables import read


@query("missing_dialects", "SELECT v AS value FROM (SELECT unnest(['msa', 'egyptian', 'gulf', 'levantine', 'maghrebi', 'arabizi', 'sudanese']) AS v) WHERE v NOT IN (SELECT dialect FROM splits WHERE dialect IS NOT NULL)")
def missing_dialects(spark, d):
    return checks.missing_from_domain(read(spark, d, "splits"), "dialect", ("msa", "egyptian", "gulf", "levantine", "maghrebi", "arabizi", "sudanese"))


@query("score_violations", "SELECT feedback_row, CASE WHEN l IS NULL OR l NOT IN ('positive', 'negative', 'neutral') THEN 'label' WHEN s IS NULL THEN 'score_missing' WHEN s < 0 OR s > 1 THEN 'score_range' WHEN s < 0.6 THEN 'score_floor' END AS violation FROM (SELECT feedback_row, model_label AS l, try_cast(model_score AS DOUBLE) AS s FROM feedback)")
def score_violations(spark, d):
    return read(spark, d, "feedback").select("feedback_row", checks.response_violation(F.col("model_label"), F.col("model_score").try_cast("double"), 0.6).alias("violation"))


@query("label_ids", "SELECT row_id, CASE label WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 WHEN 'neutral' THEN 2 END::BIGINT AS label_id FROM splits")
def label_ids(spark, d):
    return read(spark, d, "splits").select("row_id", checks.encode(F.col("label")).alias("label_id"))


@query("soft_loss", """WITH n AS (SELECT row_id, length(coalesce(text, '')) AS n, CASE label WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 ELSE 2 END AS y FROM splits WHERE label IN ('positive', 'negative', 'neutral')),
l AS (SELECT row_id, y, (n % 7) / 7.0::DOUBLE AS a, (n % 5) / 5.0::DOUBLE AS b, (n % 3) / 3.0::DOUBLE AS c, (n % 4) / 4.0::DOUBLE AS ta, (n % 6) / 6.0::DOUBLE AS tb, (n % 2) / 2.0::DOUBLE AS tc FROM n),
e AS (SELECT *, exp(a) + exp(b) + exp(c) AS z, exp(a / 2) + exp(b / 2) + exp(c / 2) AS zs, exp(ta / 2) + exp(tb / 2) + exp(tc / 2) AS zt FROM l)
SELECT row_id, round(0.5 * -ln(exp(CASE y WHEN 0 THEN a WHEN 1 THEN b ELSE c END) / z) + 0.5 * 4 * (exp(ta / 2) / zt * ln((exp(ta / 2) / zt) / (exp(a / 2) / zs)) + exp(tb / 2) / zt * ln((exp(tb / 2) / zt) / (exp(b / 2) / zs)) + exp(tc / 2) / zt * ln((exp(tc / 2) / zt) / (exp(c / 2) / zs))), 6) AS loss FROM e""")
def soft_loss(spark, d):
    n = F.length(F.coalesce("text", F.lit("")))
    student, teacher = F.array((n % 7) / 7.0, (n % 5) / 5.0, (n % 3) / 3.0), F.array((n % 4) / 4.0, (n % 6) / 6.0, (n % 2) / 2.0)
    rows = read(spark, d, "splits").where("label IN ('positive', 'negative', 'neutral')")
    return rows.select("row_id", F.round(checks.soft_loss(student, teacher, checks.encode(F.col("label")), 0.5, 2.0), 6).alias("loss"))


@query("latency_noise", "WITH p AS (SELECT event_type, event_id % 3 AS run, quantile_cont(value, 0.95) AS p FROM events GROUP BY 1, 2) SELECT event_type, round((max(p) - min(p)) / min(p), 6) AS noise FROM p GROUP BY event_type")
def latency_noise(spark, d):
    p = read(spark, d, "events").groupBy("event_type").agg(*(F.percentile(F.when(F.col("event_id") % 3 == k, F.col("value")), F.lit(0.95)).alias(f"p{k}") for k in range(3)))
    return p.select("event_type", F.round(checks.noise(*(F.col(f"p{k}") for k in range(3))), 6).alias("noise"))


@query("last_documents", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS r FROM documents) WHERE r <= 10")
def last_documents(spark, d):
    return checks.newest_per(read(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", 10)


@query("same_prediction_lists", f"WITH {SCORE.format(t='text', f='splits')} SELECT row_id, (predicted_label = CASE WHEN round(positive, 1) >= greatest(round(negative, 1), round(neutral, 1)) THEN 'positive' WHEN round(negative, 1) >= round(neutral, 1) THEN 'negative' ELSE 'neutral' END) AS same FROM decided")
def same_prediction_lists(spark, d):
    exact = scoring.expression_scored(read(spark, d, "splits").select("row_id", "text"), "text").withColumn("a", F.array(F.struct(F.col("predicted_label").alias("label"), F.col("predicted_score").alias("score"))))
    rough = scoring.with_decision(exact.withColumns({x: F.round(x, 1) for x in ("positive", "negative", "neutral")}))
    return rough.select("row_id", checks.same_labels(F.col("a"), F.array(F.struct(F.col("predicted_label").alias("label"), F.col("predicted_score").alias("score")))).alias("same"))


@query("sample_sizes", "SELECT company, count(*) AS n FROM (SELECT company FROM final_data ORDER BY sha256('2026-10-02|' || review_id::VARCHAR) LIMIT 500) GROUP BY company")
def sample_sizes(spark, d):
    return splitting.daily_sample(read(spark, d, "final_data").select("review_id", "company"), "review_id", "2026-10-02", 500).groupBy("company").agg(F.count(F.lit(1)).alias("n"))
