"""Queries of drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import drift, scoring
from .catalog import query
from .panels import SCORE
from .tables import read

CATEGORICAL, NUMERIC = ["company", "dialect", "label"], ["n_chars", "dialect_confidence"]


def _psi_sql(source: str, ref: str, categorical: list[str], numeric: list[str]) -> str:
    cells = [f"SELECT '{c}' AS col, {ref} AS ref, {c}::VARCHAR AS cat, NULL::DOUBLE AS num FROM {source}" for c in categorical]
    cells += [f"SELECT '{c}' AS col, {ref} AS ref, NULL::VARCHAR AS cat, {c}::DOUBLE AS num FROM {source}" for c in numeric]
    is_num = "col IN (" + ", ".join(f"'{c}'" for c in numeric) + ")" if numeric else "FALSE"
    return f"""cells AS ({' UNION ALL '.join(cells)}),
st AS (SELECT col, min(num) AS lo, max(num) AS hi, count(num) AS n, stddev_samp(num) AS sd, count(DISTINCT CASE WHEN ref THEN num END) AS dist, count(*) FILTER (WHERE ref) AS nr, count(*) FILTER (WHERE NOT ref) AS nc FROM cells GROUP BY col),
k AS (SELECT *, ceil(log2(greatest(n, 1))) + 1 AS k FROM st),
b AS (SELECT cells.col, ref, CASE WHEN {is_num.replace('col', 'cells.col')} AND dist > 20 THEN least(floor((num - lo) / ((hi - lo) / k)), k - 1)::VARCHAR WHEN {is_num.replace('col', 'cells.col')} THEN num::VARCHAR ELSE coalesce(cat, chr(0)) END AS bin
  FROM cells JOIN k USING (col) WHERE NOT ({is_num.replace('col', 'cells.col')}) OR num IS NOT NULL),
c AS (SELECT col, bin, count(*) FILTER (WHERE ref) AS r, count(*) FILTER (WHERE NOT ref) AS c FROM b GROUP BY col, bin),
s AS (SELECT col, r / greatest(sum(r) OVER (PARTITION BY col), 1) AS r, c / greatest(sum(c) OVER (PARTITION BY col), 1) AS c FROM c),
f AS (SELECT col, sum(CASE WHEN r = 0 AND c = 0 THEN 0 ELSE (greatest(r, 1e-4) - greatest(c, 1e-4)) * ln(greatest(r, 1e-4) / greatest(c, 1e-4)) END) AS psi FROM s GROUP BY col),
psi AS (SELECT st.col AS "column", CASE WHEN nr = 0 OR nc = 0 THEN 'one side is empty' WHEN {is_num.replace('col', 'st.col')} AND n = 0 THEN 'no value' WHEN {is_num.replace('col', 'st.col')} AND (sd IS NULL OR sd < 1e-8) THEN 'hardly varies' ELSE '' END AS reason,
  round(psi, 4) AS psi FROM st LEFT JOIN f USING (col)),
out AS (SELECT "column", CASE WHEN reason = '' THEN psi END AS score, CASE WHEN reason <> '' THEN 'SKIPPED' WHEN psi < 0.1 THEN 'PASS' WHEN psi < 0.2 THEN 'WARN' ELSE 'FAIL' END AS decision, reason FROM psi)"""


_SRC = "src AS (SELECT *, length(text)::DOUBLE AS n_chars FROM splits)"
_PSI = f"WITH {_SRC}, {_psi_sql('src', '(split = ' + chr(39) + 'train' + chr(39) + ')', CATEGORICAL, NUMERIC)}"


def _scores(spark, d):
    rows = read(spark, d, "splits").withColumn("n_chars", F.length("text").cast("double"))
    return drift.psi(rows, F.col("split") == "train", CATEGORICAL, NUMERIC)


@query("psi_columns", _PSI + " SELECT * FROM out")
def psi_columns(spark, d):
    return _scores(spark, d)


@query("drift_verdict", _PSI + """ SELECT CASE max(CASE decision WHEN 'PASS' THEN 1 WHEN 'WARN' THEN 2 WHEN 'FAIL' THEN 3 ELSE 0 END) WHEN 0 THEN 'SKIPPED' WHEN 1 THEN 'PASS' WHEN 2 THEN 'WARN' ELSE 'FAIL' END AS overall,
count(score) AS checked, round(coalesce(count(*) FILTER (WHERE score >= 0.1) / count(score), 0.0), 4) AS drift_share FROM out""")
def drift_verdict(spark, d):
    return drift.verdict(_scores(spark, d))


_BY_SOURCE = f"WITH {_SRC}, {_psi_sql('src', '(source = ' + chr(39) + 'final_data' + chr(39) + ')', CATEGORICAL, NUMERIC)}"


@query("worst_column", _BY_SOURCE + " SELECT \"column\", score, decision, reason FROM out WHERE decision = 'FAIL' ORDER BY score DESC, \"column\" LIMIT 1")
def worst_column(spark, d):
    rows = read(spark, d, "splits").withColumn("n_chars", F.length("text").cast("double"))
    return drift.worst(drift.psi(rows, F.col("source") == "final_data", CATEGORICAL, NUMERIC))


@query("psi_events", "WITH " + _psi_sql("events", "(event_id % 2 = 0)", ["event_type"], ["value"]) + " SELECT * FROM out")
def psi_events(spark, d):
    return drift.psi(read(spark, d, "events"), F.col("event_id") % 2 == 0, ["event_type"], ["value"])


@query("tvd_dialect", """WITH c AS (SELECT dialect, count(*) FILTER (WHERE split = 'train') AS r, count(*) FILTER (WHERE split <> 'train') AS c FROM splits WHERE dialect IS NOT NULL GROUP BY dialect)
SELECT round(sum(abs(r / (SELECT sum(r) FROM c) - c / (SELECT sum(c) FROM c))) / 2, 6) AS tvd FROM c""")
def tvd_dialect(spark, d):
    return drift.total_variation(read(spark, d, "splits"), F.col("split") == "train", "dialect")


@query("feature_means", """SELECT 'row_id' AS feature, round(avg(row_id), 6) AS mean FROM splits UNION ALL SELECT 'review_id', round(avg(review_id), 6) FROM splits UNION ALL SELECT 'dialect_confidence', round(avg(dialect_confidence), 6) FROM splits""")
def feature_means(spark, d):
    return drift.feature_means(read(spark, d, "splits"))


_DAILY = f"WITH {SCORE.format(t='review_description', f='final_data')}, g AS (SELECT loaded_at::DATE AS day, avg(predicted_score) AS mean FROM decided GROUP BY 1)"


def _daily(spark, d):
    scored = scoring.expression_scored(read(spark, d, "final_data"), "review_description")
    return scored.groupBy(F.to_date("loaded_at").alias("day")).agg(F.avg("predicted_score").alias("mean"))


@query("rolling_confidence", _DAILY + """, w AS (SELECT day, mean, count(mean) OVER x AS n_before, avg(mean) OVER x AS m, stddev_samp(mean) OVER x AS s FROM g WINDOW x AS (ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
SELECT day, round(mean, 6) AS mean, n_before, round(m, 6) AS mean_before, round(s, 6) AS std_before, CASE WHEN n_before >= 7 AND s > 0 THEN round((mean - m) / s, 3) END AS z_score FROM w""")
def rolling_confidence(spark, d):
    return drift.rolling_confidence(_daily(spark, d).where("day IS NOT NULL"))


@query("prediction_psi", f"WITH {SCORE.format(t='text', f='splits')}, {_psi_sql('decided', '(split = ' + chr(39) + 'train' + chr(39) + ')', ['predicted_label'], ['predicted_score'])} SELECT * FROM out")
def prediction_psi(spark, d):
    return drift.psi(scoring.expression_scored(read(spark, d, "splits"), "text"), F.col("split") == "train", ["predicted_label"], ["predicted_score"])


@query("share_deltas", f"""WITH {SCORE.format(t='text', f='splits')} SELECT value, round((c - r) * 100, 3) AS delta_points FROM ({' UNION ALL '.join(f"SELECT '{x}' AS value, count(*) FILTER (WHERE predicted_label = '{x}' AND split = 'train') / count(*) FILTER (WHERE split = 'train') AS r, count(*) FILTER (WHERE predicted_label = '{x}' AND split <> 'train') / count(*) FILTER (WHERE split <> 'train') AS c FROM decided" for x in t.LABELS)})""")
def share_deltas(spark, d):
    rows = scoring.expression_scored(read(spark, d, "splits"), "text")
    is_train, n = F.col("split") == "train", {x: F.col("predicted_label") == x for x in t.LABELS}
    one = rows.agg(*(((F.count_if(c & ~is_train) / F.count_if(~is_train)) - (F.count_if(c & is_train) / F.count_if(is_train))).alias(x) for x, c in n.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(x).alias("value"), F.round(F.col(x) * 100, 3).alias("delta_points")) for x in t.LABELS))).alias("x")).select("x.*")
