"""Queries of merging reviewed feedback and of the report over it."""

from __future__ import annotations

from ..functions import text as t
from ..operators import dialect, merging
from . import sql as q
from .catalog import query
from .tables import read

_ROWS = ", ".join(("review_id", "override_id", "captured_at", "text", "model_label", "corrected_label", "company", "model_version", "guideline_version", "corroborating_agents", "adjudicated_label", "status", "route"))
_KEYS = (
    f"rk AS (SELECT *, {q.key('x.norm')} AS key FROM (WITH {q.normal_cte('overrides', 'coalesce(text, chr(32))', *_ROWS.split(', ')).replace('coalesce(text, chr(32)) AS raw', 'text AS raw')} SELECT * FROM n) x), "
    f"hk AS (SELECT DISTINCT {q.key('x.norm')} AS key FROM (WITH {q.normal_cte('train_feedback', 'coalesce(text, chr(32))', 'override_id')} SELECT * FROM n) x), "
    f"c AS (SELECT *, CASE WHEN {q.label('lower(adjudicated_label)')} <> '' THEN {q.label('lower(adjudicated_label)')} ELSE corrected_label END AS final, key IN (SELECT key FROM hk) AS merged FROM rk), "
    f"el AS (SELECT * FROM c WHERE NOT merged AND status IN {merging.TRAINABLE}), "
    "o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY captured_at, override_id) AS r FROM el) WHERE r = 1), "
    f"a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY final ORDER BY captured_at, override_id) AS nth FROM o) WHERE final <> 'neutral' OR final IS NULL OR nth <= {merging.NEUTRAL_CAP})"
)
_SUMS = dialect.lexicon_sql()
_TAG = f"""k AS (SELECT *, {q.key("coalesce(text, '')")} AS k FROM a), s AS (SELECT *, length(k) - length(regexp_replace(k, '[A-Za-z]', '', 'g')) AS lat, {', '.join(f'({x}) AS {v}' for v, x in _SUMS.items())} FROM k),
fresh AS (SELECT text, final AS label, company, false AS is_near_empty, CASE WHEN lat >= 3 THEN 'arabizi' WHEN {' + '.join(_SUMS)} = 0 THEN 'msa' {' '.join(f"WHEN {v} = greatest({', '.join(_SUMS)}) THEN '{v}'" for v in dialect.PRIORITY)} END AS dialect,
  CASE WHEN lat >= 3 THEN least(1.0, lat / 20.0) WHEN {' + '.join(_SUMS)} = 0 THEN 0.0 ELSE greatest({', '.join(_SUMS)}) / ({' + '.join(_SUMS)}) END::DOUBLE AS dialect_confidence, '{merging.SOURCE}' AS source, guideline_version, model_label,
  model_version, captured_at, override_id, status AS qa_status, corroborating_agents AS corroborated_by FROM s)"""


@query("merge_fresh", f"WITH {_KEYS}, {_TAG} SELECT * FROM fresh")
def merge_fresh(spark, d):
    return merging.fresh_rows(read(spark, d, "overrides"), read(spark, d, "train_feedback"))


@query("merge_whole", f"WITH {_KEYS}, {_TAG} SELECT {', '.join(merging.MERGED)} FROM train_feedback UNION ALL SELECT {', '.join(merging.MERGED)} FROM fresh")
def merge_whole(spark, d):
    return merging.merge(read(spark, d, "overrides"), read(spark, d, "train_feedback"))


_SHARES = ", ".join(f"round(coalesce((SELECT count(*) FROM a WHERE final = '{x}') / nullif((SELECT count(*) FROM a WHERE final IN ({q.DOMAIN})), 0), 0.0), 6) AS share_{x}" for x in t.LABELS)
_SUMMARY = f"""SELECT (SELECT count(*) FROM c WHERE NOT merged) AS candidates, (SELECT count(*) FROM el) AS eligible, (SELECT count(*) FROM el) - (SELECT count(*) FROM o) AS collapsed, (SELECT count(*) FROM o) - (SELECT count(*) FROM a) AS suppressed,
(SELECT count(*) FROM a) AS accepted, {_SHARES}, (SELECT count(*) FROM train_feedback) + (SELECT count(*) FROM a) AS cumulative"""


@query("merge_summary", f"WITH {_KEYS} {_SUMMARY}")
def merge_summary(spark, d):
    return merging.merge_summary(read(spark, d, "overrides"), read(spark, d, "train_feedback"))


@query("merge_again", "SELECT 0::BIGINT AS fresh")
def merge_again(spark, d):
    """Merging what was merged adds nothing."""
    from pyspark.sql import functions as F

    reviewed, held = read(spark, d, "overrides"), read(spark, d, "train_feedback")
    return merging.fresh_rows(reviewed, merging.merge(reviewed, held, -1), -1).agg(F.count(F.lit(1)).alias("fresh"))


@query("reviewed_merged", f"WITH {_KEYS} SELECT override_id, merged FROM c")
def reviewed_merged(spark, d):
    return merging.with_merged(read(spark, d, "overrides"), read(spark, d, "train_feedback")).select("override_id", "merged")


@query("merge_pending", f"WITH {_KEYS} SELECT count(*) AS rows, count(*) FILTER (WHERE NOT merged) AS pending, count(*) FILTER (WHERE NOT merged) > 0 AS has_new FROM c WHERE status IN {merging.TRAINABLE}")
def merge_pending(spark, d):
    return merging.pending(read(spark, d, "overrides"), read(spark, d, "train_feedback"))


@query("final_labels", f"WITH {_KEYS} SELECT override_id, final FROM c WHERE status IN {merging.TRAINABLE}")
def final_labels(spark, d):
    from pyspark.sql import functions as F

    rows = read(spark, d, "overrides").where(F.col("status").isin(*merging.TRAINABLE))
    return rows.select("override_id", merging.final_label(F.col("adjudicated_label"), F.col("corrected_label")).alias("final"))


@query("status_counts", " UNION ALL ".join(f"SELECT '{s}' AS status, count(*) FILTER (WHERE status = '{s}') AS n FROM overrides" for s in merging.STATUSES))
def status_counts(spark, d):
    return merging.status_counts(read(spark, d, "overrides"))


_CAPTURED = f"""r AS (SELECT {q.label('model_label')} AS m, {q.label('corrected_label')} AS c FROM feedback),
w AS (SELECT count(*) AS n_raw, count(*) FILTER (WHERE m IN ({q.DOMAIN}) AND m <> c) AS n_wrong, count(*) FILTER (WHERE m IN ({q.DOMAIN})) AS n_known,
  {', '.join(f"count(*) FILTER (WHERE m = '{x}') AS n_{x}, count(*) FILTER (WHERE m = '{x}' AND m <> c) AS wrong_{x}" for x in t.LABELS)} FROM r)"""


@query("feedback_report", f"""WITH {_KEYS}, {_CAPTURED} SELECT n_raw, n_wrong AS n_corrections, n_raw - n_wrong AS n_confirmations, {', '.join(f'round(n_{x} / nullif(n_known, 0), 6) AS mix_{x}' for x in t.LABELS)},
  {', '.join(f'round(wrong_{x} / nullif(n_{x}, 0), 5) AS error_{x}' for x in t.LABELS)}, round(n_wrong / nullif(n_known, 0), 5) AS error_overall,
  {', '.join(f"(SELECT count(*) FROM overrides WHERE status = '{s}') AS status_{s}" for s in merging.STATUSES)}, (SELECT count(*) FROM overrides WHERE status IN {merging.TRAINABLE}) AS n_trainable,
  (SELECT count(*) FROM overrides WHERE route = 'adjudicate_first') AS n_adjudicate_first, x.* FROM w, ({_SUMMARY}) x""")
def feedback_report(spark, d):
    return merging.report(read(spark, d, "feedback"), read(spark, d, "overrides"), read(spark, d, "train_feedback"))
