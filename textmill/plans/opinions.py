"""Queries of human feedback."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..functions import text as t
from ..operators import feedback as fb
from . import sql as q
from .catalog import query
from .tables import read

_KEYED = f"""{q.normal_cte("feedback", "coalesce(text, '')", 'feedback_row')}, f AS (SELECT feedback.*, norm, {q.key('norm')} AS key, {q.label('corrected_label')} AS lab FROM feedback JOIN n USING (feedback_row))"""


@query("feedback_valid", f"""SELECT feedback_row, CASE WHEN text IS NULL OR {q.strip('text')} = '' THEN 'blank_text' WHEN NOT regexp_full_match(coalesce(agent_id, ''), '[A-Za-z0-9._-]{{1,64}}') THEN 'agent_id'
  WHEN coalesce(model_label, '') NOT IN ({q.DOMAIN}) THEN 'model_label' WHEN coalesce(corrected_label, '') NOT IN ({q.DOMAIN}) THEN 'corrected_label' END AS error FROM feedback""")
def feedback_valid(spark, d):
    c = F.col
    return read(spark, d, "feedback").select("feedback_row", t.validation_error(c("text"), c("agent_id"), c("model_label"), c("corrected_label")).alias("error"))


@query("feedback_ids", f"SELECT feedback_row, override_id, substr(sha256({q.strip('text')} || chr(31) || model_label || chr(31) || corrected_label || chr(31) || agent_id), 1, 16) AS content_id FROM feedback")
def feedback_ids(spark, d):
    return fb.with_ids(read(spark, d, "feedback")).select("feedback_row", "override_id", "content_id")


@query("feedback_scores", "SELECT feedback_row, CASE WHEN regexp_full_match(trim(model_score), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(trim(model_score) AS DOUBLE) END AS score, corrected_label <> model_label AS is_correction FROM feedback")
def feedback_scores(spark, d):
    return read(spark, d, "feedback").select("feedback_row", t.numeric_or_null(F.col("model_score")).alias("score"), (F.col("corrected_label") != F.col("model_label")).alias("is_correction"))


@query("feedback_votes", f"""WITH {_KEYED}, a AS (SELECT key, trim(agent_id) AS agent, min(lab) AS lo, max(lab) AS hi FROM f WHERE trim(agent_id) <> '' AND lab <> '' GROUP BY ALL),
l AS (SELECT key, CASE WHEN lo = hi THEN lo END AS lab, count(*) AS n, array_to_string(list_sort(list(agent)), ';') AS voters FROM a GROUP BY 1, 2)
SELECT key, sum(n)::BIGINT AS agents, sum(CASE WHEN lab IS NOT NULL THEN n ELSE 0 END)::BIGINT AS consistent_agents, coalesce(min(lab) FILTER (WHERE n >= 2), '') AS agreed_label,
  coalesce(arg_min(voters, lab) FILTER (WHERE n >= 2 AND lab IS NOT NULL), '') AS voters FROM l GROUP BY key""")
def feedback_votes(spark, d):
    return fb.votes(fb.keyed(read(spark, d, "feedback")))


_RULED = f"""o AS (SELECT {q.key('x.norm')} AS key, {q.label('lower(adjudicated_label)')} AS r FROM (WITH {q.normal_cte("overrides", "coalesce(text, '')", 'adjudicated_label')} SELECT * FROM n) x)"""


@query("feedback_rulings", f"WITH {_RULED} SELECT key, CASE WHEN min(r) FILTER (WHERE r <> '') = max(r) FILTER (WHERE r <> '') THEN min(r) FILTER (WHERE r <> '') ELSE '' END AS ruling FROM o GROUP BY key")
def feedback_rulings(spark, d):
    return fb.rulings(fb.keyed(read(spark, d, "overrides")))


@query("feedback_one_per_text", f"WITH {_KEYED} SELECT key, arg_min(feedback_row, (captured_at, override_id, feedback_row)) AS feedback_row, count(*) AS n FROM f GROUP BY key")
def feedback_one_per_text(spark, d):
    f = fb.keyed(read(spark, d, "feedback")).withColumn("one", F.lit(1))
    first = fb.one_per_key(f, ["captured_at", "override_id", "feedback_row"]).select("key", "feedback_row")
    return first.join(f.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key")


@query("feedback_capped", """SELECT override_id, label FROM train_feedback WHERE label <> 'neutral' OR label IS NULL UNION ALL
(SELECT override_id, label FROM train_feedback WHERE label = 'neutral' ORDER BY captured_at, override_id LIMIT 100)""")
def feedback_capped(spark, d):
    return fb.capped(read(spark, d, "train_feedback"), "label", "neutral", 100, ["captured_at", "override_id"]).select("override_id", "label")


@query("feedback_merged", f"""WITH {_KEYED}, h AS (SELECT DISTINCT {q.key('x.norm')} AS key FROM (WITH {q.normal_cte('train_feedback', "coalesce(text, '')", 'override_id')} SELECT * FROM n) x),
new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY captured_at, override_id) AS r FROM f WHERE key NOT IN (SELECT key FROM h)) WHERE r = 1)
SELECT text, label, source, override_id, qa_status, is_near_empty FROM train_feedback UNION ALL SELECT text, corrected_label, '', override_id, '', NULL FROM new""")
def feedback_merged(spark, d):
    new = read(spark, d, "feedback").withColumn("label", F.col("corrected_label"))
    return fb.merged(read(spark, d, "train_feedback"), new).select("text", "label", "source", "override_id", "qa_status", "is_near_empty")


@query("feedback_pending", "SELECT count(*) AS rows, count(*) FILTER (WHERE override_id NOT IN (SELECT override_id FROM train_feedback)) AS pending FROM overrides WHERE route = 'train'")
def feedback_pending(spark, d):
    held = read(spark, d, "train_feedback").select("override_id", F.lit(True).alias("held"))
    return read(spark, d, "overrides").where("route = 'train'").join(held, "override_id", "left").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("held").isNull()).alias("pending"))


@query("production_error_rate", "SELECT label, n, wrong, round(wrong / nullif(n, 0), 5) AS error_rate FROM (" + " UNION ALL ".join(
    f"SELECT '{x}' AS label, count(*) FILTER (WHERE model_label = '{x}') AS n, count(*) FILTER (WHERE model_label = '{x}' AND corrected_label IS DISTINCT FROM model_label) AS wrong FROM feedback" for x in t.LABELS)
    + f" UNION ALL SELECT 'all', count(*) FILTER (WHERE model_label IN ({q.DOMAIN})), count(*) FILTER (WHERE model_label IN ({q.DOMAIN}) AND corrected_label IS DISTINCT FROM model_label) FROM feedback)")
def production_error_rate(spark, d):
    return fb.error_rates(read(spark, d, "feedback"), "model_label", "corrected_label")


@query("captures_per_day", "SELECT batch_day, override_id, min(feedback_row) AS feedback_row FROM feedback GROUP BY batch_day, override_id")
def captures_per_day(spark, d):
    return fb.first_per_day(read(spark, d, "feedback").select("batch_day", "override_id", "feedback_row", "agent_id"), "batch_day", "override_id", "feedback_row").select("batch_day", "override_id", "feedback_row")


@query("late_captures", "SELECT batch_day, count(*) AS n, count(*) FILTER (WHERE (captured_at::TIMESTAMPTZ AT TIME ZONE 'UTC')::DATE < batch_day::DATE) AS late FROM feedback GROUP BY batch_day")
def late_captures(spark, d):
    return read(spark, d, "feedback").groupBy("batch_day").agg(F.count(F.lit(1)).alias("n"), F.count_if(dates.utc_day(F.col("captured_at")) < F.col("batch_day").try_cast("date")).alias("late"))


@query("second_agent", f"""WITH {_KEYED}, a AS (SELECT key, list_sort(list(DISTINCT trim(agent_id))) AS agents FROM f WHERE trim(agent_id) <> '' GROUP BY key)
SELECT feedback_row, coalesce(list_filter(agents, lambda x: x <> trim(f.agent_id))[1], '') AS second_agent FROM f JOIN a USING (key)""")
def second_agent(spark, d):
    f = fb.keyed(read(spark, d, "feedback")).withColumn("agent_id", F.trim("agent_id"))
    a = f.where("agent_id <> ''").groupBy("key").agg(F.array_sort(F.collect_set("agent_id")).alias("agents"))  # agents of a text: bounded by the roster
    other = F.try_element_at(F.filter("agents", lambda x: x != F.col("agent_id")), F.lit(1))
    return f.join(a, "key").select("feedback_row", F.coalesce(other, F.lit("")).alias("second_agent"))


@query("calendar_dates", """WITH y AS (SELECT unnest(range(2024, 2035))::INT AS year), n AS (SELECT year, make_date(year, 11, 1) AS f FROM y)
SELECT year, (f + ((4 - dayofweek(f) + 7) % 7)::INT + 22)::DATE AS after_fourth_thursday, (make_date(year, 11, 30) - ((dayofweek(make_date(year, 11, 30)) - 5 + 7) % 7)::INT)::DATE AS last_friday,
CASE WHEN (year % 4 = 0 AND year % 100 <> 0) OR year % 400 = 0 THEN make_date(year, 2, 29) END AS leap_day FROM n""")
def calendar_dates(spark, d):
    y = spark.range(2024, 2035).select(F.col("id").cast("int").alias("year"))
    return y.select("year", dates.day_after_fourth_thursday(F.col("year")).alias("after_fourth_thursday"), dates.last_friday_of_november(F.col("year")).alias("last_friday"), dates.same_day_in(F.col("year"), F.lit("2024-02-29").cast("date")).alias("leap_day"))
