"""Queries of cleaning, keys and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import cleaning, similarity
from . import sql as q
from .catalog import query
from .tables import read

_N = q.normal_cte("final_data", "review_description", "review_id")


@query("clean_flags", f"""
SELECT review_id, length({q.strip('review_description')}) < 10 AS is_near_empty, regexp_matches(review_description, '[a-zA-Z]') AS has_latin,
  regexp_matches(review_description, '{t.DIACRITICS}') AS has_diacritics, {q.shorten('review_description')} <> review_description AS has_elongation,
  regexp_matches(review_description, '{t.ASTRAL}') AS has_emoji FROM final_data""")
def clean_flags(spark, d):
    return cleaning.flags(read(spark, d, "final_data").select("review_id", "review_description"), "review_description").drop("review_description")


@query("clean_noise_pct", f"""
SELECT round(avg(regexp_matches(x, '[a-zA-Z]')::INT) * 100, 4) AS latin, round(avg(regexp_matches(x, '{t.DIACRITICS}')::INT) * 100, 4) AS diacritics,
  round(avg(({q.shorten('x')} <> x)::INT) * 100, 4) AS elongated, round(avg(regexp_matches(x, '{t.ASTRAL}')::INT) * 100, 4) AS emoji
FROM (SELECT review_description AS x FROM final_data WHERE review_description IS NOT NULL)""")
def clean_noise_pct(spark, d):
    return cleaning.noise_percentages(read(spark, d, "final_data"), "review_description")


@query("clean_normalized", f"WITH {_N} SELECT review_id, norm AS text, length({q.strip('raw')}) < 10 AS is_near_empty FROM n WHERE raw IS NOT NULL")
def clean_normalized(spark, d):
    return cleaning.normalized(read(spark, d, "final_data"), "review_description", "review_id")


@query("clean_elongation", f"SELECT review_id, {q.shorten('review_description')} AS text FROM final_data")
def clean_elongation(spark, d):
    return read(spark, d, "final_data").select("review_id", t.collapse_elongation(F.col("review_description")).alias("text"))


@query("clean_exact_dedup", f"WITH {_N} SELECT min(review_id) AS review_id, norm AS text FROM n WHERE raw IS NOT NULL GROUP BY norm")
def clean_exact_dedup(spark, d):
    return cleaning.keep_first(cleaning.normalized(read(spark, d, "final_data"), "review_description", "review_id").select("review_id", "text"), "text", "review_id")


@query("clean_funnel", f"""WITH {_N}, g AS (SELECT norm, count(*) AS c, arg_min(length({q.strip('raw')}) < 10, review_id) AS e FROM n WHERE raw IS NOT NULL GROUP BY norm)
SELECT (SELECT count(*) FROM final_data) AS raw_rows, (SELECT count(*) FROM final_data WHERE review_description IS NULL) AS null_text,
  sum(c)::BIGINT - count(*) AS exact_removed, count(*) AS final_rows, sum(e::BIGINT)::BIGINT AS final_near_empty FROM g""")
def clean_funnel(spark, d):
    return cleaning.funnel(read(spark, d, "final_data"), "review_description", "review_id")


@query("clean_pipeline_metrics")
def clean_pipeline_metrics(spark, d):
    """The funnel with its last step, fuzzy deduplication, which SQL cannot say."""
    return cleaning.pipeline(read(spark, d, "final_data"), "review_description", "review_id")


@query("text_keys", f"""WITH {_N}, k AS (SELECT review_id, {q.key('norm')} AS key FROM n WHERE raw IS NOT NULL)
SELECT review_id, key, length(key) AS chars, len(list_filter(string_split(key, ' '), lambda w: w <> ''))::INT AS words FROM k""")
def text_keys(spark, d):
    n = cleaning.normalized(read(spark, d, "final_data"), "review_description", "review_id")
    return n.select("review_id", t.text_key(F.col("text")).alias("key")).select("review_id", "key", F.length("key").alias("chars"), F.size(t.words(F.col("key"))).alias("words"))


@query("light_duplicates", f"""WITH k AS (SELECT review_description AS x, rating, md5(trim(regexp_replace({q.key('review_description')}, '[^\\x{{600}}-\\x{{6ff}} ]', '', 'g'))) AS h
  FROM final_data WHERE review_description IS NOT NULL), g AS (SELECT h, count(*) AS n, min(rating) AS a, max(rating) AS b FROM k GROUP BY h)
SELECT (SELECT count(*) - count(DISTINCT x) FROM k)::BIGINT AS exact_duplicates, (SELECT sum(n - 1) FROM g)::BIGINT AS light_duplicates, (SELECT count(*) FROM g WHERE n > 1 AND a <> b) AS conflicting_groups""")
def light_duplicates(spark, d):
    return cleaning.light_duplicates(read(spark, d, "final_data"), "review_description", "rating")


@query("conflicting_labels", f"""WITH {_N}, r AS (SELECT {q.key('norm')} AS key, lower(trim(rating)) AS rating FROM n JOIN final_data USING (review_id) WHERE raw IS NOT NULL)
SELECT key, count(*) AS n, count(DISTINCT rating) AS labels FROM r GROUP BY key HAVING count(DISTINCT rating) > 1""")
def conflicting_labels(spark, d):
    from ..operators.profiling import conflicting

    rows = read(spark, d, "final_data").where("review_description IS NOT NULL").withColumn("rating", F.lower(F.trim("rating")))
    return conflicting(rows, t.text_key(t.normalize(F.col("review_description"))), "rating")


@query("coerced_labels", f"SELECT review_id, {q.label('rating')} AS label, (rating IS NULL OR {q.label('rating')} = '') AS unknown FROM final_data")
def coerced_labels(spark, d):
    lab = t.coerce_label(F.col("rating"))
    return read(spark, d, "final_data").select("review_id", lab.alias("label"), (F.col("rating").isNull() | (lab == "")).alias("unknown"))


def _distinct(spark, d):
    n = cleaning.normalized(read(spark, d, "final_data"), "review_description", "review_id").select(F.col("review_id").alias("id"), "text")
    return cleaning.keep_first(n, "text", "id")


@query("fuzzy_dedup")
def fuzzy_dedup(spark, d):
    return similarity.fuzzy_keep_first(_distinct(spark, d), 0.9).select(F.col("id").alias("review_id"), "text")


@query("fuzzy_pairs")
def fuzzy_pairs(spark, d):
    return similarity.similar_pairs(_distinct(spark, d), 0.9).select(F.col("a").alias("review_id_a"), F.col("b").alias("review_id_b"), F.round("similarity", 4).alias("similarity"))


@query("leak_guard")
def leak_guard(spark, d):
    """Distinct feedback texts that repeat a test text."""
    clean = lambda df: cleaning.keep_first(df.select("id", t.normalize(F.col("text")).alias("text")).where("text IS NOT NULL"), "text", "id")
    new = clean(read(spark, d, "feedback").select(F.col("feedback_row").alias("id"), "text"))
    test = clean(read(spark, d, "splits").where("split = 'test'").select(F.col("row_id").alias("id"), "text"))
    return similarity.overlapping(new, test, 0.9).groupBy(F.col("a").alias("feedback_row")).agg(F.round(F.max("similarity"), 4).alias("similarity"), F.count(F.lit(1)).alias("test_texts"))
