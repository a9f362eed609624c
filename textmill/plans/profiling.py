"""Queries of profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import profiling as p
from . import sql as q
from .catalog import query
from .tables import read

_LEN = "length(review_description)"
_COLUMNS = {"review_id": "bigint", "review_description": "string", "rating": "string", "company": "string", "loaded_at": "timestamp_ntz"}


@query("null_profile", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{k}' AS type, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS n FROM final_data" for c, k in _COLUMNS.items()))
def null_profile(spark, d):
    return p.nulls(read(spark, d, "final_data"))


def _describe(by: str) -> str:
    return f"""SELECT {by}, count(x) AS n, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS least, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
  round(quantile_cont(x, 0.75), 6) AS q75, round(quantile_cont(x, 0.99), 6) AS q99, max(x) AS greatest FROM (SELECT coalesce(lower(trim(rating)), 'none') AS rating, {_LEN} AS x FROM final_data) GROUP BY {by}"""


@query("length_by_class", _describe("rating"))
def length_by_class(spark, d):
    rows = read(spark, d, "final_data").select(F.coalesce(F.lower(F.trim("rating")), F.lit("none")).alias("rating"), F.length("review_description").alias("x"))
    return p.describe(rows, F.col("x"), "rating")


@query("crosstab_cube", """WITH r AS (SELECT coalesce(company, 'NULL') AS company, coalesce(rating, 'NULL') AS rating FROM final_data)
SELECT CASE WHEN grouping(company) = 1 THEN 'ALL' ELSE company END AS company, CASE WHEN grouping(rating) = 1 THEN 'ALL' ELSE rating END AS rating, count(*) AS n FROM r GROUP BY CUBE (company, rating)""")
def crosstab_cube(spark, d):
    return p.cross_cube(read(spark, d, "final_data"), "company", "rating")


@query("crosstab_row_pct", "SELECT company, " + ", ".join(f"round(count(*) FILTER (WHERE lower(trim(rating)) = '{x}') * 100 / count(*), 4) AS pct_{x}" for x in t.LABELS) + " FROM final_data GROUP BY company")
def crosstab_row_pct(spark, d):
    return p.row_percent(read(spark, d, "final_data").withColumn("rating", F.lower(F.trim("rating"))), "company", "rating", list(t.LABELS))


@query("top_words_by_company", f"""WITH {q.normal_cte('final_data', 'review_description', 'company')}, w AS (SELECT company, unnest(string_split({q.key('norm')}, ' ')) AS word FROM n WHERE raw IS NOT NULL),
c AS (SELECT company, word, count(*) AS n FROM w WHERE length(word) > 2 GROUP BY company, word)
SELECT company, word, n, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY company ORDER BY n DESC, word) AS rank FROM c) WHERE rank <= 20""")
def top_words_by_company(spark, d):
    rows = read(spark, d, "final_data").select("company", t.normalize(F.col("review_description")).alias("text"))
    return p.top_words(rows, "text", "company")


@query("length_outliers", f"SELECT review_id, {_LEN} AS chars, lim AS \"limit\" FROM final_data, (SELECT quantile_cont({_LEN}, 0.99) AS lim FROM final_data) WHERE {_LEN} > lim")
def length_outliers(spark, d):
    return p.above_quantile(read(spark, d, "final_data"), F.length("review_description"), "chars").select("review_id", "chars", "limit")


@query("length_bands", f"""WITH s AS (SELECT review_description AS x, length({q.strip('review_description')}) AS n, len(list_filter(string_split({q.key('review_description')}, ' '), lambda w: w <> '')) AS w FROM final_data)
SELECT count(*) FILTER (WHERE x IS NULL) AS null_text, count(*) FILTER (WHERE n = 0) AS blank, count(*) FILTER (WHERE n > 0 AND n < 10) AS below_10,
  count(*) FILTER (WHERE n >= 10 AND n < 20) AS from_10_to_19, count(*) FILTER (WHERE w = 1) AS single_word FROM s""")
def length_bands(spark, d):
    return p.length_bands(read(spark, d, "final_data"), "review_description")


_FREE = f"regexp_replace(regexp_replace(x, '{t.EMOJI_BLOCKS}', '', 'g'), '{t.ASTRAL}', '', 'g')"


@query("text_patterns", f"""WITH s AS (SELECT review_description AS x FROM final_data WHERE review_description IS NOT NULL)
SELECT count(*) FILTER (WHERE regexp_matches(x, '{t.ARABIC}')) AS arabic, count(*) FILTER (WHERE regexp_matches(x, '[a-zA-Z]')) AS latin, count(*) FILTER (WHERE regexp_matches(x, '{t.EMOJI_BLOCKS}')) AS emoji,
  count(*) FILTER (WHERE regexp_matches(x, '{t.DIACRITICS}')) AS diacritics, count(*) FILTER (WHERE {q.shorten('x')} <> x) AS elongated, count(*) FILTER (WHERE regexp_matches(x, '[0-9]')) AS digits,
  count(*) FILTER (WHERE length(x) - length(regexp_replace(x, '{t.PUNCTUATION}', '', 'g')) > 10) AS much_punctuation, count(*) FILTER (WHERE {q.strip(_FREE)} = '' AND {q.strip('x')} <> '') AS only_emoji FROM s""")
def text_patterns(spark, d):
    return p.patterns(read(spark, d, "final_data"), "review_description")
