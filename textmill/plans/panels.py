"""Queries of tagging, splitting, sampling, scoring and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import dialect, features, scoring, splitting
from . import sql as q
from .catalog import query
from .tables import read

_SUMS = dialect.lexicon_sql()
_TAG = f"""k AS (SELECT review_id, {q.key("coalesce(review_description, '')")} AS k FROM final_data),
s AS (SELECT review_id, length(k) - length(regexp_replace(k, '[A-Za-z]', '', 'g')) AS lat, {', '.join(f'({x}) AS {v}' for v, x in _SUMS.items())} FROM k),
tagged AS (SELECT review_id, CASE WHEN lat >= 3 THEN 'arabizi' WHEN {' + '.join(_SUMS)} = 0 THEN 'msa' {' '.join(f"WHEN {v} = greatest({', '.join(_SUMS)}) THEN '{v}'" for v in dialect.PRIORITY)} END AS dialect,
  CASE WHEN lat >= 3 THEN least(1.0, lat / 20.0) WHEN {' + '.join(_SUMS)} = 0 THEN 0.0 ELSE greatest({', '.join(_SUMS)}) / ({' + '.join(_SUMS)}) END::DOUBLE AS dialect_confidence FROM s)"""


@query("dialect_tag", f"WITH {_TAG} SELECT review_id, dialect, round(dialect_confidence, 6) AS dialect_confidence FROM tagged")
def dialect_tag(spark, d):
    return dialect.tagged(read(spark, d, "final_data").select("review_id", "review_description"), "review_description").select("review_id", "dialect", F.round("dialect_confidence", 6).alias("dialect_confidence"))


@query("dialect_mix", f"WITH {_TAG} SELECT dialect, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM tagged GROUP BY dialect")
def dialect_mix(spark, d):
    return splitting.proportions(dialect.tagged(read(spark, d, "final_data"), "review_description"), None, "dialect", 6)


_PARTS = """h AS (SELECT review_id, lower(trim(rating)) AS label, sha256('42|' || review_id::VARCHAR) AS k FROM final_data WHERE rating IS NOT NULL),
r AS (SELECT review_id, label, row_number() OVER (PARTITION BY label ORDER BY k) AS rank, count(*) OVER (PARTITION BY label) AS size FROM h),
parts AS (SELECT review_id, label, CASE WHEN rank <= round(size * 0.2) THEN 'test' WHEN rank <= round(size * 0.2) + round((size - round(size * 0.2)) * (0.1 / 0.8)) THEN 'val' ELSE 'train' END AS part FROM r)"""


def _parts(spark, d):
    return splitting.stratified(read(spark, d, "final_data").select("review_id", F.lower(F.trim("rating")).alias("label")), "label", "review_id")


@query("split_stratified", f"WITH {_PARTS} SELECT review_id, label, part FROM parts")
def split_stratified(spark, d):
    return _parts(spark, d).select("review_id", "label", "part")


@query("split_metrics", f"""WITH {_PARTS} SELECT part, 'label' AS dim, label AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY part), 5) AS share FROM parts GROUP BY part, label
UNION ALL SELECT part, 'all', 'all', count(*), 1.0 FROM parts GROUP BY part""")
def split_metrics(spark, d):
    parts = _parts(spark, d)
    by_label = splitting.proportions(parts, "part", "label").select("part", F.lit("label").alias("dim"), F.col("label").alias("value"), "n", "share")
    return by_label.unionByName(parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.lit("all").alias("dim"), F.lit("all").alias("value"), "n", F.lit(1.0).alias("share")))


@query("split_proportions", "SELECT split, dialect, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 5) AS share FROM splits GROUP BY split, dialect")
def split_proportions(spark, d):
    return splitting.proportions(read(spark, d, "splits"), "split", "dialect")


@query("label_shares", "SELECT v AS value, n, round(n / sum(n) OVER (), 6) AS share FROM (" + " UNION ALL ".join(f"SELECT '{x}' AS v, count(*) FILTER (WHERE label = '{x}') AS n FROM train_feedback" for x in t.LABELS) + ")")
def label_shares(spark, d):
    return splitting.domain_shares(read(spark, d, "train_feedback"), "label", t.LABELS)


@query("daily_sample", "SELECT '2026-10-01' AS day, review_id, company FROM final_data ORDER BY sha256('2026-10-01|' || review_id::VARCHAR) LIMIT 1000")
def daily_sample(spark, d):
    return splitting.daily_sample(read(spark, d, "final_data").select("review_id", "company"), "review_id", "2026-10-01", 1000, 1)


@query("split_fingerprint", """SELECT count(*) AS rows, sum(('0x' || substr(sha256(coalesce(row_id::VARCHAR, chr(0)) || chr(31) || coalesce(text, chr(0)) || chr(31) || coalesce(label, chr(0))), 1, 12))::BIGINT)::BIGINT AS content FROM splits WHERE split = 'test'""")
def split_fingerprint(spark, d):
    return splitting.fingerprint(read(spark, d, "splits").where("split = 'test'"), "row_id", "text", "label")


SCORE = """l AS (SELECT *, (length(coalesce({t}, '')) % 7) / 7.0::DOUBLE AS a, (length(coalesce({t}, '')) % 5) / 5.0::DOUBLE AS b, (length(coalesce({t}, '')) % 3) / 3.0::DOUBLE AS c FROM {f}),
e AS (SELECT *, exp(a - greatest(a, b, c)) AS ea, exp(b - greatest(a, b, c)) AS eb, exp(c - greatest(a, b, c)) AS ec FROM l),
scored AS (SELECT * EXCLUDE (a, b, c, ea, eb, ec), round(ea / (ea + eb + ec), 9) AS positive, round(eb / (ea + eb + ec), 9) AS negative, round(ec / (ea + eb + ec), 9) AS neutral FROM e),
decided AS (SELECT *, CASE WHEN positive = greatest(positive, negative, neutral) THEN 'positive' WHEN negative = greatest(positive, negative, neutral) THEN 'negative' ELSE 'neutral' END AS predicted_label,
  greatest(positive, negative, neutral) AS predicted_score FROM scored)"""


@query("score_panel", f"WITH {SCORE.format(t='review_description', f='final_data')} SELECT review_id, positive, negative, neutral, predicted_label, predicted_score FROM decided")
def score_panel(spark, d):
    return scoring.expression_scored(read(spark, d, "final_data").select("review_id", "review_description"), "review_description").drop("review_description")


@query("score_summary", f"""WITH {SCORE.format(t='review_description', f='final_data')} SELECT count(*) AS n, round(avg(predicted_score), 6) AS mean_score, round(quantile_cont(predicted_score, 0.5), 6) AS median_score,
  {', '.join(f"round(count(*) FILTER (WHERE predicted_label = '{x}') / count(*), 6) AS share_{x}" for x in t.LABELS)} FROM decided""")
def score_summary(spark, d):
    return scoring.summary(scoring.expression_scored(read(spark, d, "final_data"), "review_description"))


class LengthScorer:
    """A scorer without a model: it makes probabilities of the text's length and digits."""

    def __call__(self, texts):
        import numpy as np

        n = np.array([len(x) for x in texts], float)
        raw = np.c_[1 + n % 11, 1 + n % 13, 1 + n % 3]
        return raw / raw.sum(axis=1, keepdims=True)


@query("score_pluggable", """WITH n AS (SELECT review_id, length(coalesce(review_description, '')) AS n FROM final_data), r AS (SELECT review_id, 1 + n % 11 AS a, 1 + n % 13 AS b, 1 + n % 3 AS c FROM n)
SELECT review_id, CASE WHEN a >= b AND a >= c THEN 'positive' WHEN b >= c THEN 'negative' ELSE 'neutral' END AS predicted_label, round(greatest(a, b, c) / (a + b + c), 6) AS predicted_score FROM r""")
def score_pluggable(spark, d):
    return scoring.scored(read(spark, d, "final_data").select("review_id", "review_description"), "review_description", LengthScorer).select("review_id", "predicted_label", F.round("predicted_score", 6).alias("predicted_score"))


_WORDS = "list_filter(string_split({k}, ' '), lambda w: w <> '')"


@query("oov_rates", f"""WITH tr AS (SELECT {_WORDS.format(k=q.key('n.norm'))} AS ws FROM (WITH {q.normal_cte('splits', 'text', 'row_id', 'split')} SELECT * FROM n) n WHERE split = 'train' AND raw IS NOT NULL),
v AS (SELECT word FROM (SELECT DISTINCT rowid_, word FROM (SELECT row_number() OVER () AS rowid_, ws FROM tr), unnest(ws) AS u(word)) GROUP BY word HAVING count(*) >= 2),
ev AS (SELECT row_id, {_WORDS.format(k=q.key('n.norm'))} AS ws FROM (WITH {q.normal_cte('splits', "coalesce(text, '')", 'row_id', 'split')} SELECT * FROM n) n WHERE split <> 'train'),
x AS (SELECT row_id, word FROM ev, unnest(ws) AS u(word)), c AS (SELECT row_id, count(*) AS tokens, count(*) FILTER (WHERE v.word IS NULL) AS unk FROM x LEFT JOIN v USING (word) GROUP BY row_id),
r AS (SELECT ev.row_id, coalesce(tokens, 0)::BIGINT AS tokens, round(coalesce(unk / tokens, 0.0), 6) AS oov_rate FROM ev LEFT JOIN c USING (row_id))
SELECT *, CASE WHEN oov_rate <= 0 THEN 'none' WHEN oov_rate <= 0.02 THEN 'low' WHEN oov_rate <= 0.05 THEN 'moderate' ELSE 'high' END AS oov_bucket FROM r""")
def oov_rates(spark, d):
    splits = read(spark, d, "splits")
    return features.oov_rate(splits.where("split <> 'train'"), "row_id", "text", features.vocabulary(splits.where("split = 'train'"), "text"))


@query("pca_features")
def pca_features(spark, d):
    e = read(spark, d, "embeddings")
    basis = features.fit_basis(e, "embedding", 10)
    return features.project(e, "embedding", basis).select("vec_id", *(F.round(f"embedding_pc{i}", 5).alias(f"embedding_pc{i}") for i in range(1, len(basis.components) + 1)))
