"""Queries of reports: drift of inputs and outputs, the frozen projection, metric gates, windows of telemetry, calendars."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..functions import checks, dates
from ..functions import json as j
from ..functions import text as t
from ..operators import dialect, drift, features, pairing, scoring, splitting
from ..operators import evaluation as ev
from ..sources import files
from ..sources.store import shared_folder
from . import sql as q
from .catalog import query
from .drifting import _psi_sql
from .evaluating import _EV
from .panels import _PARTS, _TAG, SCORE
from .tables import read

_TRAIN = "(split = 'train')"
_DEC = SCORE.format(t="text", f="splits")


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _scored(spark, d):
    return scoring.expression_scored(read(spark, d, "splits"), "text")


_ENGINEERED = f"WITH {_DEC}, en AS (SELECT *, length(text)::BIGINT AS text_length FROM decided), {_psi_sql('en', _TRAIN, ['predicted_label', 'dialect'], ['positive', 'text_length'])}"


@query("input_report", _ENGINEERED + " SELECT * FROM out UNION ALL SELECT 'embedding_pc1', NULL, 'SKIPPED', 'absent'")
def input_report(spark, d):
    rows = _scored(spark, d)
    engineer = lambda df: df.withColumn("text_length", F.length("text").cast("long"))
    return drift.input_report(rows.where("split = 'train'"), rows.where("split <> 'train'"), engineer, "text", ("dialect", "text_length", "embedding_pc1"))


@query("input_report_outputs_only", f"WITH {_DEC}, {_psi_sql('decided', _TRAIN, ['predicted_label'], ['positive'])} SELECT * FROM out")
def input_report_outputs_only(spark, d):
    rows = _scored(spark, d).drop("text")
    return drift.input_report(rows.where("split = 'train'"), rows.where("split <> 'train'"), lambda df: df, "text", ("text_length",))


_DAY = "2026-09-15"


def _mix_sql(tag: str, column: str, where: str) -> str:
    return f"{tag} AS (SELECT count(*) AS n, {', '.join(f'count(*) FILTER (WHERE {column} = {chr(39)}{x}{chr(39)}) / nullif(count(*) FILTER (WHERE {column} IN ({q.DOMAIN})), 0) AS {x}' for x in t.LABELS)}, avg(predicted_score) AS mean FROM decided WHERE {where})"


def _index_sql(a: str) -> str:
    g = "greatest({}, 1e-4)"
    return "round(" + " + ".join(f"CASE WHEN {a}.{x} = 0 AND cu.{x} = 0 THEN 0 ELSE ({g.format(f'{a}.{x}')} - {g.format(f'cu.{x}')}) * ln({g.format(f'{a}.{x}')} / {g.format(f'cu.{x}')}) END" for x in t.LABELS) + ", 4)"


_BAND = "CASE WHEN {0} IS NULL THEN 'SKIPPED' WHEN {0} < 0.1 THEN 'PASS' WHEN {0} < 0.2 THEN 'WARN' ELSE 'FAIL' END"
_REPORT = f"""WITH {_DEC}, {_mix_sql('cu', 'predicted_label', "split = 'test'")}, {_mix_sql('re', 'predicted_label', "split = 'val'")}, {_mix_sql('pr', 'label', "split = 'train'")},
hi AS (SELECT batch_day::DATE AS day, avg(try_cast(model_score AS DOUBLE)) AS mean FROM feedback GROUP BY 1), be AS (SELECT * FROM hi WHERE day < DATE '{_DAY}' AND mean IS NOT NULL ORDER BY day DESC LIMIT 14),
bs AS (SELECT count(mean) AS n_before, avg(mean) AS m, stddev_samp(mean) AS s FROM be), ip AS (SELECT CASE WHEN count(*) > 0 THEN 'PASS' END AS input_decision FROM feedback WHERE batch_day = '{_DAY}'),
x AS (SELECT cu.n AS n_current, re.n AS n_reference, {_index_sql('pr')} AS psi_prior, {_index_sql('re')} AS psi_reference, {', '.join(f'round((cu.{x} - pr.{x}) * 100, 3) AS delta_points_{x}' for x in t.LABELS)}, round(cu.mean, 6) AS mean, round(re.mean, 6) AS reference_mean,
  round(cu.mean - re.mean, 6) AS delta, n_before, CASE WHEN n_before >= 7 AND s > 0 THEN round((cu.mean - m) / s, 3) END AS z_score, input_decision FROM cu, re, pr, bs, ip),
y AS (SELECT '{_DAY}' AS day, *, {_BAND.format('psi_prior')} AS decision, {_BAND.format('psi_reference')} AS decision_reference, delta < 0 AS falling FROM x)
SELECT *, CASE WHEN input_decision IS NULL THEN 'indeterminate' WHEN input_decision = 'PASS' AND decision = 'PASS' THEN 'stable' WHEN input_decision = 'PASS' THEN 'model_degraded' WHEN decision = 'PASS' THEN 'world_changed' ELSE 'ambiguous' END AS triage,
  falling AND decision IN ('WARN', 'FAIL') AS escalate FROM y"""


@query("prediction_report", _REPORT)
def prediction_report(spark, d):
    rows, fb = _scored(spark, d), read(spark, d, "feedback").withColumn("day", F.col("batch_day").try_cast("date"))
    history = fb.groupBy("day").agg(F.avg(F.col("model_score").try_cast("double")).alias("mean"))
    inputs = fb.select("day", F.lit("PASS").alias("decision")).distinct()
    return drift.prediction_report(rows.where("split = 'test'"), rows.where("split = 'val'"), rows.where("split = 'train'"), history, inputs, _DAY, t.LABELS)


def _daily_sql(name: str, day: str, column: str) -> str:
    g = "(greatest({0}, 1e-4) - greatest({1}, 1e-4)) * ln(greatest({0}, 1e-4) / greatest({1}, 1e-4))"
    return f"""{name}c AS (SELECT {day} AS day, {column} AS v, count(*) AS n FROM feedback WHERE {column} IS NOT NULL AND {day} IS NOT NULL GROUP BY ALL), {name}d AS (SELECT day, sum(n) AS dn FROM {name}c GROUP BY day),
{name}m AS (SELECT v, sum(n) / (SELECT sum(n) FROM {name}c) AS r FROM {name}c GROUP BY v), {name} AS (SELECT day, round(sum({g.format('r', 'coalesce(n, 0) / dn')}), 4) AS score FROM {name}d CROSS JOIN {name}m LEFT JOIN {name}c USING (day, v) GROUP BY day),
{name}s AS (SELECT day, score, CASE WHEN score < 0.1 THEN 'PASS' WHEN score < 0.2 THEN 'WARN' ELSE 'FAIL' END AS decision FROM {name})"""


_IN, _OUT = "batch_day::DATE", "try_cast(substr(captured_at, 1, 10) AS DATE)"


@query("daily_decisions", f"WITH {_daily_sql('o', _OUT, 'model_label')} SELECT strftime(day, '%Y-%m-%d') AS day, score, decision FROM os")
def daily_decisions(spark, d):
    out = drift.daily_decisions(read(spark, d, "feedback"), F.substring("captured_at", 1, 10).try_cast("date"), "model_label")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("triage_days", f"""WITH {_daily_sql('i', _IN, 'company')}, {_daily_sql('o', _OUT, 'model_label')}, x AS (SELECT os.day, isq.decision AS input_decision, os.decision AS output_decision FROM os LEFT JOIN "is" isq USING (day))
SELECT strftime(day, '%Y-%m-%d') AS day, input_decision, output_decision, CASE WHEN input_decision IS NULL THEN 'indeterminate' WHEN input_decision = 'PASS' AND output_decision = 'PASS' THEN 'stable' WHEN input_decision = 'PASS' THEN 'model_degraded' WHEN output_decision = 'PASS' THEN 'world_changed' ELSE 'ambiguous' END AS triage FROM x""".replace("is AS (SELECT day, score", '"is" AS (SELECT day, score'))
def triage_days(spark, d):
    fb = read(spark, d, "feedback")
    inputs = drift.daily_decisions(fb, F.col("batch_day").try_cast("date"), "company")
    outputs = drift.daily_decisions(fb, F.substring("captured_at", 1, 10).try_cast("date"), "model_label")
    return drift.triage_by_day(inputs, outputs).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


_WORST = f"src AS (SELECT *, length(text)::DOUBLE AS n_chars FROM splits), {_psi_sql('src', '(source = ' + chr(39) + 'final_data' + chr(39) + ')', ['company', 'dialect', 'label'], ['n_chars'])}"


@query("worst_of_reports", f"WITH {_WORST} SELECT 'second' AS source, \"column\", score FROM out WHERE decision = 'FAIL' ORDER BY score DESC, list_position(['dialect', 'label', 'company', 'n_chars'], \"column\") LIMIT 1")
def worst_of_reports(spark, d):
    rows = read(spark, d, "splits").withColumn("n_chars", F.length("text").cast("double"))
    scores = drift.psi(rows, F.col("source") == "final_data", ["company", "dialect", "label"], ["n_chars"])
    return drift.worst_of([("first", ["dialect"], scores.limit(0)), ("second", ["dialect", "label", "company", "n_chars"], scores)])


# ---- the frozen projection

_FIXED = features.Basis(tuple(i / 64 for i in range(64)), tuple(tuple((1.0 if (i >> k) & 1 else -1.0) / 8 for i in range(64)) for k in range(3)), (0.5, 0.3, 0.1), 500, "e", 128, "mean", 3)
_COORDINATE = "round(list_sum(list_transform(range(1, 65), lambda i: (embedding[i]::DOUBLE - (i - 1) / 64.0::DOUBLE) * CASE WHEN ((i - 1) >> {k}) & 1 = 1 THEN 0.125::DOUBLE ELSE -0.125::DOUBLE END)), 5)"


@query("fixed_projection", "SELECT vec_id, " + ", ".join(f"{_COORDINATE.format(k=k)} AS embedding_pc{k + 1}" for k in range(3)) + " FROM embeddings")
def fixed_projection(spark, d):
    """A basis that was saved and loaded again."""
    path = _folder(spark, "basis")
    features.save_basis(spark, _FIXED, path)
    out = features.project(read(spark, d, "embeddings"), "embedding", features.load_basis(spark, path))
    return out.select("vec_id", *(F.round(f"embedding_pc{k + 1}", 5).alias(f"embedding_pc{k + 1}") for k in range(3)))


@query("explained_variance", "SELECT 1 AS component, 0.5 AS explained, 0.5 AS total UNION ALL VALUES (2, 0.3, 0.8), (3, 0.1, 0.9)")
def explained_variance(spark, d):
    return features.explained(spark, _FIXED).withColumns({c: F.round(c, 6) for c in ("explained", "total")})


@query("pca_invariants", "SELECT 10::BIGINT AS components, count(*)::BIGINT AS rows, true AS orthonormal, true AS centred, true AS uncorrelated, true AS descending FROM embeddings")
def pca_invariants(spark, d):
    """What principal components are known by: orthonormal axes, coordinates of mean 0 without correlation, variances in descending order."""
    e = read(spark, d, "embeddings")
    path = _folder(spark, "basis")
    panel = features.reference_panel(e, "vec_id", "embedding", 10, path, encoder="e", max_length=128, pooling="mean")
    basis = features.load_basis(spark, path)
    k = len(basis.components)
    dots = [abs(sum(a * b for a, b in zip(basis.components[i], basis.components[m])) - (i == m)) for i in range(k) for m in range(i, k)]
    names = [f"embedding_pc{i + 1}" for i in range(k)]
    one = panel.agg(F.count(F.lit(1)).alias("rows"), *(F.avg(n).alias(f"m{i}") for i, n in enumerate(names)), *(F.var_samp(n).alias(f"v{i}") for i, n in enumerate(names)), *(F.corr(names[i], names[i + 1]).alias(f"c{i}") for i in range(k - 1)))
    every = lambda xs: reduce(lambda a, b: a & b, xs)
    return one.select(
        F.lit(k).cast("long").alias("components"), "rows", F.lit(max(dots) < 1e-9).alias("orthonormal"), every([F.abs(F.col(f"m{i}")) < 1e-6 for i in range(k)]).alias("centred"),
        every([F.abs(F.col(f"c{i}")) < 1e-6 for i in range(k - 1)]).alias("uncorrelated"), every([F.col(f"v{i}") >= F.col(f"v{i + 1}") for i in range(k - 1)]).alias("descending"))


@query("pooled_means", "SELECT vec_id, round((embedding[1]::DOUBLE + embedding[33]::DOUBLE * (vec_id % 2)) / (1 + vec_id % 2), 6) AS first, round((embedding[32]::DOUBLE + embedding[64]::DOUBLE * (vec_id % 2)) / (1 + vec_id % 2), 6) AS last FROM embeddings")
def pooled_means(spark, d):
    v = F.col("embedding").cast("array<double>")
    pooled = features.masked_mean(F.array(F.slice(v, 1, 32), F.slice(v, 33, 32)), F.array(F.lit(1.0), (F.col("vec_id") % 2).cast("double")))
    return read(spark, d, "embeddings").select("vec_id", F.round(pooled[0], 6).alias("first"), F.round(pooled[31], 6).alias("last"))


class LengthEncoder:
    """An encoder without weights: length and words of a text."""

    def __call__(self, texts):
        import numpy as np

        return np.array([[len(x), x.count(" ")] for x in texts], float).reshape(len(texts), 2)


@query("embedded_texts", "SELECT row_id, length(coalesce(text, ''))::DOUBLE AS a, (length(coalesce(text, '')) - length(replace(coalesce(text, ''), ' ', '')))::DOUBLE AS b FROM splits WHERE split = 'test'")
def embedded_texts(spark, d):
    out = features.embedded(read(spark, d, "splits").where("split = 'test'").select("row_id", "text"), "text", LengthEncoder)
    return out.select("row_id", F.col("embedding")[0].alias("a"), F.col("embedding")[1].alias("b"))


@query("row_confidence", f"WITH {_DEC} SELECT row_id, predicted_score AS given, greatest(positive, neutral) AS fallback FROM decided")
def row_confidence(spark, d):
    rows = _scored(spark, d)
    return rows.select("row_id", features.row_confidence(rows).alias("given"), features.row_confidence(rows.drop("predicted_score", "negative")).alias("fallback"))


@query("class_counts", f"WITH {_DEC} SELECT x AS label, (SELECT count(*) FROM decided WHERE predicted_label = x) AS n, round((SELECT count(*) FROM decided WHERE predicted_label = x) / (SELECT count(*) FROM decided), 6) AS share FROM (SELECT unnest(['positive', 'negative', 'neutral']) AS x)")
def class_counts(spark, d):
    return scoring.class_counts(_scored(spark, d))


# ---- splits with their varieties

@query("split_report", f"""WITH {_PARTS}, {_TAG}, b AS (SELECT part, label, dialect FROM parts JOIN tagged USING (review_id)), n AS (SELECT part, count(*) AS size FROM b GROUP BY part)
SELECT part, 'label' AS dim, label AS value, count(*) AS n, round(count(*) / any_value(size), 5) AS share FROM b JOIN n USING (part) GROUP BY part, label UNION ALL
SELECT part, 'dialect', dialect, count(*), round(count(*) / any_value(size), 5) FROM b JOIN n USING (part) GROUP BY part, dialect UNION ALL SELECT part, 'all', 'all', size, 1.0 FROM n""")
def split_report(spark, d):
    """The three parts, tagged with their variety, written by part, read again and counted in both dimensions at once."""
    raw = read(spark, d, "final_data").select("review_id", "review_description", F.lower(F.trim("rating")).alias("label"))
    path = _folder(spark, "parts")
    dialect.tagged(splitting.stratified(raw, "label", "review_id"), "review_description").write.partitionBy("part").parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.groupingSets([["part", "label"], ["part", "dialect"], ["part"]], "part", "label", "dialect").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    size = counts.where("g = 3").select("part", F.col("n").alias("size"))
    dim = F.when(F.col("g") == 3, "all").when(F.col("g") == 1, "label").otherwise("dialect")
    value = F.when(F.col("g") == 3, "all").when(F.col("g") == 1, F.col("label")).otherwise(F.col("dialect"))
    return counts.join(size, "part").select("part", dim.alias("dim"), value.alias("value"), "n", F.round(F.col("n") / F.col("size"), 5).alias("share"))


# ---- metrics against a base

_VALUE = "CASE WHEN doc_id % 17 = 0 THEN 'true' WHEN doc_id % 19 = 0 THEN 'n/a' ELSE (n_chars + {more})::VARCHAR END"
_GATE = f"""b AS (SELECT source || CASE WHEN doc_id % 2 = 0 THEN '_old' ELSE '' END AS path, 'm' || doc_id AS metric, {_VALUE.format(more='0')} AS value FROM documents WHERE source IS NOT NULL AND doc_id % 10 <> 3 AND doc_id % 2 = 0),
w AS (SELECT source || CASE WHEN doc_id % 2 = 0 THEN '_old' ELSE '' END AS path, 'm' || doc_id AS metric, {_VALUE.format(more='doc_id % 3')} AS value FROM documents WHERE source IS NOT NULL AND doc_id % 10 <> 4),
g AS (SELECT coalesce(b.path, w.path) AS path, coalesce(b.metric, w.metric) AS metric, b.value AS old, w.value AS new FROM b FULL JOIN w ON b.path = w.path AND b.metric = w.metric),
i AS (SELECT *, regexp_matches(metric, '5$') OR regexp_matches(path, '5$') AS ignored, path IN (SELECT path FROM b) AS known, try_cast(new AS DOUBLE) - try_cast(old AS DOUBLE) AS raw FROM g),
k AS (SELECT *, CASE WHEN regexp_matches(old, '^[0-9.]+$') AND regexp_matches(new, '^[0-9.]+$') THEN raw END AS delta FROM i),
r AS (SELECT *, CASE WHEN NOT known THEN 'new_file' WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'removed' WHEN delta IS NULL THEN 'malformed' WHEN abs(delta) > 0.005 THEN 'drift' ELSE '' END AS reason FROM k WHERE NOT ignored),
s AS (SELECT path, metric, old, new, round(delta, 6) AS diff, CASE reason WHEN '' THEN 'PASS' WHEN 'new_file' THEN 'NEW' ELSE 'FAIL' END AS status, reason FROM r)"""


def _metrics(spark, d):
    docs = read(spark, d, "documents").where("source IS NOT NULL")
    n = F.col("doc_id")
    value = lambda more: F.when(n % 17 == 0, "true").when(n % 19 == 0, "n/a").otherwise((F.col("n_chars") + more).cast("string"))
    side = lambda df, more: df.select(F.concat("source", F.when(n % 2 == 0, "_old").otherwise("")).alias("path"), F.concat(F.lit("m"), n.cast("string")).alias("metric"), value(more).alias("value"))
    return side(docs.where("doc_id % 10 <> 3 AND doc_id % 2 = 0"), F.lit(0)), side(docs.where("doc_id % 10 <> 4"), n % 3)


@query("metric_gate", f"WITH {_GATE} SELECT * FROM s")
def metric_gate(spark, d):
    return ev.metric_gate(*_metrics(spark, d), ignore="5$")


@query("gate_summary", f"WITH {_GATE} SELECT count(*) AS compared, count(*) FILTER (WHERE status = 'FAIL') AS failed, count(*) FILTER (WHERE status = 'NEW') AS new, (SELECT count(*) FROM i WHERE ignored) AS ignored, count(*) FILTER (WHERE status = 'FAIL') = 0 AS passed FROM s")
def gate_summary(spark, d):
    return ev.gate_summary(*_metrics(spark, d), ignore="5$")


@query("call_stats", """WITH c AS (SELECT 1 + event_id % 32 AS items, value / 1000 AS drain, value / 500 AS score FROM events), x AS (SELECT count(*) AS batches, sum(items)::BIGINT AS items, avg(items / 32) AS f, quantile_cont(items / 32, 0.5) AS p, sum(drain + score) AS w FROM c)
SELECT batches, items, round(f, 6) AS fill_ratio, round(p, 6) AS fill_p50, round(items / batches, 6) AS amortization, round(w, 6) AS work_seconds, round(items / w, 6) AS per_second, round(5000 / round(w, 6), 6) AS speedup, round((5000 + items * 0.02) / (round(w, 6) + batches * 0.02), 6) AS speedup_with_overhead FROM x""")
def call_stats(spark, d):
    calls = read(spark, d, "events").select((1 + F.col("event_id") % 32).alias("items"), (F.col("value") / 1000).alias("drain"), (F.col("value") / 500).alias("score"))
    return ev.call_stats(calls, 32, 5000.0, 0.02)


# ---- telemetry

_HIST = ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS le_{i}" for i, b in enumerate(pairing.BUCKETS))


@query("worker_counters", f"SELECT CASE WHEN event_id % 2 = 0 THEN 'stable' ELSE 'candidate' END AS worker, count(*) AS ingested, count(*) FILTER (WHERE event_type = 'error') AS errors, count(value) AS latency_count, round(sum(value), 6) AS latency_sum, {_HIST} FROM events GROUP BY 1")
def worker_counters(spark, d):
    e = read(spark, d, "events").withColumn("worker", F.when(F.col("event_id") % 2 == 0, "stable").otherwise("candidate"))
    return pairing.worker_counters(e, F.col("event_type") == "error", F.col("value"))


def _p95() -> str:
    bounds = (0.0, *pairing.BUCKETS)
    cases = "".join(f" WHEN 0.95 * n <= c{i} THEN {bounds[i]} + {bounds[i + 1] - bounds[i]} * (0.95 * n - {'0' if not i else f'c{i - 1}'}) / (c{i} - {'0' if not i else f'c{i - 1}'})" for i in range(len(pairing.BUCKETS)))
    return f"CASE{cases} ELSE {pairing.BUCKETS[-1]} END"


_CUM = ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS c{i}" for i, b in enumerate(pairing.BUCKETS))


@query("trailing_metrics", f"""WITH m AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'stable' ELSE 'candidate' END AS worker, event_type, value, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE * k AS at_ FROM events, (SELECT unnest(range(1, 6)) AS k)),
g AS (SELECT at_, worker, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error') AS errors, count(value) AS n, {_CUM} FROM m GROUP BY ALL)
SELECT strftime(at_, '%Y-%m-%d %H:%M') AS at, worker, requests, round(errors / requests, 6) AS error_rate, round({_p95()}, 6) AS p95 FROM g""")
def trailing_metrics(spark, d):
    e = read(spark, d, "events").withColumns({"worker": F.when(F.col("event_id") % 2 == 0, "stable").otherwise("candidate"), "ts": F.col("ts").cast("timestamp")})
    out = pairing.trailing_metrics(e, F.col("ts"), F.col("event_type") == "error", F.col("value"))
    return out.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm"))


@query("instant_counts", "SELECT nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS click, nullif(count(*) FILTER (WHERE event_type = 'nothing'), 0) AS nothing FROM events WHERE ts <= TIMESTAMP '2024-01-10 12:00:00' AND ts > TIMESTAMP '2024-01-10 06:00:00'")
def instant_counts(spark, d):
    return pairing.instant(read(spark, d, "events"), F.col("ts").cast("timestamp"), "2024-01-10 12:00:00", 360, "click", "nothing", by="event_type")


@query("exposed_metrics", "SELECT 'ingest_total{worker=\"' || event_type || '\",kind=\"a\\\"b\"} ' || count(*) AS line FROM events GROUP BY event_type")
def exposed_metrics(spark, d):
    g = read(spark, d, "events").groupBy(F.col("event_type").alias("worker")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit('a"b'))
    return files.exposition(g, "ingest_total", "n", "worker", "kind")


_BODY = """CASE event_id % 4 WHEN 0 THEN '{"texts":["' || event_type || '",5,"x"],"predictions":[{"label":"' || event_type || '","score":0.5},{"score":1}]}' WHEN 1 THEN '{"texts":null}' WHEN 2 THEN 'no json' ELSE '[1]' END"""


@query("telemetry_bodies", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type || '|x' ELSE '' END AS texts, CASE WHEN event_id % 4 = 0 THEN event_type || '|' ELSE '' END AS labels, CASE WHEN event_id % 4 = 0 THEN 2 ELSE 0 END AS n FROM events")
def telemetry_bodies(spark, d):
    body = F.expr(_BODY)
    rows = read(spark, d, "events").select("event_id", j.body_texts(body).alias("t"), j.body_labels(body).alias("l"))
    return rows.select("event_id", F.array_join("t", "|").alias("texts"), F.array_join("l", "|").alias("labels"), F.size("l").alias("n"))


@query("pair_keys", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'r' || event_id WHEN event_id % 3 = 1 THEN sha256(event_type || chr(31) || 'x') ELSE '' END AS key FROM events")
def pair_keys(spark, d):
    n = F.col("event_id") % 3
    texts = F.when(n == 1, F.array("event_type", F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return read(spark, d, "events").select("event_id", j.pair_key(F.when(n == 0, F.concat(F.lit("r"), "event_id")).when(n == 1, ""), texts).alias("key"))


@query("encoded_results", """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"id":"' || event_id || '",' ELSE '{' END || '"text":"' || event_type || '","label":"positive","score":0.5}' AS message FROM events""")
def encoded_results(spark, d):
    given = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string"))
    return read(spark, d, "events").select("event_id", j.result(given, F.col("event_type"), F.lit("positive"), F.lit(0.5)).alias("message"))


@query("held_seconds", f"SELECT event_id, round(epoch_us(TIMESTAMP '2024-02-01 00:00:00') / 1e6 - epoch_us(date_trunc('second', ts)) / 1e6, 3) AS held FROM ({_EV})")
def held_seconds(spark, d):
    e = read(spark, d, "events").select("event_id", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("since"))
    return e.select("event_id", F.round(dates.held_seconds(F.col("since"), F.lit("2024-02-01T00:00:00+00:00")), 3).alias("held"))


@query("label_numbers", "SELECT label, (row_number() OVER (ORDER BY label) - 1)::INT AS id, 'text' AS by FROM (SELECT DISTINCT label FROM splits WHERE label IS NOT NULL) UNION ALL VALUES ('positive', 0, 'map'), ('negative', 1, 'map'), ('neutral', 2, 'map')")
def label_numbers(spark, d):
    rows = read(spark, d, "splits")
    given = checks.label_ids(rows, "label", {"0": "positive", "1": "negative", "2": "neutral"}).withColumn("by", F.lit("map"))
    return checks.label_ids(rows, "label").withColumn("by", F.lit("text")).unionByName(given)


# ---- calendars, settings, small files

_EVENTS = [
    {"name": "moon", "date": "2026-10-17", "confirmed": False, "lead_days": 21}, "no entry", {"date": "2026-01-01"}, {"name": "national", "date": "2025-09-23", "confirmed": True, "lead_days": 14},
    {"name": "sale", "rule": "black_friday", "confirmed": True, "lead_days": 70}, {"name": "odd", "rule": "unknown", "confirmed": True}, {"name": "broken", "date": "soon", "confirmed": True}, {"name": "autumn", "date": "2026-10-01", "confirmed": True},
]
_CALENDAR = """WITH e(place, name, on_, confirmed, lead) AS (VALUES (0, 'moon', DATE '2026-10-17', false, 21), (3, 'national', DATE '2026-09-23', true, 14), (4, 'sale', DATE '2026-11-27', true, 70), (7, 'autumn', DATE '2026-10-01', true, 21)),
x AS (SELECT DISTINCT batch_day::DATE AS day FROM feedback), h AS (SELECT day, place, name, on_ FROM x JOIN e ON confirmed AND on_ BETWEEN day AND day + lead), f AS (SELECT day, min(place) AS place FROM h GROUP BY day)
SELECT strftime(x.day, '%Y-%m-%d') AS day, (SELECT name FROM h WHERE h.day = x.day AND h.place = f.place) AS event, (SELECT strftime(on_, '%Y-%m-%d') FROM h WHERE h.day = x.day AND h.place = f.place) AS event_date, (SELECT on_ - h.day FROM h WHERE h.day = x.day AND h.place = f.place)::INT AS days_until,
coalesce((SELECT string_agg(name, ';' ORDER BY h.place) FROM h WHERE h.day = x.day AND h.place > f.place), '') AS others, 'moon' AS unconfirmed, 'odd;broken' AS unresolvable FROM x LEFT JOIN f ON x.day = f.day"""


@query("calendar_window", _CALENDAR)
def calendar_window(spark, d):
    path = _folder(spark, "calendar")
    files.write_state(spark, path, json.dumps({"events": _EVENTS}))
    days = read(spark, d, "feedback").select(F.col("batch_day").try_cast("date").alias("day")).where("day IS NOT NULL")
    out = dates.calendar_signal(days, files.read_calendar(spark, path))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("day", "event_date")})


@query("settings_used", "SELECT 'least_agents' AS name, '3' AS value UNION ALL VALUES ('suspicious', '0.9'), ('neutral_cap', '50'), ('least_chars', '12'), ('absent', '0')")
def settings_used(spark, d):
    path = _folder(spark, "params")
    files.write_state(spark, path, json.dumps({"feedback": {"least_agents": "3"}, "preprocessing": {"min_chars": 12}}))
    defaults = {"least_agents": 2, "suspicious": 0.9, "neutral_cap": 50, "least_chars": 10}
    used = files.settings(files.read_yaml(spark, path), "feedback", defaults, {"least_chars": ("preprocessing", "min_chars")})
    used["absent"] = len(files.read_yaml(spark, path + "-none"))
    return spark.createDataFrame([(k, str(v)) for k, v in used.items()], "name string, value string")


@query("state_replaced", "SELECT 'second' AS content, NULL AS absent")
def state_replaced(spark, d):
    path = _folder(spark, "state")
    for text in ("first", "second"):
        files.write_state(spark, path, text)
    return spark.createDataFrame([(files.read_state(spark, path), files.read_state(spark, path + "-none"))], "content string, absent string")


@query("csv_glob", "SELECT feedback_row::VARCHAR AS feedback_row, coalesce(note, '') AS note FROM feedback WHERE batch_day < '2026-09-15'")
def csv_glob(spark, d):
    """Several files by a pattern, each with a byte order mark; what the pattern leaves out and an empty folder add nothing."""
    base = _folder(spark, "glob")
    rows = read(spark, d, "feedback").select(F.col("feedback_row").cast("string").alias("feedback_row"), "note", "batch_day")
    for name, part in (("a", "batch_day < '2026-09-10'"), ("b", "batch_day >= '2026-09-10' AND batch_day < '2026-09-15'"), ("c", "batch_day >= '2026-09-15'")):
        rows.where(part).select(F.col("feedback_row").alias("﻿feedback_row"), "note").write.options(**files.CSV).csv(f"{base}/{name}")
    found = files.read_csv_strings(spark, f"{base}/[ab]", ("feedback_row", "note"))
    return found.unionByName(files.read_csv_strings(spark, f"{base}/none*", ("feedback_row", "note")))


@query("file_days", "SELECT batch_day AS day, batch_day <> (SELECT min(batch_day) FROM feedback) AS readable, batch_day = (SELECT max(batch_day) FROM feedback) AS newest FROM feedback GROUP BY batch_day")
def file_days(spark, d):
    """Reports named by day, one of them unreadable: listed in order, and the newest of them."""
    base = _folder(spark, "days")
    days = [r[0] for r in read(spark, d, "feedback").select("batch_day").distinct().orderBy("batch_day").collect()]  # a few days
    for i, day in enumerate(days):
        files.write_state(spark, f"{base}/{day}.json", '{"n": 1}' if i else "{broken")
    reports = files.read_json_reports(spark, base, "n int")
    last = files.newest(reports.where("report IS NOT NULL")).select(F.col("day").alias("last"))
    return files.days_of(reports).crossJoin(F.broadcast(last)).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "readable", (F.col("day") == F.col("last")).alias("newest"))  # last: one row


@query("renamed_columns", "SELECT review_id, review_description AS text, rating AS label, '' AS note FROM final_data")
def renamed_columns(spark, d):
    rows = files.renamed(read(spark, d, "final_data"), review_description="text", rating="label")
    return rows.select("review_id", "text", "label").join(files.with_defaults(rows, "note").limit(1), how="cross")


@query("variants_missing", "SELECT v AS value FROM (SELECT unnest(['click', 'view', 'error', 'never']) AS v) WHERE v NOT IN (SELECT event_type FROM events)")
def variants_missing(spark, d):
    return checks.missing_from_domain(read(spark, d, "events"), "event_type", ("click", "view", "error", "never"))
