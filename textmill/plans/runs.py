"""Queries over tables of runs, benchmarks and small documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import runs as r
from ..sources.store import shared_folder
from .catalog import query
from .panels import LengthScorer
from .tables import read


@query("best_per_group", "SELECT company, arg_min(review_id, (-n, review_id)) AS review_id, max(n) AS chars FROM (SELECT company, review_id, length(review_description) AS n FROM final_data WHERE company IS NOT NULL AND review_description IS NOT NULL) GROUP BY company")
def best_per_group(spark, d):
    rows = read(spark, d, "final_data").where("company IS NOT NULL").select("company", "review_id", F.length("review_description").alias("chars"))
    return r.top_run(rows, "chars", "company", "review_id")


@query("unreferenced_runs", "SELECT review_id FROM final_data WHERE review_id NOT IN (SELECT review_id FROM feedback WHERE review_id IS NOT NULL)")
def unreferenced_runs(spark, d):
    return r.unreferenced(read(spark, d, "final_data").select("review_id"), read(spark, d, "feedback"), "review_id")


_PATHS = "SELECT doc_id, CASE WHEN source LIKE '%a%' THEN 'file:///old/runs/' || doc_id ELSE './runs/' || doc_id END AS location FROM documents"


def _paths(spark, d):
    path = F.when(F.col("source").contains("a"), F.concat(F.lit("file:///old/runs/"), "doc_id")).otherwise(F.concat(F.lit("./runs/"), "doc_id"))
    return read(spark, d, "documents").select("doc_id", path.alias("location"))


@query("relocated", f"SELECT doc_id, CASE WHEN contains(location, '/old/') THEN './store/' || doc_id ELSE location END AS location FROM ({_PATHS})")
def relocated(spark, d):
    return r.relocated(_paths(spark, d), "location", "/old/", "doc_id", "./store")[0]


@query("relocated_count", f"SELECT count(*) FILTER (WHERE contains(location, '/old/')) AS repaired FROM ({_PATHS})")
def relocated_count(spark, d):
    return r.relocated(_paths(spark, d), "location", "/old/", "doc_id", "./store")[1]


@query("merged_stores", "SELECT override_id, label, 'local' AS store FROM train_feedback UNION ALL SELECT DISTINCT ON (override_id) override_id, corrected_label, 'foreign' FROM overrides WHERE override_id NOT IN (SELECT override_id FROM train_feedback)")
def merged_stores(spark, d):
    local = read(spark, d, "train_feedback").select("override_id", "label", F.lit("local").alias("store"))
    return r.merged_stores(local, read(spark, d, "overrides").select("override_id", F.col("corrected_label").alias("label"), F.lit("foreign").alias("store")), "override_id")


@query("merged_stores_overwrite", "SELECT override_id, corrected_label AS label, 'foreign' AS store FROM overrides UNION ALL SELECT override_id, label, 'local' FROM train_feedback WHERE override_id NOT IN (SELECT override_id FROM overrides)")
def merged_stores_overwrite(spark, d):
    local = read(spark, d, "train_feedback").select("override_id", "label", F.lit("local").alias("store"))
    return r.merged_stores(local, read(spark, d, "overrides").select("override_id", F.col("corrected_label").alias("label"), F.lit("foreign").alias("store")), "override_id", True)


_BENCH = """WITH s AS (SELECT event_type AS variant, 1 + event_id % 2 * 31 AS batch_size, value AS ms FROM events), b AS (SELECT event_type AS variant, sum(user_id * 1000) / 1e6 AS mb FROM events GROUP BY 1),
q AS (SELECT event_type AS variant, round(avg((value < 50)::INT), 6) AS accuracy FROM events GROUP BY 1)"""


@query("benchmark_rows", _BENCH + """ SELECT variant, bs.batch_size, bs.p50, bs.p95, round(mb, 1) AS size_mb, round(mb / (SELECT mb FROM b WHERE variant = 'click'), 3) AS size_ratio, accuracy
FROM (SELECT variant, batch_size, round(quantile_cont(ms, 0.5), 6) AS p50, round(quantile_cont(ms, 0.95), 6) AS p95 FROM s GROUP BY ALL) bs JOIN b USING (variant) JOIN q USING (variant)""")
def benchmark_rows(spark, d):
    e = read(spark, d, "events").withColumnRenamed("event_type", "variant")
    rows = r.benchmark_rows(
        e.select("variant", (1 + F.col("event_id") % 2 * 31).alias("batch_size"), F.col("value").alias("ms")), e.select("variant", (F.col("user_id") * 1000).alias("bytes")),
        e.groupBy("variant").agg(F.round(F.avg((F.col("value") < 50).cast("int")), 6).alias("accuracy")), "click")
    return rows.withColumn("x", F.explode("latency")).select("variant", "x.*", "size_mb", "size_ratio", "accuracy")


@query("folder_bytes", "SELECT 1::BIGINT AS files, count(*)::BIGINT * 4 AS bytes FROM agents")
def folder_bytes(spark, d):
    path = f"{shared_folder(spark)}/bytes-{uuid.uuid4().hex}"
    read(spark, d, "agents").select(F.lit("abc").alias("value")).coalesce(1).write.text(path)
    return r.folder_bytes(spark, path)


@query("first_matching", "SELECT event_id, event_type FROM events WHERE event_type LIKE '%err%' AND props LIKE '%7%' ORDER BY event_id LIMIT 1")
def first_matching(spark, d):
    return r.first_matching(read(spark, d, "events"), "event_id", event_type="err", props="7").select("event_id", "event_type")


@query("run_grid", "SELECT (row_number() OVER (ORDER BY a, b) - 1)::BIGINT AS run, rate, size FROM (VALUES (0, 2e-5), (1, 3e-5), (2, 5e-5)) x(a, rate), (VALUES (0, 16), (1, 32)) y(b, size)")
def run_grid(spark, d):
    return r.grid(spark, rate=[2e-5, 3e-5, 5e-5], size=[16, 32])


@query("sections", "SELECT section, content FROM (SELECT company AS section, count(*)::VARCHAR AS content FROM final_data WHERE company IS NOT NULL AND company <> 'Qafzet' GROUP BY company) UNION ALL VALUES ('Qafzet', 'seen'), ('last_updated_section', 'Qafzet')")
def sections(spark, d):
    rows = read(spark, d, "final_data").where("company IS NOT NULL").groupBy(F.col("company").alias("section")).agg(F.count(F.lit(1)).cast("string").alias("content"))
    return r.with_section(rows, "Qafzet", "seen")


@query("findings", "SELECT doc_id AS no, source AS finding FROM documents UNION ALL SELECT max(doc_id) + 1, 'long documents recur' FROM documents")
def findings(spark, d):
    return r.with_finding(read(spark, d, "documents").select(F.col("doc_id").alias("no"), F.col("source").alias("finding")), "long documents recur")


class LengthModel:
    """A model without weights: logits from the length of the text."""

    def __call__(self, texts):
        import numpy as np

        return np.log(LengthScorer()(texts))


@query("teacher_logits", """WITH n AS (SELECT row_id, length(coalesce(text, '')) AS n FROM splits WHERE split = 'val'), r AS (SELECT row_id, 1 + n % 11 AS a, 1 + n % 13 AS b, 1 + n % 3 AS c FROM n)
SELECT row_id, round(ln(a / (a + b + c)), 6) AS logit_0, round(ln(c / (a + b + c)), 6) AS logit_2, CASE WHEN a >= b AND a >= c THEN 'positive' WHEN b >= c THEN 'negative' ELSE 'neutral' END AS predicted_label FROM r""")
def teacher_logits(spark, d):
    out = r.with_logits(read(spark, d, "splits").where("split = 'val'").select("row_id", "text"), "text", LengthModel, 32, t.LABELS)
    return out.select("row_id", F.round(F.col("logits")[0], 6).alias("logit_0"), F.round(F.col("logits")[2], 6).alias("logit_2"), "predicted_label")


@query("cache_current", "SELECT count(*) AS cached, (SELECT count(*) FROM splits WHERE split <> 'test') AS source, count(*) = (SELECT count(*) FROM splits WHERE split <> 'test') AS current FROM splits WHERE split = 'train'")
def cache_current(spark, d):
    s = read(spark, d, "splits")
    return r.is_current(s.where("split = 'train'"), s.where("split <> 'test'"))
