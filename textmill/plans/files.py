"""Queries of sources and sinks: tables written in a format and read back whole."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources import files
from ..sources.store import shared_folder
from .catalog import query
from .tables import read


def _path(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_strings", "SELECT feedback_row::VARCHAR AS feedback_row, coalesce(override_id, '') AS override_id, coalesce(text, '') AS text, coalesce(note, '') AS note FROM feedback")
def csv_strings(spark, d):
    path, cols = _path(spark, "csv"), ("feedback_row", "override_id", "text", "note")
    files.write_csv_sorted(read(spark, d, "feedback").withColumn("feedback_row", F.col("feedback_row").cast("string")), path, cols, "override_id", "feedback_row")
    return files.read_csv_strings(spark, path, cols)


@query("csv_typed", "SELECT review_id, rating, company FROM final_data")
def csv_typed(spark, d):
    path = _path(spark, "csv")
    files.write_csv_sorted(read(spark, d, "final_data"), path, ("review_id", "rating", "company"), "review_id")
    return files.read_csv(spark, path, "review_id bigint, rating string, company string")


@query("json_report", "SELECT strftime(DATE '2026-01-01' + row_number() OVER (ORDER BY split)::INT, '%Y-%m-%d') AS day, split, n, round(confidence, 6) AS confidence FROM (SELECT split, count(*) AS n, avg(dialect_confidence) AS confidence FROM splits GROUP BY split)")
def json_report(spark, d):
    """A report a split, each a JSON file named by a day."""
    path = _path(spark, "json")
    g = read(spark, d, "splits").groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("dialect_confidence").alias("confidence"))
    for i, r in enumerate(g.orderBy("split").toJSON().collect()):  # a row a split
        files.write_state(spark, f"{path}/2026-01-{i + 2:02d}.json", r)
    out = files.read_json_reports(spark, path, "split string, n bigint, confidence double")
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "report.split", "report.n", F.round("report.confidence", 6).alias("confidence"))


@query("day_partitions", "SELECT batch_day::DATE AS batch_day, count(*) AS n FROM feedback GROUP BY 1")
def day_partitions(spark, d):
    path = _path(spark, "days")
    files.append_by_day(read(spark, d, "feedback").select("feedback_row", "batch_day"), path, "batch_day")
    return spark.read.parquet(path).groupBy("batch_day").agg(F.count(F.lit(1)).alias("n")).select(F.col("batch_day").cast("date").alias("batch_day"), "n")


@query("metrics_long", "SELECT source, metric, value FROM (SELECT source, count(*)::DOUBLE AS documents, sum(n_chars)::DOUBLE AS chars, max(n_chars)::DOUBLE AS longest FROM documents GROUP BY source) UNPIVOT (value FOR metric IN (documents, chars, longest))")
def metrics_long(spark, d):
    g = read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars"), F.max("n_chars").alias("longest"))
    return files.long_metrics(g, "source")


@query("union_with_missing", "SELECT text, label, company, source, 'splits' AS origin FROM splits WHERE split = 'train' UNION ALL SELECT text, label, company, source, 'train_feedback' FROM train_feedback")
def union_with_missing(spark, d):
    a = read(spark, d, "splits").where("split = 'train'").select("text", "label", "company", "source", F.lit("splits").alias("origin"))
    return a.unionByName(read(spark, d, "train_feedback").select("text", "label", "company", "source", F.lit("train_feedback").alias("origin")), allowMissingColumns=True)
