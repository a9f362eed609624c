"""Queries of message decoding and of streams, run to their end over the input files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import json as j
from ..operators import pairing
from ..sources import queue
from ..streaming import jobs
from .catalog import query
from .evaluating import REPLAY, telemetry
from .panels import LengthScorer
from .tables import read

_MSG = """m AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type || ' raw' WHEN 1 THEN '{"id":"' || event_id || '","text":"' || event_type || '"}' WHEN 2 THEN '{"text":5}' ELSE props END AS raw FROM events)"""


def _messages(events):
    r = F.col("event_id") % 4
    return events.select("event_id", F.when(r == 0, F.concat("event_type", F.lit(" raw"))).when(r == 1, F.concat(F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('","text":"'), "event_type", F.lit('"}')))
                         .when(r == 2, '{"text":5}').otherwise(F.col("props")).alias("raw"))


@query("queue_decode", f"WITH {_MSG} SELECT event_id, CASE WHEN NOT json_valid(raw) THEN raw WHEN json_type(raw) = 'OBJECT' AND json_type(raw, '$.text') = 'VARCHAR' THEN json_extract_string(raw, '$.text') END AS text, CASE WHEN json_valid(raw) THEN nullif(json_extract_string(raw, '$.id'), '') END AS id FROM m")
def queue_decode(spark, d):
    return _messages(read(spark, d, "events")).select("event_id", j.message_text(F.col("raw")).alias("text"), j.message_id(F.col("raw")).alias("id"))


@query("props_numbers", "SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events")
def props_numbers(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


def _stream(spark, d, table):
    schema = read(spark, d, table).schema
    return jobs.stream_files(spark, f"{d}/{table[:-1]}[{table[-1]}].parquet", schema)


@query("stream_windows", "SELECT time_bucket(INTERVAL 60 MINUTES, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING time_bucket(INTERVAL 60 MINUTES, ts) + INTERVAL 2 HOURS <= (SELECT date_trunc('millisecond', max(ts)) FROM events)")
def stream_windows(spark, d):
    rows = _stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return jobs.to_table(jobs.windowed_counts(rows, "ts", 60, "event_type"), "windows").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_captures", "SELECT DISTINCT user_id::VARCHAR || '-' || event_type AS key, strftime(ts, '%Y-%m-%d') AS day FROM events")
def stream_captures(spark, d):
    rows = _stream(spark, d, "events").select(F.concat(F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    return jobs.to_table(jobs.first_captures(rows, "key", "ts").select("key", F.date_format("ts", "yyyy-MM-dd").alias("day")), "captures")


@query("stream_scored", """WITH n AS (SELECT event_id, length(event_type) AS n FROM events), r AS (SELECT event_id, 1 + n % 11 AS a, 1 + n % 13 AS b, 1 + n % 3 AS c FROM n) SELECT event_id, round(a / (a + b + c), 6) AS positive FROM r""")
def stream_scored(spark, d):
    rows = _stream(spark, d, "events").select("event_id", "event_type")
    import pandas as pd

    def make():
        score = LengthScorer()
        return lambda texts: pd.DataFrame({"positive": score(texts)[:, 0]})

    return jobs.to_table(jobs.score_batches(rows, "event_type", make, "event_id long, event_type string, positive double").select("event_id", F.round("positive", 6).alias("positive")), "scored")


@query("stream_pairs", REPLAY + " SELECT key, outcome FROM o")
def stream_pairs(spark, d):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKS)
    try:
        return jobs.to_table(jobs.paired(telemetry(_stream(spark, d, "events")), 1800, most=None), "pairs")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


@query("queue_unreadable", f"WITH {_MSG} SELECT raw AS line, count(*) AS n FROM m WHERE raw IS NOT NULL AND json_valid(raw) AND coalesce(json_type(raw, '$.text'), '') <> 'VARCHAR' GROUP BY raw")
def queue_unreadable(spark, d):
    bad = jobs.queue_messages(_messages(read(spark, d, "events")).where("raw IS NOT NULL"), "raw")[1]
    return bad.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def _numbers(n):
    """A queue that holds the messages 0 to n - 1."""
    def make():
        left = iter(range(n))
        return lambda wait: next((f'{{"id":"{i}","text":"m{i % 7}"}}' for i in left), None)

    return make


@query("queue_drained", "SELECT i::VARCHAR AS id, 'm' || (i % 7) AS text FROM (SELECT unnest(range(500)) AS i)")
def queue_drained(spark, d):
    queue.register(spark, "numbers", _numbers(500))
    return jobs.queue_messages(spark.read.format("numbers").option("max_items", 1000).option("max_wait_ms", 300).load())[0]


@query("landed_records", "SELECT event_id, event_type, value FROM events WHERE event_id % 7 <> 0")
def landed_records(spark, d):
    """Posted lines, a seventh of them broken, through the landing folder."""
    import uuid

    from ..sources.store import shared_folder

    path = f"{shared_folder(spark)}/landing-{uuid.uuid4().hex}"
    record = F.to_json(F.struct("event_id", "event_type", "value"))
    read(spark, d, "events").select(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{broken "), "event_type")).otherwise(record).alias("value")).write.text(path)
    good, _ = jobs.landed(spark, path, "event_id long, event_type string, value double")
    return jobs.to_table(good, "landed")


@query("call_fill", "WITH p AS (SELECT count(*) AS n FROM events) SELECT sum(n)::BIGINT AS items FROM p")
def call_fill(spark, d):
    return jobs.chunk_stats(read(spark, d, "events"), "event_id").agg(F.sum("items").alias("items"))


@query("agreement", """WITH p AS ({}) SELECT count(*) FILTER (WHERE outcome IN ('agree', 'disagree')) AS pairs, round(count(*) FILTER (WHERE outcome = 'agree') / nullif(count(*) FILTER (WHERE outcome IN ('agree', 'disagree')), 0), 6) AS agreement,
count(*) FILTER (WHERE outcome LIKE 'gap%') AS gaps FROM p""".format(__import__("textmill.plans.catalog", fromlist=["_SQL"])._SQL["paired_answers"]))
def agreement(spark, d):
    return pairing.agreement(pairing.pairs(telemetry(read(spark, d, "events")), 1800))
