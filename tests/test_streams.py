"""Streams run to their end over small files."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textmill.sources import queue
from textmill.streaming import jobs, pairing

EVENTS = "key string, worker string, labels array<string>, shadow boolean, request_id string, s int"


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKS)


def answers(spark, rows):
    """(key, worker, label or labels, second, shadow, request id)"""
    full = [(k, w, lab if isinstance(lab, list) else [lab], shadow, rid, s) for k, w, lab, s, shadow, rid in ((*r, True, "r")[:6] if len(r) < 6 else r for r in rows)]
    return spark.createDataFrame(full, EVENTS).select("key", "worker", "labels", "shadow", "request_id", F.timestamp_seconds(F.col("s") + 1000).alias("ts"))


def in_batches(spark, tmp_path, batches, most=4096, ttl=30):
    """The outcomes after every micro-batch of one stream that goes on."""
    got = []
    for b in batches:
        df = answers(spark, b).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "in"))
        out = []
        jobs.run_available(jobs.paired(jobs.stream_files(spark, str(tmp_path / "in"), df.schema), ttl, most=most), lambda x, n: out.extend(tuple(r) for r in x.collect()), str(tmp_path / "cp"))  # noqa: B023
        got.append(sorted(out))
    return got


def test_pairing(spark, tmp_path):
    first = [("a", "stable", "x", 0), ("a", "candidate", "x", 5), ("b", "candidate", "x", 1), ("b", "stable", "y", 2), ("c", "stable", "x", 3)]
    assert in_batches(spark, tmp_path, [first, [("z", "stable", "x", 500)]]) == [[("a", "agree"), ("b", "disagree")], [("c", "gap_candidate")]]


def test_answers_far_apart_do_not_meet(spark, tmp_path):
    rows = [("a", "stable", "x", 0), ("a", "candidate", "x", 500)]
    assert in_batches(spark, tmp_path, [rows, [("z", "stable", "x", 2000)]]) == [[("a", "gap_candidate")], [("a", "gap_stable")]]
    late = answers(spark, [*rows, ("z", "stable", "x", 2000)])
    assert sorted(tuple(r) for r in pairing.replayed(late).collect()) == [("a", "gap_candidate"), ("a", "gap_stable")]


def test_answers_of_several_batches_meet_and_leave_no_timer(spark, tmp_path):
    got = in_batches(spark, tmp_path, [[("a", "stable", "x", 0)], [("a", "candidate", "x", 10)], [("z", "stable", "x", 900)], [("y", "stable", "x", 1800)]])
    assert got == [[], [("a", "agree")], [], [("z", "gap_candidate")]]


def test_what_counts(spark, tmp_path):
    """No key or neither shadow nor request id: no pair; not shadowed or without labels: a pair without a row; the last answer of a worker counts."""
    rows = [("", "stable", "x", 0, True, "r"), ("n", "stable", "x", 0, False, ""), ("n", "candidate", "x", 1, False, ""), ("u", "stable", "x", 0, False, "r"), ("u", "candidate", "x", 1, False, "r"),
            ("e", "stable", [], 0, True, ""), ("e", "candidate", "x", 1, True, ""), ("s", "stable", "x", 0, False, "r"), ("s", "candidate", "x", 1, True, ""), ("l", "stable", "x", 0, True, ""), ("l", "stable", "y", 1, True, ""), ("l", "candidate", "y", 2, True, ""),
            ("two", "stable", ["x", "y"], 0, True, ""), ("two", "candidate", ["y", "x"], 1, True, ""), ("g", "candidate", "x", 0, False, "r")]
    want = [("l", "agree"), ("s", "agree"), ("two", "disagree")]
    assert in_batches(spark, tmp_path, [rows, [("z", "stable", "x", 5000)]]) == [want, []]
    assert sorted(tuple(r) for r in pairing.replayed(answers(spark, rows)).collect()) == want
    assert pairing.replayed(answers(spark, rows).limit(0)).count() == 0


def test_room_is_made_for_new_pairs(spark, tmp_path):
    """With room for one pair a lane, the older one goes without a gap."""
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [r[0] for r in spark.range(200).select(F.concat(F.lit("k"), "id").alias("k")).where(F.pmod(F.xxhash64("k"), F.lit(lanes)) == 0).limit(2).collect()]
    rows = [(keys[0], "stable", "x", 0), (keys[1], "stable", "x", 1), (keys[0], "candidate", "x", 2)]
    assert in_batches(spark, tmp_path, [rows, [("z", "stable", "x", 900)]], most=lanes) == [[], [(keys[0], "gap_stable")]]
    assert in_batches(spark, tmp_path / "wide", [rows])[0] == [(keys[0], "agree")]


def test_pairs_run_where_the_workers_do_not_know_the_package(tmp_path):
    data = os.environ.get("TEXTMILL_TEST_DATA", "/root/testdata/sf0.001")
    if not os.path.isdir(data):
        pytest.skip("no test tables")
    root = Path(__file__).resolve().parent.parent
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
import __spark_entry__ as e
print("rows", e.queries()["stream_pairs"](spark, {data!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, cwd=tmp_path, timeout=300)
    assert "rows " in out.stdout and int(out.stdout.split("rows ")[1].split()[0]) > 0, out.stderr[-2000:]


def test_captures_once_a_day(spark, tmp_path):
    spark.createDataFrame([("k", 0), ("k", 9), ("l", 3), ("k", 90_000)], "key string, s int").select("key", F.timestamp_seconds("s").alias("ts")).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    out = jobs.to_table(jobs.first_captures(jobs.stream_files(spark, str(tmp_path / "in"), schema), "key", "ts"), "t")
    assert sorted(r["key"] for r in out.collect()) == ["k", "k", "l"]


def test_windows_come_out_once_they_are_over(spark, tmp_path):
    spark.createDataFrame([(0,), (30,), (90,), (9000,)], "s int").select(F.timestamp_seconds("s").alias("ts")).write.parquet(str(tmp_path / "in"))
    rows = jobs.stream_files(spark, str(tmp_path / "in"), "ts timestamp")
    out = jobs.to_table(jobs.windowed_counts(rows, "ts", 1, delay="0 seconds"), "w")
    assert sorted(r["n"] for r in out.collect()) == [1, 2]


def test_batches_that_run_twice_leave_one_copy(spark, tmp_path):
    write = jobs.append_batches_by_day(str(tmp_path / "days"), "day")
    one, two = (spark.createDataFrame(x, "id long, day string") for x in ([(1, "a"), (2, "b")], [(3, "b")]))
    for df, n in ((one, 0), (two, 1), (two, 1), (one, 0)):
        write(df, n)
    assert sorted((r["id"], r["day"]) for r in spark.read.parquet(str(tmp_path / "days")).collect()) == [(1, "a"), (2, "b"), (3, "b")]


def test_unreadable_lines_are_set_aside(spark, tmp_path):
    spark.createDataFrame([(x,) for x in ('{"a": 1, "b": "x"}', "{broken", '{"a": "text"}', "[1]", "", '{"b": null}')], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    good, bad = jobs.landed(spark, str(tmp_path / "in"), "a int, b string")
    assert sorted(tuple(r) for r in jobs.to_table(good, "good").fillna({"a": 0, "b": ""}).collect()) == [(0, ""), (1, "x")]
    assert {r["line"] for r in jobs.to_table(bad, "bad").collect()} >= {"{broken", '{"a": "text"}', "[1]"}


@pytest.mark.parametrize("limit,why", [({"batches": 2}, "batches"), ({"seconds": 1.0}, "duration"), ({"idle_seconds": 1.0}, "idle")])
def test_a_stream_stops_for_each_reason(spark, tmp_path, limit, why):
    for i in range(3):
        spark.createDataFrame([(i,)], "a int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = []
    df = jobs.stream_files(spark, str(tmp_path / "in"), "a int", per_trigger=1)
    assert jobs.run_until(df, lambda b, n: got.append(b.count()), str(tmp_path / "cp"), **limit) == why
    assert got[:2] == [1, 1][: len(got)] and (why != "batches" or len(got) == 2)


def test_rate_makes_rows(spark, tmp_path):
    got = []
    jobs.run_until(jobs.rate(spark, 50), lambda b, n: got.append(b.count()), str(tmp_path / "cp"), batches=1, seconds=30)
    assert sum(got) > 0


def test_calls_are_cut_to_size(spark):
    stats = jobs.chunk_stats(spark.range(1000), "id", 32, 4)
    assert stats.agg(F.sum("items")).first()[0] == 1000 and stats.agg(F.max("items")).first()[0] == 32
    sizes = []

    def make():
        import pandas as pd

        return lambda texts: pd.DataFrame({"n": [len(texts)] * len(texts)})

    out = jobs.score_batches(spark.createDataFrame([(str(i),) for i in range(70)], "t string").coalesce(1), "t", make, "t string, n long", 32)
    sizes = sorted(r["n"] for r in out.collect())
    assert sizes == [6] * 6 + [32] * 64


def test_a_queue_is_drained_and_streamed(spark, tmp_path):
    def make():
        left = iter(range(10))
        return lambda wait: next((str(i) for i in left), None)

    queue.register(spark, "ten", make)
    assert sorted(int(r[0]) for r in spark.read.format("ten").option("max_items", 4).load().collect()) == [0, 1, 2, 3]
    got = []
    jobs.run_until(spark.readStream.format("ten").option("max_items", 4).load(), lambda b, n: got.extend(int(r[0]) for r in b.collect()), str(tmp_path / "cp"), batches=2, seconds=60)
    assert got[:4] == [0, 1, 2, 3] and len(got) in (8, 10)
