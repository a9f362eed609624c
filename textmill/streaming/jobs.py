"""Structured Streaming jobs: micro-batch scoring, capture without repeats, stateful pairing, windows."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import json as j
from ..sources.store import shared_folder
from .pairing import pairing_processor

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_files(spark: SparkSession, path: str, schema: StructType | str, kind: str = "parquet", per_trigger: int | None = None) -> DataFrame:
    """A stream of the files of a path (a glob is allowed): a landing folder stands for the queue or the posted messages."""
    r = spark.readStream.format(kind).schema(schema)
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    return r.load(path)


def landed(spark: SparkSession, path: str, schema: StructType | str, per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Posted JSON lines as two streams: the records, and the lines that cannot be read (``line``).

    A line counts as unreadable where it is no JSON object or a field of it has another type."""
    raw = stream_files(spark, path, "value string", "text", per_trigger)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = raw.select("value", F.from_json("value", f"{fields}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}).alias("r"))
    good = F.col("r").isNotNull() & F.col("r.__bad").isNull() & F.ltrim("value").startswith("{")
    return parsed.where(good).select(*(F.col(f"r.`{n}`").alias(n) for n in schema.names)), parsed.where(~good).select(F.col("value").alias("line"))


def queue_messages(raw: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Queue messages decoded to ``id`` and ``text``, and those without a text (``line``), to be set aside."""
    decoded = raw.select(F.col(column).alias("line"), j.message_id(F.col(column)).alias("id"), j.message_text(F.col(column)).alias("text"))
    return decoded.where(F.col("text").isNotNull()).select("id", "text"), decoded.where(F.col("text").isNull()).select("line")


def rate(spark: SparkSession, per_second: int) -> DataFrame:
    """A stream of ``value`` and ``timestamp`` at a set pace: the producer of a load test."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load()


def run_available(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", timeout: float | None = None) -> None:
    """Process what is there and stop; ``write`` gets every micro-batch and its number.  Without ``timeout`` it takes as long as it takes."""
    q = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if timeout is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout):
        q.stop()
        raise TimeoutError(f"the stream did not end within {timeout} s")


def run_until(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every_ms: int = 100, mode: str = "append",
              seconds: float | None = None, batches: int | None = None, idle_seconds: float | None = None) -> str:
    """Run micro-batches until a time is over, a number of non-empty ones is done, or nothing has come for a while.

    Says which: ``duration``, ``batches`` or ``idle``.  A batch that is being worked on is finished first."""
    state = {"done": 0, "at": time.monotonic()}

    def counted(batch: DataFrame, number: int) -> None:
        if batches is not None and state["done"] >= batches:
            raise RuntimeError("enough")  # not committed: its rows come again when the stream goes on
        if not batch.isEmpty():
            write(batch, number)
            state["done"] += 1
            state["at"] = time.monotonic()

    began = time.monotonic()
    q = df.writeStream.foreachBatch(counted).outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime=f"{every_ms} milliseconds").start()
    why = ""
    while not why:
        time.sleep(0.02)
        if batches is not None and state["done"] >= batches:
            why = "batches"
        elif q.exception() is not None:
            raise q.exception()
        elif seconds is not None and time.monotonic() - began >= seconds:
            why = "duration"
        elif idle_seconds is not None and time.monotonic() - state["at"] >= idle_seconds and not q.status["isTriggerActive"]:
            why = "idle"
    q.stop()
    return why


def _by_number(spark: SparkSession, name: str) -> tuple[str, list[int], Callable[[DataFrame, int], None]]:
    base, seen = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")
        seen.append(number)

    return base, seen, write


def to_table(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream to its end into a parquet table of the shared folder, and read that.

    Batches go to folders of their own number, so a batch that runs twice leaves one copy; in complete
    mode the last batch is the whole result."""
    spark = df.sparkSession
    base, seen, write = _by_number(spark, name)
    run_available(df, write, f"{base}/checkpoint", mode)
    if not seen:
        return spark.createDataFrame([], df.schema)
    paths = [f"{base}/out/batch={n}" for n in (seen[-1:] if mode == "complete" else sorted(set(seen)))]
    return spark.read.schema(df.schema).parquet(*paths)


def append_batches_by_day(path: str, day: str) -> Callable[[DataFrame, int], None]:
    """A writer of micro-batches into a table partitioned by day: a batch that runs twice replaces what it wrote before."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day, "batch").parquet(path)

    return write


def first_captures(df: DataFrame, key: str, ts: str, delay: str = "1 day") -> DataFrame:
    """The first capture of every key on each UTC day; a capture leaves the state when the watermark is ``delay`` past it."""
    return df.withColumn("__day", F.date_trunc("day", F.col(ts))).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key, "__day"]).drop("__day")


def score_batches(df: DataFrame, text: str, make_scorer: Callable[[], Callable[[list[str]], "object"]], schema: str, size: int | None = None) -> DataFrame:
    """One call of the scorer per micro-batch of at most ``size`` rows (by default an Arrow batch), order kept;
    another number of answers than texts is an error."""
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = make_scorer()
        for whole in batches:
            step = size or max(1, len(whole))
            for i in range(0, len(whole), step):
                b = whole.iloc[i : i + step]
                out = score([t or "" for t in b[text].tolist()])
                if len(out) != len(b):
                    raise ValueError(f"{len(out)} answers for {len(b)} texts")
                yield pd.concat([b[names].reset_index(drop=True), pd.DataFrame(out).reset_index(drop=True)], axis=1)

    return df.mapInPandas(run, schema)


def chunk_stats(df: DataFrame, order: str, size: int = 32, parts: int = 256) -> DataFrame:
    """How rows fill calls of at most ``size``: one row a call, ``part``, ``call``, ``items``, ``fill_ratio``.

    Rows are dealt to parts by a hash of ``order``, each part is cut into calls on its own, so no task numbers all rows."""
    dealt = df.groupBy(F.pmod(F.xxhash64(order), F.lit(parts)).cast("int").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    calls = dealt.select("part", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / size))).alias("call"))
    items = F.least(F.lit(size).cast("long"), F.col("n") - F.col("call") * size)
    return calls.select("part", "call", items.alias("items"), F.round(items / size, 6).alias("fill_ratio"))


def paired(df: DataFrame, ttl_seconds: int = 30, delay_seconds: int = 0, most: int | None = 4096) -> DataFrame:
    """``key``, ``outcome`` of a stream of ``key``, ``worker``, ``labels`` (array), ``shadow``, ``request_id``, ``ts``; state lives in the
    state store, which has to be RocksDB (``spark.sql.streaming.stateStore.providerClass``).

    Keys are dealt to lanes by hash, as many as shuffle partitions; each holds its part of the ``most`` open pairs."""
    eligible = df.where((F.coalesce("key", F.lit("")) != "") & (F.coalesce("shadow", F.lit(False)) | (F.coalesce("request_id", F.lit("")) != "")))
    lanes = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = None if most is None else max(1, most // lanes)
    said = F.when(F.size("labels") > 0, F.to_json("labels")).otherwise("")
    rows = eligible.select(F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("int").alias("lane"), "key", "worker", said.alias("said"), F.coalesce("shadow", F.lit(False)).alias("shadow"), "ts")
    return rows.withWatermark("ts", f"{delay_seconds} seconds").groupBy("lane").transformWithStateInPandas(pairing_processor(ttl_seconds * 1000, share, delay_seconds * 1000), "key string, outcome string", "append", "eventtime")


def windowed_counts(df: DataFrame, ts: str, minutes: int, *by: str, delay: str = "1 hour") -> DataFrame:
    """Counts per window; a window comes out once, when the watermark has passed its end, and leaves the state."""
    rows = df.withWatermark(ts, delay)
    return rows.groupBy(F.window(ts, f"{minutes} minutes").alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")
