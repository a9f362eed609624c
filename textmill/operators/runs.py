"""Tables of runs, benchmarks and small documents: best runs, merges of stores, benchmark rows, sections, grids."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def top_run(runs: DataFrame, metric: str, by: str, name: str) -> DataFrame:
    """Per group the run with the highest metric; the first by name where several have it, by two combining aggregates in one."""
    return runs.where(F.col(metric).isNotNull()).groupBy(by).agg(F.min_by(name, F.struct(-F.col(metric), F.col(name))).alias(name), F.max(metric).alias(metric))


def unreferenced(runs: DataFrame, references: DataFrame, run: str) -> DataFrame:
    """Runs that no row of the registry names; a null reference names none."""
    return runs.join(references.where(F.col(run).isNotNull()).select(run).distinct(), run, "left_anti")


def relocated(rows: DataFrame, location: str, prefix: str, key: str, base: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with every location that holds ``prefix`` rewritten to ``base`` and the key, and one row with how many were."""
    broken = F.col(location).contains(prefix)
    fixed = rows.withColumn(location, F.when(broken, F.concat(F.lit(f"{base}/"), F.col(key).cast("string"))).otherwise(F.col(location)))
    return fixed, rows.agg(F.count_if(broken).alias("repaired"))


def merged_stores(local: DataFrame, foreign: DataFrame, key: str, overwrite: bool = False) -> DataFrame:
    """Rows of two stores: of a key both have, the local row stays, or with ``overwrite`` gives way."""
    first, second = (foreign, local) if overwrite else (local, foreign)
    return first.unionByName(second.join(first.select(key).distinct(), key, "left_anti").select(*first.columns))


def benchmark_rows(samples: DataFrame, sizes: DataFrame, quality: DataFrame, baseline: str) -> DataFrame:
    """One row a variant: p50 and p95 of every batch size's samples, size and its ratio to the baseline's, and the accuracy
    measured elsewhere.  A variant without one of them has null there."""
    p = F.percentile("ms", F.array(F.lit(0.5), F.lit(0.95)))
    lat = samples.groupBy("variant", "batch_size").agg(p.alias("p")).groupBy("variant").agg(F.sort_array(F.collect_list(F.struct("batch_size", F.round(F.col("p")[0], 6).alias("p50"), F.round(F.col("p")[1], 6).alias("p95")))).alias("latency"))  # a row a batch size
    total = sizes.groupBy("variant").agg((F.sum("bytes") / 1e6).alias("mb"))
    base = total.where(F.col("variant") == baseline).agg(F.max("mb").alias("base"))
    out = lat.join(total, "variant", "full").join(quality, "variant", "left").crossJoin(F.broadcast(base))  # base: one row
    return out.select("variant", "latency", F.round("mb", 1).alias("size_mb"), F.round(F.try_divide("mb", "base"), 3).alias("size_ratio"), "accuracy")


def folder_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row: number and bytes of all files below a folder, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def first_matching(df: DataFrame, order: str, **holds: str) -> DataFrame:
    """The first row in order whose columns hold the given pieces of text; none if there is none."""
    for column, piece in holds.items():
        df = df.where(F.coalesce(F.col(column), F.lit("")).contains(piece))
    return df.orderBy(order).limit(1)


def grid(spark: SparkSession, **values: list) -> DataFrame:
    """Every combination of the values, numbered in order: a table of runs to make."""
    names = list(values)
    rows = [(i, *x) for i, x in enumerate(product(*values.values()))]
    return spark.createDataFrame(rows, ["run", *names])


def with_section(sections: DataFrame, name: str, content: str) -> DataFrame:
    """A document of ``section``, ``content`` with one section set and ``last_updated_section`` naming it."""
    spark = sections.sparkSession
    marker = "last_updated_section"
    new = spark.createDataFrame([(name, content), (marker, name)], "section string, content string")
    return sections.where(~F.col("section").isin(name, marker)).unionByName(new)


def with_finding(findings: DataFrame, text: str) -> DataFrame:
    """A list of ``no``, ``finding`` with one more at its end."""
    last = findings.agg(F.coalesce(F.max("no") + 1, F.lit(0)).cast("long").alias("no"), F.lit(text).alias("finding"))
    return findings.unionByName(last)


def scalars(config: dict, skip: tuple[str, ...] = ()) -> dict:
    """The plain values of a configuration; nested ones, those under ``hydra`` and those in ``skip`` are left out."""
    return {str(k): v for k, v in config.items() if str(k) not in skip and not str(k).startswith("hydra") and (v is None or isinstance(v, (str, int, float, bool)))}


def with_logits(df: DataFrame, text: str, make_model: Callable[[], Callable[[list[str]], np.ndarray]], size: int, labels: tuple[str, ...]) -> DataFrame:
    """``df`` with the ``logits`` of a model made once a worker and called with at most ``size`` texts, and the hard
    ``predicted_label`` (the first of the highest).  Another number of answers than texts is an error."""
    fields = df.schema.fieldNames()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", logits array<double>, predicted_label string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for whole in batches:
            for i in range(0, len(whole), size):
                b = whole.iloc[i : i + size]
                out = np.asarray(model([x or "" for x in b[text].tolist()]), float)
                if out.shape != (len(b), len(labels)):
                    raise ValueError(f"the model gave {out.shape} for {len(b)} texts and {len(labels)} labels")
                yield b[fields].assign(logits=list(out), predicted_label=[labels[k] for k in out.argmax(axis=1)])

    return df.mapInPandas(run, schema)


def is_current(cached: DataFrame, source: DataFrame) -> DataFrame:
    """One row: rows of a cached table and of what it was made from, and whether they are as many."""
    return cached.agg(F.count(F.lit(1)).alias("cached")).crossJoin(source.agg(F.count(F.lit(1)).alias("source"))).withColumn("current", F.col("cached") == F.col("source"))
