"""Engineered features: unknown-word rate, length, confidence, and a frozen projection of embeddings."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import LABELS, normalize, words
from ..sources.files import read_state, write_state


def vocabulary(df: DataFrame, text: str, least: int = 2) -> DataFrame:
    """Words of the normalised texts that at least ``least`` texts hold."""
    return df.select(F.explode(F.array_distinct(words(normalize(F.col(text))))).alias("word")).groupBy("word").count().where(F.col("count") >= least).select("word")


def oov_rate(df: DataFrame, key: str, text: str, vocab: DataFrame) -> DataFrame:
    """``key``, ``tokens``, ``oov_rate`` (share of words not in ``vocab``; 0 without words), ``oov_bucket``.

    The vocabulary is joined, not sent: its size grows with the data."""
    rows = df.select(key, words(normalize(F.coalesce(F.col(text), F.lit("")))).alias("w"))
    exploded = rows.select(key, F.explode("w").alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))
    known = exploded.join(vocab.select("word", F.lit(True).alias("known")), "word", "left").groupBy(key).agg(
        F.sum("n").alias("tokens"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("unknown"))
    out = rows.select(key).join(known, key, "left").select(key, F.coalesce("tokens", F.lit(0)).alias("tokens"), F.round(F.coalesce(F.try_divide("unknown", "tokens"), F.lit(0.0)), 6).alias("oov_rate"))
    return out.withColumn("oov_bucket", oov_bucket(F.col("oov_rate")))


def oov_bucket(rate: Column) -> Column:
    return F.when(rate <= 0, "none").when(rate <= 0.02, "low").when(rate <= 0.05, "moderate").otherwise("high")


@dataclass(frozen=True)
class Basis:
    """A frozen projection: mean, components (row by row) and what it was fitted on."""

    mean: tuple[float, ...]
    components: tuple[tuple[float, ...], ...]
    explained: tuple[float, ...]
    rows: int
    encoder: str = ""
    max_length: int = 0
    pooling: str = ""

    requested: int = 0

    def incompatibility(self, encoder: str, max_length: int, pooling: str) -> tuple[str | None, str | None]:
        """(error, warning) of using the basis with other embeddings."""
        wrong = [f"{name} {given} is not {own}" for name, given, own in (("max_length", max_length, self.max_length), ("pooling", pooling, self.pooling)) if given != own]
        return "; ".join(wrong) or None, None if encoder == self.encoder else f"encoder {encoder} is not {self.encoder}"


def save_basis(spark: SparkSession, basis: Basis, path: str) -> None:
    """The frozen basis as one JSON document, in place of an older one."""
    write_state(spark, path, json.dumps(asdict(basis)))


def load_basis(spark: SparkSession, path: str) -> Basis:
    """The basis kept at a path; a missing one is an error, it must not be fitted anew for each comparison."""
    text = read_state(spark, path)
    if text is None:
        raise FileNotFoundError(f"no basis at {path}: fit and save one on the reference")
    d = json.loads(text)
    return Basis(**d | {"mean": tuple(d["mean"]), "components": tuple(map(tuple, d["components"])), "explained": tuple(d["explained"])})


def explained(spark: SparkSession, basis: Basis) -> DataFrame:
    """``component`` (from 1), ``explained`` (share of the variance) and ``total`` up to it."""
    rows = [(i + 1, float(v), float(sum(basis.explained[: i + 1]))) for i, v in enumerate(basis.explained)]
    return spark.createDataFrame(rows, "component int, explained double, total double")


def reference_panel(df: DataFrame, key: str, embedding: str, k: int, path: str, **about) -> DataFrame:
    """The reference with its coordinates, in a basis that is fitted on it once and kept at ``path``."""
    basis = fit_basis(df, embedding, k, **about)
    save_basis(df.sparkSession, basis, path)
    return project(df, embedding, basis)


def row_confidence(df: DataFrame, labels: tuple[str, ...] = LABELS) -> Column:
    """The confidence of a prediction: ``predicted_score`` where the table has it, else the highest of the class columns it has; an error where it has neither."""
    if "predicted_score" in df.columns:
        return F.col("predicted_score")
    held = [c for c in labels if c in df.columns]
    if not held:
        raise ValueError("neither predicted_score nor a class column")
    return F.greatest(*held) if len(held) > 1 else F.col(held[0])


def masked_mean(states: Column, mask: Column) -> Column:
    """Mean of the states (an array of arrays of one length) where the mask is set; zeros where it is set nowhere."""
    weight = F.greatest(F.aggregate(mask, F.lit(0.0), lambda a, m: a + m), F.lit(1.0))
    place = F.sequence(F.lit(0), F.size(states[0]) - 1)
    return F.transform(place, lambda i: F.aggregate(F.zip_with(states, mask, lambda h, m: F.get(h, i) * m), F.lit(0.0), lambda a, x: a + x) / weight)


def embedded(df: DataFrame, text: str, make_encoder: Callable[[], Callable[[list[str]], np.ndarray]], size: int = 32, out: str = "embedding") -> DataFrame:
    """``df`` with the vector of an encoder that is made once a worker and called with at most ``size`` texts."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` array<double>"

    def run(batches):
        encode = make_encoder()
        for whole in batches:
            for i in range(0, len(whole), size):
                b = whole.iloc[i : i + size]
                m = np.asarray(encode([x or "" for x in b[text].tolist()]), float)
                if m.ndim != 2 or len(m) != len(b):
                    raise ValueError(f"the encoder gave {m.shape} for {len(b)} texts")
                yield b.assign(**{out: list(m)})

    return df.mapInPandas(run, schema)


def fit_basis(df: DataFrame, embedding: str, k: int, **about) -> Basis:
    """Principal components of an array column; ``k`` is cut to what rows and dimensions allow."""
    size = df.select(F.size(embedding).alias("d")).where("d > 0").agg(F.min("d"), F.max("d"), F.count(F.lit(1))).first()
    if size[0] is None or size[0] != size[1]:
        raise ValueError("embeddings must all have one positive number of dimensions")
    d, n = size[0], size[2]
    asked, k = k, max(1, min(k, n, d))
    rows = df.where(F.size(embedding) > 0)
    mean = rows.agg(*(F.avg(F.col(embedding)[i].cast("double")).alias(f"m{i}") for i in range(d))).first()
    model = PCA(k=k, inputCol="v", outputCol="p").fit(rows.select(array_to_vector(F.col(embedding).cast("array<double>")).alias("v")))
    axes = model.pc.toArray()
    # the sign of a component is free: its largest entry is made positive
    signs = [1.0 if axes[abs(axes[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    return Basis(tuple(map(float, mean)), tuple(tuple(map(float, axes[:, j] * signs[j])) for j in range(k)), tuple(map(float, model.explainedVariance.toArray())), n, requested=asked, **about)


def project(df: DataFrame, embedding: str, basis: Basis, prefix: str = "embedding_pc") -> DataFrame:
    """``df`` with the centred coordinates in the basis: one matrix product an Arrow batch.  Null or empty vectors have null coordinates."""
    mean, components = np.array(basis.mean), np.array(basis.components)
    names = [f"{prefix}{i + 1}" for i in range(len(components))]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    at = df.columns.index(embedding)

    def run(batches):
        for b in batches:
            column = b.column(at)
            size = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
            ok = size == len(mean)
            if (~ok & (size > 0)).any():
                raise ValueError(f"an embedding does not have the {len(mean)} dimensions of the basis")
            flat = np.asarray(column.filter(pa.array(ok)).flatten()).astype(float).reshape(-1, len(mean))
            out = np.full((len(components), b.num_rows), np.nan)
            out[:, ok] = ((flat - mean) @ components.T).T
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, mask=~ok) for c in out)], names=[*b.schema.names, *names])

    return df.mapInArrow(run, schema)
