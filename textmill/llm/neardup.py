"""Near-duplicate records with small edits, insertions or reordering.

Method: MinHash bands propose candidates, odd sketches verify them.  ``SAMPLE`` of a text's
MinHash values are folded into a parity bitmap of ``WORDS`` * 64 bits.  Of two texts of Jaccard
similarity j, 2 * SAMPLE * (1 - j) values differ on average, whatever the length of the texts, and the
population count of the XOR of their bitmaps tells how many.  It is tested inside the band join:
a pair is thrown out where the count lies more than ``SIGMAS`` standard deviations above what is
expected at the threshold (3e-5 of the pairs exactly on the threshold, far fewer above it; of
pairs without a word in common 99.9 % go, at 30 words as at 5,000).  What is left is checked exactly.

Bands: ``bands`` keys of ``rows`` minima each.  A pair of Jaccard similarity j shares no
band with probability (1 - j**rows)**bands.  With the default 60 x 4 that is 2.4e-4 at the
threshold itself (0.75 of the words in common is j = 0.6), 2e-6 at 0.8 and 1e-11 at 0.9.

Texts with one set are one class before any banding, so copies (a third of all rows, say)
cost one row each and are never compared with one another.

Defined results: null or blank texts, and texts below ``min_words`` words, are in no pair;
in the groups they come out with a class of their own, no link and themselves as group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, exp, sqrt
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nearsame import MIN_WORDS, THRESHOLD, classes, members, mix, verified, word_sets
from ..sources.store import written

BANDS, ROWS, SEED = 60, 4, 20240607
#: MinHash values in the odd sketch, its 64-bit words, and standard deviations allowed.
SAMPLE, WORDS, SIGMAS = 96, 6, 4.0
_SKETCH = [f"o{i}" for i in range(WORDS)]


def band_keys(elems: pa.ListArray, bands: int = BANDS, rows: int = ROWS, seed: int = SEED) -> tuple[pa.ListArray, np.ndarray]:
    """The band keys of each set, and the odd sketch of the first ``SAMPLE`` minima (those of a band's first
    rows, then the second ones, and so on)."""
    off = np.asarray(elems.offsets, dtype=np.int64)
    u = np.asarray(elems.values)[off[0] : off[-1]].view(np.uint64)
    at = off[:-1] - off[0]
    rng = np.random.default_rng(seed)
    keys, sketch = np.empty((len(at), bands), np.uint64), np.zeros((WORDS, len(at)), np.uint64)
    for b in range(bands):
        key = np.full(len(at), b + 1, np.uint64)
        for r in range(rows):
            xor, mul = rng.integers(0, 2**63, 2, dtype=np.uint64)
            least = np.minimum.reduceat((u ^ xor) * (mul * np.uint64(2) + np.uint64(1)), at)
            key = mix(key ^ least)
            if (place := r * bands + b) < SAMPLE:
                bit = mix(least ^ np.uint64(0x9E3779B97F4A7C15 * (place + 1) % 2**64)) % np.uint64(64 * WORDS)
                for w in range(WORDS):
                    sketch[w] ^= np.where(bit >> np.uint64(6) == w, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))
        keys[:, b] = key
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (len(at) + 1) * bands, bands, dtype=np.int32)), pa.array(keys.view(np.int64).ravel())), sketch


def most_odd(threshold: float, sample: int = SAMPLE, bits: int = 64 * WORDS, sigmas: float = SIGMAS) -> int:
    """The population count above which two sketches are too far apart for the threshold (of words in common)."""
    j = threshold / (2 - threshold)
    differ = 2 * sample * (1 - j)
    expected = bits / 2 * (1 - exp(-2 * differ / bits))
    drawn = exp(-2 * differ / bits) * 2 * sqrt(sample * j * (1 - j))  # by which values differ
    folded = bits / 4 * (1 - exp(-4 * differ / bits)) - differ * exp(-4 * differ / bits)  # by where they fall
    return ceil(expected + sigmas * sqrt(drawn**2 + folded))


def banded(cls: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per class and band: ``key``, ``cls``, ``n`` and the odd sketch."""
    schema = "cls long, n int, keys array<long>, " + ", ".join(f"{o} long" for o in _SKETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys, sketch = band_keys(b.column(2), bands, rows)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), keys, *(pa.array(s.view(np.int64)) for s in sketch)], names=["cls", "n", "keys", *_SKETCH])

    return cls.select("cls", "n", "elems").mapInArrow(run, schema).select(F.explode("keys").alias("key"), "cls", "n", *_SKETCH)


def close_enough(a: str, b: str, threshold: float) -> Column:
    """Whether sizes and odd sketches of two sides allow the threshold."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    odd = reduce(add, [F.bit_count(F.col(f"{a}.{o}").bitwiseXOR(F.col(f"{b}.{o}"))) for o in _SKETCH])
    return (F.least(na, nb) * 2 >= (na + nb) * threshold) & (odd <= most_odd(threshold))


def similar_classes(cls: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Pairs ``a`` < ``b`` of classes that reach the threshold, with ``common`` and ``similarity``.

    The band join is a sort-merge join by hint: Spark does not see that ``explode`` multiplies the rows and
    would send the table to the driver."""
    keyed = banded(cls, bands, rows)
    met = keyed.alias("a").join(keyed.alias("b").hint("merge"), F.col("a.key") == F.col("b.key")).where((F.col("a.cls") < F.col("b.cls")) & close_enough("a", "b", threshold))
    return verified(met.select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).distinct(), cls, cls, threshold)


def prepared(df: DataFrame, id_col: str, text: str, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """The rows' sets and their classes, each written once."""
    sets = written(word_sets(df, id_col, text, min_words=min_words), "sets")
    return sets, written(classes(sets), "classes")


def near_duplicate_pairs(df: DataFrame, id_col: str, text: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """All near-same pairs of rows, smaller id first, equal texts included."""
    sets, cls = prepared(df, id_col, text, min_words)
    pairs = similar_classes(cls, threshold).select("a", "b")
    rows = members(sets, cls)
    between = pairs.join(rows.select(F.col("id").alias("x"), F.col("cls").alias("a")).hint("merge"), "a").join(rows.select(F.col("id").alias("y"), F.col("cls").alias("b")).hint("merge"), "b")
    several = members(sets, cls.where("members > 1"))
    within = several.select(F.col("id").alias("x"), "cls").join(several.select(F.col("id").alias("y"), "cls").hint("merge"), "cls").where("x < y")
    return between.select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b")).unionByName(
        within.select(F.col("x").alias(f"{id_col}_a"), F.col("y").alias(f"{id_col}_b")))


def connected(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph ``a``, ``b``: one row ``node``, ``component`` (its smallest node).

    Alternating large-star and small-star steps; each step is one shuffle of the edges, pre-grouped by
    a minimum, and its result is written, so lineage stays short.  Ends when no edge changes.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def near_duplicate_groups(df: DataFrame, id_col: str, text: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per record: ``cls`` (smallest id with the same words), ``members`` of the class, ``links``
    (other rows it is near-same to) and ``group`` (smallest id of its connected group).

    Copies are not expanded into pairs; no link between different texts is lost.
    """
    sets, cls = prepared(df, id_col, text, min_words)
    pairs = written(similar_classes(cls, threshold).select("a", "b"), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(cls.select(F.col("cls").alias("b"), "members").hint("merge"), "b").groupBy("a").agg(F.sum("members").alias("to")).withColumnRenamed("a", "cls")
    held = cls.select("c1", "c2", "cls", "first", "members").join(connected(pairs).withColumnRenamed("node", "cls").hint("merge"), "cls", "left").join(degree.hint("merge"), "cls", "left")
    held = written(held.withColumn("component", F.coalesce("component", "cls")), "groups")
    names = held.groupBy("component").agg(F.min("first").alias("group"))  # combined before the shuffle
    named = held.join(names.hint("merge"), "component")
    rows = sets.select("id", "c1", "c2").join(named.hint("merge"), ["c1", "c2"]).select(
        "id", F.col("first").alias("cls"), "members", (F.coalesce("to", F.lit(0)) + F.col("members") - 1).alias("links"), "group")
    every = df.select(F.col(id_col).alias("id")).where(F.col(id_col).isNotNull())
    return every.join(rows.hint("merge"), "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("cls", "id").alias("cls"), F.coalesce("members", F.lit(1)).alias("members"),
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("group", "id").alias("group"))
