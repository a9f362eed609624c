"""Near-same texts: what the operators for near-duplicates, split overlaps and batch
deduplication share.

Two texts are near-same when, after unifying look-alike characters, removing vowel
marks, cutting runs and lower-casing, both have at least ``MIN_WORDS`` words and twice
the number of words in common over the sum of their word counts is at least
``THRESHOLD`` (repeats count, order does not).

A text becomes a set of 64-bit *elements*, one per (word, how-manyth occurrence), kept in
ascending order of the hash.  The order is the same for every text and needs no corpus
statistics.  Texts with one set form a *class*, named by 128 bits of its content; all heavy
work is on classes, and rows are joined back at the end.  Ids may be of any type that has an order.

Two facts used everywhere, for sets of n and m elements with c in common and
2c/(n+m) >= t:

* the symmetric difference n+m-2c is at most (1-t)(n+m), and the population count of the
  XOR of two odd sketches never exceeds it, so the sketch test loses no pair;
* in hash order the common elements fall into at most n+m-2c+1 runs of neighbours, which
  for t = 0.75 and n, m >= 12 is less than c, so every near-same pair shares a match of at
  least two neighbouring elements.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import blocks
from .lookalike import unify_text

MIN_WORDS = 12
THRESHOLD = 0.75
#: Elements of one shard on average at most; shards that count for what is hot; classes that hold a hot pair.
SHARD_ELEMENTS, MOST_SHARDS, HOT_PAIR = 4_000_000, 2000, 20_000

_MARKS = re.compile("[\u064b-\u065f\u0670]")
_RUNS = re.compile(r"(.)\1{2,}", re.S)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

SETS = "n int, c1 long, c2 long, s1 long, s2 long, elems array<long>"


def clean_text(text: str | None) -> str | None:
    """Look-alikes unified, vowel marks removed, runs cut to two, lower case."""
    if text is None:
        return None
    return _RUNS.sub(r"\1\1", _MARKS.sub("", unify_text(text))).lower()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hashes of the words of one batch, each computed once."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def element_arrays(texts: list[str | None], min_words: int = MIN_WORDS):
    """Indices of the texts with enough words, element counts, and the flat ascending elements."""
    hash_of = _WordHashes().__getitem__
    kept, lens, flat = [], [], []
    for i, t in enumerate(texts):
        if not t:
            continue
        words = clean_text(t).split()
        if len(words) < min_words:
            continue
        kept.append(i)
        lens.append(len(words))
        flat.extend(map(hash_of, words))
    n = np.array(lens, dtype=np.int64)
    h = np.array(flat, dtype=np.uint64)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, row))
    h = h[order]
    if len(h):
        first = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])]
        start = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
        occurrence = (np.arange(len(h)) - start).astype(np.uint64)
        h = mix(h + occurrence * np.uint64(0x9E3779B97F4A7C15))
        e = h.view(np.int64)
        e = e[np.lexsort((e, row))]
    else:
        e = h.view(np.int64)
    return np.array(kept, dtype=np.int64), n, e


def _starts(n: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(n)[:-1]].astype(np.int64) if len(n) else np.zeros(0, np.int64)


def set_columns(n: np.ndarray, e: np.ndarray) -> list[pa.Array]:
    """n, the 128-bit name of the set, its odd sketch, and the elements."""
    at, u = _starts(n), e.view(np.uint64)
    if not len(n):
        z = pa.array([], pa.int64())
        return [pa.array([], pa.int32()), z, z, z, z, pa.array([], pa.list_(pa.int64()))]
    c1 = np.add.reduceat(mix(u ^ np.uint64(0x5851F42D4C957F2D)), at)
    c2 = np.add.reduceat(mix(u ^ np.uint64(0x14057B7EF767814F)), at)
    bit = np.uint64(1) << ((u >> np.uint64(40)) & np.uint64(63))
    half = (u >> np.uint64(46)) & np.uint64(1)
    s1 = np.bitwise_xor.reduceat(np.where(half == 0, bit, np.uint64(0)), at)
    s2 = np.bitwise_xor.reduceat(np.where(half == 1, bit, np.uint64(0)), at)
    offsets = pa.array(np.r_[at, [len(e)]].astype(np.int32))
    return [pa.array(n.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in (c1, c2, s1, s2)), pa.ListArray.from_arrays(offsets, pa.array(e))]


def word_sets(df: DataFrame, id_col: str, text: str, *keep: str, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per text of at least ``min_words`` words: ``id``, the kept columns and :data:`SETS`."""
    fields = [T.StructField("id", df.schema[id_col].dataType), *(T.StructField(k, df.schema[k].dataType) for k in keep)]
    schema = T.StructType([*fields, *T.StructType.fromDDL(SETS).fields])
    names, b_text = schema.names, len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, b_text):
            kept, n, e = element_arrays(b.column(b.num_columns - 1).to_pylist(), min_words)
            rows = pa.array(kept)
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(rows) for i in range(b.num_columns - 1)), *set_columns(n, e)], names=names)

    picked = df.select(F.col(id_col).alias("id"), *keep, F.col(text).alias("__text")).where(F.col("__text").isNotNull() & F.col("id").isNotNull())
    return picked.mapInArrow(run, schema)


def classes(sets: DataFrame, *more: Column, base: int = 0) -> DataFrame:
    """One row per distinct set: ``cls`` (a number), ``first`` (smallest id), ``members``, n, the sketch and the elements.

    A set is named by 128 bits; the number only stands for that name.  It is drawn where the row is made, so
    the table has to be written before it is used twice: the place of its task in 2^14, the row in 2^29 (``base`` above both)."""
    same = [F.first(c).alias(c) for c in ("n", "s1", "s2", "elems")]
    made = sets.groupBy("c1", "c2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("members"), *same, *more)
    drawn = F.monotonically_increasing_id()
    return made.withColumn("cls", F.shiftright(drawn, 33) * (1 << 29) + drawn.bitwiseAND((1 << 33) - 1) + F.lit(base << 43))


def members(sets: DataFrame, cls: DataFrame, *keep: str) -> DataFrame:
    """``id`` (and kept columns) with the ``cls`` it belongs to."""
    return sets.select("c1", "c2", "id", *keep).join(cls.select("c1", "c2", "cls").hint("merge"), ["c1", "c2"]).select("id", "cls", *keep)


def sketch_allows(a: str, b: str, threshold: float = THRESHOLD) -> Column:
    """False only for pairs that cannot reach the threshold: by their sizes, or by their odd sketches."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    total = na + nb
    odd = F.bit_count(F.col(f"{a}.s1").bitwiseXOR(F.col(f"{b}.s1"))) + F.bit_count(F.col(f"{a}.s2").bitwiseXOR(F.col(f"{b}.s2")))
    return (F.least(na, nb) * 2 >= total * threshold) & (odd <= total * (1 - threshold))


def verified(pairs: DataFrame, left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``pairs`` (a, b, ...) whose sets reach the threshold, with ``common`` and ``similarity``.

    The joins are sort-merge joins by hint: arrays count as one element in Spark's size estimates, so
    a table of elements would be taken for small and sent to the driver."""
    l = left.select(F.col("cls").alias("a"), F.col("elems").alias("__ea")).hint("merge")
    r = right.select(F.col("cls").alias("b"), F.col("elems").alias("__eb")).hint("merge")
    total = F.size("__ea") + F.size("__eb")
    return (
        pairs.join(l, "a").join(r, "b").withColumn("common", F.size(F.array_intersect("__ea", "__eb")))
        .where(F.col("common") * 2 >= total * threshold).withColumn("similarity", F.col("common") * 2 / total).drop("__ea", "__eb")
    )


def pair_name(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit key of two neighbouring elements; two pairs that share one are only routed alike."""
    return mix(first.view(np.uint64) + second.view(np.uint64) * np.uint64(3)).view(np.int64)


@dataclass(frozen=True)
class Routing:
    """How element sequences are spread: shards of the hash range, elements whose pairs are drawn to any shard,
    and pairs that are spread over several, with how many."""

    shards: int
    elements: np.ndarray
    pairs: np.ndarray
    spread: np.ndarray


def routing(*sides: DataFrame, shards: int | None = None) -> Routing:
    """The routing of classes of all ``sides``, from counts over every element and every pair of neighbours.

    A shard holds ``SHARD_ELEMENTS`` elements on average at most, and there is one at least for every shuffle
    partition.  An element is hot where it is more than half of an average shard, a pair where more
    than ``HOT_PAIR`` classes (or 1 in 100,000 of all elements) hold it.  So at most 4 * MOST_SHARDS elements and 200,000 pairs come back.
    Counts below a fraction of the limit within an Arrow batch are left out, which can only make
    a count too small by half: what is hot is found, and a few others are taken for hot."""
    spark = sides[0].sparkSession
    every = reduce(DataFrame.unionByName, [s.select("n", "elems") for s in sides])
    total = every.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if shards is None:
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_ELEMENTS))
    most_e = max(1000, total // (2 * min(shards, MOST_SHARDS)))
    most_p = max(HOT_PAIR, total // 100_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            elems = b.column("elems")
            off = np.asarray(elems.offsets, dtype=np.int64)
            e = np.asarray(elems.values)[off[0] : off[-1]]
            if len(e) < 2:
                continue
            share = len(e) / max(total, 1)
            inside = np.ones(len(e), bool)
            inside[off[1:-1] - off[0] - 1] = False
            inside[-1] = False
            two = pair_name(e, np.roll(e, -1))[inside]
            for is_pair, x, most in ((False, e, most_e), (True, two, most_p)):
                v, c = np.unique(x, return_counts=True)
                keep = c >= max(1, most * share / 2)
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(keep.sum(), is_pair)), pa.array(v[keep]), pa.array(c[keep].astype(np.int64))], names=["p", "k", "c"])

    counts = every.select("elems").mapInArrow(run, "p boolean, k long, c long").groupBy("p", "k").agg(F.sum("c").alias("c"))
    rows = counts.where(F.col("c") > F.when(F.col("p"), most_p // 2).otherwise(most_e // 2)).collect()
    pairs = sorted((r["k"], min(shards, -(-r["c"] // HOT_PAIR))) for r in rows if r["p"])
    return Routing(shards, np.array(sorted(r["k"] for r in rows if not r["p"]), np.int64), np.array([k for k, _ in pairs], np.int64), np.array([n for _, n in pairs], np.int64))


def _within(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``x`` are in the sorted array, and where."""
    if not len(sorted_):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return sorted_[at] == x, at


def segments(cls: DataFrame, side: int, to: Routing, copied: bool, *order: str) -> DataFrame:
    """Each class's element sequence cut into the stretches that belong to one shard of the hash range.

    A pair of neighbours belongs to the shard of its first element, or, where that element is hot, to a shard
    drawn from both: a word in a third of all texts is spread out.  A hot pair is a stretch of its own: the
    side that is not ``copied`` is spread over several shards by class, the other goes to each of them.
    Stretches keep one element of the next shard, so no neighbouring pair is cut."""
    schema = T.StructType.fromDDL("shard int, side int, cls long, n int, s1 long, s2 long, seg array<int>")
    schema = T.StructType([*schema.fields, *(T.StructField(o, cls.schema[o].dataType) for o in order)])
    shards = to.shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            elems = b.column("elems")
            off = np.asarray(elems.offsets, dtype=np.int64)
            e = np.asarray(elems.values)[off[0] : off[-1]]
            off = off - off[0]
            if len(e) < 2:
                continue
            row = np.repeat(np.arange(len(off) - 1), np.diff(off))
            shard = (((e >> np.int64(32)) + np.int64(2**31)) * shards) >> np.int64(32)
            pair = np.flatnonzero(row[1:] == row[:-1])  # position of the first of two neighbours
            is_hot, _ = _within(to.elements, e[pair])
            name = pair_name(e[pair], e[pair + 1])
            goes = np.where(is_hot, (name.view(np.uint64) % np.uint64(shards)).astype(np.int64), shard[pair])
            spread, at = _within(to.pairs, name)
            new = np.r_[True, (row[pair][1:] != row[pair][:-1]) | (goes[1:] != goes[:-1]) | spread[1:] | spread[:-1]]
            head = np.flatnonzero(new)
            first, goes, lone, at = pair[head], goes[head], spread[head], at[head]
            count = np.diff(np.r_[head, len(pair)]) + 1
            if lone.any():
                ways = np.where(lone, to.spread[at], 1)
                base = np.where(lone, (name[head].view(np.uint64) % np.uint64(shards)).astype(np.int64), goes)
                if copied:
                    again = np.repeat(np.arange(len(head)), ways)
                    goes = (base[again] + np.arange(len(again)) - np.repeat(_starts(ways), ways)) % shards
                    first, count = first[again], count[again]
                else:
                    who = mix(np.asarray(b.column("cls"))[row[first]].view(np.uint64))
                    goes = (base + (who % ways.astype(np.uint64)).astype(np.int64)) % shards
            where = np.repeat(first - _starts(count), count) + np.arange(count.sum())
            seg = pa.ListArray.from_arrays(pa.array(np.r_[_starts(count), [count.sum()]].astype(np.int32)), pa.array((e[where] & np.int64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)))
            rows = pa.array(row[first])
            take = {c: b.column(c).take(rows) for c in ("cls", "n", "s1", "s2", *order)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(goes.astype(np.int32)), pa.array(np.full(len(first), side, np.int32)), take["cls"], take["n"], take["s1"], take["s2"], seg, *(take[o] for o in order)], names=schema.names)

    return cls.select("cls", "n", "s1", "s2", "elems", *order).mapInArrow(run, schema)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of an int64 sequence in order, by prefix doubling (one round per doubling of the longest repeat)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    k = 1
    while n:
        nxt = np.zeros(n, np.int64)
        nxt[: n - k if k < n else 0] = rank[k:] + 1
        key = rank * np.int64(n + 2) + nxt
        order = np.argsort(key, kind="stable")
        s = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.r_[0, np.cumsum(s[1:] != s[:-1])]
        rank = new
        if rank[order[-1]] == n - 1 or k >= n:
            break
        k *= 2
    return order
