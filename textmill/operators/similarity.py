"""Fuzzy deduplication and the overlap guard: Indel similarity joins, exact.

The similarity is 200 * LCS / (m + n), so a pair at the threshold is at most
d = (1 - threshold) * (m + n) insertions and deletions apart.  Three tests that no such pair
fails leave the candidates:

* lengths: 2 * min(m, n) / (m + n) >= threshold;
* letters: the bags of characters differ by at most d;
* bigrams: one insertion or deletion takes and gives at most three character bigrams (texts
  padded by one at both ends), so the bags of bigrams differ by at most 3 * d.

The bags are folded into odd sketches (parity per bit, repeated elements told apart by their
number).  The population count of the XOR of two sketches never exceeds the difference of
the bags, so folding loses no pair either.  Long texts have longer sketches; XOR of its halves
brings one to the length of the other.  Built-in Levenshtein with a limit prunes what is
left in the JVM (it never exceeds the Indel distance), and a bit-parallel LCS checks the rest.

Rows are cut by length into blocks of at most ``BLOCK`` rows; every two blocks whose lengths fit
meet in one task, which holds the sketches of those two and nothing else.  Comparisons grow
with the square of the rows within a band of lengths: that is the price of exactness.  The
driver gets one row per text length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.store import written

#: Bits of the sketch of letters of texts below ``SHORT`` characters, doubled with the length ``DOUBLED`` times at most; that of bigrams has four times as many.
LETTER_BITS, SHORT, DOUBLED = 128, 96, 3
#: Rows of one block at most; fewer where all rows are few, so that there are tasks for all cores.
BLOCK, LEAST_BLOCK = 16384, 1024


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of one integer."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & where.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    """Indel similarity in percent; 100 for two empty texts."""
    total = len(a) + len(b)
    return 200.0 * lcs(a, b) / total if total else 100.0


def as_percent(threshold: float) -> float:
    """Thresholds up to 1 are shares, others percent."""
    return threshold * 100 if threshold <= 1 else threshold


@F.pandas_udf(T.DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a.tolist(), b.tolist())], dtype="float64")


def _odd_sketch(texts: list[str], size: int, bits: int) -> np.ndarray:
    """Odd sketch of the bag of character ``size``-grams of every text (texts padded by ``size`` - 1), in 64-bit words."""
    pad = "\x01" * (size - 1)
    code = np.frombuffer("".join(f"{pad}{t}{pad}" for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    count = np.array([len(t) for t in texts], np.int64) + size - 1
    width = count + size - 1
    row = np.repeat(np.arange(len(texts), dtype=np.uint64), count)
    where = np.repeat(np.cumsum(width) - width - np.cumsum(count) + count, count) + np.arange(count.sum())
    key = row
    for k in range(size):
        key = key << np.uint64(21) | code[where + k]
    key.sort()
    row, gram = (key >> np.uint64(21 * size)).astype(np.int64), key & np.uint64((1 << 21 * size) - 1)
    place = np.arange(len(gram))
    fresh = np.r_[True, key[1:] != key[:-1]][: len(key)]
    nth = (place - np.maximum.accumulate(np.where(fresh, place, 0))).astype(np.uint64)
    h = (gram * np.uint64(0x9E3779B97F4A7C15)) ^ (nth * np.uint64(0xC2B2AE3D27D4EB4F))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    bit = (h >> np.uint64(40)) % np.uint64(bits)
    odd = np.bincount(row * bits + bit.astype(np.int64), minlength=len(texts) * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(texts), bits), axis=1).view(np.uint64)


def _doublings(n: int) -> int:
    return min(DOUBLED, (n // SHORT).bit_length())


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """Odd sketches of twice the width, or more, brought to ``width`` words."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def sketched(df: DataFrame) -> DataFrame:
    """``id``, length ``n`` and ``sketch`` (letters, then bigrams) of ``df(id, text)``; null texts are left out."""
    schema = T.StructType([df.schema["id"], T.StructField("n", T.IntegerType()), T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            if not texts:
                continue
            made: list[bytes] = [b""] * len(texts)
            for d in range(DOUBLED + 1):
                mine = [i for i, t in enumerate(texts) if _doublings(len(t)) == d]
                for k in range(0, len(mine), 500 >> d):  # bounds the memory
                    some = mine[k : k + (500 >> d)]
                    t, bits = [texts[i] for i in some], LETTER_BITS << d
                    for i, w in zip(some, np.hstack([_odd_sketch(t, 1, bits), _odd_sketch(t, 2, 4 * bits)])):
                        made[i] = w.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int32()), pa.array(made, pa.binary())], names=schema.names)

    return df.where("text IS NOT NULL").select("id", "text").mapInArrow(run, schema)


class _Blocks:
    """Blocks of rows in order of length: a block is some lengths with sketches of one size, or one of several parts of one length."""

    def __init__(self, lengths: list[tuple[int, int]], percent: float):
        self.length, self.first, self.parts, least, most, room = [], [], [], [], [], 0
        block = min(BLOCK, max(LEAST_BLOCK, sum(c for _, c in lengths) // 16))
        for n, count in sorted(lengths):
            parts = -(-count // block)
            if parts == 1 and count <= room and _doublings(n) == _doublings(most[-1]):
                most[-1], room = n, room - count
            else:
                least += [n] * parts
                most += [n] * parts
                room = block - count if parts == 1 else 0
            self.length.append(n)
            self.first.append(len(least) - parts)
            self.parts.append(parts)
        self.length, self.first, self.parts, least, most = (np.array(x, np.int64) for x in (self.length, self.first, self.parts, least, most))
        self.size = len(least)
        # blocks whose lengths fit are neighbours: from .. to
        self.low = np.searchsorted(most * (200 - percent), least * percent - 1e-6)
        self.high = np.searchsorted(least * percent, most * (200 - percent) + 1e-6, side="right") - 1

    def of(self, n: np.ndarray, mix: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.length, n)
        return self.first[at] + (mix % self.parts[at].astype(np.uint64)).astype(np.int64)


def _words(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Sketches of one size as rows of words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(max(1, len(column)), -1)[: len(column)]


def _met(df: DataFrame, blocks: _Blocks, side: int | None) -> DataFrame:
    """Every row once for each block that its own may meet: ``task``, ``side``.

    Without a side (a join of rows with themselves) every two blocks meet once, the lower one on side 0."""
    schema = T.StructType([T.StructField("task", T.LongType()), T.StructField("side", T.IntegerType()), *df.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            some = np.frombuffer(b"".join(w[-16:] for w in b.column(2).to_pylist()), np.uint64).reshape(-1, 2)
            own = blocks.of(b.column(1).to_numpy(), (some[:, 0] ^ some[:, 1]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33))
            low, high = blocks.low[own], blocks.high[own]
            for k in range(int((high - low).max()) + 1):
                at = np.flatnonzero(low + k <= high)
                mine, other = own[at], low[at] + k
                if side is None:
                    on = (other < mine).astype(np.int32)
                    task = np.minimum(mine, other) * blocks.size + np.maximum(mine, other)
                else:
                    on = np.full(len(at), side, np.int32)
                    task = mine * blocks.size + other if side == 0 else other * blocks.size + mine
                yield pa.RecordBatch.from_arrays([pa.array(task), pa.array(on), *(c.take(pa.array(at)) for c in b.columns)], names=schema.names)

    return df.mapInArrow(run, schema)


def _close(letters: np.ndarray, bigrams: np.ndarray, n: np.ndarray, letters_y: np.ndarray, bigrams_y: np.ndarray, ny: np.ndarray, percent: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows x and y (both in order of length) that pass all tests, by place; ``same``: y is x, and only later rows count."""
    columns = [np.ascontiguousarray(c) for c in letters_y.T]
    starts = np.flatnonzero(np.r_[True, n[1:] != n[:-1]][: len(n)]).tolist()
    for start, end in zip(starts, [*starts[1:], len(n)]):
        m = int(n[start])
        lo = int(np.searchsorted(ny * (200 - percent), m * percent - 1e-6))
        hi = int(np.searchsorted(ny * percent, m * (200 - percent) + 1e-6, side="right"))
        limit = np.floor((100 - percent) * (m + ny[lo:hi]) / 100 + 1e-6).astype(np.int64)
        narrow = np.minimum(limit, 255).astype(np.uint8)
        step = max(1, 65536 // max(1, hi - lo))
        for i in range(start, end, step):
            j = min(i + step, end)
            a = max(lo, i + 1) if same else lo
            if a >= hi:
                continue
            gap = np.bitwise_count(columns[0][a:hi] ^ letters[i:j, :1])
            for w in range(1, len(columns)):
                gap += np.bitwise_count(columns[w][a:hi] ^ letters[i:j, w : w + 1])
            x, y = np.divmod(np.flatnonzero(gap <= narrow[a - lo :]), hi - a)
            x, y = x + i, y + a
            if same:
                x, y = x[y > x], y[y > x]
            for k in range(0, len(x), 16384):
                xs, ys = x[k : k + 16384], y[k : k + 16384]
                fits = np.bitwise_count(bigrams_y[ys] ^ bigrams[xs]).sum(axis=1, dtype=np.int64) <= 3 * limit[ys - lo]
                yield xs[fits], ys[fits]


def _candidates(left: DataFrame, right: DataFrame | None, percent: float) -> DataFrame:
    """``a``, ``b``: ids of the pairs that may reach the similarity, each once; without ``right`` the pairs within ``left``."""
    left = written(sketched(left), "sketches")
    right = None if right is None else written(sketched(right), "sketches")
    both = left if right is None else left.select("n").unionByName(right.select("n"))
    blocks = _Blocks([(r["n"], r["count"]) for r in both.groupBy("n").count().collect()], percent)
    if right is None:
        met = _met(left, blocks, None).withColumnRenamed("id", "a").withColumn("b", F.col("a"))
    else:  # ids of two tables may differ in type
        met = _met(left, blocks, 0).withColumnRenamed("id", "a").unionByName(_met(right, blocks, 1).withColumnRenamed("id", "b"), allowMissingColumns=True)
    schema = T.StructType([T.StructField(c, met.schema[c].dataType) for c in "ab"])
    within = right is None

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("n").combine_chunks()
        on, n = t["side"].to_numpy(), t["n"].to_numpy().astype(np.int64)
        low, high = divmod(t["task"][0].as_py(), blocks.size)
        same = within and low == high
        x = np.flatnonzero(on == 0)
        y = x if same else np.flatnonzero(on == 1)
        sx, sy = (_words(t["sketch"].take(pa.array(at))) for at in (x, y))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(x) and len(y):
            wx, wy = sx.shape[1] // 5, sy.shape[1] // 5
            w = min(wx, wy)
            for i, k in _close(_folded(sx[:, :wx], w), _folded(sx[:, wx:], 4 * w), n[x], _folded(sy[:, :wy], w), _folded(sy[:, wy:], 4 * w), n[y], percent, same):
                a.append(x[i])
                b.append(y[k])
        return pa.table([t["a"].take(pa.array(np.concatenate(a))), t["b"].take(pa.array(np.concatenate(b)))], names=schema.names)

    return met.groupBy("task").applyInArrow(run, schema)


def _near(pairs: DataFrame, left: DataFrame, right: DataFrame, percent: float) -> DataFrame:
    l = left.select(F.col("id").alias("a"), F.col("text").alias("ta"))  # noqa: E741
    r = right.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(l, "a").join(r, "b")
    limit = f"cast(((100 - {percent}) * (length(ta) + length(tb))) div 100 as int)"
    pruned = both.where(F.expr(f"levenshtein(ta, tb, {limit}) >= 0"))
    return pruned.withColumn("similarity", indel_ratio("ta", "tb")).where(F.col("similarity") >= percent).select("a", "b", "similarity")


def similar_pairs(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Pairs ``a`` < ``b`` of ``df(id, text)`` (distinct texts) with ``similarity`` in percent."""
    percent = as_percent(threshold)
    df = written(df.select("id", "text"), "texts")
    met = _candidates(df, None, percent)
    return _near(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), df, df, percent)


def overlapping(df: DataFrame, held: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Pairs (``a`` of ``df``, ``b`` of ``held``) with ``similarity``: rows that repeat a held text."""
    percent = as_percent(threshold)
    df, held = written(df.select("id", "text"), "texts"), written(held.select("id", "text"), "texts")
    return _near(_candidates(df, held, percent), df, held, percent)


def fuzzy_keep_first(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``df(id, text)`` with every row dropped that is similar to an earlier *kept* one.

    Greedy keep-first is the lexicographically first maximal independent set of the pair graph:
    each round keeps the rows whose earlier neighbours are all dropped, and drops the neighbours
    of those kept, until every row is settled.  The pairs are written once, and so is the state
    of every round."""
    pairs = written(similar_pairs(df, threshold).select("a", "b"), "pairs")
    open_edges = pairs
    dropped = None
    while True:
        later = open_edges.select(F.col("b").alias("id")).distinct()
        sure = open_edges.select(F.col("a").alias("id")).distinct().join(later, "id", "left_anti")
        gone = written(open_edges.join(sure.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct(), "gone")
        if gone.isEmpty():
            break
        dropped = gone if dropped is None else dropped.unionByName(gone)
        left = open_edges.join(sure.withColumnRenamed("id", "a"), "a", "left_anti")
        open_edges = written(left.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti"), "edges")
    return df if dropped is None else df.join(dropped, "id", "left_anti")
