"""Same or near-same records across splits.

Method: a full-text index of the evaluation records, in shards, through which the training
records are streamed by backward search.  The text that is indexed is each record's
element sequence (see ``nearsame``), which makes matches blind to word order.  The hash
range of the elements is cut into shards; the stretches of all records that fall in a
shard meet in one task, evaluation stretches first.  There the task builds the index (a
compressed suffix array in Elias-Fano form, see ``fulltext``) and then streams the training
stretches in Arrow batches: backward search from every end position finds the suffix
range of each match of two or more elements, extends it as far left as it goes for the
longest match, locates the occurrences, and drops at once those whose odd sketches rule the
pair out.  Spans and counts are then merged per pair across
shards, and the pairs checked exactly.

Every near-same pair shares such a match (see ``nearsame``), so none is lost.

Scale: the shuffled volume is linear in the records; the number of shards follows their
elements, so a task holds a bounded index and one batch.  Pairs of neighbours whose first
element is hot are drawn to any shard; a pair that many classes hold on its own is spread
over several shards, training stretches going to each (``nearsame.routing``); copies are one class.

Defined results: null, blank and short texts are in no pair; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fulltext import FullTextIndex
from .nearsame import MIN_WORDS, THRESHOLD, _starts, classes, members, popcount, routing, segments, verified, word_sets
from ..sources.store import written

MATCHES = "a long, b long, spans long, longest int"
#: Occurrences expanded at a time.
CHUNK = 2_000_000


class Stretches:
    """Columns of segment rows as flat arrays."""

    def __init__(self, batch: pa.RecordBatch | pa.Table):
        column = lambda c: batch.column(c).combine_chunks() if isinstance(batch, pa.Table) else batch.column(c)
        self.cls, self.n, self.s1, self.s2 = (np.asarray(column(c)) for c in ("cls", "n", "s1", "s2"))
        seg = column("seg")
        if isinstance(seg, pa.ChunkedArray):
            seg = pa.concat_arrays(seg.chunks) if seg.num_chunks else pa.array([], seg.type)
        off = np.asarray(seg.offsets, dtype=np.int64)
        self.tokens = np.asarray(seg.values)[off[0] : off[-1]].astype(np.int64)
        self.off = off - off[0]
        self.row = np.repeat(np.arange(len(self.cls)), np.diff(self.off))


def matches(index: FullTextIndex, q: Stretches, threshold: float) -> Iterator[tuple[np.ndarray, ...]]:
    """Chunks of (query row, index row, span length at its end) for every match of two or more elements
    whose sizes and sketches allow the threshold."""
    symbol = index.symbols(q.tokens)
    end = np.flatnonzero((q.row[1:] == q.row[:-1]) & (symbol[1:] >= 0) & (symbol[:-1] >= 0)) + 1
    lo, hi = index.whole(symbol[end])
    lo, hi = index.back(symbol[end - 1], lo, hi)
    end, lo, hi = (x[hi > lo] for x in (end, lo, hi))
    length = np.full(len(end), 2)
    live = np.arange(len(end))
    l2, h2, at = lo, hi, end - 2
    while len(live):
        ok = (at >= 0) & (q.row[np.maximum(at, 0)] == q.row[end[live]]) & (symbol[np.maximum(at, 0)] >= 0)
        live, l2, h2, at = live[ok], l2[ok], h2[ok], at[ok]
        if not len(live):
            break
        l2, h2 = index.back(symbol[at], l2, h2)
        ok = h2 > l2
        live, l2, h2, at = live[ok], l2[ok], h2[ok], at[ok] - 1
        length[live] += 1
    found = hi - lo
    cut = np.r_[0, np.flatnonzero(np.diff(np.cumsum(found) // CHUNK)) + 1, len(found)]
    for a, b in zip(cut[:-1], cut[1:]):
        c = found[a:b]
        if not c.sum():
            continue
        # patterns of one chunk often have the same range, which is then located once
        first, same = np.unique(lo[a:b], return_index=True)[1], None
        ranges, same = np.unique(np.c_[lo[a:b], c], axis=0, return_inverse=True) if len(first) < b - a else (np.c_[lo[a:b], c], np.arange(b - a))
        each = ranges[:, 1]
        spot = np.repeat(ranges[:, 0] - _starts(each), each) + np.arange(each.sum())
        located = index.stretch_of(spot)
        who = np.repeat(np.arange(a, b), c)
        other = located[np.repeat(_starts(each)[same.ravel()] - _starts(c), c) + np.arange(c.sum())]
        yield q.row[end[who]], other, length[who]


def allowed(q: Stretches, mine: np.ndarray, o: Stretches, other: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs whose sizes and odd sketches allow the threshold."""
    na, nb = q.n[mine].astype(np.int64), o.n[other].astype(np.int64)
    total = na + nb
    odd = popcount(q.s1[mine].view(np.uint64) ^ o.s1[other].view(np.uint64)).astype(np.int64) + popcount(q.s2[mine].view(np.uint64) ^ o.s2[other].view(np.uint64))
    return (np.minimum(na, nb) * 2 >= total * threshold) & (odd <= total * (1 - threshold))


def merged(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Spans and longest span per pair (a, b) of classes."""
    names = [f.split()[0] for f in MATCHES.split(", ")]
    if not parts:
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3 + [pa.array([], pa.int32())], names=names)
    a, b, length = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((b, a))
    a, b, length = a[order], b[order], length[order]
    head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
    spans = np.diff(np.r_[head, len(a)])
    longest = np.maximum.reduceat(length, head) if len(a) else length
    return pa.RecordBatch.from_arrays([pa.array(a[head]), pa.array(b[head]), pa.array(spans.astype(np.int64)), pa.array(longest.astype(np.int32))], names=names)


def search_stream(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For a partition sorted by shard and side: index side 0, then stream side 1 through it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, waiting, index = None, [], None
        for whole in batches:
            if not whole.num_rows:
                continue
            key = np.asarray(whole.column("shard")).astype(np.int64) * 2 + np.asarray(whole.column("side"))
            cut = np.r_[0, np.flatnonzero(np.diff(key)) + 1, len(key)]
            for i, j in zip(cut[:-1], cut[1:]):
                part = whole.slice(i, j - i)
                if shard != key[i] // 2:
                    shard, waiting, index = key[i] // 2, [], None
                if key[i] % 2 == 0:
                    waiting.append(part)
                    continue
                if index is None:
                    if not waiting:
                        continue
                    index, waiting = FullTextIndex(Stretches(pa.Table.from_batches(waiting))), []
                q = Stretches(part)
                found = []
                for mine, other, length in matches(index, q, threshold):
                    ok = allowed(q, mine, index.of, other, threshold)
                    found.append((q.cls[mine[ok]], index.of.cls[other[ok]], length[ok]))
                yield merged(found)

    return run


def class_overlaps(query: DataFrame, held: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of a query class ``a`` and a held class ``b`` that are near-same, with ``spans``, ``longest``,
    ``common`` and ``similarity``."""
    to = routing(query, held)
    rows = segments(held, 0, to, False).unionByName(segments(query, 1, to, True))
    found = rows.repartitionById(to.shards, F.col("shard")).sortWithinPartitions("shard", "side").mapInArrow(search_stream(threshold), MATCHES)
    pairs = found.groupBy("a", "b").agg(F.sum("spans").alias("spans"), F.max("longest").alias("longest"))
    return verified(pairs, query, held, threshold)


def cross_overlaps(df: DataFrame, id_col: str, text: str, is_train: str, *keep: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Near-same class pairs (a train, b evaluation) and the row membership of either side."""
    sets = written(word_sets(df.withColumn("__train", F.expr(is_train)), id_col, text, "__train", *keep, min_words=min_words), "sets")
    train, held = sets.where("__train"), sets.where("NOT __train")
    tc, hc = written(classes(train), "train"), written(classes(held), "held")
    return class_overlaps(tc, hc, threshold), members(train, tc, *keep), members(held, hc, *keep)


def cross_pairs(df: DataFrame, id_col: str, text: str, is_train: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """Near-same pairs of a training row and an evaluation row, smaller id first."""
    found, train, held = cross_overlaps(df, id_col, text, is_train, threshold=threshold, min_words=min_words)
    rows = found.select("a", "b").join(train.select(F.col("id").alias("x"), F.col("cls").alias("a")).hint("merge"), "a").join(held.select(F.col("id").alias("y"), F.col("cls").alias("b")).hint("merge"), "b")
    return rows.select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b"))


def cross_counts(df: DataFrame, id_col: str, text: str, split: str, source: str, train: str = "train", threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """Per evaluation split and training source: evaluation rows that recur, train rows they recur in,
    row pairs, and how many of those have all words in common."""
    found, tr, held = cross_overlaps(df, id_col, text, f"{split} = '{train}'", split, source, threshold=threshold, min_words=min_words)
    per_source = tr.groupBy("cls", source).agg(F.count(F.lit(1)).alias("tn")).withColumnRenamed("cls", "a").withColumnRenamed(source, "train_source")
    per_split = held.groupBy("cls", split).agg(F.count(F.lit(1)).alias("hn")).withColumnRenamed("cls", "b").withColumnRenamed(split, "eval_split")
    # counts of rows come from class sizes: rows are never expanded into pairs
    joined = written(found.select("a", "b", "similarity").join(per_source, "a").join(per_split, "b"), "overlaps")
    pairs = joined.groupBy("eval_split", "train_source").agg(F.sum(F.col("tn") * F.col("hn")).alias("row_pairs"), F.sum(F.when(F.col("similarity") == 1, F.col("tn") * F.col("hn")).otherwise(0)).alias("same_words"))
    ev = joined.select("eval_split", "train_source", "b", "hn").distinct().groupBy("eval_split", "train_source").agg(F.sum("hn").alias("eval_rows"))
    tn = joined.select("eval_split", "train_source", "a", "tn").distinct().groupBy("eval_split", "train_source").agg(F.sum("tn").alias("train_rows"))
    return pairs.join(ev, ["eval_split", "train_source"]).join(tn, ["eval_split", "train_source"]).select("eval_split", "train_source", "eval_rows", "train_rows", "row_pairs", "same_words")
