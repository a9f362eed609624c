"""Long exact spans shared between records.

Method: super-k-mer partitioning.  Every window of ``length`` characters has a minimiser,
the ``seed``-character piece in it with the smallest hash (leftmost on ties); consecutive
windows with the same minimiser form a super-k-mer.  Equal windows have equal minimisers
at equal places, so they meet in the minimiser's bucket.

1. Each record is cut into super-k-mers by array operations over whole batches of
   characters; only (minimiser, record, place) rows are shuffled, and minimisers that one
   record alone holds end there.
2. The rest travel as packed strings, one per super-k-mer, to their buckets.  Equal
   strings become one class first, with the smallest and largest record that hold them,
   so a passage in a third of all records costs one string, not a third of the rows.
3. In each bucket the windows of the classes are sorted by a hash, and those that share one are
   grouped by their letters.  Buckets of more than ``HOT`` different strings are spread over the cluster
   window by window instead of being held by one task; there, too, the letters decide.

Classes and window groups are named by 128 bits.

Any span of ``length`` or more characters is found; there is no cap.  Defined results:
null texts and texts shorter than ``length`` share nothing; a span that recurs only inside
one record is not shared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import blocks
from .nearsame import _starts, mix
from ..sources.store import written

LENGTH, SEED_CHARS, HOT = 160, 64, 5000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = np.uint64(2**28 - 1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 20)
        _POWERS["up"] = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE)])
        _POWERS["down"] = np.cumprod(np.r_[np.uint64(1), np.full(size, _BACK)])
    return _POWERS["up"][:n], _POWERS["down"][:n]


def codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def rolling(code: np.ndarray, m: int) -> np.ndarray:
    """A hash of every ``m``-character piece."""
    n = len(code)
    if n < m:
        return np.zeros(0, np.uint64)
    up, down = _powers(n)
    s = np.r_[np.uint64(0), np.cumsum((code.astype(np.uint64) + np.uint64(1)) * up)]
    return mix((s[m:] - s[:-m]) * down[: n - m + 1])


def super_kmers(texts: list[str], length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(text index, first window, windows, minimiser hash) of every super-k-mer, in order."""
    code = codes(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    n, w = len(code), length - seed + 1
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64)
    h = rolling(code, seed)
    packed = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    blocks = -(-len(packed) // w)
    x = np.full(blocks * w, np.uint64(2**64 - 1))
    x[: len(packed)] = packed
    x = x.reshape(blocks, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    behind = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    least = np.minimum(behind[:windows], ahead[w - 1 : w - 1 + windows])
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(texts)), sizes)[:windows]
    at = np.flatnonzero(np.arange(windows) + length <= ends[row])
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64)
    v, r = least[at], row[at]
    head = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (r[1:] != r[:-1])])
    place = (v[head] & _PLACE).astype(np.int64)
    begin = ends - sizes
    return r[head], at[head] - begin[r[head]], np.diff(np.r_[head, len(at)]), h[place]


def cut(df: DataFrame, length: int, seed: int) -> DataFrame:
    """``mh``, ``id``, ``start``, ``cnt`` of every super-k-mer of ``df(id, text)``."""
    schema = T.StructType([T.StructField("mh", T.LongType()), T.StructField("id", df.schema["id"].dataType), T.StructField("start", T.IntegerType()), T.StructField("cnt", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, 1):
            rows, part = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                if t is not None and len(t) >= length:
                    rows.append(i)
                    part.append(t)
            if part:
                r, start, cnt, mh = super_kmers(part, length, seed)
                ids = b.column(0).take(pa.array(np.array(rows, np.int64)[r]))
                yield pa.RecordBatch.from_arrays([pa.array(mh.view(np.int64)), ids, pa.array(start.astype(np.int32)), pa.array(cnt.astype(np.int32))], names=schema.names)

    return df.mapInArrow(run, schema)


def pack(df: DataFrame, length: int) -> DataFrame:
    """Packed strings of ``df(id, text, runs)``: ``mh``, ``id``, ``start``, ``cnt``, ``s``."""
    schema = T.StructType([T.StructField("mh", T.LongType()), T.StructField("id", df.schema["id"].dataType), T.StructField("start", T.IntegerType()), T.StructField("cnt", T.IntegerType()), T.StructField("s", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, 1):
            rows, out = [], ([], [], [], [])
            for i, (t, runs) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                for x in runs:
                    rows.append(i)
                    a, c = x["start"], x["cnt"]
                    for o, v in zip(out, (x["mh"], a, c, t[a : a + c + length - 1])):
                        o.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), b.column(0).take(pa.array(rows, pa.int64())), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def window_keys(strings: list[str], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string index, offset, hash) of every window of every packed string."""
    code = codes(strings)
    size = np.array([len(s) for s in strings], np.int64)
    begin, count = _starts(size), size - length + 1
    where = np.repeat(begin - _starts(count), count) + np.arange(count.sum())
    row = np.repeat(np.arange(len(strings)), count)
    return row, where - begin[row], rolling(code, length)[where]


# A window group is what two or more classes share: its name, the class, and the class's window interval in it.
GROUPS = "wid long, wid2 long, cid long, cid2 long, a int, b int"


def by_letters(group: np.ndarray, texts: list[str]) -> np.ndarray:
    """Groups (ascending numbers) parted where their texts differ: a number of the group and the text for each member."""
    head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    first = np.repeat(head, np.diff(np.r_[head, len(group)]))
    out = group.astype(np.int64) * 1
    known: dict[tuple[int, str], int] = {}
    top = int(out.max()) + 1 if len(out) else 0
    for i, f in enumerate(first.tolist()):
        if i != f and texts[i] != texts[f]:
            out[i] = known.setdefault((f, texts[i]), top + len(known))
    return out


def _bucket_groups(length: int):
    """Window groups of whole buckets, for a partition sorted by minimiser."""

    def groups(table: pa.Table) -> pa.RecordBatch:
        cid, cid2, low, high = (np.asarray(table.column(c).combine_chunks()) for c in ("cid", "cid2", "low", "high"))
        strings = table.column("s").to_pylist()
        mh = np.asarray(table.column("mh").combine_chunks())
        row, off, key = window_keys(strings, length)
        key = mix(key ^ mix(mh.view(np.uint64))[row])
        order = np.lexsort((off, row, key))
        k, r, o = key[order], row[order], off[order]
        head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        size = np.diff(np.r_[head, len(k)])
        several = (np.minimum.reduceat(low[r], head) < np.maximum.reduceat(high[r], head)) & (size > 1)
        take = np.repeat(several, size)
        g = np.repeat(np.arange(len(head)), size)[take]
        r, o = r[take], o[take]
        g = by_letters(g, [strings[i][j : j + length] for i, j in zip(r.tolist(), o.tolist())])
        order = np.lexsort((o, r, g))
        g, r, o = g[order], r[order], o[order]
        if len(g):  # what the letters have parted may be held by one record only
            head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            still = np.repeat(np.minimum.reduceat(low[r], head) < np.maximum.reduceat(high[r], head), np.diff(np.r_[head, len(g)]))
            g, r, o = g[still], r[still], o[still]
        # windows with the same classes are one group; a class's interval in it runs from its first to its last
        if len(r):
            start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            size = np.diff(np.r_[start, len(g)])
            wid, wid2 = (np.repeat(mix(np.add.reduceat(mix(c[r].view(np.uint64)), start)), size).view(np.int64) for c in (cid, cid2))
            order = np.lexsort((o, r, wid2, wid))
            wid, wid2, r, o = wid[order], wid2[order], r[order], o[order]
            # intervals break where windows are not consecutive
            head = np.flatnonzero(np.r_[True, (wid[1:] != wid[:-1]) | (wid2[1:] != wid2[:-1]) | (r[1:] != r[:-1]) | (o[1:] > o[:-1] + 1)])
            tail = np.r_[head[1:] - 1, len(r) - 1]
            names, c, c2, a, b = (wid[head], wid2[head]), cid[r[head]], cid2[r[head]], o[head], o[tail]
        else:
            c = c2 = a = b = np.zeros(0, np.int64)
            names = (c, c)
        return pa.RecordBatch.from_arrays([*map(pa.array, names), pa.array(c), pa.array(c2), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["wid", "wid2", "cid", "cid2", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            mh = np.asarray(b.column("mh"))
            at = int(np.searchsorted(mh, mh[-1]))  # where the last bucket begins
            if at == 0 and waiting and np.asarray(waiting[-1].column("mh"))[-1] == mh[0]:
                waiting.append(b)
                continue
            done = [*waiting, b.slice(0, at)]
            waiting = [b.slice(at)]
            if sum(x.num_rows for x in done):
                yield groups(pa.Table.from_batches(done))
        if waiting:
            yield groups(pa.Table.from_batches(waiting))

    return run


def _hot_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, b_text):
            row, off, key = window_keys(b.column("s").to_pylist(), length)
            key = mix(key ^ mix(np.asarray(b.column("mh")).view(np.uint64))[row])
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(b.column(c).take(at) for c in ("cid", "cid2", "low", "high")), pa.array(off.astype(np.int32))], names=["key", "cid", "cid2", "low", "high", "a"])

    b_text = 3
    return run


class Shared:
    """What the stages leave: ``packed`` (super-k-mers with a shared minimiser), their ``classes``, and the window ``groups``."""

    def __init__(self, df: DataFrame, id_col: str, text: str, length: int = LENGTH, seed: int = SEED_CHARS, hot: int = HOT):
        self.length, self.id_col = length, id_col
        docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull() & (F.length("text") >= length))
        rows = written(cut(docs, length, seed), "kmers")
        held = rows.groupBy("mh").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select("mh")
        runs = rows.join(held.hint("merge"), "mh", "left_semi").groupBy("id").agg(F.collect_list(F.struct("mh", "start", "cnt")).alias("runs"))  # bounded by the record's length
        name = lambda *c: (F.xxhash64(*c), F.xxhash64(F.lit(7), *c))
        self.packed = written(pack(docs.join(runs.hint("merge"), "id"), length).withColumns(dict(zip(("cid", "cid2"), name("mh", "s")))), "packed")
        self.classes = written(self.packed.groupBy("mh", "cid", "cid2", "s").agg(F.min("id").alias("low"), F.max("id").alias("high")), "kclasses")
        sizes = self.classes.groupBy("mh").count()
        mixed = self.classes.join(sizes.where(f"count > 1 AND count <= {hot}").select("mh").hint("merge"), "mh", "left_semi")
        normal = mixed.repartition("mh").sortWithinPartitions("mh").mapInArrow(_bucket_groups(length), GROUPS)
        big = self.classes.join(sizes.where(f"count > {hot}").select("mh").hint("merge"), "mh", "left_semi").select("mh", "cid", "cid2", "s", "low", "high")
        windows = big.repartition("cid").mapInArrow(_hot_windows(length), "key long, cid long, cid2 long, low long, high long, a int")
        shared = lambda df, *by: df.groupBy(*by).agg(F.min("low").alias("x"), F.max("high").alias("y")).where("x < y").select(*by)
        met = windows.join(shared(windows, "key").hint("merge"), "key", "left_semi").join(self.classes.select("cid", "cid2", "s").hint("merge"), ["cid", "cid2"])
        lettered = met.select("cid", "cid2", "low", "high", "a", F.substring(F.col("s"), F.col("a") + 1, F.lit(length)).alias("w"))
        lettered = lettered.select("cid", "cid2", "low", "high", "a", *(c.alias(n) for n, c in zip(("wid", "wid2"), name("w"))))
        spread = lettered.join(shared(lettered, "wid", "wid2").hint("merge"), ["wid", "wid2"], "left_semi").select("wid", "wid2", "cid", "cid2", "a", F.col("a").alias("b"))
        self.groups = written(normal.unionByName(spread), "groups")

    def pairs(self) -> DataFrame:
        """Pairs of records (smaller first) that share a span, each once."""
        of, c, g = self.packed.select("cid", "cid2", "id").distinct(), ["cid", "cid2"], ["g", "g2"]
        within = self.classes.where("low < high").select(*c).join(of.hint("merge"), c).select(F.col("cid").alias("g"), F.col("cid2").alias("g2"), "id")
        across = self.groups.select("wid", "wid2", *c).distinct().join(of.hint("merge"), c).select(F.col("wid").alias("g"), F.col("wid2").alias("g2"), "id").distinct()
        both = written(within.unionByName(across), "holders")
        # pieces of one passage are held by the same records: one group per set of holders is enough
        holders = both.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "id")).alias("y"))
        one = holders.groupBy("n", "x", "y").agg(F.min(F.struct(*g)).alias("g")).select("g.*")
        once = both.join(one.hint("merge"), g, "left_semi")
        a, b = once.select(*g, F.col("id").alias("x")), once.select(*g, F.col("id").alias("y"))
        return a.join(b.hint("merge"), g).where("x < y").select(F.col("x").alias(f"{self.id_col}_a"), F.col("y").alias(f"{self.id_col}_b")).distinct()

    def spans(self) -> DataFrame:
        """Maximal shared stretches: ``id``, ``start`` (from 0), ``chars``."""
        c = ["cid", "cid2"]
        whole = self.classes.where("low < high").select(*c, F.lit(0).alias("a"), F.lit(None).cast("int").alias("b"))
        parts = self.groups.select(*c, "a", "b").distinct()
        marked = self.packed.select("id", *c, "start", "cnt").join(whole.unionByName(parts).hint("merge"), c).select(
            "id", (F.col("start") + F.col("a")).alias("f"), (F.col("start") + F.coalesce("b", F.col("cnt") - 1) + self.length).alias("t"))
        w = Window.partitionBy("id").orderBy("f", "t")  # bounded by the record's length
        # two windows belong to one stretch only if every window between them is shared
        seen = F.max("t").over(w.rowsBetween(Window.unboundedPreceding, -1))
        stretch = marked.withColumn("new", F.when(F.col("f") + self.length - 1 <= seen, 0).otherwise(1)).withColumn("k", F.sum("new").over(w))
        return stretch.groupBy("id", "k").agg(F.min("f").alias("start"), (F.max("t") - F.min("f")).alias("chars")).drop("k")

    def coverage(self, df: DataFrame, text: str) -> DataFrame:
        """One row per record: ``spans``, ``longest``, ``shared_chars`` and ``shared_part`` (of its characters, 0 for none)."""
        w = Window.partitionBy("id").orderBy("start")
        s = self.spans().withColumn("fresh", F.col("start") + F.col("chars") - F.greatest("start", F.coalesce(F.max(F.col("start") + F.col("chars")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
        per = s.groupBy("id").agg(F.count(F.lit(1)).alias("spans"), F.max("chars").alias("longest"), F.sum(F.greatest("fresh", F.lit(0))).alias("shared_chars"))
        sizes = df.select(F.col(self.id_col).cast("long").alias("id"), F.length(text).alias("chars"))
        zero = lambda c: F.coalesce(c, F.lit(0))
        return sizes.join(per, "id", "left").select(
            F.col("id").alias(self.id_col), zero("spans").alias("spans"), zero("longest").alias("longest"), zero("shared_chars").alias("shared_chars"),
            F.when(F.col("chars") > 0, F.round(zero("shared_chars") / F.col("chars"), 6)).otherwise(0.0).alias("shared_part"))
