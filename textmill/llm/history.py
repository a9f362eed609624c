"""Deduplicating new batches against all history.

Method: accepted records become immutable suffix arrays over their concatenated element
sequences (see ``nearsame``), one per batch; arrays of one size are merged with the next one,
so n batches are at most log2(n) + 1 arrays and each record is merged as often at most.  An
array holds at most ``ARRAY_ELEMENTS`` elements: what is larger is several arrays, so
nothing has to fit into one cell or one task as history grows.  A batch binary-searches its substrings of two and more elements in
every array; the matches' coverage is aggregated per record, records whose sizes or sketches rule a
pair out are dropped at once, and what is left is checked exactly.

Element order is fixed by the hash alone, so an accepted batch's array never has to be
rebuilt when later ones change word frequencies.  Elements are cut into shards by hash range,
as for overlaps across splits.

``HistoryIndex`` keeps everything on shared storage, in tables bucketed by shard (arrays) or
by class (elements, rows).  A check sends the batch to the buckets: history is read
where it lies, and neither shuffled nor tokenised again; of the classes only those that a match
names are joined.

Defined results: null, blank and short texts repeat nothing and are repeated by nothing;
rows without a readable day are never taken as earlier, nor batches without a day as later.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import shared_folder, written
from .crosssplit import CHUNK, MATCHES, Stretches, allowed, merged
from .nearsame import MIN_WORDS, THRESHOLD, Routing, _starts, classes, members, routing, segments, suffix_array, verified, word_sets

#: Elements of one array at most, and of the part of a batch that is searched at a time.
ARRAY_ELEMENTS = 1_000_000
STRETCH = ("cls", "n", "s1", "s2", "seg", "day")
ARRAYS = "shard int, name string, first_day int, data binary"


class Segment:
    """An immutable suffix array of stretches."""

    def __init__(self, table: pa.Table, order: np.ndarray | None = None):
        self.table = table
        self.of = s = Stretches(table)
        self.day = np.asarray(table.column("day").combine_chunks()).astype(np.int64)
        rows = len(s.cls)
        at = np.arange(len(s.tokens)) + s.row
        text = np.empty(len(s.tokens) + rows, np.int64)
        text[at] = s.tokens + (1 << 32)
        text[s.off[1:] + np.arange(rows)] = np.arange(rows)  # end marks, each its own, below every token
        self.row_of = np.empty(len(text), np.int64)
        self.row_of[at] = s.row
        self.row_of[s.off[1:] + np.arange(rows)] = np.arange(rows)
        if order is None:
            order = suffix_array(text)[rows:]  # without the suffixes that start at an end mark
        self.order, self.text = order, text
        self.head = pair_key(text[order], text[order + 1])

    def dump(self) -> bytes:
        """The stretches and their suffix order, to be kept."""
        sink = pa.BufferOutputStream()
        order = pa.array(self.order.astype(np.uint32))
        with pa.ipc.new_stream(sink, self.table.schema) as w:
            w.write_table(self.table)
        with pa.ipc.new_stream(sink, pa.schema([("order", pa.uint32())])) as w:
            w.write_batch(pa.RecordBatch.from_arrays([order], names=["order"]))
        return sink.getvalue().to_pybytes()

    @staticmethod
    def load(data: bytes) -> Segment:
        source = pa.BufferReader(data)
        table = pa.ipc.open_stream(source).read_all()
        order = np.asarray(pa.ipc.open_stream(source).read_all().column(0).combine_chunks())
        return Segment(table, order.astype(np.int64))

    def search(self, q: Stretches, day: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, ...]]:
        """Chunks of (query class, held class, length of the match from here on) for every shared substring of two
        elements with a record of an earlier day."""
        start = np.flatnonzero(q.row[1:] == q.row[:-1])
        t = q.tokens + (1 << 32)
        key = pair_key(t[start], t[start + 1])
        lo, hi = np.searchsorted(self.head, key, "left"), np.searchsorted(self.head, key, "right")
        start, lo, hi = (x[hi > lo] for x in (start, lo, hi))
        found = hi - lo
        cut = np.r_[0, np.flatnonzero(np.diff(np.cumsum(found) // CHUNK)) + 1, len(found)]
        for a, b in zip(cut[:-1], cut[1:]):
            c = found[a:b]
            if not c.sum():
                continue
            who = np.repeat(np.arange(a, b), c)
            place = self.order[np.repeat(lo[a:b] - _starts(c), c) + np.arange(c.sum())]
            mine, other = q.row[start[who]], self.row_of[place]
            ok = allowed(q, mine, self.of, other, threshold) & (self.day[other] < day[mine])
            who, place, mine, other = who[ok], place[ok], mine[ok], other[ok]
            # two hashes can agree by accident: the first element is compared, then the match is followed to its end
            here = start[who]
            length = np.zeros(len(who), np.int64)
            live = np.arange(len(who))
            while len(live):
                x, y = here[live] + length[live], place[live] + length[live]
                inside = (x < q.off[mine[live] + 1]) & (y < len(self.text))
                same = inside.copy()
                same[inside] = t[x[inside]] == self.text[y[inside]]
                live = live[same]
                length[live] += 1
            real = length >= 2
            yield q.cls[mine[real]], self.of.cls[other[real]], length[real]


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A key of the first two symbols of a suffix in the order of the suffixes: tokens fill 33 bits, so the
    second keeps its upper 30; what shares a key is compared in full."""
    return (first << np.int64(30)) | (np.minimum(second, (1 << 33) - 1) >> np.int64(3))


def sized(counts: list[int], limit: int) -> list[int]:
    """Which array each of the batches (element counts, in order of arrival) ends in: arrays of one size are merged, none beyond the limit."""
    log: list[tuple[int, int, list[int]]] = []  # level, elements, batches
    for i, n in enumerate(counts):
        held, size = [i], n
        while log and log[-1][0] <= size.bit_length() and log[-1][1] + size <= limit:
            _, more, before = log.pop()
            held, size = before + held, size + more
        log.append((size.bit_length(), size, held))
    of = [0] * len(counts)
    for k, (_, _, held) in enumerate(log):
        for i in held:
            of[i] = k
    return of


def _build(name: str, limit: int = ARRAY_ELEMENTS):
    """The arrays of each shard, for a partition sorted by shard and day."""

    def arrays(shard: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        days = np.asarray(table.column("day").chunk(0))
        size = np.diff(np.asarray(table.column("seg").chunk(0).offsets)).astype(np.int64)
        # a batch is a day; one beyond the limit is several
        part = (np.cumsum(size) - 1) // limit
        head = np.flatnonzero(np.r_[True, (days[1:] != days[:-1]) | (part[1:] != part[:-1])])
        of = sized(np.add.reduceat(size, head).tolist(), limit)
        ends = np.r_[head[1:], len(days)]
        first = 0
        for i in range(len(head)):
            if i + 1 == len(head) or of[i + 1] != of[i]:
                piece = table.slice(first, ends[i] - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([name]), pa.array([int(days[first])], pa.int32()), pa.array([Segment(piece).dump()], pa.binary())], names=["shard", "name", "first_day", "data"])
                first = ends[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, size = None, [], 0
        for whole in batches:
            if not whole.num_rows:
                continue
            keys = np.asarray(whole.column("shard"))
            cut = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]
            for i, j in zip(cut[:-1], cut[1:]):
                if held and (keys[i] != shard or size > 4 * limit):  # what is held of a shard is bounded
                    yield from arrays(shard, pa.Table.from_batches(held))
                    held, size = [], 0
                shard = int(keys[i])
                part = whole.slice(i, j - i).select(list(STRETCH))
                held.append(part)
                size += len(part.column("seg").values)
        if held:
            yield from arrays(shard, pa.Table.from_batches(held))

    return run


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches inside kept arrays, to be merged."""
    for b in batches:
        for shard, data in zip(b.column("shard").to_pylist(), b.column("data")):
            t = pa.ipc.open_stream(pa.BufferReader(data.as_buffer())).read_all().combine_chunks()
            for r in t.to_batches():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(r.num_rows, shard, np.int32)), *(r.column(c) for c in STRETCH)], names=["shard", *STRETCH])


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's stretches of one shard as one piece or several, for a partition sorted by shard."""
    shard, held, size = None, [], 0

    def out() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        t = pa.Table.from_batches(held)
        with pa.ipc.new_stream(sink, t.schema) as w:
            w.write_table(t)
        last = max(int(np.asarray(b.column("day")).max()) for b in held)
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([last], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["shard", "last_day", "batch"])

    for whole in batches:
        if not whole.num_rows:
            continue
        keys = np.asarray(whole.column("shard"))
        cut = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]
        for i, j in zip(cut[:-1], cut[1:]):
            if held and (keys[i] != shard or size > ARRAY_ELEMENTS):
                yield out()
                held, size = [], 0
            shard = int(keys[i])
            part = whole.slice(i, j - i).select(list(STRETCH))
            held.append(part)
            size += int(np.asarray(part.column("seg").offsets)[-1] - np.asarray(part.column("seg").offsets)[0])
    if held:
        yield out()


def _lookup(threshold: float):
    """Every piece of a batch through every array of its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, q, day = None, None, None
        for b in batches:
            for batch, data in zip(b.column("batch"), b.column("data")):
                if last is None or not batch.equals(last):
                    t = pa.ipc.open_stream(pa.BufferReader(batch.as_buffer())).read_all()
                    last, q, day = batch, Stretches(t), np.asarray(t.column("day").combine_chunks()).astype(np.int64)
                yield merged(list(Segment.load(data.as_buffer()).search(q, day, threshold)))

    return run


class HistoryIndex:
    """Suffix arrays of everything accepted so far, kept under ``path`` between runs.

    ``add`` takes accepted records, ``check`` finds what a batch repeats.  Files are only ever added: a
    manifest of the live arrays gets a new version once its files are complete, so a run that dies leaves the
    version before, and what it wrote is named nowhere.  Routing and ``buckets`` are fixed by the first batch; a shard that grows
    gets more arrays, not larger ones.  Ids keep their type; all batches must have the same."""

    SHARDS_PER_BUCKET = 4

    def __init__(self, spark, path: str, buckets: int | None = None, threshold: float = THRESHOLD, min_words: int = MIN_WORDS):
        self.spark, self.path, self.threshold, self.min_words = spark, path.rstrip("/"), threshold, min_words
        self.version, self.live, self.accepted, self.to = 0, [], [], None
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        try:
            rows = spark.read.parquet(f"{self.path}/manifest").collect()  # a row a version
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = []
        if rows:
            now = max(rows, key=lambda r: r["version"])
            self.version, self.buckets, self.accepted = now["version"], now["buckets"], list(now["accepted"])
            self.live = sorted((r["level"], r["name"]) for r in now["live"])
            self.to = Routing(now["shards"], *(np.array(now[c], np.int64) for c in ("elements", "pairs", "spread")))

    def _table(self, name: str) -> str:
        return f"textmill_{name}_{hashlib.md5(self.path.encode()).hexdigest()}"

    def _append(self, df: DataFrame, name: str, by: str) -> None:
        """Append to a bucketed table; ``df`` has the partitions of its buckets, so that there is one file a bucket."""
        df.write.format("parquet").bucketBy(self.buckets, by).option("path", f"{self.path}/{name}").mode("append").saveAsTable(self._table(name))

    def _kept(self, name: str, by: str) -> DataFrame:
        """A bucketed table; one of an earlier session is declared again."""
        if not self.spark.catalog.tableExists(self._table(name)):
            fields = self.spark.read.parquet(f"{self.path}/{name}").schema.fields
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(f"CREATE TABLE {self._table(name)} ({schema}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return self.spark.table(self._table(name))

    def _sets(self, df: DataFrame, id_col: str, text: str, day: str) -> DataFrame:
        dated = df.select(F.col(id_col).alias("name"), F.col(text).alias("__t"), F.expr(day).cast("int").alias("day")).where("day IS NOT NULL")
        return written(word_sets(dated, "name", "__t", "day", min_words=self.min_words), "sets")

    def _commit(self, live: list[tuple[int, str]], accepted: list[str]) -> None:
        to = self.to
        row = (self.version + 1, self.buckets, to.shards, to.elements.tolist(), to.pairs.tolist(), to.spread.tolist(), sorted(live), accepted)
        schema = "version int, buckets int, shards int, elements array<long>, pairs array<long>, spread array<long>, live array<struct<level:int,name:string>>, accepted array<string>"
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        self.version, self.live, self.accepted = self.version + 1, sorted(live), accepted

    def add(self, df: DataFrame, id_col: str, text: str, day: str = "0") -> None:
        """Accept records: their arrays (one per day at first), classes and rows are written, then equal levels merged.

        ``day`` is an SQL expression of a day number; without days every record counts as earlier than any batch."""
        name = uuid.uuid4().hex
        sets = self._sets(df, id_col, text, day)
        cls = written(classes(sets, F.min("day").alias("day"), base=self.version + 1), "classes")
        if self.to is None:
            self.to = routing(cls, shards=self.buckets * self.SHARDS_PER_BUCKET)
        self._append(cls.select("cls", "elems", F.lit(name).alias("batch")).repartition(self.buckets, "cls"), "classes", "cls")
        self._append(members(sets, cls, "day").select(F.col("id").alias("name"), "day", "cls", F.lit(name).alias("batch")).repartition(self.buckets, "cls"), "members", "cls")
        rows = segments(cls, 0, self.to, False, "day").drop("side")
        self._append_arrays(rows, name)
        live, level, made = list(self.live), 0, name
        while any(lv == level for lv, _ in live):
            other = next(n for lv, n in live if lv == level)
            both = self._arrays([made, other]).select("shard", "data").mapInArrow(_stretches, "shard int, cls long, n int, s1 long, s2 long, seg array<int>, day int")
            made = uuid.uuid4().hex
            self._append_arrays(both, made)
            live.remove((level, other))
            level += 1
        self._commit([*live, (level, made)], [*self.accepted, name])

    def _append_arrays(self, rows: DataFrame, name: str) -> None:
        self._append(rows.repartition(self.buckets, "shard").sortWithinPartitions("shard", "day").mapInArrow(_build(name), ARRAYS), "arrays", "shard")

    def _arrays(self, names: list[str]) -> DataFrame:
        return self._kept("arrays", "shard").where(F.col("name").isin(names))

    def _matched(self, df: DataFrame, id_col: str, text: str, day: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Near-same class pairs (a, b, similarity), the batch's rows (``id_col``, a, ``__bd``) and the matched accepted ones (held, b, ``__hd``)."""
        sets = self._sets(df, id_col, text, day)
        cls = written(classes(sets, F.max("day").alias("day")), "batch")
        rows = segments(cls, 1, self.to, True, "day").drop("side")
        blobs = rows.repartition(self.buckets, "shard").sortWithinPartitions("shard").mapInArrow(_blobs, "shard int, last_day int, batch binary")
        # the batch is the side that a hash table is built of, bucket by bucket; the arrays stream past it
        met = self._arrays([n for _, n in self.live]).join(blobs.hint("shuffle_hash"), "shard").where("first_day < last_day").select("batch", "data")
        found = met.mapInArrow(_lookup(self.threshold), MATCHES)
        pairs = written(found.groupBy("a", "b").agg(F.sum("spans").alias("spans"), F.max("longest").alias("longest")), "pairs")
        kept = F.col("batch").isin(self.accepted)
        held = self._kept("classes", "cls").where(kept)
        named = pairs.select(F.col("b").alias("cls")).distinct()
        both = written(verified(pairs, cls, held.join(named.hint("shuffle_hash"), "cls", "left_semi"), self.threshold).select("a", "b", "similarity"), "verified")
        left = members(sets, cls, "day").select(F.col("id").alias(id_col), F.col("cls").alias("a"), F.col("day").alias("__bd"))
        rows = self._kept("members", "cls").where(kept)
        right = rows.join(both.select(F.col("b").alias("cls")).distinct().hint("shuffle_hash"), "cls", "left_semi").select(F.col("name").alias("held"), F.col("cls").alias("b"), F.col("day").alias("__hd"))
        return both, left, right

    def check(self, df: DataFrame, id_col: str, text: str, day: str = "1") -> DataFrame:
        """``id_col``, ``held`` and ``similarity``: what the batch repeats of everything accepted on earlier days."""
        if not self.live:
            return df.select(F.col(id_col), F.lit(None).cast("string").alias("held"), F.lit(None).cast("double").alias("similarity")).limit(0)
        both, left, right = self._matched(df, id_col, text, day)
        return both.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where("__hd < __bd").select(id_col, "held", "similarity")

    def repeats(self, df: DataFrame, id_col: str, text: str, day: str = "1") -> DataFrame:
        """One row per batch row that repeats something: how many accepted rows (``repeats``), the first of them by id
        (``held``) and the highest ``similarity``.  Rows are counted by class and day, copies are not expanded."""
        if not self.live:
            return self.check(df, id_col, text, day).withColumn("repeats", F.lit(0).cast("long")).select(id_col, "repeats", "held", "similarity")
        both, left, right = self._matched(df, id_col, text, day)
        counts = right.groupBy("b", "__hd").agg(F.count(F.lit(1)).alias("k"), F.min("held").alias("held"))
        days = left.select("a", "__bd").distinct()
        per = both.join(counts.hint("merge"), "b").join(days.hint("merge"), "a").where("__hd < __bd").groupBy("a", "__bd").agg(
            F.sum("k").alias("repeats"), F.min("held").alias("held"), F.max("similarity").alias("similarity"))
        return left.join(per.hint("merge"), ["a", "__bd"]).select(id_col, "repeats", "held", "similarity")


def repeated_rows(batch: DataFrame, batch_id: str, batch_text: str, batch_day: str, held: DataFrame, held_id: str, held_text: str, held_day: str,
                  threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows ``batch_id``, ``held_id``, ``similarity``: what each batch row repeats from days before its own.

    ``batch_day`` and ``held_day`` are SQL expressions of a day number.  The history is accepted into an index of its
    own in the shared folder, in the order of its days, and all batches are checked against it."""
    index = HistoryIndex(batch.sparkSession, f"{shared_folder(batch.sparkSession)}/history-{uuid.uuid4().hex}", threshold=threshold, min_words=min_words)
    index.add(held, held_id, held_text, held_day)
    return index.check(batch, batch_id, batch_text, batch_day).withColumnRenamed("held", held_id)
