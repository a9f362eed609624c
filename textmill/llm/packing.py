"""Filling fixed-capacity containers with items.

Method: shortest-pack-first over the length histogram.  Lengths are placed longest first,
each into the pack that is shortest so far (has most room) as long as it fits, else into
a new one; packs of one content are one *pattern* with a count, so the work depends on the
capacity and not on the number of items.  Patterns are then joined back to the items by
each item's rank among those of its length.

An item is never split unless it exceeds the capacity; then it is cut into pieces of the
capacity and a last one with the rest.

One addition: a new pack, which is the shortest one, takes equal lengths until the next doesn't fit.

Scale: only the histogram (at most ``capacity`` rows a kind) reaches the driver.  The slots of the
patterns go out to the executors where they are at most ``MOST_SLOTS``, else they are joined as a table, by
ranges of ``RANGE`` ranks, so that no item meets the slots of other ranges.  Ranks are taken within
(length, part), parts drawn by a hash of the id and as many as hold ``PART_ITEMS`` items each, so a length that
a third of all items share is ranked by many tasks.

Defined results: items without a token (null or empty text) are in no container; equal
lengths are filled in order of id; empty input gives no container; a kind without a
positive capacity is left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written

#: Parts of a length at least, and items of one part on average at most.
PARTS, PART_ITEMS = 64, 500_000
#: At most so many slots (40 bytes each) are sent to the executors; beyond it they are joined as a table, by ranges of so many ranks.
MOST_SLOTS, RANGE = 200_000, 4096


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Patterns (number of containers, ((length, times), ...)) that hold every item of the histogram."""
    room: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}
    open_rooms: list[int] = []  # negated, so that the pack with most room is on top

    def put(free: int, number: int, content: tuple[tuple[int, int], ...]) -> None:
        if free not in room:
            room[free] = []
            heapq.heappush(open_rooms, -free)
        room[free].append((number, content))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left > 0:
            while open_rooms and not room.get(-open_rooms[0]):
                room.pop(-heapq.heappop(open_rooms), None)
            free = -open_rooms[0] if open_rooms else 0
            if free < length:
                # a new pack is the shortest one, so it takes equal lengths until the next doesn't fit
                times = capacity // length
                whole, rest = divmod(left, times)
                if whole:
                    put(capacity - times * length, whole, ((length, times),))
                if rest:
                    put(capacity - rest * length, 1, ((length, rest),))
                break
            number, content = room[free].pop()
            times = min(free // length, max(1, left // number))
            used = min(number, left // times)
            if used < number:
                room[free].append((number - used, content))
            put(free - times * length, used, (*content, (length, times)))
            left -= used * times
    return [p for packs in room.values() for p in packs]


def slots(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, container of that rank, times), sorted: where the items of each length go."""
    rows, base, at = [], 0, dict.fromkeys(counts, 0)
    for number, content in pack_histogram(counts, capacity):
        merged: dict[int, int] = {}
        for length, times in content:
            merged[length] = merged.get(length, 0) + times
        for length, times in merged.items():
            rows.append((length, at[length], base, times))
            at[length] += number * times
        base += number
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pieces(items: DataFrame, kinds: DataFrame) -> DataFrame:
    """``kind``, ``capacity``, ``id``, ``piece`` (from 0), ``length``: items of ``items(id, tokens)`` cut where they exceed the capacity."""
    k = kinds.where("capacity > 0")
    both = items.where("tokens > 0").crossJoin(F.broadcast(k))  # kinds: a parameter table of a few rows
    cut = both.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / F.col("capacity")).cast("long"))))
    return cut.select("kind", "capacity", "id", "piece", F.least("capacity", F.col("tokens") - F.col("piece") * F.col("capacity")).alias("length"))


def packed(items: DataFrame, kinds: DataFrame) -> DataFrame:
    """``kind``, ``container`` (from 0), ``id``, ``piece``, ``length``: the container of every piece.

    ``items`` has ``id`` and ``tokens``; ``kinds`` has ``kind`` and ``capacity``."""
    every = pieces(items, kinds)
    parts = max(PARTS, -(-every.count() // PART_ITEMS))
    rows = every.withColumn("part", F.pmod(F.xxhash64("id", "piece"), F.lit(parts)).cast("int"))
    per_part = written(rows.groupBy("kind", "capacity", "length", "part").agg(F.count(F.lit(1)).alias("n")), "histogram")
    tables = {}
    for r in per_part.groupBy("kind", "capacity", "length").agg(F.sum("n").alias("n")).collect():  # at most the sum of the capacities
        tables.setdefault((r["kind"], r["capacity"]), {})[r["length"]] = r["n"]
    kind_no = {k: i for i, k in enumerate(sorted(tables))}
    where = [np.c_[np.full(len(s), kind_no[k]), s] for k in sorted(tables) if len(s := slots(tables[k], k[1]))]
    table = np.concatenate(where) if where else np.zeros((0, 5), np.int64)
    offset = per_part.withColumn("offset", F.sum("n").over(Window.partitionBy("kind", "length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    rank = F.row_number().over(Window.partitionBy("kind", "length", "part").orderBy("id", "piece")) - 1
    ranked = rows.withColumn("r", rank).join(offset.select("kind", "length", "part", F.coalesce("offset", F.lit(0)).alias("offset")), ["kind", "length", "part"])
    ranked = ranked.select("kind", "id", "piece", "length", (F.col("r") + F.col("offset")).alias("rank"))
    if len(table) > MOST_SLOTS:
        return _joined(ranked, table, sorted(tables))
    sent = items.sparkSession.sparkContext.broadcast(table)
    names = {k[0]: i for k, i in kind_no.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        top = np.int64(1) << np.int64(40)
        lengths = np.unique(t[:, 0] * top + t[:, 1])
        of = np.searchsorted(lengths, t[:, 0] * top + t[:, 1])
        keys = of * top + t[:, 2]
        for b in batches:
            if not b.num_rows:
                continue
            kind = np.array([names[k] for k in b.column(0).to_pylist()], np.int64)
            length, rank = np.asarray(b.column(3)), np.asarray(b.column(4))
            at = np.searchsorted(keys, np.searchsorted(lengths, kind * top + length) * top + rank, "right") - 1
            container = t[at, 3] + (rank - t[at, 2]) // t[at, 4]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(container), b.column(1), b.column(2), b.column(3)], names=["kind", "container", "id", "piece", "length"])

    return ranked.mapInArrow(run, f"kind string, container long, id {items.schema['id'].dataType.simpleString()}, piece long, length long")


def _joined(ranked: DataFrame, table: np.ndarray, kinds: list[tuple[str, int]]) -> DataFrame:
    """The slot of each rank, from a table of slots: both are put in order within ranges of ranks, and every rank takes the last slot before it."""
    import pandas as pd

    t = pd.DataFrame(table, columns=["k", "length", "first", "base", "times"])
    t["kind"] = [kinds[i][0] for i in t.pop("k")]
    t["last"] = t.groupby(["kind", "length"])["first"].shift(-1, fill_value=np.iinfo(np.int64).max)
    slot = ranked.sparkSession.createDataFrame(t)
    top = ranked.groupBy("kind", "length").agg(F.max("rank").alias("top"))
    within = slot.join(top, ["kind", "length"]).withColumn("last", F.least(F.col("last") - 1, "top")).where("first <= last")
    within = within.withColumn("range", F.explode(F.sequence(F.floor(F.col("first") / RANGE), F.floor(F.col("last") / RANGE))))
    marks = within.select("kind", "length", "range", F.greatest("first", F.col("range") * RANGE).alias("rank"), F.lit(None).cast(ranked.schema["id"].dataType).alias("id"), F.lit(None).cast("long").alias("piece"), F.struct("first", "base", "times").alias("slot"))
    both = ranked.select("kind", "length", F.floor(F.col("rank") / RANGE).alias("range"), "rank", "id", "piece", F.lit(None).cast(marks.schema["slot"].dataType).alias("slot")).unionByName(marks)
    w = Window.partitionBy("kind", "length", "range").orderBy("rank", F.col("slot").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    s = both.withColumn("at", F.last("slot", True).over(w)).where("slot IS NULL")
    return s.select("kind", (F.col("at.base") + F.floor((F.col("rank") - F.col("at.first")) / F.col("at.times"))).cast("long").alias("container"), "id", "piece", "length")


def containers(filled: DataFrame, kinds: DataFrame) -> DataFrame:
    """One row per container: ``pieces``, ``used``, ``unused``."""
    per = filled.groupBy("kind", "container").agg(F.count(F.lit(1)).alias("pieces"), F.sum("length").alias("used"))
    return per.join(F.broadcast(kinds), "kind").select("kind", "container", "pieces", "used", (F.col("capacity") - F.col("used")).alias("unused"))
