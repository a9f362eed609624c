"""Mixing sources to target weights.

Method: capped water-filling.  A total size is shared out by the target weights; a source
that would need more than ``max_repeats`` times its own size is clamped there, and what it
cannot take is given to the others in proportion to their weights, until nobody exceeds.
Each source is then drawn in whole repetitions and one seeded fraction of it: records are
ordered by a seeded hash, and taken until the fraction of the tokens is reached.

Scale: per source only its size and a histogram of tokens over ``BUCKETS`` ranges of the
hash reach the driver, whatever the number of records; only the records of one range per
source, where the limit falls, are put in order.

Defined results: records without a source, of a source without a target or with no token
are not drawn; a target source without records is clamped at 0; negative or null shares
count as 0; if all sources are clamped the draw is smaller than asked and says so.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS, SEED = 1024, 17


@dataclass(frozen=True)
class Source:
    name: str
    weight: float
    repeats: int
    size: int


def water_fill(sources: list[Source], total: float) -> dict[str, float]:
    """How much of each source is drawn, at most ``repeats * size`` each, in all ``total`` where that can be."""
    out = dict.fromkeys((s.name for s in sources), 0.0)
    free = [s for s in sources if s.weight > 0 and s.size > 0 and s.repeats > 0]
    left = float(total)
    while free and left > 0:
        weight = sum(s.weight for s in free)
        full = [s for s in free if s.weight / weight * left >= s.repeats * s.size]
        if not full:
            out |= {s.name: s.weight / weight * left for s in free}
            break
        for s in full:
            out[s.name] = float(s.repeats * s.size)
            left -= out[s.name]
        free = [s for s in free if s not in full]
    return out


class Mix:
    """The draw from ``items(id, source, tokens)`` for ``targets(source, target_share, max_repeats)``.

    ``total``: size of the whole draw in tokens; by default the size of all target sources."""

    def __init__(self, items: DataFrame, targets: DataFrame, total: int | None = None, seed: int = SEED):
        spark = items.sparkSession
        clean = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("share"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("repeats"))
        self.items = items.where("tokens > 0").join(F.broadcast(clean), "source").select("id", "source", "tokens", F.xxhash64(F.lit(seed), "id").alias("h"))  # targets: a parameter table
        bucket = F.floor((F.shiftrightunsigned("h", 1).cast("double")) / float(1 << 63) * BUCKETS).cast("int")
        self.items = self.items.withColumn("bucket", F.least(bucket, F.lit(BUCKETS - 1)))
        histogram = self.items.groupBy("source", "bucket").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect()  # BUCKETS rows a target source at most
        size: dict[str, int] = {}
        for r in histogram:
            size[r["source"]] = size.get(r["source"], 0) + r["t"]
        self.sources = [Source(r["source"], r["share"], r["repeats"], size.get(r["source"], 0)) for r in sorted(clean.collect())]
        self.total = sum(size.values()) if total is None else total
        self.amount = water_fill(self.sources, self.total)
        rows = []
        for s in self.sources:
            whole, part = (divmod(self.amount[s.name], s.size) if s.size else (0, 0.0))
            per = {r["bucket"]: r["t"] for r in histogram if r["source"] == s.name}
            at, before = -1, 0
            for b in sorted(per):
                if before + per[b] > part:
                    at = b
                    break
                before += per[b]
            else:
                at = BUCKETS
            rows.append((s.name, int(whole), float(part), at, int(before)))
        self.plan = spark.createDataFrame(rows, "source string, whole long, part double, at int, before long")

    def draw(self) -> DataFrame:
        """``id``, ``source``, ``tokens``, ``repeats``: every record that is drawn, and how often."""
        planned = self.items.join(F.broadcast(self.plan), "source")
        w = Window.partitionBy("source").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0)
        edge = planned.where("bucket = at").withColumn("upto", F.col("before") + F.sum("tokens").over(w))
        # the record on the limit is taken if that comes nearer to it
        inside = F.col("upto") - F.col("tokens") / 2 <= F.col("part")
        rest = planned.where("bucket <> at").withColumn("more", (F.col("bucket") < F.col("at")).cast("long"))
        out = edge.withColumn("more", inside.cast("long")).drop("upto").unionByName(rest)
        times = F.col("whole") + F.col("more")
        return out.select("id", "source", "tokens", times.alias("repeats")).where("repeats > 0")

    def shares(self) -> DataFrame:
        """One row per target source: its size, how much of it is drawn, and the share it has in the draw."""
        got = self.draw().groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("drawn"), F.count(F.lit(1)).alias("records"), F.max("repeats").alias("most"))
        asked = self.items.sparkSession.createDataFrame([(s.name, s.weight, s.repeats, s.size, self.amount[s.name]) for s in self.sources], "source string, target_share double, max_repeats long, source_tokens long, wanted double")
        joined = asked.join(got, "source", "left").fillna(0, ["drawn", "records", "most"])
        all_ = joined.agg(F.sum("drawn").alias("all_drawn"))
        return joined.crossJoin(F.broadcast(all_)).select(
            "source", "target_share", "max_repeats", "source_tokens", F.round("wanted", 3).alias("wanted_tokens"), F.col("drawn").alias("drawn_tokens"), "records", F.col("most").alias("most_repeats"),
            F.round(F.coalesce(F.try_divide("drawn", "all_drawn"), F.lit(0.0)), 6).alias("actual_share"))
