"""Consensus from several annotators' labels, agreement, and annotator reliability.

Method: confidence-aware truth discovery.  Truths and annotators are estimated in alternation until they
settle: the truth of an item minimises the weighted distance of its votes, and an annotator's
error variance s2 is taken at the upper end of its chi-squared confidence interval, so that a
long-tail contributor with three lucky votes does not count like one with thousands.

A single error variance cannot describe annotators who swap two labels or favour one (plain weights agree
with 73 % of the rulings, see README).  So the squared distance d2 of a vote l from a truth t is the annotator's own,
and it is kept in units of the annotator's variance: d2 / s2 = -log p(l | t), with p from the soft truths
of the round before, drawn towards the pool of all annotators by ``PRIOR`` votes.  s2 there is the point estimate
sum(d2) / n of n votes; the method's weight 1 / u, where u = sum(d2) / chi2(alpha / 2, n) is the upper
bound, makes of it chi2(alpha / 2, n) / n * -log p(l | t).  That factor weighs every vote in every round:
0.93 at 1,500 votes, 0.3 at ten, 0.05 at two.

Items with a ruling keep it, and teach how each annotator labels.

Defined results: blank or unknown labels and blank annotators are no votes; an annotator
with two different labels for an item has no vote there; repeats of a vote count once; an
item with conflicting rulings counts as not ruled; ties go to the label first in ``labels``.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written

LABELS = ("positive", "negative", "neutral")
PRIOR, CONFIDENCE = 3.0, 0.95
#: Truths are settled when less than this share of a vote moves on average; a fit that needs more rounds is an error.
TOLERANCE, ROUNDS = 5e-4, 200


def chi_squared_quantile(p: float, votes: Column) -> Column:
    """Quantile of the chi-squared distribution (Wilson and Hilferty's approximation)."""
    k = F.greatest(votes.cast("double"), F.lit(1.0))
    z = NormalDist().inv_cdf(p)
    return k * F.pow(F.greatest(1 - 2 / (9 * k) + z * F.sqrt(2 / (9 * k)), F.lit(1e-4)), 3)


def confidence(votes: Column) -> Column:
    """The point estimate of an error variance from so many votes over its chi-squared upper bound."""
    return chi_squared_quantile((1 - CONFIDENCE) / 2, votes) / F.greatest(votes.cast("double"), F.lit(1.0))


def tidy(label: Column) -> Column:
    return F.lower(F.trim(label))


def votes_of(raw: DataFrame, rulings: DataFrame, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """One row per vote that counts: ``item``, ``agent``, ``lab`` (place in ``labels``), ``ruled`` (place or null).

    ``raw`` has item, agent, label; ``rulings`` item, label."""
    known = F.array(*map(F.lit, labels))
    votes = (
        raw.select("item", F.trim("agent").alias("agent"), tidy(F.col("label")).alias("label"))
        .where(F.col("item").isNotNull() & (F.col("agent") != "") & F.col("label").isin(*labels))
        .groupBy("item", "agent").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
        .select("item", "agent", (F.array_position(known, F.col("label")) - 1).cast("int").alias("lab"))
    )
    ruled = (
        rulings.select("item", tidy(F.col("label")).alias("label")).where(F.col("label") != "")
        .groupBy("item").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
        .select("item", (F.array_position(known, F.col("label")) - 1).cast("int").alias("ruled")).where("ruled >= 0")
    )
    return votes.join(ruled, "item", "left")


class Consensus:
    """The fitted truths and annotators of a table of votes.  An item has at most one vote of each annotator.

    A round is one pass over the votes, which stay where they are (by item), and one table of labels squared
    numbers an annotator.  ``rounds`` of them are made at most, ``self.rounds`` were needed."""

    def __init__(self, votes: DataFrame, labels: tuple[str, ...] = LABELS, tolerance: float = TOLERANCE, rounds: int = ROUNDS):
        self.labels, k = labels, len(labels)
        parts = int(votes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by_item = Window.partitionBy("item")
        held = written(votes, "votes").repartition(parts, "item").sortWithinPartitions("item")
        held = held.select("item", "agent", "lab", "ruled", F.count(F.lit(1)).over(by_item).alias("n"), *(((F.avg((F.col("lab") == t).cast("double")).over(by_item) + 0.1 / k) / 1.1).alias(f"q{t}") for t in range(k))).persist()
        try:
            cells = written(self._cells(held), "cells")
            self.votes = held.drop(*(f"q{t}" for t in range(k)))
            for self.rounds in range(1, rounds + 1):
                before, cells = cells, written(self._cells(self._soft(self._annotators(cells))), "cells")
                if self._moved(before, cells) < tolerance:
                    break
            else:
                raise RuntimeError(f"the truths have not settled after {rounds} rounds")
            self.soft = written(self._soft(self._annotators(cells)), "soft")
        finally:
            held.unpersist()

    def _soft(self, annotators: DataFrame) -> DataFrame:
        """Votes with the probabilities ``q0``, ``q1``, ... of their item's labels."""
        k, w = len(self.labels), Window.partitionBy("item")
        joined = self.votes.join(annotators, "agent")
        near = [reduce(lambda rest, l, t=t: F.when(F.col("lab") == l, F.col(f"t{t}_{l}")).otherwise(rest), range(k), F.lit(0.0)) for t in range(k)]  # noqa: E741
        summed = joined.select("item", "agent", "lab", "ruled", "n", *((F.sum(d).over(w) + F.col(f"p{t}")).alias(f"s{t}") for t, d in enumerate(near)))
        top = F.greatest(*(F.col(f"s{t}") for t in range(k)))
        e = summed.select("item", "agent", "lab", "ruled", "n", *(F.exp(F.col(f"s{t}") - top).alias(f"e{t}") for t in range(k)))
        return e.select("item", "agent", "lab", "ruled", "n", *((F.col(f"e{t}") / reduce(add, [F.col(f"e{u}") for u in range(k)])).alias(f"q{t}") for t in range(k)))

    def _cells(self, soft: DataFrame) -> DataFrame:
        """One row per agent: how many votes of each label it gave to items of each truth (``c{truth}_{label}``), and the items' truths (``m{truth}``)."""
        k = len(self.labels)
        q = [F.when(F.col("ruled").isNotNull(), (F.col("ruled") == t).cast("double")).otherwise(F.col(f"q{t}")) for t in range(k)]
        cells = [F.sum(F.when(F.col("lab") == l, q[t]).otherwise(0.0)).alias(f"c{t}_{l}") for t in range(k) for l in range(k)]  # noqa: E741
        return soft.groupBy("agent").agg(*cells, *(F.sum(q[t] / F.col("n")).alias(f"m{t}") for t in range(k)))

    def _moved(self, before: DataFrame, after: DataFrame) -> float:
        """By how much of a vote the cells of two rounds differ, on average over all votes."""
        cells = [c for c in after.columns if c[0] == "c"]
        old = before.select("agent", *(F.col(c).alias(f"o{c}") for c in cells))
        apart, all_ = after.join(old, "agent").agg(F.sum(reduce(add, [F.abs(F.col(c) - F.col(f"o{c}")) for c in cells])), F.sum(reduce(add, [F.col(c) for c in cells]))).first()
        return apart / all_ if all_ else 0.0

    def _annotators(self, cells: DataFrame) -> DataFrame:
        """One row per agent: minus the weighted distances as ``t{truth}_{label}``, and the log prior ``p{truth}``."""
        k = len(self.labels)
        pool = cells.agg(*(F.sum(c).alias(f"all_{c}") for c in cells.columns if c != "agent"))
        both = cells.crossJoin(F.broadcast(pool))  # one row of totals
        weight = confidence(reduce(add, [F.col(f"c{t}_{l}") for t in range(k) for l in range(k)]))  # noqa: E741
        out = [F.col("agent")]
        mass = reduce(add, [F.col(f"all_m{t}") for t in range(k)])
        for t in range(k):
            total, pooled = reduce(add, [F.col(f"c{t}_{l}") for l in range(k)]), reduce(add, [F.col(f"all_c{t}_{l}") for l in range(k)])  # noqa: E741
            for l in range(k):  # noqa: E741
                share = (F.col(f"all_c{t}_{l}") + 0.01) / (pooled + 0.01 * k)
                out.append((weight * F.log((F.col(f"c{t}_{l}") + PRIOR * share) / (total + PRIOR))).alias(f"t{t}_{l}"))
            out.append(F.log((F.col(f"all_m{t}") + 0.01) / (mass + 0.01 * k)).alias(f"p{t}"))
        return both.select(*out)

    def items(self) -> DataFrame:
        """One row per item: ``label``, ``probability``, ``agents``, ``labels`` (different ones), ``agreement``
        (share of agreeing pairs of annotators, null below two), ``ruled``."""
        k = len(self.labels)
        per = self.soft.groupBy("item").agg(
            F.max("ruled").alias("r"), F.count(F.lit(1)).alias("agents"), *(F.first(f"q{t}").alias(f"q{t}") for t in range(k)),
            *(F.count_if(F.col("lab") == t).alias(f"n{t}") for t in range(k)))
        top = F.greatest(*(F.col(f"q{t}") for t in range(k)))
        best = reduce(lambda rest, t: F.when(F.col(f"q{t}") == top, t).otherwise(rest), reversed(range(k)), F.lit(0))
        names = F.array(*map(F.lit, self.labels))
        pairs = F.col("agents") * (F.col("agents") - 1)
        return per.select(
            "item", F.element_at(names, F.coalesce("r", best) + 1).alias("label"), F.when(F.col("r").isNotNull(), 1.0).otherwise(top).alias("probability"), "agents",
            reduce(add, [(F.col(f"n{t}") > 0).cast("int") for t in range(k)]).alias("labels"),
            F.try_divide(reduce(add, [F.col(f"n{t}") * (F.col(f"n{t}") - 1) for t in range(k)]), pairs).alias("agreement"), F.col("r").isNotNull().alias("ruled"))

    def agents(self) -> DataFrame:
        """One row per annotator: ``votes``, ``accuracy`` (expected share of right votes), ``error_bound`` (chi-squared
        upper bound of the error variance), ``weight`` (its inverse) and ``confidence`` (what its distances are multiplied by)."""
        k = len(self.labels)
        right = reduce(add, [F.when(F.col("lab") == t, F.when(F.col("ruled").isNotNull(), (F.col("ruled") == t).cast("double")).otherwise(F.col(f"q{t}"))).otherwise(0.0) for t in range(k)])
        per = self.soft.groupBy("agent").agg(F.count(F.lit(1)).alias("votes"), F.sum(right).alias("right"))
        wrong = F.greatest(F.col("votes") - F.col("right"), F.lit(1e-3))
        bound = wrong / chi_squared_quantile((1 - CONFIDENCE) / 2, F.col("votes"))
        return per.select("agent", "votes", (F.col("right") / F.col("votes")).alias("accuracy"), bound.alias("error_bound"), (1 / bound).alias("weight"), confidence(F.col("votes")).alias("confidence"))
