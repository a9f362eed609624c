"""Distribution drift: population stability, total variation, verdicts, rolling confidence, triage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ZERO_SHARE = 1e-4
WARN, FAIL = 0.1, 0.2
#: Numeric columns with at most so many distinct reference values are compared value by value.
FEW_VALUES = 20
MIN_STD = 1e-8


def band(score: Column, warn: float = WARN, fail: float = FAIL) -> Column:
    return F.when(score < warn, "PASS").when(score < fail, "WARN").otherwise("FAIL")


def _psi(shares: DataFrame, keys: list[str], zero: float) -> DataFrame:
    r, c = F.greatest("r", F.lit(zero)), F.greatest("c", F.lit(zero))
    return shares.groupBy(*keys).agg(F.sum(F.when((F.col("r") == 0) & (F.col("c") == 0), 0.0).otherwise((r - c) * F.log(r / c))).alias("psi"))


def long_form(df: DataFrame, is_reference: Column, categorical: list[str], numeric: list[str]) -> DataFrame:
    """``column``, ``ref``, ``cat`` (string), ``num`` (double): one row per row and column, from one scan."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("cat"), F.lit(None).cast("double").alias("num")) for c in categorical]
    cells += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("string").alias("cat"), F.col(c).cast("double").alias("num")) for c in numeric]
    return df.select(is_reference.alias("ref"), F.explode(F.array(*cells)).alias("x")).select("ref", "x.*")


def psi(df: DataFrame, is_reference: Column, categorical: list[str], numeric: list[str], zero: float = ZERO_SHARE, few: int = FEW_VALUES) -> DataFrame:
    """``column``, ``score``, ``decision`` (PASS, WARN, FAIL, SKIPPED), ``reason``.

    Categories: every value is a bin, null too.  Numbers: equal-width bins over the range of both
    sides, ceil(log2 n) + 1 of them, n being the rows of both; with few distinct reference values
    each is a bin.  A numeric column that is all null or hardly varies is SKIPPED; a category never is.

    All columns are compared in one job: one scan to explode, one aggregate for ranges, one for bins."""
    cells = long_form(df, is_reference, categorical, numeric)
    stats = cells.groupBy("column").agg(
        F.min("num").alias("lo"), F.max("num").alias("hi"), F.count("num").alias("n"), F.stddev_samp("num").alias("sd"),
        F.countDistinct(F.when(F.col("ref"), F.col("num"))).alias("dist"), F.count_if(F.col("ref")).alias("nr"), F.count_if(~F.col("ref")).alias("nc"))
    number = F.col("column").isin(*numeric) if numeric else F.lit(False)
    k = F.ceil(F.log2(F.greatest("n", F.lit(1)).cast("double"))) + 1
    width = (F.col("hi") - F.col("lo")) / k
    place = F.when(width > 0, F.least(F.floor((F.col("num") - F.col("lo")) / width), k - 1)).otherwise(0)
    by_value = F.when(number & (F.col("dist") > few), place.cast("string")).when(number, F.col("num").cast("string")).otherwise(F.coalesce("cat", F.lit("\x00")))
    binned = cells.join(F.broadcast(stats), "column").where(~number | F.col("num").isNotNull())  # a row per column of the table
    counts = binned.groupBy("column", by_value.alias("bin")).agg(F.count_if(F.col("ref")).alias("r"), F.count_if(~F.col("ref")).alias("c"))
    w = Window.partitionBy("column")  # over bins, not rows
    shares = counts.select("column", (F.col("r") / F.greatest(F.sum("r").over(w), F.lit(1))).alias("r"), (F.col("c") / F.greatest(F.sum("c").over(w), F.lit(1))).alias("c"))
    scores = _psi(shares, ["column"], zero)
    reason = (
        F.when((F.col("nr") == 0) | (F.col("nc") == 0), "one side is empty")
        .when(number & (F.col("n") == 0), "no value").when(number & (F.col("sd").isNull() | (F.col("sd") < MIN_STD)), "hardly varies")
    )
    out = stats.join(scores, "column", "left").withColumn("reason", reason)
    score = F.when(F.col("reason").isNull(), F.round("psi", 4))
    return out.select("column", score.alias("score"), F.when(F.col("reason").isNotNull(), "SKIPPED").otherwise(band(score)).alias("decision"), F.coalesce("reason", F.lit("")).alias("reason"))


def verdict(scores: DataFrame) -> DataFrame:
    """One row: the worst decision (SKIPPED counts for nothing; nothing checked is SKIPPED), how many
    columns were checked, and the share of them at or above the first band."""
    severity = F.expr("CASE decision WHEN 'PASS' THEN 1 WHEN 'WARN' THEN 2 WHEN 'FAIL' THEN 3 WHEN 'ERROR' THEN 4 ELSE 0 END")
    top = F.max(severity)
    overall = F.when(F.coalesce(top, F.lit(0)) == 0, "SKIPPED").otherwise(F.element_at(F.array(*map(F.lit, ("PASS", "WARN", "FAIL", "ERROR"))), F.greatest(top, F.lit(1))))
    return scores.agg(overall.alias("overall"), F.count("score").alias("checked"), F.round(F.coalesce(F.try_divide(F.count_if(F.col("score") >= WARN), F.count("score")), F.lit(0.0)), 4).alias("drift_share"))


def total_variation(df: DataFrame, is_reference: Column, column: str) -> DataFrame:
    """One row: half the sum of the absolute differences of the shares of all values, ``tvd``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("__value")).agg(F.count_if(is_reference).alias("r"), F.count_if(~is_reference).alias("c"))
    total = counts.agg(F.sum("r").alias("tr"), F.sum("c").alias("tc"))
    return counts.crossJoin(F.broadcast(total)).agg(F.round(F.sum(F.abs(F.coalesce(F.try_divide("r", "tr"), F.lit(0.0)) - F.coalesce(F.try_divide("c", "tc"), F.lit(0.0)))) / 2, 6).alias("tvd"))


def rolling_confidence(daily: DataFrame, days: int = 14, least: int = 7) -> DataFrame:
    """``day``, ``mean`` with the mean, deviation and number of the days strictly before (at most ``days``),
    and the z-score where there are at least ``least`` of them and they vary.  ``daily`` has one row a day."""
    w = Window.orderBy("day").rowsBetween(-days, -1)  # one row a day: small whatever the data
    out = daily.select("day", "mean", F.count("mean").over(w).alias("n_before"), F.avg("mean").over(w).alias("m"), F.stddev_samp("mean").over(w).alias("s"))
    z = F.when((F.col("n_before") >= least) & (F.col("s") > 0), F.round((F.col("mean") - F.col("m")) / F.col("s"), 3))
    return out.select("day", F.round("mean", 6).alias("mean"), "n_before", F.round("m", 6).alias("mean_before"), F.round("s", 6).alias("std_before"), z.alias("z_score"))


def triage(df: DataFrame, input_decision: str, output_decision: str) -> DataFrame:
    """``df`` with ``triage``: where a change comes from."""
    ok_in, ok_out = F.col(input_decision) == "PASS", F.col(output_decision) == "PASS"
    return df.withColumn("triage", F.when(F.col(input_decision).isNull(), "indeterminate").when(ok_in & ok_out, "stable").when(ok_in, "model_degraded").when(ok_out, "world_changed").otherwise("ambiguous"))


def feature_means(df: DataFrame) -> DataFrame:
    """``feature``, ``mean`` of every numeric column of the schema."""
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")]
    one = df.agg(*(F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(numeric)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.round(F.col(f"m{i}"), 6).alias("mean")) for i, c in enumerate(numeric)))).alias("x")).select("x.*")


#: Compared where no engineered column can be made.
OUTPUT_ONLY = ("predicted_label", "positive")


def resolve_columns(reference: list[str], current: list[str], wanted: tuple[str, ...] | None, default: tuple[str, ...] = OUTPUT_ONLY) -> tuple[list[str], list[str]]:
    """The wanted columns that both sides have, in their order, and those that are skipped; an error where none is left."""
    wanted = tuple(dict.fromkeys(default if wanted is None else wanted))
    present = [c for c in wanted if c in reference and c in current]
    if not present:
        raise ValueError(f"none of {', '.join(wanted)} is in both tables")
    return present, [c for c in wanted if c not in present]


def input_report(reference: DataFrame, current: DataFrame, engineer: Callable[[DataFrame], DataFrame] | None = None, text: str = "text",
                 engineered: tuple[str, ...] = (), wanted: tuple[str, ...] | None = None) -> DataFrame:
    """``column``, ``score``, ``decision``, ``reason`` of every wanted column; one that a side lacks is SKIPPED as absent.

    With a text column the engineered columns are made and compared beside the outputs; without one the
    outputs alone are."""
    made = engineer is not None and text in reference.columns and text in current.columns
    if made:
        reference, current = engineer(reference), engineer(current)
    present, skipped = resolve_columns(reference.columns, current.columns, wanted, (*OUTPUT_ONLY, *engineered) if made else OUTPUT_ONLY)
    both = reference.select(F.lit(True).alias("__ref"), *present).unionByName(current.select(F.lit(False).alias("__ref"), *present))
    text_like = ("string", "boolean")
    categorical = [c for c in present if both.schema[c].dataType.typeName() in text_like]
    scores = psi(both, F.col("__ref"), categorical, [c for c in present if c not in categorical])
    absent = [(c, None, "SKIPPED", "absent") for c in skipped]
    return scores.unionByName(scores.sparkSession.createDataFrame(absent, "column string, score double, decision string, reason string")) if absent else scores


def class_psi(left: dict[str, Column], right: dict[str, Column], zero: float = ZERO_SHARE) -> Column:
    """Stability index of two class mixes given as shares a class."""
    f = [F.when((left[x] == 0) & (right[x] == 0), 0.0).otherwise((F.greatest(left[x], F.lit(zero)) - F.greatest(right[x], F.lit(zero))) * F.log(F.greatest(left[x], F.lit(zero)) / F.greatest(right[x], F.lit(zero)))) for x in left]
    return reduce(lambda a, b: a + b, f)


def prediction_report(current: DataFrame, reference: DataFrame, prior: DataFrame, history: DataFrame, inputs: DataFrame, day: str, labels: tuple[str, ...],
                      window: int = 14, least: int = 7) -> DataFrame:
    """One row: the output drift of a day.

    ``current`` and ``reference`` have ``predicted_label`` and ``predicted_score``, ``prior`` has ``label``; ``history`` has ``day`` and
    ``mean`` of other days, ``inputs`` ``day`` and ``decision``.  The mix against the prior decides; that against the reference panel
    is context.  The confidence has its delta, whether it falls, and the z-score against the days before.  ``escalate`` is a falling confidence with a
    prior index in WARN or FAIL.  A side without rows has null shares and SKIPPED."""
    def mix(df: DataFrame, column: str, tag: str, *more: Column) -> DataFrame:
        n = F.count_if(F.col(column).isin(*labels))
        return df.agg(F.count(F.lit(1)).alias(f"n_{tag}"), *(F.try_divide(F.count_if(F.col(column) == x), n).alias(f"{tag}_{x}") for x in labels), *more)

    one = mix(current, "predicted_label", "current", F.avg("predicted_score").alias("mean")).crossJoin(mix(reference, "predicted_label", "reference", F.avg("predicted_score").alias("reference_mean"))).crossJoin(mix(prior, "label", "prior"))
    before = history.where((F.col("day") < F.lit(day).cast("date")) & F.col("mean").isNotNull()).orderBy(F.desc("day")).limit(window)  # a row a day
    one = one.crossJoin(before.agg(F.count("mean").alias("n_before"), F.avg("mean").alias("m"), F.stddev_samp("mean").alias("s")))
    one = one.crossJoin(inputs.where(F.col("day") == F.lit(day).cast("date")).agg(F.max("decision").alias("input_decision")))
    side = lambda tag: {x: F.col(f"{tag}_{x}") for x in labels}
    scores = {tag: F.round(class_psi(side(tag), side("current")), 4) for tag in ("prior", "reference")}
    decision = lambda tag: F.when(scores[tag].isNull(), "SKIPPED").otherwise(band(scores[tag]))
    delta = F.round(F.col("mean") - F.col("reference_mean"), 6)
    out = one.select(
        F.lit(day).alias("day"), "n_current", "n_reference", scores["prior"].alias("psi_prior"), decision("prior").alias("decision"), scores["reference"].alias("psi_reference"), decision("reference").alias("decision_reference"),
        *(F.round((F.col(f"current_{x}") - F.col(f"prior_{x}")) * 100, 3).alias(f"delta_points_{x}") for x in labels),
        F.round("mean", 6).alias("mean"), F.round("reference_mean", 6).alias("reference_mean"), delta.alias("delta"), (delta < 0).alias("falling"), "n_before",
        F.when((F.col("n_before") >= least) & (F.col("s") > 0), F.round((F.col("mean") - F.col("m")) / F.col("s"), 3)).alias("z_score"), "input_decision")
    return triage(out, "input_decision", "decision").withColumn("escalate", F.coalesce(F.col("falling") & F.col("decision").isin("WARN", "FAIL"), F.lit(False)))


def daily_decisions(df: DataFrame, day: Column, column: str, zero: float = ZERO_SHARE) -> DataFrame:
    """``day``, ``score``, ``decision``: the mix of a column on every day against its mix on all days.

    What a day lacks is counted from the mix of all days, so no day is joined with every value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(day.alias("day"), F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).where("day IS NOT NULL")
    w = Window.partitionBy("day")  # over values, not rows
    shares = counts.withColumn("c", F.col("n") / F.sum("n").over(w))
    mix = counts.groupBy("value").agg(F.sum("n").alias("rn"))
    total = mix.agg(F.sum("rn").alias("all_n"))
    mix = mix.crossJoin(F.broadcast(total)).withColumn("r", F.col("rn") / F.col("all_n")).select("value", "r")  # total: one row
    f = lambda r, c: (F.greatest(r, F.lit(zero)) - F.greatest(c, F.lit(zero))) * F.log(F.greatest(r, F.lit(zero)) / F.greatest(c, F.lit(zero)))
    none = mix.agg(F.sum(f(F.col("r"), F.lit(0.0))).alias("none"))
    per = shares.join(mix, "value").groupBy("day").agg(F.sum(f(F.col("r"), F.col("c")) - f(F.col("r"), F.lit(0.0))).alias("x"))
    score = F.round(F.col("x") + F.col("none"), 4)
    return per.crossJoin(F.broadcast(none)).select("day", score.alias("score"), band(score).alias("decision"))  # none: one row


def triage_by_day(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Every day of the outputs with the input decision of that day, null where there is none, and the triage."""
    joined = outputs.select("day", F.col("decision").alias("output_decision")).join(inputs.select("day", F.col("decision").alias("input_decision")), "day", "left")
    return triage(joined, "input_decision", "output_decision").select("day", "input_decision", "output_decision", "triage")


def worst_of(reports: list[tuple[str, list[str], DataFrame]]) -> DataFrame:
    """``source``, ``column``, ``score`` of the failing column with the highest score over several reports; of equal
    scores the one of the earlier report, then of the earlier column, wins."""
    rows = []
    for i, (source, columns, scores) in enumerate(reports):
        at = F.array_position(F.array(*map(F.lit, columns)), F.col("column"))
        rows.append(scores.where("decision = 'FAIL' AND score IS NOT NULL").select(F.lit(source).alias("source"), "column", "score", F.struct(-F.col("score"), F.lit(i), at).alias("o")))
    return reduce(DataFrame.unionByName, rows).orderBy("o").limit(1).drop("o")


def worst(scores: DataFrame) -> DataFrame:
    """The failing column with the highest score (first by name on ties), no row if none fails."""
    return scores.where("decision = 'FAIL' AND score IS NOT NULL").orderBy(F.desc("score"), "column").limit(1)


