"""Lexicon-based language-variety tagging, in column expressions only."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_key

# Markers and weights of each variety.
MARKERS = {
    "egyptian": {
        "مش": 2, "موش": 3, "مش عارف": 3, "دلوقتي": 3, "دلوقتى": 3, "بقالي": 3, "باقي": 1, "خالص": 2, "قوي": 2, "اوي": 2, "كده": 2, "كدا": 2,
        "النهارده": 3, "امبارح": 3, "فين": 3, "ايه": 2, "ليه": 2, "ازاي": 3, "ازاى": 3, "عايز": 3, "عايزين": 3, "عاوزه": 3, "عايزة": 2, "محصلش": 3,
        "معايا": 2, "ييجي": 2, "يجي": 1, "هييجي": 3, "مفيش": 3, "بتبقي": 3, "بيقول": 2, "بيقولوا": 3, "بتاع": 2, "بتاعة": 3, "اللي": 1, "دي": 1,
    },
    "gulf": {
        "مو": 2, "مافي": 2, "موب": 3, "ليش": 3, "وش": 2, "شنو": 3, "ايش": 3, "كيفكم": 3, "هذي": 2, "هالحين": 3, "ذاك": 1, "ذي": 1, "يبغى": 3, "يبغي": 3,
        "نبغى": 3, "ودي": 2, "ودها": 2, "احس": 2, "مره": 2, "صارلي": 1, "بالعكس": 2, "قهر": 2, "يبون": 2, "يبي": 2, "ابي": 2, "ابغى": 3, "ابغي": 3,
        "وايد": 3, "احلى": 1, "عقب": 2, "بعدين": 1,
    },
    "levantine": {
        "مش": 1, "مافي": 2, "شو": 3, "كيف": 2, "مين": 2, "وين": 3, "ليش": 2, "شلون": 3, "هيك": 3, "هكذا": 1, "هون": 2, "بدي": 3, "بدنا": 3, "بدك": 3,
        "خليني": 3, "خلينا": 2, "عم": 1, "بروح": 2, "بشوف": 2, "عندي": 1, "هلق": 3, "هلقيت": 3, "بكرة": 1, "زبط": 2, "كتير": 2, "مشان": 3, "عشان": 1,
    },
    "maghrebi": {
        "واش": 3, "علاش": 3, "كيفاش": 3, "دابا": 3, "دaba": 1, "مزيان": 3, "شحال": 3, "الو": 2, "بزاف": 3, "صارو": 1, "هاد": 2, "هاذ": 2, "شكون": 3, "اش": 2,
    },
}
# Who wins a tie, first to last.
PRIORITY = ("levantine", "gulf", "egyptian", "maghrebi")
LATIN_LEAST, LATIN_FULL = 3, 20


def latin_letters(t: Column) -> Column:
    return F.regexp_count(t, F.lit("[A-Za-z]"))


def score(t: Column, variety: str) -> Column:
    """Sum of the weights of the markers that the text contains, anywhere."""
    return reduce(add, [F.when(t.contains(m), w).otherwise(0) for m, w in MARKERS[variety].items()])


def tagged(df: DataFrame, text: str, out: str = "dialect", confidence: str = "dialect_confidence") -> DataFrame:
    """``df`` with the variety and its confidence; null text is msa with 0."""
    key = text_key(F.coalesce(F.col(text), F.lit("")))
    scored = df.withColumn("__k", key).withColumns({"__latin": latin_letters(F.col("__k")), **{f"__{v}": score(F.col("__k"), v) for v in PRIORITY}})
    total = reduce(add, [F.col(f"__{v}") for v in PRIORITY])
    top = F.greatest(*(F.col(f"__{v}") for v in PRIORITY))
    best = reduce(lambda rest, v: F.when(F.col(f"__{v}") == top, v).otherwise(rest), reversed(PRIORITY), F.lit("msa"))
    latin = F.col("__latin") >= LATIN_LEAST
    return scored.withColumns({
        out: F.when(latin, "arabizi").when(total == 0, "msa").otherwise(best),
        confidence: F.when(latin, F.least(F.lit(1.0), F.col("__latin") / float(LATIN_FULL))).when(total == 0, 0.0).otherwise(top / total),
    }).drop("__k", "__latin", *(f"__{v}" for v in PRIORITY))


def lexicon_sql() -> dict[str, str]:
    """SQL sums of the marker weights over a column ``k``."""
    return {v: " + ".join(f"CASE WHEN contains(k, '{m}') THEN {w} ELSE 0 END" for m, w in MARKERS[v].items()) for v in PRIORITY}
