"""Text expressions, all JVM-side: cleaning, flags, keys, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whitespace as Python splits on it, spelled out so that it means the same in every regular-expression engine.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DIACRITICS = r"[\x{64b}-\x{65f}\x{670}]"
ASTRAL = r"[\x{10000}-\x{10ffff}]"
ARABIC = r"[\x{600}-\x{6ff}]"
# Blocks counted as emoji in profiling.
EMOJI_BLOCKS = r"[\x{1f600}-\x{1f64f}\x{1f300}-\x{1f5ff}\x{1f680}-\x{1f6ff}\x{1f1e0}-\x{1f1ff}\x{2702}-\x{27b0}\x{1f900}-\x{1f9ff}\x{1fa00}-\x{1faff}\x{2600}-\x{26ff}]"
PUNCTUATION = r"[!?.,:;()\[\]{}]"
# The label domain in its order of ids.
LABELS = ("positive", "negative", "neutral")


def strip(t: Column) -> Column:
    """Without leading and trailing Unicode whitespace."""
    return F.regexp_replace(F.regexp_replace(t, f"^{WS}+", ""), f"{WS}+$", "")


def near_empty(t: Column, least: int = 10) -> Column:
    """Whether the stripped text has fewer than ``least`` characters; null for null."""
    return F.length(strip(t)) < least


def remove_diacritics(t: Column) -> Column:
    return F.regexp_replace(t, DIACRITICS, "")


def collapse_elongation(t: Column, keep: int = 2) -> Column:
    """Runs of more than ``keep`` equal characters cut to ``keep`` (line feeds are left alone)."""
    return F.regexp_replace(t, rf"(?d)(.)\1{{{keep},}}", "$1" * keep)


def normalize(t: Column, keep: int = 2) -> Column:
    """Diacritics removed, runs cut, lower case, in that order."""
    return F.lower(collapse_elongation(remove_diacritics(t), keep))


def text_key(t: Column) -> Column:
    """Whitespace runs as one space, stripped."""
    return F.trim(F.regexp_replace(t, f"{WS}+", " "))


def words(t: Column) -> Column:
    """The words of a text; an empty array for a blank one."""
    return F.filter(F.split(text_key(t), " "), lambda w: w != "")


def has_latin(t: Column) -> Column:
    return t.rlike("[a-zA-Z]")


def has_emoji(t: Column) -> Column:
    return t.rlike(ASTRAL)


def has_diacritics(t: Column) -> Column:
    return t.rlike(DIACRITICS)


def has_elongation(t: Column) -> Column:
    return t.rlike(r"(?d)(.)\1{2,}")


def light_key(t: Column) -> Column:
    """Whitespace collapsed, then only Arabic letters and spaces kept: the key of light duplicates."""
    return F.trim(F.regexp_replace(text_key(t), r"[^\x{600}-\x{6ff} ]", ""))


def coerce_label(label: Column, domain: tuple[str, ...] = LABELS) -> Column:
    """The stripped label if it is of the domain, else the empty string."""
    s = strip(F.coalesce(label, F.lit("")))
    return F.when(s.isin(*domain), s).otherwise("")


def numeric_or_null(t: Column) -> Column:
    """A plain decimal number, else null."""
    s = F.trim(t)
    return F.when(s.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"), s.try_cast("double"))


def content_id(*parts: Column) -> Column:
    """First 16 hexadecimal digits of SHA-256 over the parts, separated by U+001F."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 16)


def ordering_hash(seed: int | str, key: Column) -> Column:
    """A reproducible random order: SHA-256 of the seed and the key."""
    return F.sha2(F.concat(F.lit(f"{seed}|"), key.cast("string")), 256)


def validation_error(text: Column, agent: Column, model: Column, corrected: Column) -> Column:
    """The first rule a feedback record breaks, or null."""
    return (
        F.when(text.isNull() | (strip(text) == ""), "blank_text")
        .when(~F.coalesce(agent, F.lit("")).rlike(r"^[A-Za-z0-9._-]{1,64}$"), "agent_id")
        .when(~F.coalesce(model, F.lit("")).isin(*LABELS), "model_label")
        .when(~F.coalesce(corrected, F.lit("")).isin(*LABELS), "corrected_label")
    )
