"""Pieces of SQL the oracles are put together from."""

from __future__ import annotations

from ..functions.text import DIACRITICS, LABELS, WS

DOMAIN = ", ".join(f"'{x}'" for x in LABELS)


def strip(t: str) -> str:
    return f"regexp_replace(regexp_replace({t}, '^{WS}+', ''), '{WS}+$', '')"


def key(t: str) -> str:
    return f"trim(regexp_replace({t}, '{WS}+', ' ', 'g'))"


def plain(t: str) -> str:
    return f"regexp_replace({t}, '{DIACRITICS}', '', 'g')"


def shorten(t: str) -> str:
    """Runs cut to two, by looking two characters back."""
    c = f"substr({t}, i::BIGINT, 1)"
    return (
        f"CASE WHEN {t} IS NULL THEN NULL ELSE coalesce(array_to_string(list_transform(list_filter(range(1, length({t}) + 1), "
        f"lambda i: NOT (i > 2 AND {c} <> chr(10) AND {c} = substr({t}, i::BIGINT - 1, 1) AND {c} = substr({t}, i::BIGINT - 2, 1))), "
        f"lambda i: {c}), ''), '') END"
    )


def normal_cte(table: str, text: str, *cols: str) -> str:
    """``n``: the columns with ``plain`` (without diacritics) and ``norm`` (normalised)."""
    keep = ", ".join(cols)
    return (
        f"p AS (SELECT {keep}, {text} AS raw, {plain(text)} AS plain FROM {table}), "
        f"n AS (SELECT {keep}, raw, plain, lower({shorten('plain')}) AS norm FROM p)"
    )


def label(x: str) -> str:
    s = strip(f"coalesce({x}, '')")
    return f"CASE WHEN {s} IN ({DOMAIN}) THEN {s} ELSE '' END"
