"""SQL of the same results, for those queries SQL can express: brute force over all words, windows or forms."""

from __future__ import annotations

import unicodedata

from .lookalike import ARABIC_DIGITS, FOREIGN_LETTERS, INVISIBLE_RANGES, LATIN_LETTERS, PERSIAN_DIGITS, PERSIAN_ONLY

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
MARKS = r"\x{64b}-\x{65f}\x{670}"
LETTERS = r"\x{620}-\x{63f}\x{641}-\x{64a}\x{66e}-\x{6d3}\x{6d5}"


def _forms() -> tuple[str, str, list[tuple[str, str]]]:
    """Characters with a one-letter plain form, those forms, and ligatures: Arabic shapes, Latin ligatures, widths, spaces."""
    a, b, more = "\t", " ", []
    for cp in (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000, *range(0xFB00, 0xFB07), *range(0xFE70, 0xFEFD), *range(0xFF01, 0xFF5F)):
        plain = " " if unicodedata.category(chr(cp)) == "Zs" else unicodedata.normalize("NFKC", chr(cp))
        if len(plain) == 1 and plain != chr(cp):
            a, b = a + chr(cp), b + plain
        elif len(plain) > 1 and not plain.startswith(" "):
            more.append((chr(cp), plain))
    return a, b, more


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unify_stages(source: str, text: str, *cols: str) -> str:
    """CTEs that end in ``uni(cols, raw, t)``: the consistent form of a text."""
    a, b, more = _forms()
    keep = ", ".join(cols)
    invisible = "[" + "".join(rf"\x{{{x:x}}}-\x{{{y:x}}}" for x, y in INVISIBLE_RANGES) + "]"
    expr = f"translate({text}, {_q(a)}, {_q(b)})"
    for x, y in more:
        expr = f"replace({expr}, {_q(x)}, {_q(y)})"
    expr = f"nfc_normalize(regexp_replace({expr}, '{invisible}', '', 'g'))"
    expr = f"nfc_normalize(translate({expr}, {_q(FOREIGN_LETTERS)}, {_q(LATIN_LETTERS)}))"
    for x, y in (("ک", "ك"), ("ی", "ي")) * 2:
        expr = rf"regexp_replace({expr}, '{x}([{MARKS}]*[{LETTERS}])', '{y}\1', 'g')"
    expr = f"translate(replace({expr}, 'ی', 'ى'), '{PERSIAN_DIGITS}', '{ARABIC_DIGITS}')"
    return f"uni AS (SELECT {keep}, {text} AS raw, {expr} AS t FROM {source})"


def persian_spelling(t: str) -> str:
    """Words with a letter of the Persian orthography alone, in that orthography throughout."""
    token = r"\x{620}-\x{65f}\x{66e}-\x{6d5}\x{6ee}\x{6ef}"
    word = "w"
    for x, y in (("ك", "ک"), ("ي", "ی")) * 2:
        word = rf"regexp_replace({word}, '{x}([{MARKS}]*[{LETTERS}])', '{y}\1', 'g')"
    word = rf"regexp_replace({word}, 'ى([{MARKS}]*([^{MARKS}{LETTERS}]|$))', 'ی\1', 'g')"
    return f"array_to_string(list_transform(regexp_extract_all({t}, '[{token}]+|[^{token}]+'), lambda w: CASE WHEN regexp_matches(w, '[{PERSIAN_ONLY}]') THEN {word} ELSE w END), '')"


def word_stages(source: str, text: str, p: str, *cols: str) -> str:
    """CTEs that end in ``{p}w(id, word, k)`` and ``{p}n(cols, n)``: word counts of texts of at least 12 words; the first column is the id."""
    keep = ", ".join(cols)
    c = "substr(t, i::BIGINT, 1)"
    cut = (f"coalesce(array_to_string(list_transform(list_filter(range(1, length(t) + 1), lambda i: NOT (i > 2 AND {c} = substr(t, i::BIGINT - 1, 1) AND {c} = substr(t, i::BIGINT - 2, 1))), lambda i: {c}), ''), '')")
    return (
        unify_stages(source, text, *cols).replace("uni AS", f"{p}u AS", 1)
        + f", {p}m AS (SELECT {keep}, regexp_replace(t, '[{MARKS}]', '', 'g') AS t FROM {p}u WHERE t IS NOT NULL), {p}c AS (SELECT {keep}, lower({cut}) AS t FROM {p}m)"
        + f", {p}x AS (SELECT {cols[0]} AS id, unnest(string_split(regexp_replace(t, '{WS}+', ' ', 'g'), ' ')) AS word FROM {p}c)"
        + f", {p}w0 AS (SELECT id, word, count(*) AS k FROM {p}x WHERE word <> '' GROUP BY ALL)"
        + f", {p}s AS (SELECT id, sum(k) AS n FROM {p}w0 GROUP BY id HAVING sum(k) >= 12), {p}w AS (SELECT {p}w0.* FROM {p}w0 JOIN {p}s USING (id))"
        + f", {p}n AS (SELECT {keep}, n FROM {p}c JOIN {p}s ON {cols[0]} = id)"
    )


def _common(a: str, b: str, on: str = "") -> str:
    return f"SELECT x.id AS a, y.id AS b, sum(least(x.k, y.k)) AS c FROM {a}w x JOIN {b}w y ON x.word = y.word {on} GROUP BY ALL"


# every window of 160 characters that two documents hold; long texts are first cut into overlapping pieces, so that a window is cheap to take
WINDOWS = (
    "c AS (SELECT doc_id, p * 800 AS base, substr(text, (p * 800 + 1)::BIGINT, 959) AS t FROM documents, unnest(range(0, ((length(text) - 160) // 800 + 1)::BIGINT)) AS u(p) WHERE length(text) >= 160), "
    "w AS (SELECT doc_id, base + i - 1 AS pos, substr(t, i::BIGINT, 160) AS s FROM c, unnest(range(1, length(t) - 158)) AS u(i)), h AS (SELECT s FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)), "
    "k AS (SELECT * FROM w SEMI JOIN h USING (s))"
)
ISLANDS = (
    "starts AS (SELECT DISTINCT doc_id, pos FROM k), isl AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM starts), "
    "spans AS (SELECT doc_id, min(pos)::BIGINT AS start, (count(*) + 159)::BIGINT AS chars FROM isl GROUP BY doc_id, g)"
)


def oracle_sql() -> dict[str, str]:
    near = "2 * c >= 0.75 * (p.n + q.n)"
    words4 = word_stages("final_data", "review_description", "f", "review_id")
    seven = (
        f"{word_stages('feedback', 'text', 'b', 'feedback_row', 'batch_day')}, {word_stages('train_feedback', 'text', 'h', 'override_id', 'captured_at')}, j AS ({_common('b', 'h')}), "
        f"o AS (SELECT a, b, 2 * c / (p.n + q.n) AS s FROM j JOIN bn p ON a = p.feedback_row JOIN hn q ON b = q.override_id WHERE {near} AND substr(captured_at, 1, 10)::DATE < batch_day::DATE)"
    )
    split = word_stages("splits", "text", "s", "row_id", "split", "source") + ", tw AS (SELECT sw.* FROM sw JOIN sn ON id = row_id WHERE split = 'train'), ew AS (SELECT sw.* FROM sw JOIN sn ON id = row_id WHERE split <> 'train')"
    overlaps = f"WITH {split}, j AS ({_common('t', 'e')}), o AS (SELECT a, b, p.source AS train_source, q.split AS eval_split, c, p.n + q.n AS nn FROM j JOIN sn p ON a = p.row_id JOIN sn q ON b = q.row_id WHERE {near})"
    labels = "('positive', 'negative', 'neutral')"
    votes = (
        "WITH raw AS (SELECT review_id AS item, trim(agent_id) AS agent, lower(trim(corrected_label)) AS label FROM feedback UNION ALL SELECT review_id, trim(second_agent_id), lower(trim(second_label)) FROM overrides), "
        f"v AS (SELECT item, agent, min(label) AS l FROM raw WHERE item IS NOT NULL AND agent <> '' AND label IN {labels} GROUP BY item, agent HAVING min(label) = max(label)), "
        f"r AS (SELECT review_id AS item FROM overrides WHERE adjudicated_label <> '' GROUP BY review_id HAVING min(lower(trim(adjudicated_label))) = max(lower(trim(adjudicated_label))) AND min(lower(trim(adjudicated_label))) IN {labels}), "
        "c AS (SELECT item, l, count(*) AS n FROM v GROUP BY item, l)"
    )
    return {
        "p1_agreement": votes + " SELECT item AS review_id, sum(n)::BIGINT AS agents, count(*) AS labels, round(sum(n * (n - 1)) / nullif(sum(n) * (sum(n) - 1), 0), 6) AS agreement, item IN (SELECT item FROM r) AS ruled FROM c GROUP BY item",
        "p8_invariants": "SELECT container_kind, 0::BIGINT AS lost, 0::BIGINT AS twice, 0::BIGINT AS split, 0::BIGINT AS renumbered, 0::BIGINT AS over, 0::BIGINT AS gaps FROM containers",
        "p9_invariants": "SELECT source, 0::BIGINT AS over_repeats, true AS as_wanted FROM mix_targets",
        "p2_found": f"WITH {unify_stages('final_data', 'review_description', 'review_id')} SELECT a.review_id AS review_id_a, b.review_id AS review_id_b FROM uni a JOIN uni b ON a.t = b.t AND a.raw <> b.raw AND a.review_id < b.review_id",
        "p2_unified": f"WITH {unify_stages('final_data', 'review_description', 'review_id')} SELECT review_id, CASE WHEN t = '' THEN t ELSE {persian_spelling('t')} END AS unified FROM uni",
        "p2_groups": f"WITH {unify_stages('final_data', 'review_description', 'review_id')}, v AS (SELECT t, raw, min(review_id) AS variant FROM uni WHERE raw IS NOT NULL GROUP BY t, raw), g AS (SELECT t, count(*) AS variants, min(variant) AS \"group\" FROM v GROUP BY t HAVING count(*) > 1) "
                     "SELECT review_id, \"group\", variant, variants FROM uni JOIN v USING (t, raw) JOIN g USING (t)",
        "p4_groups": f"WITH RECURSIVE {words4}, j AS ({_common('f', 'f', 'AND x.id < y.id')}), e AS (SELECT a, b, 2 * c = p.n + q.n AS same FROM j JOIN fn p ON a = p.review_id JOIN fn q ON b = q.review_id WHERE {near}), "
                     "two AS (SELECT a, b, same FROM e UNION ALL SELECT b, a, same FROM e), reach(x, y) AS (SELECT a, b FROM two UNION SELECT x, b FROM reach JOIN two ON y = a), r AS (SELECT x, min(y) AS g FROM reach GROUP BY x), "
                     "k AS (SELECT a, min(b) FILTER (WHERE same) AS c, count(*) FILTER (WHERE same) AS s, count(*) AS n FROM two GROUP BY a) "
                     "SELECT review_id, least(review_id, c) AS cls, coalesce(s, 0) + 1 AS members, coalesce(n, 0) AS links, least(review_id, g) AS \"group\" FROM final_data LEFT JOIN k ON review_id = k.a LEFT JOIN r ON review_id = r.x WHERE review_id IS NOT NULL",
        "p4_found": f"WITH {word_stages('final_data', 'review_description', 'f', 'review_id')}, j AS ({_common('f', 'f', 'AND x.id < y.id')}) SELECT a AS review_id_a, b AS review_id_b FROM j JOIN fn p ON a = p.review_id JOIN fn q ON b = q.review_id WHERE {near}",
        "p6_found": overlaps + " SELECT least(a, b) AS row_id_a, greatest(a, b) AS row_id_b FROM o",
        "p6_counts": overlaps + " SELECT eval_split, train_source, count(DISTINCT b) AS eval_rows, count(DISTINCT a) AS train_rows, count(*) AS row_pairs, count(*) FILTER (WHERE 2 * c = nn) AS same_words FROM o GROUP BY eval_split, train_source",
        "p7_found": f"WITH {seven} SELECT a AS feedback_row, b AS override_id FROM o",
        "p7_repeats": f"WITH {seven} SELECT a AS feedback_row, count(*) AS repeats, min(b) AS override_id, round(max(s), 6) AS similarity FROM o GROUP BY a",
        "p10_found": f"WITH {WINDOWS} SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM (SELECT DISTINCT s, doc_id FROM k) a JOIN (SELECT DISTINCT s, doc_id FROM k) b ON a.s = b.s AND a.doc_id < b.doc_id",
        "p10_spans": f"WITH {WINDOWS}, {ISLANDS} SELECT doc_id, start, chars FROM spans",
        "p10_coverage": f"WITH {WINDOWS}, {ISLANDS}, p AS (SELECT doc_id, sum(least(160, coalesce(nxt - pos, 160)))::BIGINT AS shared FROM (SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM starts) GROUP BY doc_id), "
                        "q AS (SELECT doc_id, count(*) AS spans, max(chars) AS longest FROM spans GROUP BY doc_id) SELECT doc_id, coalesce(spans, 0) AS spans, coalesce(longest, 0) AS longest, coalesce(shared, 0) AS shared_chars, "
                        "CASE WHEN length(text) > 0 THEN round(coalesce(shared, 0) / length(text), 6) ELSE 0.0 END AS shared_part FROM documents LEFT JOIN p USING (doc_id) LEFT JOIN q USING (doc_id)",
    }
