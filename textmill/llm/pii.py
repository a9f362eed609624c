"""Personal information inside free text: found, typed, and replaced by placeholders.

Method: regular expressions propose spans, validators confirm or reject them, and nearby context
words raise or lower the score; spans of at least ``THRESHOLD`` remain, the best one where
several overlap.  The validators: Luhn for cards and residence ids, mod 97 for account numbers, the birth
date inside a national number, digit counts and dialling forms of phone numbers.

A card or account number passes by its check digits alone and never without.  A residence id whose
Luhn digit is right passes on its own, any other only where a word announces it: in feedback of sf0.1 25 of
the 28 that a word announces in the different texts fail Luhn, so rejecting those would leave nearly all of them in.

Patterns run on a folded copy of the text (digits in ASCII, look-alike letters unified,
vowel marks and invisible characters left out) with the place of every character in the
original, so the rest of the text comes out unchanged, to the letter.

Defined results: null -> null text and no spans; '' and blank texts have none.  Every
regular expression is free of nested repeats, so the time is linear in the text's length.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import blocks
from .lookalike import FOREIGN_LETTERS, INVISIBLE_RANGES, LATIN_LETTERS

KINDS = ("name", "email", "phone", "id_number", "address")
THRESHOLD = 0.5
#: Characters before and after a span in which context words count.
BEFORE, AFTER = 28, 16


@lru_cache(1)
def _folds() -> tuple[dict[int, str], re.Pattern]:
    """One-to-one replacements, and what is left out or grows."""
    one: dict[int, str] = {}
    for cp in range(0x80, 0x10000):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        digit = unicodedata.digit(ch, None) if unicodedata.category(ch) == "Nd" else None
        if digit is not None:
            one[cp] = str(digit)
        elif unicodedata.category(ch) == "Zs":
            one[cp] = " "
        elif len(k := unicodedata.normalize("NFKC", ch)) == 1 and k != ch:
            one[cp] = k
    for a, b in zip(FOREIGN_LETTERS, LATIN_LETTERS):
        one[ord(a)] = b
    for a, b in zip("یکأإآٱ", "يكاااا"):
        one[ord(a)] = b
    for cp, ch in list(one.items()):
        one[cp] = "ا" if ch in "أإآٱ" else ch
    gone = "".join(f"{chr(a)}-{chr(b)}" for a, b in INVISIBLE_RANGES if b < 0x10000)
    return one, re.compile(f"[\u064b-\u065f\u0670ـ̀-ͯ{gone}ﻵ-ﻼﬀ-ﬆ]")


def fold(text: str) -> tuple[str, list[int] | None]:
    """The text to search, and the place of each of its characters in the original (None: the same place).
    Runs of spaces are one."""
    one, odd = _folds()
    if text.isascii() or not odd.search(text):
        folded = text if text.isascii() else text.translate(one)
        if "  " not in folded:
            return folded, None
        places = [i for i, c in enumerate(folded) if c != " " or i == 0 or folded[i - 1] != " "]
        return "".join([folded[i] for i in places]), places
    out, places = [], []
    for i, ch in enumerate(text):
        if odd.match(ch):
            for c in unicodedata.normalize("NFKC", ch) if ch >= "ﬀ" and ch < "﻿" else "":
                out.append("ا" if c in "أإآ" else c)
                places.append(i)
        else:
            out.append(ch)
            places.append(i)
    folded = "".join(out).translate(one)
    if "  " in folded:
        keep = [i for i, c in enumerate(folded) if c != " " or i == 0 or folded[i - 1] != " "]
        folded, places = "".join([folded[i] for i in keep]), [places[i] for i in keep]
    return folded, places


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(number: str) -> bool:
    """Whether an international account number passes ISO 7064 mod 97-10."""
    s = number.replace(" ", "").upper()
    return bool(re.fullmatch(r"[A-Z]{2}\d{2}[A-Z0-9]{10,30}", s)) and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _digits(s: str) -> str:
    return re.sub(r"\D", "", s)


def _national(s: str) -> float:
    """A 14-digit national number holds the century and a birth date."""
    d = _digits(s)
    month, day = int(d[3:5]), int(d[5:7])
    return 0.8 if d[0] in "23" and 1 <= month <= 12 and 1 <= day <= 31 else 0.0


def _residence(s: str) -> float:
    return 0.5 if luhn(_digits(s)) else 0.2


def _card(s: str) -> float:
    d = _digits(s)
    return 0.8 if luhn(d) and len(set(d)) > 1 else 0.0


def _account(s: str) -> float:
    return 0.8 if mod97(s) else 0.0


def _phone(s: str) -> float:
    d, foreign = _digits(s), s.lstrip("(").startswith(("+", "00"))
    if foreign:
        return 0.6 if 10 <= len(d) <= 15 else 0.0
    if not 9 <= len(d) <= 11:
        return 0.0
    return 0.55 if len(d) == 11 or re.search(r"[ ()\-.]", s) else 0.3


def _certain(_: str) -> float:
    return 0.8


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: re.Pattern
    score: Callable[[str], float]
    context: re.Pattern | None = None
    bonus: float = 0.35
    group: int = 0
    #: What every match holds, or has before it.
    cue: str = r"\d"


def _any(*words: str) -> str:
    return "(?:" + "|".join(words) + ")"


# Words that announce an item, and words that announce something else.
PHONE_WORDS = _any("tel", "phone", "call", "mob", "mobile", "whatsapp", "رقمي", "تليفون", "واتس", "موبايل", "كلموني", "جوال", "هاتف", "téléphone", "raqmi")
ID_WORDS = _any("national id", r"nat\.? id", r"\bid\b", "iqama", "raqm qawmy", "الرقم القومي", "رقم قومي", "بطاقة", "هوية", "رقم الهوية", "اقامة", "carte d.identité")
PASSPORT_WORDS = _any("passport", "passeport", "باسبور", "جواز سفر", "جواز")
NOT_ITEMS = re.compile(_any("order", "invoice", "sku", "trk", "ref", "ticket", "طلب رقم", "فاتورة", "رقم الطلب", "شحنة رقم", "commande", "facture", "version") + r"[\s#:.]*$", re.I)
#: What such a word takes from the score: much where it stands as a heading of the number, less where it may end a sentence.
HEADED, BARE = 0.5, 0.25
_L = r"[A-Za-zÀ-ÖØ-öø-ÿ]"
_A = r"[ء-غف-ي]"
_LATIN_NAME = rf"(?:[A-ZÀ-Ö]\.|[A-ZÀ-Ö]{_L}+)\s+[A-ZÀ-Ö][A-Za-zÀ-ÖØ-öø-ÿ'\-]+"
_ARABIC_NAME = rf"{_A}{{3,}}\s+(?:ال)?{_A}{{3,}}"
# groupings of an international number after the country's digits
_INTERNATIONAL = r" ?\(0\)\d(?:[ .\-]\d{2}){4}|(?:\.\d{2,4}){3,5}|(?:-\d{2,4}){3,4}| \d{2,3} \d{3} \d{3,4}| \d{1,2} \d{4} \d{4}| \d(?: \d{2}){4}|\d{8,12}"
_STREET = rf"(?!(?:the|a|an|my|our|your|this|that|their|his|her|egp|sar|usd)\b){_L}[\w'\-]+"
# what names and written-out e-mail signs are told by
_AT, _AT_WORD = r"[\[({](?:at|@)[\])}]", r"\s(?:at|arobase)\s"
_TITLES = rf"(?:الطلب باسم|مع تحيات|مع الاستاذة?|المستلمة?\s?:|السيدة?|العميلة|اسمي|(?<!{_A})[اد]/)\s"
_WITH_YOU = rf"(?<!{_A})(?:انا|معك(?:م)?)\s"
_SPOKE = rf"(?<!{_A})(?:كلمني|كلمتني)\s"
_LATIN_TITLES = r"\b(?:[Aa]ccount holder|[Aa]na esm[yi]|[Mm]y name is|[Ii] am|[Rr]egards,|[Cc]aller:|[Ss]igned|[Ss]incerely,|[Mm]r\.?|[Mm]rs\.?|[Mm]s\.?|Mme|Mlle|[Mm]onsieur|[Mm]adame|Dr\.)\s"
_ASKED = r"\b(?:[Aa]sk(?:ed)? for|[Ss]p(?:oke|eak) (?:with|to)|[Tt]alk(?:ed)? (?:with|to)|[Cc]ontact person:?)\s"
_CUSTOMER = r"\b[Cc]ustomer\s"
# What a firm's or a department's name ends in, roles that are no names, and verbs of wanting.
_FIRMS = ("Express", "Store", "Shop", "Service", "Support", "Team", "Market", "Bank", "Center", "Centre", "Delivery", "Online", "Company", "Office", "Desk", "Street", "Department")
_ROLES = "(?:مندوب|موظف|مدير|خدمة|عميل|زبون|واحد|شخص|صاحب|مسؤول|مش|كنت|عايز|عاوز|حابب)"
_WANTS = "(?:عايز|عايزة|عاوز|عاوزة|حابب|حابة|اريد|ابغى|ابي|محتاج|محتاجة)"
_PLACE = rf"{_A}{{2,}}(?:\s{_A}{{2,}})?"

RULES = (
    Rule("email", re.compile(r"(?<![\w.+\-])[A-Za-z0-9][\w.+\-]*\s?@\s?[A-Za-z0-9][\w\-]*(?:\.[\w\-]+)+", re.A), _certain, cue="@"),
    Rule("email", re.compile(rf"(?<![\w.+\-])[A-Za-z0-9][\w.+\-]*\s?{_AT}\s?[\w\-]+(?:\s?(?:\.|[\[({{](?:dot|\.)[\])}}])\s?[\w\-]+)+", re.A | re.I), _certain, cue=f"(?i:{_AT})"),
    Rule("email", re.compile(r"(?<![\w.+\-])[A-Za-z0-9][\w.+\-]*" + _AT_WORD + r"[\w\-]+(?:\s(?:dot|point)\s[\w\-]+)+", re.A | re.I), _certain, cue=f"(?i:{_AT_WORD})"),
    Rule("phone", re.compile(rf"(?<![\d+\-/#(])(?<![A-Za-z]-)(?:\+|00)\d{{1,3}}(?:{_INTERNATIONAL})(?![\w/])"), _phone, re.compile(PHONE_WORDS, re.I)),
    Rule("phone", re.compile(r"(?<![\d+\-/#(])(?<!\d\.)(?<![A-Za-z]-)(?:\(0\d{2,3}\)|0\d{2,3})[ .\-]?\d{3}[ .\-]?\d{3,5}(?![\w/])"), _phone, re.compile(PHONE_WORDS, re.I)),
    Rule("id_number", re.compile(r"(?<![\d.+\-/#])(?<![A-Za-z])[23](?:\d{13}|\d{6}[ \-]?\d{7}|[ \-]\d{6}[ \-]\d{2}[ \-]\d{5})(?![\w/])"), _national, re.compile(ID_WORDS, re.I)),
    Rule("id_number", re.compile(r"(?<![\d.+\-/#])(?<![A-Za-z])[12]\d{9}(?![\w/])"), _residence, re.compile(ID_WORDS, re.I)),
    Rule("id_number", re.compile(r"(?<![\w.+\-/#])[A-Za-z]{1,2} ?\d{7,8}(?![\w/])"), lambda s: 0.5 if s[:2].isupper() and s[1].isalpha() else 0.2, re.compile(PASSPORT_WORDS, re.I)),
    Rule("id_number", re.compile(r"(?<![\w.+\-/#])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{10,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![\w/])"), _account),
    Rule("id_number", re.compile(r"(?<![\d.+\-/#])(?<![A-Za-z])(?:[3-6]\d{14,15}|[3-6]\d{3}(?:[ \-]\d{4}){3}|3[47]\d{2}[ \-]\d{6}[ \-]\d{5})(?![\w/\-]|\.\d)"), _card),
    # street addresses: a street word with a name and the numbers of building, floor or flat
    Rule("address", re.compile(rf"\d{{1,4}}\s+شارع\s+{_PLACE}\s*[،,]?\s*(?:الدور|عمارة|شقة)\s+\d{{1,4}}"), _certain),
    Rule("address", re.compile(rf"(?<!{_A})(?:شارع|ش\.?)\s+{_PLACE}\s*[،,]?\s*(?:برج|عمارة|رقم|بناية|منزل)\s+\d{{1,4}}(?:\s*[،,]?\s*(?:شقة|الدور)\s+\d{{1,4}})?"), _certain),
    Rule("address", re.compile(rf"(?<!{_A})(?:حارة|زقاق)\s+{_PLACE}\s*[،,]?\s*(?:منزل|بيت|رقم)\s+\d{{1,4}}(?:\s+خلف\s+{_A}+)?"), _certain),
    Rule("address", re.compile(rf"(?<!{_A})حي\s+{_PLACE}\s*[،,]?\s*قطعة\s+\d{{1,4}}(?:\s*[،,]?\s*فيلا\s+\d{{1,4}})?"), _certain),
    Rule("address", re.compile(rf"3omara\s+\d{{1,4}}\s*,?\s*share3\s+{_STREET}(?:\s*,?\s*sha2a\s+\d{{1,4}})?", re.I), _certain),
    Rule("address", re.compile(rf"(?:(?:flat|apt\.?|apartment|unit)\s+\d{{1,4}}\s*,\s*)?\d{{1,4}}\s+(?:{_STREET}\s+){{1,2}}(?:avenue|ave|street|st|road|rd|lane|ln|boulevard|blvd|drive)\b\.?(?:\s*,\s*(?:flat|apt\.?|apartment|unit)\s+\d{{1,4}})?", re.I), _certain),
    Rule("address", re.compile(rf"{_STREET}\s+(?:avenue|ave|street|st|road|rd|lane)\b\.?\s*,\s*(?:bldg|building|house|no)\.?\s+\d{{1,4}}(?:\s*,\s*(?:flat|apt\.?)\s+\d{{1,4}})?", re.I), _certain),
    Rule("address", re.compile(rf"\d{{1,4}}\s*,?\s+(?:rue|avenue|boulevard|impasse|allée)\s+(?:des?\s+|du\s+|de la\s+|de l')?{_STREET}(?:\s*,\s*(?:porte|appt?|étage)\s+\d{{1,4}})?", re.I), _certain),
    Rule("address", re.compile(r"(?:\b(?:bldg|building|villa|house|block)\.?\s+\d{1,4}\s*,\s*(?:street|st|road|rd)\.?\s+\d{1,4}|\bP\.?\s?O\.?\s?Box\s+\d{1,6})\b", re.I), _certain),
    # names: only where a word announces one
    Rule("name", re.compile(rf"{_TITLES}+({_ARABIC_NAME})"), _certain, group=1, cue=_TITLES),
    Rule("name", re.compile(rf"{_WITH_YOU}+(?!{_ROLES})({_ARABIC_NAME})(?=\s+(?:و{_WANTS}|بخصوص)(?!{_A}))"), _certain, group=1, cue=_WITH_YOU),
    Rule("name", re.compile(rf"{_SPOKE}+(?!{_ROLES})({_ARABIC_NAME})(?=\s+(?:من|بخصوص|امبارح|وقال(?:ي|ت|تلي|لي)?)(?!{_A}))"), _certain, group=1, cue=_SPOKE),
    Rule("name", re.compile(rf"{_LATIN_TITLES}+({_LATIN_NAME})"), _certain, group=1, cue=_LATIN_TITLES),
    Rule("name", re.compile(rf"{_ASKED}+({_LATIN_NAME})"), lambda s: 0.0 if s.split()[-1] in _FIRMS else 0.8, group=1, cue=_ASKED),
    Rule("name", re.compile(rf"{_CUSTOMER}+({_LATIN_NAME})(?=\s+(?:called|wrote|said|says|asked|complained|came|was|is|has|had|wants|reported)\b|\s*[,(])"), _certain, group=1, cue=_CUSTOMER),
)

#: Texts that hold no rule's cue hold no item.
_WORTH = re.compile("|".join(dict.fromkeys(r.cue for r in RULES)))


def spans(text: str | None) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of the items of a text, in order, not overlapping."""
    if not text:
        return []
    folded, places = fold(text)
    if not _WORTH.search(folded):
        return []
    found = []
    for rule in RULES:
        for m in rule.pattern.finditer(folded):
            g = rule.group if rule.group >= 0 else m.lastindex
            a, b = m.span(g)
            score = rule.score(m.group(g))
            if not score:
                continue
            if rule.context is not None:
                before = folded[max(0, a - BEFORE) : a]
                if m_not := NOT_ITEMS.search(before):
                    score -= HEADED if re.search(r"[#:.]|رقم|sku|trk", m_not.group(), re.I) else BARE
                elif rule.context.search(before) or rule.context.search(folded[b : b + AFTER]):
                    score += rule.bonus
            if score >= THRESHOLD - 1e-9:
                found.append((a, b, rule.kind, min(score, 1.0)))
    found.sort(key=lambda s: (-s[3], s[0] - s[1], s[0]))
    kept: list[tuple[int, int, str, float]] = []
    taken = bytearray(len(folded)) if len(found) > 1 else b""
    for s in found:
        if taken.find(1, s[0], s[1]) < 0:
            kept.append(s)
            if len(found) > 1:
                taken[s[0] : s[1]] = b"\1" * (s[1] - s[0])
    kept.sort()
    if places is not None:
        kept = [(places[a], places[b - 1] + 1, k, s) for a, b, k, s in kept]
    return kept


def redact(text: str | None, found: list[tuple[int, int, str, float]] | None = None) -> str | None:
    """The text with ``[KIND]`` in place of every item and otherwise unchanged."""
    if not text:
        return text
    out, at = [], 0
    for a, b, kind, _ in spans(text) if found is None else found:
        out += (text[at:a], f"[{kind.upper()}]")
        at = b
    out.append(text[at:])
    return "".join(out)


def _mapped(df: DataFrame, id_col: str, fields: list[str], schema: T.StructType, rows: Callable) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, *range(1, 1 + len(fields))):
            columns: list[list] = [[] for _ in schema.names[1:]]
            at: list[int] = []
            known: dict[str, list] = {}
            for k, field in enumerate(fields):
                for i, t in enumerate(b.column(1 + k).to_pylist()):
                    if not t:
                        continue
                    hit = known.get(t)
                    if hit is None:
                        hit = known[t] = spans(t)
                    for row in rows(field, t, hit):
                        at.append(i)
                        for c, v in zip(columns, row):
                            c.append(v)
            arrow = [pa.array(c, pa.string() if f.dataType == T.StringType() else pa.int32() if f.dataType == T.IntegerType() else pa.float64()) for c, f in zip(columns, schema.fields[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *arrow], names=schema.names)

    return df.select(id_col, *fields).mapInArrow(run, schema)


def found_kinds(df: DataFrame, id_col: str, *fields: str) -> DataFrame:
    """``id_col``, ``field``, ``kind``: one row for each kind of item a field holds."""
    schema = T.StructType([df.schema[id_col], *T.StructType.fromDDL("field string, kind string").fields])
    return _mapped(df, id_col, list(fields), schema, lambda field, t, hit: [(field, k) for k in dict.fromkeys(s[2] for s in hit)])


def found_spans(df: DataFrame, id_col: str, *fields: str) -> DataFrame:
    """``id_col``, ``field``, ``kind``, ``start`` (from 0), ``end``, ``score`` of every item."""
    schema = T.StructType([df.schema[id_col], *T.StructType.fromDDL("field string, kind string, start int, end int, score double").fields])
    return _mapped(df, id_col, list(fields), schema, lambda field, t, hit: [(field, k, a, b, s) for a, b, k, s in hit])


def redacted(df: DataFrame, *fields: str) -> DataFrame:
    """``df`` with the items of the fields replaced; every row and every other column as it was."""
    at = [df.columns.index(f) for f in fields]
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, *at):
            columns = list(b.columns)
            for i in at:
                columns[i] = pa.array([redact(t) for t in columns[i].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, df.schema)
