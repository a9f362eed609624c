"""Visually identical text with different characters.

Every text is brought to one form in which texts that look alike are equal and
texts that look different stay different.

Method: each character belongs to a *visual class* that has a member in one or
more writing systems (Latin, Cyrillic, Greek, Armenian, Cherokee).  A token's resolved script
sets (the script extensions of each character, and the systems in which its class can be
written) are intersected.  A token whose characters come
from several systems although one system can write it alone is a mixed-script
confusable; one that several systems can write alone is a whole-script
confusable.  Either way the consistent spelling is taken from the first system
of the intersection, so the chosen spelling depends on the classes alone: two
tokens that look alike always end as the same string.  A token no single system
can write keeps every class's first member.  The remaining forms (widths, drawn
shapes, ligatures, accent composition and order, spaces, invisible characters)
are normalised afterwards.

Visible differences are kept: vowel marks, letter case, stretched letters
(repeats and tatweel), hamza on an alif, the number of spaces, and line breaks.

Defined results: null -> null; '' -> ''; no length limit.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.store import written
from .batches import blocks

# Letters that look the same, one string of letters per writing system and the Latin ones they
# look like, position by position.  The systems stand in order of preference for a consistent spelling.
CONFUSABLE = {
    "cyrillic": ("АВСЕНІЈКМОРЅТХУасеіјорѕхуһԁԛԝҮѵӀӏ", "ABCEHIJKMOPSTXYaceijopsxyhdqwYvll"),
    "greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναρ", "ABEZHIKMNOPTYXovap"),
    "armenian": ("ՕՏՍԼօհոսց", "OSULohnug"),
    "cherokee": ("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ", "ABCDEHJKLMPRSTVWZ"),
}
# Latin letters drawn like other Latin ones.
LATIN_VARIANTS = ("ɑɡ", "ag")
SYSTEMS = ("latin", *CONFUSABLE)
#: All letters with a look-alike, and the Latin ones.
FOREIGN_LETTERS = "".join(a for a, _ in CONFUSABLE.values()) + LATIN_VARIANTS[0]
LATIN_LETTERS = "".join(b for _, b in CONFUSABLE.values()) + LATIN_VARIANTS[1]
# Digits of the Persian set that look like Arabic-Indic ones (the others are drawn differently).
PERSIAN_DIGITS = "۰۱۲۳۷۸۹"
ARABIC_DIGITS = "٠١٢٣٧٨٩"
# Letters of the Persian orthography and the Arabic letter they look like, by place in the word.
KEHEH_BEFORE_LETTER = ("ک", "ك")
YEH_BEFORE_LETTER = ("ی", "ي")
YEH_AT_END = ("ی", "ى")
#: Letters only Persian orthography has; a token with one of them is spelled the Persian way.
PERSIAN_ONLY = "پچژگ"

# Characters without a shape of their own.
INVISIBLE_RANGES = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5),
    (0x180B, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164),
    (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xE0000, 0xE0FFF),
)
#: Kinds of compatibility mapping whose two sides look the same.
SAME_SHAPE = ("<wide>", "<narrow>", "<initial>", "<medial>", "<final>", "<isolated>", "<noBreak>", "<font>")


def _single_forms() -> dict[int, str | None]:
    """Code point -> replacement, from the Unicode data of this Python, by rule."""
    table: dict[int, str | None] = {}
    for cp in range(0x80, 0x30000):  # no character beyond has another form
        ch = chr(cp)
        kind, _, rest = unicodedata.decomposition(ch).partition(" ")
        category = unicodedata.category(ch)
        if category == "Zs":
            table[cp] = " "
        elif kind in SAME_SHAPE or (kind == "<compat>" and (category == "Nl" or (category in ("Ll", "Lu", "Lo", "Lt") and len(rest.split()) > 1))):
            table[cp] = unicodedata.normalize("NFKC", ch)
    for a, b in INVISIBLE_RANGES:
        table.update(dict.fromkeys(range(a, b + 1)))
    table[9] = " "
    return table


_TABLES: dict[str, object] = {}


def _tables() -> dict[str, object]:
    """Built once per Python worker."""
    if not _TABLES:
        forms = _single_forms()
        _TABLES["forms"] = forms
        spread: list[list[int]] = []  # ranges over the keys beyond the basic plane; a character between them only costs a look-up
        for c in sorted(c for c in forms if c >= 0x10000):
            if spread and c - spread[-1][1] < 0x400:
                spread[-1][1] = c
            else:
                spread.append([c, c])
        _TABLES["needs"] = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(forms) if c < 0x10000) + "".join(f"{chr(a)}-{chr(b)}" for a, b in spread) + "]")
        _TABLES["class_of"] = dict(zip(FOREIGN_LETTERS, LATIN_LETTERS))
        _TABLES["member"] = {system: dict(zip(reversed(latin), reversed(own))) for system, (own, latin) in CONFUSABLE.items()}
        _TABLES["digits"] = str.maketrans(PERSIAN_DIGITS, ARABIC_DIGITS)
    return _TABLES


def _ranges(pattern: regex.Pattern) -> str:
    """A character class of the characters that a pattern matches, for the plain and faster engine."""
    found = [ord(c) for c in pattern.findall("".join(map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x20000)))))]
    heads = [c for i, c in enumerate(found) if not i or found[i - 1] != c - 1]
    tails = [c for i, c in enumerate(found) if i + 1 == len(found) or found[i + 1] != c + 1]
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(heads, tails)) + "]"


_FOREIGN = re.compile(_ranges(regex.compile(rf"[{LATIN_VARIANTS[0]}]|[[\p{{scx=Cyrl}}\p{{scx=Grek}}\p{{scx=Armn}}\p{{scx=Cher}}]--[\p{{scx=Arab}}\p{{scx=Latn}}]]", regex.V1)))
_TOKEN = re.compile(r"[^\W\d_؀-ۿ]+")
_SCRIPTS = {system: regex.compile(rf"\p{{scx={system}}}") for system in SYSTEMS}
_MORE = "(?=[\u064b-\u065f\u0670]*[ؠ-ؿف-يٮ-ۓە])"
_PERSIAN_ANY = re.compile(f"[{PERSIAN_DIGITS}کی]")
_ARABIC_TOKEN = re.compile("[ؠ-ٟٮ-ەۮۯ]+")
_PERSIAN_MARK = re.compile(f"[{PERSIAN_ONLY}]")
_ARABIC_SHARED = re.compile("[كيى]")


@lru_cache(1 << 16)
def scripts_of(ch: str) -> frozenset[str]:
    """The writing systems among those compared that have a character, by its script extensions; empty for the rest."""
    return frozenset(s for s, p in _SCRIPTS.items() if p.match(ch))


@lru_cache(1 << 16)
def resolved(cls: str) -> frozenset[str]:
    """The writing systems in which a visual class can be written."""
    return scripts_of(cls) | {s for s, letters in _tables()["member"].items() if cls in letters}


def resolve_token(token: str) -> tuple[str, frozenset[str], bool]:
    """A token's consistent spelling, the systems that can write it alone, and whether it mixes systems.

    Characters of no system compared (an Arabic or Chinese letter, say) leave a token without a system."""
    tables = _tables()
    class_of, member = tables["class_of"], tables["member"]
    classes = [class_of.get(c, c) for c in token]
    possible = frozenset(SYSTEMS).intersection(*map(resolved, classes))
    mixed = not frozenset(SYSTEMS).intersection(*(scripts_of(c) or SYSTEMS for c in token))
    pick = next((s for s in SYSTEMS if s in possible), None)
    if pick in (None, "latin"):
        spelled = "".join(classes)
    else:
        spelled = "".join(member[pick].get(c, c) for c in classes)
    return spelled, possible, mixed


def _arabic_spelling(text: str) -> str:
    """Persian letters and digits in the Arabic spelling wherever both are drawn the same."""
    text = re.sub(KEHEH_BEFORE_LETTER[0] + _MORE, KEHEH_BEFORE_LETTER[1], text)
    text = re.sub(YEH_BEFORE_LETTER[0] + _MORE, YEH_BEFORE_LETTER[1], text)
    return text.replace(*YEH_AT_END).translate(_tables()["digits"])


def _persian_token(m: re.Match) -> str:
    """A token only Persian can write, in the Persian spelling throughout."""
    token = m.group()
    if not _PERSIAN_MARK.search(token):
        return token
    token = re.sub(KEHEH_BEFORE_LETTER[1] + _MORE, KEHEH_BEFORE_LETTER[0], token)
    token = re.sub(YEH_BEFORE_LETTER[1] + _MORE, YEH_BEFORE_LETTER[0], token)
    return re.sub(YEH_AT_END[1] + "(?![\u064b-\u065f\u0670]*[ؠ-ؿف-يٮ-ۓە])", YEH_AT_END[0], token)


def unify_text(text: str | None) -> str | None:
    """The one consistent form of a text."""
    if text is None or text.isascii():
        return text if text is None or "\t" not in text else text.replace("\t", " ")
    tables = _tables()
    if tables["needs"].search(text):
        text = text.translate(tables["forms"])
    elif "\t" in text:
        text = text.replace("\t", " ")
    text = unicodedata.normalize("NFC", text)
    if _FOREIGN.search(text):
        text = _TOKEN.sub(lambda m: resolve_token(m.group())[0] if _FOREIGN.search(m.group()) else m.group(), text)
        text = unicodedata.normalize("NFC", text)
    if _PERSIAN_ANY.search(text):
        text = _arabic_spelling(text)
    if _PERSIAN_MARK.search(text) and _ARABIC_SHARED.search(text):
        text = _ARABIC_TOKEN.sub(_persian_token, text)
    return text


def unified(df: DataFrame, text: str, out: str = "unified") -> DataFrame:
    """``df`` with the consistent form of ``text`` in ``out``; every row is kept."""
    schema = T.StructType([*(f for f in df.schema.fields if f.name != out), T.StructField(out, T.StringType())])
    rest = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, len(rest)):
            forms = pa.array([unify_text(t) for t in b.column(len(rest)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(rest))), forms], names=schema.names)

    return df.select(*rest, F.col(text).alias("__unify")).mapInArrow(run, schema)


def token_report(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per token spelled in a system of its own or in several:
    ``id_col``, ``token``, ``spelling``, ``systems`` (comma-joined), ``kind`` (mixed, whole)."""
    schema = T.StructType([T.StructField("__id", df.schema[id_col].dataType), *(T.StructField(n, T.StringType()) for n in ("token", "spelling", "systems", "kind"))])

    def run(batches):
        for b in blocks(batches, 1):
            rows: list[list] = [[], [], [], [], []]
            for rid, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not t or not _FOREIGN.search(t):
                    continue
                for m in _TOKEN.finditer(unicodedata.normalize("NFC", t)):
                    if _FOREIGN.search(m.group()):
                        spelled, systems, mixed = resolve_token(m.group())
                        if spelled != m.group():
                            for c, v in zip(rows, (rid, m.group(), spelled, ",".join(s for s in SYSTEMS if s in systems), "mixed" if mixed else "whole")):
                                c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], b.schema.field(0).type), *(pa.array(c, pa.string()) for c in rows[1:])], names=["__id", "token", "spelling", "systems", "kind"])

    return df.select(F.col(id_col).alias("__id"), F.col(text).alias("__text")).mapInArrow(run, schema).withColumnRenamed("__id", id_col)


def _keyed(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Id and two 128-bit names: of the form (``form``, ``form2``) and of the string itself (``variant``, ``variant2``); written, so texts are read once."""
    forms = unified(df.select(F.col(id_col).alias("__id"), F.col(text).alias("__raw")).where(F.col(text).isNotNull() & F.col(id_col).isNotNull()), "__raw", "__form")
    two = lambda c, a: (F.xxhash64(c).alias(a), F.xxhash64(F.lit(7), c).alias(f"{a}2"))
    return written(forms.select("__id", *two("__form", "form"), *two("__raw", "variant")), "forms")


def lookalike_groups(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per record of a group of at least two *different* strings with one form: ``id_col``, ``group`` (its
    smallest id), ``variant`` (the smallest id with the same string) and ``variants`` in the group.

    Rows with null text are in no group.  Copies of one string share a variant.  Counts and minima are combined
    before the shuffle, and only names and ids are shuffled, never the texts."""
    keyed = _keyed(df, id_col, text)
    seen = written(keyed.groupBy("form", "form2", "variant", "variant2").agg(F.min("__id").alias("first")), "variants")
    groups = seen.groupBy("form", "form2").agg(F.count(F.lit(1)).alias("variants"), F.min("first").alias("group")).where("variants > 1")
    named = seen.join(groups.hint("merge"), ["form", "form2"])
    return keyed.join(named.hint("merge"), ["form", "form2", "variant", "variant2"]).select(F.col("__id").alias(id_col), "group", F.col("first").alias("variant"), "variants")


def lookalike_pairs(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Pairs (smaller id first) of rows whose texts differ in characters but have one form."""
    g = written(lookalike_groups(df, id_col, text), "lookalikes")
    a = g.select(F.col(id_col).alias("__a"), "group", F.col("variant").alias("__va"))
    b = g.select(F.col(id_col).alias("__b"), "group", F.col("variant").alias("__vb")).hint("merge")
    return a.join(b, "group").where("__a < __b AND __va <> __vb").select(F.col("__a").alias(f"{id_col}_a"), F.col("__b").alias(f"{id_col}_b"))
