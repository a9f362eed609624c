"""Missing or wrong document language labels, and documents that mix languages line by line.

Method: hyperdimensional profiles.  Every letter has a random vector of +1 and -1; the
vector of a three-letter piece is the product of its letters' vectors, each rotated by its
place; a text is the sum (bundle) of its pieces' vectors, a language the bundle of a sample
of texts labelled with it.  A text gets the language whose bundle has the highest cosine.

Because a bundle is a sum, the dot product of a text with a language is the sum of its
pieces' dot products.  Those are tabulated once for all pieces of the alphabet, so a text
costs one look-up per letter whatever the number of dimensions.  Every profile is divided by its own norm;
the text's norm is the same for all languages and does not change which cosine is highest.  The table
has a fixed size (``SYMBOLS**3`` times the languages, 7.5 MB) and is all that is sent to the executors.

A text in none of the languages has pieces that speak for none: its mean per piece is far below what texts of the
language with the highest cosine have (``OTHER`` of it, and ``SIGMAS`` standard deviations, measured on the
sample).  It is called ``other``.

The labels of the sample may be wrong: after a first fit, texts whose label the fit
contradicts are left out and the profiles bundled again.  ``SAMPLE`` bounds the documents of the sample and
``SAMPLE_CHARS`` the part of a long one that is read, a window at a place drawn by its id; the
rest covers every record and every line as a whole.

Defined results: null or blank texts, and texts without a known letter, get a null language
and confidence 0; a blank line takes the document's language with confidence 0.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import blocks

LANGS = ("ar", "en", "fr", "fa", "ar-latn")
#: At most so many labelled documents are read to make the profiles.
SAMPLE = 3000
#: So many characters of a document of the sample are read at most, so the driver holds a bounded text.
SAMPLE_CHARS = 5000
DIMENSIONS, SEED = 4096, 7
#: Scale of the soft-max, set so that confidences are near 1 for a short sentence.
SHARPNESS = 25.0
#: Share by which a line's best language must lead the document's own before the line counts as another language.
LEAD = 0.60
#: What a text in none of the languages is told by.
OTHER, SIGMAS, OTHER_NAME = 0.45, 2.5, "other"
NAMED = (*LANGS, OTHER_NAME)

# Names of the languages beside their codes.
NAMES = {
    "arabic": "ar", "ara": "ar", "english": "en", "eng": "en", "french": "fr", "fra": "fr", "fre": "fr",
    "persian": "fa", "farsi": "fa", "fas": "fa", "per": "fa", "arabizi": "ar-latn",
}
# Labels that say nothing.
EMPTY = ("", "und", "unknown", "none", "null", "nan")

# The alphabet; letters of one group share a symbol.
LETTERS = [*"abcdefghijklmnopqrstuvwxyz", "éèêë", "àâäîïôöùûüçœæñ", "0145689", "2", "3", "7", "'’",
           *"ءبتثجحخدذرزسشصضطظعغفقلمنه", "اأإآٱ", "وؤ", "يئ", "ى", "ة", "ك", *"پچژگ", "ک", "ی", "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"]
SYMBOLS = len(LETTERS) + 1


def _lookup() -> np.ndarray:
    """Symbol of each code point of the basic plane, 0 for what separates words."""
    table = np.zeros(0x10000, np.uint8)
    group = {c: i + 1 for i, letters in enumerate(LETTERS) for c in letters}
    for cp in range(0x10000):
        if 0xD800 <= cp < 0xE000:
            continue
        for c in unicodedata.normalize("NFKC", chr(cp)).lower() if cp > 0x7F else chr(cp).lower():
            if c in group:
                table[cp] = group[c]
                break
    for cp in (*range(0x64B, 0x660), 0x640, 0x670, 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF, *range(0x300, 0x370)):
        table[cp] = 255  # without a place of its own
    return table


_CACHE: dict[str, np.ndarray] = {}


def lookup() -> np.ndarray:
    if "lookup" not in _CACHE:
        _CACHE["lookup"] = _lookup()
    return _CACHE["lookup"]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each text between two separators, and the index of the text at each place."""
    code = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    sizes[0] += 1
    row = np.repeat(np.arange(len(texts)), sizes)
    table = lookup()
    s = table[np.minimum(code, 0xFFFF)]
    for cp in np.unique(code[code > 0xFFFF]).tolist():  # mathematical letters and the like, by the letter they show
        plain = unicodedata.normalize("NFKC", chr(cp)).lower()
        s = np.where(code == cp, table[ord(plain[0])] if ord(plain[0]) <= 0xFFFF else 0, s)
    keep = s != 255
    if not keep.all():
        s, row = s[keep], row[keep]
    keep = np.r_[True, (s[1:] != 0) | (s[:-1] != 0) | (row[1:] != row[:-1])]  # runs of separators are one
    return s[keep], row[keep]


def pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all three-symbol pieces with a letter in the middle, and their text's index."""
    s, row = symbols(texts)
    if len(s) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    x = s.astype(np.int32)
    number = (x[:-2] * SYMBOLS + x[1:-1]) * SYMBOLS + x[2:]
    ok = (s[1:-1] != 0) & (row[1:-1] == row[:-2])
    return number[ok], row[1:-1][ok]


def letter_vectors(dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (SYMBOLS, dimensions))


def bundle(weights: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The sum of the vectors of all pieces, each times its weight."""
    a, b, c = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters
    per = weights.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float32)
    total = np.zeros(letters.shape[1], np.float32)
    for i in range(SYMBOLS):
        total += a[i] * ((per[i] @ c) * b).sum(axis=0)  # over the last letter, then the middle one
    return total


def piece_weights(counts: np.ndarray) -> np.ndarray:
    """Weights of the pieces in each language's bundle: the log of the piece's share there over its mean over
    the languages, times the root of its share in all, so neither rare pieces nor common ones drown the rest."""
    seen = counts.sum(axis=0) > 0
    share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * max(1, seen.sum()))
    log = np.log(share)
    overall = (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).mean(axis=0)
    return np.where(seen, (log - log.mean(axis=0)) * np.sqrt(overall), 0.0)


def piece_table(profiles: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Dot products of every piece's vector with the profiles, each of these at length one."""
    unit = profiles / np.maximum(np.linalg.norm(profiles, axis=1, keepdims=True), 1e-9)
    a, b, c = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters
    out = np.empty((SYMBOLS, SYMBOLS, SYMBOLS, len(unit)), np.float32)
    for i in range(SYMBOLS):
        for lang, p in enumerate(unit):
            out[i, :, :, lang] = (a[i] * b * p) @ c.T
    return (out / np.sqrt(letters.shape[1])).reshape(-1, len(unit))


def scores(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed table rows and numbers of pieces, per text."""
    number, row = pieces(texts)
    total, count = np.zeros((len(texts), table.shape[1])), np.bincount(row, minlength=len(texts)) if len(row) else np.zeros(len(texts), np.int64)
    if len(row):
        head = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        total[row[head]] = np.add.reduceat(table[number], head, axis=0)
    return total, count


def confidence(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Soft-max of the mean dot products, sharper the more pieces there are."""
    z = total / np.sqrt(np.maximum(count, 1))[:, None] * SHARPNESS
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Profiles:
    """The tabulated profiles, and mean and deviation of the mean per piece of the sample's texts in each language (deviation for one piece)."""

    table: np.ndarray
    typical: np.ndarray
    spread: np.ndarray

    def other(self, total: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Whether a text is in none of the languages."""
        best = total.argmax(axis=1)
        mean = total[np.arange(len(best)), best] / np.maximum(count, 1)
        low = self.typical[best] - SIGMAS * self.spread[best] / np.sqrt(np.maximum(count, 1))
        return (count > 0) & (mean < OTHER * self.typical[best]) & (mean < low)


def canonical_label(label: Column) -> Column:
    """The language a label names, null where it names none."""
    x = F.regexp_replace(F.lower(F.trim(label)), "_", "-")
    head = F.split(x, "-")[0]
    named = F.create_map(*[F.lit(v) for kv in NAMES.items() for v in kv])
    code = F.when(x.isin(*EMPTY), None).when(x.contains("latn"), "ar-latn").when(head.isin(*LANGS), head).otherwise(F.try_element_at(named, head))
    return F.coalesce(code, F.when(~x.isin(*EMPTY), x))


def fit(labelled: DataFrame, text: str, label: str, id_col: str, sample: int = SAMPLE) -> Profiles:
    """The profiles, from a sample of labelled texts: those whose id's hash is below the share
    that ``sample`` is of all rows, so no task sends more than its part of the sample to the driver."""
    share = min(1.0, 0.95 * sample / max(1, labelled.count()))
    window = F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(0)) + 1
    rows = (
        labelled.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 40)) < int(share * (1 << 40)))
        .select(F.substring(F.col(text), F.pmod(F.xxhash64(F.lit(3), id_col), window).cast("int") + 1, F.lit(SAMPLE_CHARS)).alias("t"), canonical_label(F.col(label)).alias("l"))
        .where(F.col("l").isin(*LANGS) & F.col("t").isNotNull()).limit(sample).collect()
    )
    letters, none = letter_vectors(), np.zeros(len(LANGS))
    rows.sort(key=lambda r: (r["t"], r["l"]))
    texts, labels = [r["t"] for r in rows], np.array([LANGS.index(r["l"]) for r in rows], np.int64)
    if not texts:
        return Profiles(np.zeros((SYMBOLS**3, len(LANGS)), np.float32), none, none)
    number, row = pieces(texts)
    good = np.ones(len(texts), bool)
    for _ in range(2):
        counts = np.stack([np.bincount(number[(labels[row] == i) & good[row]], minlength=SYMBOLS**3) for i in range(len(LANGS))]).astype(np.float64)
        table = piece_table(np.stack([bundle(w, letters) for w in piece_weights(counts)]), letters)
        total, count = scores(texts, table)
        good = total.argmax(axis=1) == labels
    typical, spread = none.copy(), none.copy()
    for i in range(len(LANGS)):
        of = good & (labels == i) & (count > 0)
        if of.any():
            mean = total[of, i] / count[of]
            typical[i] = np.average(mean, weights=count[of])
            spread[i] = np.sqrt(np.average((mean - typical[i]) ** 2 * count[of]))
    return Profiles(table, typical, spread)


def detect(df: DataFrame, id_col: str, text: str, profiles: Profiles, *keep: str) -> DataFrame:
    """One row per record: ``record_id``, the kept columns, ``lang`` and ``confidence`` of the whole text."""
    sent = df.sparkSession.sparkContext.broadcast(profiles)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, 1):
            total, count = scores([t or "" for t in b.column(1).to_pylist()], sent.value.table)
            best, sure = total.argmax(axis=1), confidence(total, count).max(axis=1)
            best = np.where(sent.value.other(total, count), len(LANGS), best)
            langs = pa.array([NAMED[i] if n else None for i, n in zip(best, count)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(b.column(2 + k) for k in range(len(keep))), langs, pa.array(np.where(count > 0, sure, 0.0))], names=schema.names)

    schema = T.StructType([T.StructField("record_id", T.LongType()), *(T.StructField(k, df.schema[k].dataType) for k in keep), *T.StructType.fromDDL("lang string, confidence double").fields])
    return df.select(F.col(id_col).cast("long").alias("record_id"), F.col(text).alias("__text"), *keep).mapInArrow(run, schema)


def detect_lines(df: DataFrame, id_col: str, text: str, profiles: Profiles, label: str, lead: float = LEAD) -> DataFrame:
    """``record_id``, ``seg_no``, ``given`` (the label), ``lang``, ``confidence``: 0 for the whole record (the language of most of its
    characters), and 1, 2, ... for the lines of a record whose lines are in more than one language."""
    sent = df.sparkSession.sparkContext.broadcast(profiles)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, 1):
            lines, doc = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                part = (t or "").split("\n")
                lines += part
                doc += [i] * len(part)
            doc = np.array(doc)
            size = np.array([len(x) for x in lines], np.float64)
            total, count = scores(lines, sent.value.table)
            sure = confidence(total, count)
            whole = np.zeros((b.num_rows, len(LANGS)))
            np.add.at(whole, doc, total)
            main = whole.argmax(axis=1)
            best = total.argmax(axis=1)
            unsure = (sure[np.arange(len(best)), best] < lead) | (count == 0)
            sure = np.c_[sure, sure.max(axis=1)]
            counted = np.zeros(b.num_rows)
            np.add.at(counted, doc, count)
            main = np.where(sent.value.other(whole, counted), len(LANGS), main)
            best = np.where(sent.value.other(total, count), len(LANGS), best)
            best = np.where(unsure, main[doc], best)
            mass = np.zeros((b.num_rows, len(NAMED)))
            np.add.at(mass, (doc, best), np.where(count > 0, size, 0))
            top = mass.argmax(axis=1)
            mixed = (mass > 0).sum(axis=1) > 1
            some = mass.sum(axis=1) > 0
            given = confidence(whole, counted)
            whole_sure = np.where(mixed, mass.max(axis=1) / np.maximum(mass.sum(axis=1), 1), np.c_[given, given.max(axis=1)][np.arange(b.num_rows), top])
            take = np.flatnonzero(mixed[doc])
            begin = np.searchsorted(doc, np.arange(b.num_rows))
            rows = np.r_[np.arange(b.num_rows), doc[take]]
            seg = np.r_[np.zeros(b.num_rows, np.int64), take - begin[doc[take]] + 1]
            lang = [NAMED[i] if ok else None for i, ok in zip(top, some)] + [NAMED[i] for i in best[take]]
            conf = np.r_[np.where(some, whole_sure, 0.0), np.where(count[take] > 0, sure[take, best[take]], 0.0)]
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array(seg), b.column(2).take(at), pa.array(lang, pa.string()), pa.array(conf)], names=schema.names)

    schema = T.StructType.fromDDL("record_id long, seg_no long, given string, lang string, confidence double")
    return df.select(F.col(id_col).cast("long").alias("record_id"), F.col(text).alias("__text"), F.col(label).alias("given")).mapInArrow(run, schema)
