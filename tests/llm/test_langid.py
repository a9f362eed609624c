"""Languages: made-up languages are told apart, lines of mixed texts too; labels are read in all spellings."""

import random

import pytest
from pyspark.sql import functions as F

from textmill.llm import langid

WORDS = {
    "en": "the order arrived with a broken lamp and my cable worked slowly because they cancelled this screen without the box".split(),
    "fr": "le colis est arrivé trop tard mais la commande était très fragile et ils ont dit que le bouton chauffe encore".split(),
    "ar": "الطلب وصل متأخر جدا لكن المنتج ممتاز والخدمة كانت سريعة مع المندوب هذا التطبيق لا يعمل".split(),
    "fa": "این کالا خیلی خوب است ولی گوشی دیر رسید و پشتیبانی کند بود چراغ را پرسیدم".split(),
    "ar-latn": "el montag da kwayes awy bas el tawseel met2akhar w el mandoob mesh 3aref 7aga 3ashan el sa3a".split(),
}


def sentence(r, lang, n=12):
    return " ".join(r.choices(WORDS[lang], k=n))


@pytest.fixture(scope="module")
def fitted(spark):
    r = random.Random(1)
    rows = [(i, sentence(r, lang, 25), lang if r.random() > 0.1 else r.choice(list(WORDS))) for i, lang in enumerate(r.choices(list(WORDS), k=400))]
    return langid.fit(spark.createDataFrame(rows, "id long, t string, l string"), "t", "l", "id")


def test_held_out_accuracy(spark, fitted):
    r = random.Random(2)
    truth = {i: lang for i, lang in enumerate(r.choices(list(WORDS), k=300))}
    df = spark.createDataFrame([(i, sentence(r, lang, 6)) for i, lang in truth.items()], "id long, t string")
    got = langid.detect(df, "id", "t", fitted).collect()
    assert sum(x["lang"] == truth[x["record_id"]] for x in got) >= 0.97 * len(got)
    assert all(0 < x["confidence"] <= 1 for x in got)


def test_lines(spark, fitted):
    r = random.Random(3)
    rows = [(1, "\n".join([sentence(r, "ar", 30), sentence(r, "fr"), "", sentence(r, "ar")]), "x"), (2, "\n".join(sentence(r, "en") for _ in range(5)), None), (3, None, "ar"), (4, "  ", "ar"), (5, "", None), (6, "12 !!", "ar")]
    got = sorted(tuple(x)[:4] for x in langid.detect_lines(spark.createDataFrame(rows, "id long, t string, lang string"), "id", "t", fitted, "lang").collect())
    assert got == [(1, 0, "x", "ar"), (1, 1, "x", "ar"), (1, 2, "x", "fr"), (1, 3, "x", "ar"), (1, 4, "x", "ar"), (2, 0, None, "en"), (3, 0, "ar", None), (4, 0, "ar", None), (5, 0, None, None), (6, 0, "ar", got[-1][3])]


def test_labels(spark):
    labels = ["ar", "ar-EG", "arabic", "AR", "ara", "en_US", "FR", "fra", "AR-LATN", "arabizi", "und", "", None, "unknown", "de"]
    got = spark.createDataFrame([(x,) for x in labels], "l string").select(langid.canonical_label(F.col("l")).alias("c")).collect()
    assert [r["c"] for r in got] == ["ar", "ar", "ar", "ar", "ar", "en", "fr", "fr", "ar-latn", "ar-latn", None, None, None, None, "de"]


def test_empty(spark):
    df = spark.createDataFrame([], "id long, t string, l string")
    table = langid.fit(df, "t", "l", "id")
    assert langid.detect(df, "id", "t", table).count() == 0 and langid.detect_lines(df, "id", "t", table, "l").count() == 0


def test_table_equals_vectors():
    """The tabulated dot products are those of the bundled hypervectors themselves."""
    import numpy as np

    letters = langid.letter_vectors(256, 5)
    r = np.random.default_rng(2)
    profiles = r.normal(size=(5, 256)).astype(np.float32)
    table = langid.piece_table(profiles, letters)
    unit = profiles / np.linalg.norm(profiles, axis=1, keepdims=True)
    for a, b, c in r.integers(0, langid.SYMBOLS, (20, 3)):
        v = np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
        assert np.allclose(table[(a * langid.SYMBOLS + b) * langid.SYMBOLS + c], unit @ v / 16, atol=1e-4)


def test_the_highest_cosine_wins_whatever_the_norms():
    import numpy as np

    letters, r = langid.letter_vectors(512, 6), np.random.default_rng(3)
    profiles = r.normal(size=(5, 512)).astype(np.float32)
    a, b = (langid.piece_table(p, letters) for p in (profiles, profiles * np.array([[1], [9], [0.1], [2], [30]], np.float32)))
    assert np.allclose(a, b, atol=1e-5)


def test_another_language_is_other(spark, fitted):
    rows = [(1, "jdzwiek przyszedl wczoraj zbyt pozno lecz obsluga sklepu byla bardzo uprzejma"), (2, "хороший товар пришел вовремя"), (3, "zxqj vvkz qqwx jjzk xxqv kkzj wwxq zzvk jqxz vkwq xjzz qkvw zxjq"), (4, sentence(random.Random(4), "en"))]
    got = {r["record_id"]: r["lang"] for r in langid.detect(spark.createDataFrame(rows, "id long, t string"), "id", "t", fitted).collect()}
    assert got[3] == "other" and got[4] == "en" and got[2] is None


def test_letters_beyond_the_basic_plane():
    plain, drawn = "the order", "".join(chr(0x1D41A + ord(c) - 97) if c != " " else c for c in "the order")
    assert langid.symbols([plain])[0].tolist() == langid.symbols([drawn])[0].tolist()


def test_long_documents_are_in_the_sample_too(spark):
    r = random.Random(8)
    rows = [(i, sentence(r, lang, 3000), lang) for i, lang in enumerate(list(WORDS) * 4)]
    profiles = langid.fit(spark.createDataFrame(rows, "id long, t string, l string"), "t", "l", "id")
    assert (profiles.typical > 0).all()
