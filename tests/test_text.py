import pytest
from pyspark.sql import functions as F

from cartero.functions import lexicons as lx
from cartero.functions import text as tx
from cartero.operators import features


def run(spark, fn, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


@pytest.mark.parametrize("raw, clean", [
    ("WIN $5000 NOW!!! http://x.co a@b.com", "win tokendinero tokennumero now tokenexclam tokenurl tokenemail"),
    ("pls recieve ur msg asap, dont reply", "please receive your message as soon as possible do not reply"),
    ("no cobramos 100 dólares", "number cobramos tokennumero dólares"),
    ("100 dolares o 5 USD", "tokennumero tokendinero o tokennumero tokendinero"),
    ("don't", "don t"), ("èeur eur", "eur tokendinero"), ("b4 4u", "b tokennumero tokennumero you"),
    (None, ""), ("", ""), ("   ", ""), ("WWW.Spam.Com ya", "tokenurl ya"),
    ("a b ٣", "a b tokennumero"),
])
def test_clean_text(spark, raw, clean):
    assert run(spark, tx.clean_text, raw) == [clean]


def test_digit_abbreviations_live_in_raw_text_only(spark):
    assert run(spark, tx.expand_abbreviations, "b4, gr8 2day (4u)") == ["before, great today (for you)"]


def test_fix_typos_whole_words_only(spark):
    assert run(spark, tx.fix_typos, "recieve busines-like recieved") == ["receive business-like recieved"]


def test_length_and_words(spark):
    assert run(spark, tx.word_count, "  uno\tdos \n tres ", "", None) == [3, 0, 0]
    assert run(spark, tx.char_count, "añ", None) == [2, 0]


def test_lexical_translation(spark):
    out = run(spark, tx.lexical_translate, "Free money: click here and act now, limited time", "", "   ", None)
    assert out == ["dinero gratis haz clic aquí and actúa ahora tiempo limitado", "", "", ""]


def test_abbreviations_then_translation(spark):
    assert "for your information" in run(spark, tx.expand_abbreviations, "fyi please send the report asap")[0]
    assert run(spark, tx.expand_then_translate, "FYI pls, win") == ["para tu información por favor ganar"]


def test_post_normalise(spark):
    out = run(spark, tx.post_normalise, "token url token email token number", "Click Here, PLEASE call", "maybe may")
    assert out == ["tokenurl token correo tokennumero", "haga clic aquí, por favor llamada", "maybe mayo"]


def test_segment(spark):
    long_sentence = " ".join(["palabra"] * 150)
    long_word = "x" * 600
    texts = ["Hola. Adios.", "", " ", long_sentence, "Uno. " + long_word + " dos. Tres", "a" * 300 + ". " + "b" * 300 + "\n\nc"]
    out = run(spark, tx.segment, *texts)
    assert out[0] == ["Hola. Adios."] and out[1] == [] and out[2] == []
    assert [len(b) for b in out[3]] == [495, 495, 207] or all(len(b) <= 500 for b in out[3])
    for text, blocks in zip(texts, out):
        assert " ".join(" ".join(blocks).split()) == " ".join(text.split())
        assert all(len(b) <= 500 or " " not in b for b in blocks)
    assert long_word in out[4]


def brute_segments(text, limit=500):
    """Plain restatement of the packing rule on whitespace-free sentences."""
    blocks, cur = [], ""
    for s in text.split(". "):
        s = s if s.endswith(".") else s + "."
        if cur and len(cur) + 1 + len(s) > limit:
            blocks.append(cur)
            cur = s
        else:
            cur = f"{cur} {s}" if cur else s
    return blocks + [cur]


def test_segment_packs_greedily(spark):
    text = " ".join("w" * (17 + 31 * i % 97) + "." for i in range(60))
    assert run(spark, tx.segment, text) == [brute_segments(text)]


def test_tokens_and_ngrams(spark):
    got = run(spark, lambda t: features.terms(t, ["the"], 2), "the big a red the car", "x", "solo")
    assert got == [["big", "red", "car", "big red", "red car"], [], ["solo"]]


def test_term_counts(spark):
    got = run(spark, lambda t: tx.term_counts(F.split(t, " ")), "b a b c b a")
    assert [tuple(r) for r in got[0]] == [("a", 2), ("b", 3), ("c", 1)]


def test_char_grams(spark):
    assert run(spark, tx.char_grams, "abc") == [["a", "b", "c", "ab", "bc", "abc"]]
    assert run(spark, lambda t: tx.char_grams(t, (3,)), "ab") == [[]]


def test_english_hint(spark):
    assert run(spark, tx.english_hint, "the deal", "the the", "hola", None) == ["en", "es", "es", "es"]


def test_table_sizes():
    sizes = [len(t) for t in (lx.ABBREVIATIONS, lx.TYPOS, lx.PHRASES, lx.GLOSSARY, lx.ABBREVIATIONS_ES,
                              lx.RESIDUAL_PHRASES, lx.RESIDUAL_WORDS)]
    assert sizes == [67, 13, 11, 109, 14, 16, 168]


def test_charset_keeps_words_and_replaces_nothing(spark):
    """What lies between words is not replaced piece by piece, which took most of the time of every text step."""
    import re
    texts = ["", "  ", "¡Hola!  ¿qué tal?", "a-b  c", " ünter_1 ", "日本 x\ty\n", "É.É", "İx", "--", "a b", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    out = rows.select("i", tx.normalise_charset(F.col("t")).alias("x"), F.lower("t").alias("low"))
    assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
    for r in out.collect():
        kept = r.low if r.low is None else re.sub(f"[^{tx.CLEAN_ALPHABET}]{{2,}}|[^{tx.CLEAN_ALPHABET} ]", " ", r.low).strip(" ")
        assert r.x == kept


@pytest.mark.parametrize("limit", [1, 2, 7, 20])
def test_words_are_packed_as_one_by_one(spark, limit):
    """Blocks found as matches are those of packing word after word; longer words keep blocks of their own."""
    texts = ["", "a", "one two  three\tfour\nfive", "w" * 30 + " a bb " + "x" * 21, "ñandú 😀😀😀😀😀😀   é é fin.", "ab " * 40]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(tx._pack_words(F.col("t"), limit).alias("a"), tx._pack(tx.words(F.col("t")), limit).alias("b")).collect()
    assert all(r.a == r.b for r in got) and sum(len(r.a) for r in got) > 6
