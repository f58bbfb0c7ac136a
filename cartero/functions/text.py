"""Text rules of the mail domain as column expressions (no UDF anywhere)."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartero.functions import lexicons as lx
from cartero.functions.expressions import contains_any, let, literals, lookup

# FIXED VALUES: the five signal rules, applied in this order.  (?U) makes the
# JVM classes Unicode-aware.
SIGNAL_RULES = [
    (r"(?iU)https?://\S+|www\.\S+", " tokenurl "),
    (r"(?U)\S+@\S+", " tokenemail "),
    (r"(?iU)[\$€£]|\b(?:usd|eur|dolares|dollars|pesos)\b", " tokendinero "),
    (r"!+", " tokenexclam "),
    (r"(?U)\d+", " tokennumero "),
]
# What a lower-cased text must hold for a rule to match ("ſ" folds to "s").
SIGNAL_HINTS = [
    ["://", "www."], ["@"], ["$", "€", "£", "usd", "eur", "dolares", "dollars", "pesos", "ſ"], ["!"], None,
]
CLEAN_ALPHABET = "a-z0-9áéíóúñü_"

# FIXED VALUE: the characters that count as white space at the ends of a text.
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

MIN_CHARS = 5            # texts must be longer than this
MAX_CHARS = 10_000       # longer mails are cut here
LANGUAGE_WINDOW = 150    # characters looked at by the batch language step
LANGUAGE_MIN_CHARS = 6
PREFIX_CHARS = 600       # fast translation mode
FRAGMENT_CHARS = 500     # sentence-packing limit
SUMMARY_CHARS = 120      # history summary
CATALOGUE_CHARS = 35     # catalogue listing


def strip(text: Column) -> Column:
    """Strip any white space; only the ends of the text are looked at."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def sanitise(text: Column) -> Column:
    """Null becomes the empty string; surrounding white space goes."""
    return strip(F.coalesce(text, F.lit("")))


def char_count(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0))


def words(text: Column) -> Column:
    """White-space separated words, empties dropped."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def mark_signals(text: Column) -> Column:
    """Replace links, addresses, money, exclamations and numbers by signal tokens.

    A rule runs only on texts that hold one of its hints; replacements of
    earlier rules bring in no hint of a later one.
    """

    def apply(low: Column) -> Column:
        out = text
        for (pattern, token), hints in zip(SIGNAL_RULES, SIGNAL_HINTS):
            out = _rule(out, low, pattern, token, hints)
        return out

    return let(F.lower(text), apply)


def _rule(text: Column, low: Column, pattern: str, token: str, hints: list[str] | None) -> Column:
    if hints is None:
        return F.regexp_replace(text, pattern, token)
    return let(text, lambda t: F.when(contains_any(low, hints), F.regexp_replace(t, pattern, token)).otherwise(t))


def normalise_charset(text: Column) -> Column:
    """Lower-case, keep the bilingual alphabet, collapse blanks."""
    return F.array_join(alphabet_words(F.lower(text)), " ")


def alphabet_words(text: Column) -> Column:
    """Maximal runs of the bilingual alphabet; finding them is many times faster than replacing what lies between."""
    return F.regexp_extract_all(text, F.lit(f"([{CLEAN_ALPHABET}]+)"), 1)


def _replace_blank_separated(text: Column, table: Mapping[str, str]) -> Column:
    return F.array_join(F.transform(F.split(text, " "), lookup(table)), " ")


def _replace_words(text: Column, table: Mapping[str, str], fold_case: bool = False) -> Column:
    """Whole-word replacement in raw text; everything between words is kept."""
    pieces = F.regexp_extract_all(text, F.lit(r"(?U)(\w+|\W+)"), 1)
    return F.array_join(F.transform(pieces, lookup(table, fold_case)), "")


def _replace_phrases(text: Column, table: Mapping[str, str], fold_case: bool) -> Column:
    """Longest phrase first; texts without any phrase skip the replacements."""
    flags = "(?iU)" if fold_case else "(?U)"

    def chain(bound: Column) -> Column:
        out = bound
        for phrase in sorted(table, key=len, reverse=True):
            out = F.regexp_replace(out, rf"{flags}\b{phrase}\b", table[phrase])
        # Long s, dotless i and the dot of a lower-cased dotted I fold in the patterns but not in ``lower``.
        hints = [*table, "ſ", "ı", "\u0307"] if fold_case else list(table)
        low = F.lower(bound) if fold_case else bound
        return F.when(let(low, lambda t: contains_any(t, hints)), out).otherwise(bound)

    return let(text, chain)


def expand_abbreviations(text: Column, cleaned: bool = False) -> Column:
    """Whole-word abbreviation expansion; ``cleaned`` text is split at blanks only."""
    return (_replace_blank_separated if cleaned else _replace_words)(text, lx.ABBREVIATIONS)


def fix_typos(text: Column, cleaned: bool = False) -> Column:
    return (_replace_blank_separated if cleaned else _replace_words)(text, lx.TYPOS)


def clean_text(text: Column) -> Column:
    """Signals, charset, abbreviations and typos; null gives the empty string.

    No abbreviation expands to a misspelling, so both tables share one pass.
    """
    words = alphabet_words(F.lower(mark_signals(F.coalesce(text, F.lit("")))))
    return F.array_join(F.transform(words, lookup({**lx.ABBREVIATIONS, **lx.TYPOS})), " ")


def subject_and_body(subject: Column, body: Column) -> Column:
    return F.concat(F.coalesce(subject, F.lit("")), F.lit(" "), body)


def lexical_translate(text: Column) -> Column:
    """English to Spanish by phrase table, then word table; punctuation is dropped."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    phrased = _replace_phrases(lowered, lx.PHRASES, fold_case=False)
    return F.array_join(F.transform(alphabet_words(phrased), lookup(lx.GLOSSARY)), " ")


def expand_then_translate(text: Column) -> Column:
    """Raw text: lower, expand, correct, translate."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return lexical_translate(_replace_words(lowered, {**lx.ABBREVIATIONS, **lx.TYPOS}))


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)\S")


def post_normalise(text: Column) -> Column:
    """Translate English left-overs and glue signal tokens together again."""
    phrased = _replace_phrases(F.coalesce(text, F.lit("")), lx.RESIDUAL_PHRASES, fold_case=True)
    worded = _replace_words(phrased, lx.RESIDUAL_WORDS, fold_case=True)

    def glue(bound: Column) -> Column:
        out = bound
        for second, whole in lx.SIGNAL_TOKEN_GLUE:
            out = F.regexp_replace(out, rf"(?iU)\btoken\s*{second}\b", whole)
        return F.when(F.contains(F.lower(bound), F.lit("token")), out).otherwise(bound)

    return let(worded, glue)


def _pack(pieces: Column, limit: int) -> Column:
    """Greedy packing: consecutive pieces share a block while it stays within limit.

    The fold carries the finished blocks and the open one; a piece longer than
    the limit keeps a block of its own.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("done"),
        F.lit(None).cast("string").alias("open"),
    )

    def step(acc: Column, piece: Column) -> Column:
        fits = F.length(acc["open"]) + 1 + F.length(piece) <= limit
        return (
            F.when(acc["open"].isNull(), F.struct(acc["done"].alias("done"), piece.alias("open")))
            .when(fits, F.struct(acc["done"].alias("done"),
                                 F.concat(acc["open"], F.lit(" "), piece).alias("open")))
            .otherwise(F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"),
                                piece.alias("open")))
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["open"].isNull(), acc["done"]).otherwise(
            F.concat(acc["done"], F.array(acc["open"])))

    return F.aggregate(pieces, start, step, finish)


def _pack_words(text: Column, limit: int) -> Column:
    """``_pack`` of the words of a text: a block is the longest run of whole words within limit, found as one match."""
    block = rf"(?s)[^ ](?:.{{0,{limit - 2}}}[^ ])?(?= |\z)|[^ ]+" if limit > 1 else "[^ ]+"
    return F.regexp_extract_all(F.array_join(words(text), " "), F.lit(block), 0)


def segment(text: Column, limit: int = FRAGMENT_CHARS) -> Column:
    """Fragments of at most ``limit`` characters that keep sentences whole.

    Sentences longer than the limit are packed by words first.
    """

    def split_long(sentence: Column) -> Column:
        return F.when(F.length(sentence) <= limit, F.array(sentence)).otherwise(
            _pack_words(sentence, limit))

    def fragments(bound: Column) -> Column:
        sentences = F.filter(
            F.transform(F.split(bound, r"(?U)(?<=[.!?\n;:])\s+"), strip), lambda s: s != "")
        blocks = _pack(F.flatten(F.transform(sentences, split_long)), limit)
        return (
            F.when(bound == "", F.array().cast("array<string>"))
            .when(F.length(bound) <= limit, F.array(bound))
            .otherwise(blocks)
        )

    return let(sanitise(text), fragments)


def plain_stop_words(stop_words: list[str]) -> list[str]:
    """The stop words that can be tokens: two or more word characters."""
    return sorted({w for w in stop_words if re.fullmatch(r"\w\w+", w)})


def model_tokens(clean: Column, stop_words: list[str]) -> Column:
    """Tokens of two or more word characters of a cleaned text, stop words removed."""
    stop = literals(plain_stop_words(stop_words))
    tokens = F.split(clean, " ")
    return F.filter(tokens, lambda t: (F.length(t) >= 2) & ~t.isin(stop))


def ngrams(tokens: Column, upto: int = 2) -> Column:
    """Unigrams, and adjacent pairs when ``upto`` is 2."""
    if upto == 1:
        return tokens

    def grams(bound: Column) -> Column:
        pairs = F.zip_with(
            bound, F.slice(bound, 2, F.greatest(F.size(bound) - 1, F.lit(0))),
            lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)))
        return F.concat(bound, F.filter(pairs, lambda p: p.isNotNull()))

    return let(tokens, grams)


def term_counts(terms: Column) -> Column:
    """array<term> -> array<struct<term, cnt>> inside the row.

    Run lengths of the sorted array: counting terms needs no shuffle.
    """

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(
            F.transform(ordered, lambda t, i: F.when(
                (i == 0) | (t != F.get(ordered, i - 1)), i)),
            lambda i: i.isNotNull())
        return let(starts, lambda s: F.transform(s, lambda p, k: F.struct(
            F.get(ordered, p).alias("term"),
            (F.coalesce(F.get(s, k + 1), n) - p).alias("cnt"))))

    return let(F.sort_array(terms), runs)


def char_grams(text: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """Character n-grams of a text.

    They are put together from the array of its characters, so the work grows
    with the length of the text and not with its square.
    """

    def of_size(chars: Column, n: int) -> Column:
        last = F.size(chars) - n
        gram = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                           lambda i: F.concat(*[F.get(chars, i + k) for k in range(n)]))
        return F.when(last >= 0, gram).otherwise(F.array().cast("array<string>"))

    def grams(chars: Column) -> Column:
        return F.concat(*[of_size(chars, n) for n in sizes])

    return let(F.filter(F.split(text, ""), lambda c: c != ""), grams)


def language_window(text: Column, window: int | None = LANGUAGE_WINDOW) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.lower(strip(F.substring(text, 1, window) if window else text))


def english_hint(text: Column) -> Column:
    """Fallback language: English when two or more hint words occur, else Spanish."""
    hits = F.array_intersect(
        F.array_distinct(words(F.lower(F.coalesce(text, F.lit(""))))),
        F.array(*[F.lit(w) for w in lx.ENGLISH_HINTS]))
    return F.when(F.size(hits) >= 2, "en").otherwise("es")
