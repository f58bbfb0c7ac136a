"""Text normalisation stage and language identification."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartero.functions import grams
from cartero.functions import lexicons as lx
from cartero.functions import text as tx
from cartero.functions.expressions import compute_once
from cartero.operators.ranking import top_per_group
from cartero.sources.mail import write_stage

ID = "message_id"
UNKNOWN = "desconocido"
BLANK = "es"           # language of a blank mail at scoring time
MAX_LANGUAGES = 200    # more codes than this are taken for an error in the column
SERVED_PROFILE = 100_000  # n-grams of a language that the serving model tells apart
MAX_PROFILE = 2_000_000   # n-grams of all languages that are sent to every task


def normalise(df: DataFrame, text: str = "Message", keep_short: bool = False) -> DataFrame:
    """Add ``clean_en``, ``long_clean`` and ``num_palabras_clean``; drop what cleans to <= 5 chars."""
    body = F.col(text)
    if "subject" in df.columns:
        body = tx.subject_and_body(F.col("subject"), body)
    out = compute_once(df, clean_en=tx.clean_text(body))
    out = (out.withColumn("long_clean", F.length("clean_en"))
           .withColumn("num_palabras_clean", tx.word_count(F.col("clean_en"))))
    return out if keep_short else out.filter(F.length("clean_en") > tx.MIN_CHARS)


def signal_counts(df: DataFrame, by: str = "Category", text: str = "clean_en") -> DataFrame:
    """Occurrences of each signal token by class (substring count), one scan."""
    sums = df.groupBy(by).agg(*[
        F.sum(F.regexp_count(F.col(text), F.lit(t))).alias(t) for t in lx.SIGNAL_TOKENS])
    return sums.unpivot([by], lx.SIGNAL_TOKENS, "token", "ocurrencias")


# ------------------------------------------------------------- language profiles
@dataclass(frozen=True)
class LanguageModel:
    """Character n-gram log-probabilities per language.

    ``profile`` has one row per n-gram (its key) and one column per language with the gain
    over an unseen n-gram; ``floor`` is one row with the unseen log-probability.
    Its rows are bounded by ``languages x profile_size``.
    """

    profile: DataFrame
    floor: DataFrame
    languages: tuple[str, ...]
    profile_size: int
    sizes: tuple[int, ...]

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys, gains) for the tasks; the number of rows is checked first."""
        n = self.profile.count()
        if n > MAX_PROFILE:
            raise ValueError(f"a profile of {n} n-grams is too large to send to every task; lower profile_size")
        rows = self.profile.toPandas().sort_values("g")  # at most MAX_PROFILE rows
        return rows["g"].to_numpy(np.int64), rows[list(self.languages)].to_numpy(np.float64)


def train_languages(df: DataFrame, text: str = "text", lang: str = "lang",
                    sizes: tuple[int, ...] = (1, 2, 3), profile_size: int = 5000,
                    smoothing: float = 0.5, window: int | None = tx.LANGUAGE_WINDOW,
                    languages: tuple[str, ...] | None = None) -> LanguageModel:
    """Count n-grams per language and keep each language's most frequent ones.

    ``window=None`` learns from whole texts.  The list of languages is read from the data when it is
    not given; a column of more than ``MAX_LANGUAGES`` codes is refused.
    """
    df = df.filter(F.col(lang).isNotNull())
    texts = df.select(F.col(lang).alias("idioma"), tx.language_window(F.col(text), window).alias("_t"))
    counts = texts.mapInArrow(grams.counter(sizes), grams.COUNTS).groupBy("idioma", "g").agg(F.sum("n").alias("n"))
    top = top_per_group(counts, "idioma", "n", "g", profile_size)
    if languages is None:
        codes = df.select(lang).distinct().limit(MAX_LANGUAGES + 1).collect()
        if len(codes) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages in column {lang}")
        languages = tuple(sorted(r[0] for r in codes))
    wide = write_stage(top.groupBy("g").agg(*[
        F.sum(F.when(F.col("idioma") == x, F.col("n")).otherwise(0)).alias(x) for x in languages]), "profile")
    totals = wide.agg(F.count(F.lit(1)).alias("_v"), *[F.sum(x).alias(f"_{x}") for x in languages])
    floor = totals.select(*[
        (F.log(F.lit(smoothing)) - F.log(F.col(f"_{x}") + smoothing * F.col("_v"))).alias(x)
        for x in languages])
    profile = wide.select("g", *[
        (F.log(F.col(x) + smoothing) - F.log(F.lit(smoothing))).alias(x) for x in languages])
    return LanguageModel(profile, floor, languages, profile_size, sizes)


def train_whole_texts(df: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """The model that serves: whole texts, and all n-grams up to ``SERVED_PROFILE`` of a language."""
    return train_languages(df, text, lang, profile_size=SERVED_PROFILE, window=None)


def add_language(df: DataFrame, model: LanguageModel, text: str = "text",
                 window: int | None = tx.LANGUAGE_WINDOW) -> DataFrame:
    """``df`` with ``idioma_detectado``: best-scoring language, ``desconocido`` for very short texts.

    ``window=None`` looks at the whole text.  Rows are scored where they are: nothing is
    shuffled, and the profile is sent to every task once.
    """
    langs, floor = model.languages, model.floor.first()
    profile = df.sparkSession.sparkContext.broadcast(model.arrays())
    row = F.struct(*df.columns).alias("_row")
    cut = df.select(row, tx.language_window(F.col(text), window).alias("_t"))
    schema = T.StructType([cut.schema["_row"], *T.StructType.fromDDL(grams.SUMS)])
    scored = cut.mapInArrow(grams.scorer(model.sizes, profile, len(langs)), schema)
    best = F.array_max(F.array(*[
        F.struct(F.round(F.col("_sums")[i] + F.col("_n") * F.lit(floor[x]), 6).alias("s"),
                 F.lit(-i).alias("o"), F.lit(x).alias("l")) for i, x in enumerate(langs)]))["l"]
    short = F.col("_n") < grams.gram_number(tx.LANGUAGE_MIN_CHARS, model.sizes)  # the number grows with the length
    return scored.select("_row.*", F.when(short, UNKNOWN).otherwise(best).alias("idioma_detectado"))


def detect_language(df: DataFrame, model: LanguageModel, text: str = "text", ident: str = ID,
                    window: int | None = tx.LANGUAGE_WINDOW) -> DataFrame:
    """(id, idioma_detectado)."""
    return add_language(df.select(ident, text), model, text, window).select(ident, "idioma_detectado")


def add_mail_language(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` with ``idioma_detectado`` at scoring time, from the whole text.

    A blank mail counts as Spanish; one that is very short or has no letter is
    told by its English hint words.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    told = body.rlike(r"\p{L}") & (F.col("idioma_detectado") != UNKNOWN)
    return add_language(df, model, text, None).withColumn(
        "idioma_detectado", F.when(tx.strip(body) == "", BLANK).when(told, F.col("idioma_detectado")).otherwise(tx.english_hint(body)))


def detect_mail_language(df: DataFrame, model: LanguageModel, text: str = "text", ident: str = ID) -> DataFrame:
    """(id, idioma_detectado) at scoring time."""
    return add_mail_language(df.select(ident, text), model, text).select(ident, "idioma_detectado")


def language_census(df: DataFrame, column: str = "idioma_detectado") -> DataFrame:
    """(idioma_iso, conteo, porcentaje with two decimals)."""
    n = df.groupBy(F.col(column).alias("idioma_iso")).agg(F.count(F.lit(1)).alias("conteo"))
    total = F.sum("conteo").over(Window.partitionBy())
    return n.withColumn("porcentaje", F.round(F.col("conteo") * 100.0 / total, 2))


def top_languages(census: DataFrame, k: int = 8) -> DataFrame:
    return census.orderBy(F.desc("conteo"), "idioma_iso").limit(k)


def nlp_corpus(df: DataFrame, model: LanguageModel) -> DataFrame:
    """The whole normalisation stage on a clean corpus."""
    return normalise(add_language(df, model, "Message"))
