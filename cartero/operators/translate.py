"""Translation dataflow English -> Spanish."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartero.functions import lexicons as lx
from cartero.functions import text as tx
from cartero.functions.expressions import compute_once

ID = "message_id"
Translator = Callable[[Column], Column]


def translate_lexical(df: DataFrame, text: str = "clean_en") -> DataFrame:
    """Whole texts by dictionary: ``texto_es``, one fragment each."""
    return df.withColumn("texto_es", tx.lexical_translate(F.col(text))).withColumn(
        "num_fragmentos", F.lit(1))


def translate_raw(df: DataFrame, text: str = "text") -> DataFrame:
    """Raw texts: expand, correct, translate; blank texts have no fragment."""
    return df.withColumn("texto_es", tx.expand_then_translate(F.col(text))).withColumn(
        "num_fragmentos", F.when(tx.is_blank(F.col(text)), 0).otherwise(1))


def translate_prefix(df: DataFrame, text: str = "clean_en", chars: int = tx.PREFIX_CHARS) -> DataFrame:
    """Fast mode: the leading characters only (a mode of its own, not a size guard)."""
    return df.withColumn("texto_es", tx.lexical_translate(F.substring(F.col(text), 1, chars))) \
        .withColumn("num_fragmentos", F.lit(1))


def fragments(df: DataFrame, text: str = "clean_en", ident: str = ID,
              limit: int = tx.FRAGMENT_CHARS) -> DataFrame:
    """(id, pos, fragmento): one row per sentence block; a blank text keeps one empty block."""
    blocks = tx.segment(F.col(text), limit)
    whole = F.when(F.size(blocks) == 0, F.array(F.lit(""))).otherwise(blocks)
    return df.select(ident, F.posexplode(whole).alias("pos", "fragmento"))


def translate_fragments(df: DataFrame, text: str = "clean_en", ident: str = ID,
                        translator: Translator = tx.lexical_translate,
                        limit: int = tx.FRAGMENT_CHARS) -> DataFrame:
    """Translate sentence blocks and put them together again: (id, texto_es, num_fragmentos).

    With a column translator the blocks never leave their row, so nothing is
    shuffled.  ``regroup_fragments`` is the form for translators that need one
    row per block.
    """
    blocks = F.transform(tx.segment(F.col(text), limit), translator)
    out = compute_once(df.select(ident, text), _blocks=blocks)
    return out.select(
        ident, tx.post_normalise(F.array_join("_blocks", " ")).alias("texto_es"),
        F.greatest(F.size("_blocks"), F.lit(1)).alias("num_fragmentos"))


def translate_fragments_by(df: DataFrame, batch_fn, text: str = "clean_en", ident: str = ID,
                           limit: int = tx.FRAGMENT_CHARS) -> DataFrame:
    """Same, with a translator that takes lists of texts (a heavy model).

    ``batch_fn(list[str]) -> list[str]`` runs over Arrow batches on the
    executors; blocks of different mails share batches.
    """

    def run(batches):
        for pdf in batches:
            yield pdf.assign(fragmento=batch_fn(pdf["fragmento"].tolist()))

    rows = fragments(df, text, ident, limit)
    return regroup_fragments(rows.mapInPandas(run, rows.schema), ident)


def bisected(batch_fn, texts: list[str]) -> list[tuple[str | None, str | None]]:
    """(translation, error) of every text.

    A batch that fails is halved until the texts that fail stand alone, so a failure costs two calls
    per halving and loses no neighbour.
    """
    if not texts:
        return []
    try:
        out = batch_fn(texts)
        if len(out) != len(texts):
            raise ValueError(f"{len(out)} translations of {len(texts)} texts")
        return [(t, None if t is not None else "no translation") for t in out]
    except Exception as e:  # whatever a model raises is the text's error
        if len(texts) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        half = len(texts) // 2
        return bisected(batch_fn, texts[:half]) + bisected(batch_fn, texts[half:])


def translate_fragments_safely(df: DataFrame, batch_fn, text: str = "clean_en", ident: str = ID,
                               limit: int = tx.FRAGMENT_CHARS) -> DataFrame:
    """Same, with a translator that may fail: (id, texto_es, num_fragmentos, fallos, error).

    A mail with a failed block has no ``texto_es``, the number of its failed blocks and the first
    error; ``safe_translate`` puts its own text in place.
    """

    def run(batches):
        for pdf in batches:
            done = bisected(batch_fn, pdf["fragmento"].tolist())
            yield pdf.assign(fragmento=[t for t, _ in done], error=[e for _, e in done])

    rows = fragments(df, text, ident, limit)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows = rows.mapInPandas(run, schema + ", error string")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "fragmento")))
    out = rows.groupBy(ident).agg(ordered.alias("_b"), F.count("error").alias("fallos"),
                                  F.min_by("error", F.when(F.col("error").isNotNull(), F.col("pos"))).alias("error"))
    whole = tx.post_normalise(F.array_join(F.col("_b.fragmento"), " "))
    return out.select(ident, F.when(F.col("fallos") == 0, whole).alias("texto_es"),
                      F.size("_b").alias("num_fragmentos"), "fallos", "error")


def regroup_fragments(rows: DataFrame, ident: str = ID) -> DataFrame:
    """(id, pos, fragmento) -> (id, texto_es, num_fragmentos), blocks in order.

    A group is the blocks of one mail, so it is as long as that mail.
    """
    ordered = F.array_sort(F.collect_list(F.struct("pos", "fragmento")))
    return rows.groupBy(ident).agg(ordered.alias("_b")).select(
        ident, tx.post_normalise(F.array_join(F.col("_b.fragmento"), " ")).alias("texto_es"),
        F.size("_b").alias("num_fragmentos"))


def safe_translate(df: DataFrame, translated: str = "traducido", text: str = "clean_en") -> DataFrame:
    """Failed rows (null translation) keep their original text and are flagged."""
    return df.withColumn("fallo", F.col(translated).isNull()).withColumn(
        "texto_es", F.coalesce(F.col(translated), F.col(text)))


def latest_prior(prior: DataFrame, order: str, ident: str = ID) -> DataFrame:
    """Last prior translation per key; ``order`` tells the versions of a key apart.

    Only key and order number are aggregated; texts are fetched afterwards.
    """
    newest = prior.groupBy(ident).agg(F.max(order).alias(order))
    return prior.join(newest, [ident, order], "left_semi").select(ident, "texto_es")


def incremental_patch(df: DataFrame, prior: DataFrame, text: str = "clean_en", ident: str = ID,
                      translator: Translator = tx.lexical_translate,
                      limit: int = tx.FRAGMENT_CHARS) -> DataFrame:
    """Keep prior translations; translate again what is long or has none.

    Adds ``texto_es``, ``num_fragmentos`` and ``rehecho``.
    """
    joined = df.join(prior.select(ident, F.col("texto_es").alias("_prev")), ident, "left")
    need = (F.length(text) > tx.PREFIX_CHARS) | tx.is_blank(F.col("_prev"))
    blocks = F.when(need, F.transform(tx.segment(F.col(text), limit), translator))
    out = compute_once(joined.withColumn("rehecho", need), _blocks=blocks)
    return out.withColumn("texto_es", F.when(
        F.col("rehecho"), tx.post_normalise(F.array_join("_blocks", " "))).otherwise(F.col("_prev"))
    ).withColumn("num_fragmentos", F.when(
        F.col("rehecho"), F.greatest(F.size("_blocks"), F.lit(1))).otherwise(F.lit(1))
    ).drop("_prev", "_blocks")


def patch_report(patched: DataFrame) -> DataFrame:
    return patched.agg(F.count_if(~F.col("rehecho")).alias("conservados"),
                       F.count_if("rehecho").alias("rehechos"))


def pending(df: DataFrame, done: DataFrame, ident: str = ID) -> DataFrame:
    """Rows without a finished result."""
    return df.join(done.select(ident), ident, "left_anti")


def resume(df: DataFrame, done: DataFrame, work: Callable[[DataFrame], DataFrame],
           ident: str = ID) -> DataFrame:
    """Finished results plus the results of the rows still open."""
    return done.unionByName(work(pending(df, done, ident)).select(*done.columns))


def translated_corpus(df: DataFrame, text: str = "clean_en") -> DataFrame:
    """The whole stage in dictionary mode."""
    rows = df.withColumn(text, tx.sanitise(F.col(text)))
    rows = compute_once(rows, traducido=tx.lexical_translate(F.col(text)))
    rows = safe_translate(rows, text=text).drop("traducido", "fallo")
    return rows.withColumn("num_fragmentos", F.lit(1)).withColumn(
        "longitud_es", F.length("texto_es"))


def length_parity(df: DataFrame, text: str = "clean_en", translated: str = "texto_es") -> DataFrame:
    """Length correlation and ratios, source against translation."""
    a, b = F.length(text).cast("double"), F.length(translated).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.corr(a, b).alias("correlacion"),
        F.avg(b / F.when(a > 0, a)).alias("razon_media"),
        F.count_if(b > a).alias("mas_largos"))


def examples_per_language(df: DataFrame, lang: str = "idioma_detectado", ident: str = ID,
                          main: str = "en", n_main: int = 10, n_other: int = 3,
                          n_plain: int = 30) -> DataFrame:
    """First rows per language; the constant bound on the rank lets every task keep its own top rows.

    Without a language column, the first ``n_plain`` rows.
    """
    if lang not in df.columns:
        return df.orderBy(ident).limit(n_plain)
    rank = F.row_number().over(Window.partitionBy(lang).orderBy(ident))
    top = df.withColumn("orden", rank).filter(F.col("orden") <= max(n_main, n_other))
    return top.filter(F.col("orden") <= F.when(F.col(lang) == main, n_main).otherwise(n_other))


def translation_validation(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("filas"), F.count("texto_es").alias("traducidas"),
        F.round(F.avg("num_fragmentos"), 2).alias("fragmentos_media"),
        F.max("num_fragmentos").alias("fragmentos_max"))


def glossary(spark) -> DataFrame:
    """Abbreviation table with its Spanish equivalents, '' where there is none."""
    abbr = spark.createDataFrame(sorted(lx.ABBREVIATIONS.items()), "abreviatura_en string, expansion_en string")
    es = spark.createDataFrame(sorted(lx.ABBREVIATIONS_ES.items()), "abreviatura_en string, equivalente_es string")
    return abbr.join(F.broadcast(es), "abreviatura_en", "left").na.fill("", ["equivalente_es"])


def glossary_export(df: DataFrame, text: str = "text") -> DataFrame:
    """The abbreviation table with its number of uses in a corpus."""
    token = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"(?U)(\w+)"), 1))
    hits = df.select(token.alias("abreviatura_en")).filter(
        F.col("abreviatura_en").isin(sorted(lx.ABBREVIATIONS)))
    uses = hits.groupBy("abreviatura_en").agg(F.count(F.lit(1)).alias("usos"))
    return glossary(df.sparkSession).join(uses, "abreviatura_en", "left").na.fill(0, ["usos"])


