"""Scoring: language routing, full prediction record, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartero.functions import terms as in_tasks
from cartero.functions import text as tx
from cartero.functions.expressions import BROADCAST_ROWS, compute_once, hash_order
from cartero.operators import bayes
from cartero.operators.features import ID, MODEL, stop_words, terms
from cartero.sources.mail import write_stage

MIN_TOKENS = 4        # up to this many tokens a mail says too little
GREY_MARGIN = 0.15    # closer to the threshold than this is a grey zone
# FIXED VALUES: texts of the prediction record.
UNCERTAIN = "INCIERTO (Falta información)"
ROUTE_EN = "Inglés (Directo - Modelo Nativo EN)"
ROUTE_ES = "Español (Directo - Modelo Nativo ES)"
ROUTE_OTHER = "Español (Detectado %s, Traducido a ES)"
TOO_SHORT = "Información insuficiente: correo muy escueto (%d tokens tras limpieza)."
GREY_ZONE = "Zona gris de incertidumbre: probabilidad P(Spam)=%.3f muy cercana al umbral (%.2f)."


def model_of(lang: Column) -> Column:
    """The model that serves and learns a language: English has its own, all others share the Spanish one."""
    return F.when(lang == "en", "en").otherwise("es")


def route(df: DataFrame, text: str = "text", lang: str = "idioma_detectado",
          force_english: bool = False) -> DataFrame:
    """Add ``modelo``, ``idioma_modelo`` and ``texto_procesado``.

    English and Spanish go to their own model as they are; any other language is
    translated, cleaned and sent to the Spanish model.
    """
    code = F.lit("en") if force_english else F.col(lang)
    native = code.isin("en", "es")
    source = F.when(native, F.col(text)).otherwise(tx.expand_then_translate(F.col(text)))
    out = compute_once(df.withColumn(lang, code), texto_procesado=tx.clean_text(source))
    return out.withColumn(MODEL, model_of(F.col(lang))).withColumn(
        "idioma_modelo", F.when(F.col(lang) == "en", ROUTE_EN).when(F.col(lang) == "es", ROUTE_ES)
        .otherwise(F.format_string(ROUTE_OTHER, F.upper(F.col(lang)))))


def routed_features(routed: DataFrame, *carry: str) -> DataFrame:
    """Terms by the rules of the model a mail is routed to."""
    text = F.col("texto_procesado")
    rasgos = F.when(F.col(MODEL) == "en", tx.term_counts(terms(text, stop_words("en"), 2))).otherwise(
        tx.term_counts(terms(text, stop_words("es"), 1)))
    out = compute_once(routed.select(MODEL, ID, *carry, "texto_procesado"), rasgos=rasgos)
    return out.select(MODEL, ID, *carry, "rasgos")


def term_rules() -> dict[str | None, tuple[frozenset[str], int]]:
    """Stop words and longest n-gram of the served models; the key None stands for all but the English one."""
    return {m: (frozenset(tx.plain_stop_words(stop_words(m or "es"))), n) for m, n in (("en", 2), (None, 1))}


def token_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, " "), lambda t: F.length(t) > 1))


def certainty(df: DataFrame) -> DataFrame:
    """Tentative and final label, uncertainty flag and reason from p_spam and umbral."""
    n, p, th = token_count(F.col("texto_procesado")), F.col("p_spam"), F.col("umbral")
    out = df.withColumn("_n", n).withColumn("etiqueta_tentativa", F.when(p >= th, "SPAM").otherwise("HAM"))
    short, grey = F.col("_n") <= MIN_TOKENS, F.abs(p - th) < GREY_MARGIN
    return out.withColumn("es_incierto", short | grey).withColumn(
        "motivo_incertidumbre", F.when(short, F.format_string(TOO_SHORT, F.col("_n")))
        .when(grey, F.format_string(GREY_ZONE, p, th)).otherwise("")).withColumn(
        "etiqueta", F.when(F.col("es_incierto"), UNCERTAIN).otherwise(F.col("etiqueta_tentativa"))).drop("_n")


def score_mails(routed: DataFrame, model: bayes.NaiveBayes, explain: bool = True, k: int = 6) -> DataFrame:
    """``routed`` with p_spam, and with the ``k`` strongest known grams of each mail and class.

    Words, pairs and weights of a mail meet where the mail is: its two sums and its two
    bounded lists of strongest grams are kept while it is read once, and nothing is shuffled.  The
    weights (at most BROADCAST_ROWS rows) are sent to every task once; a larger
    model is joined instead.
    """
    if model.max_rows > BROADCAST_ROWS:
        return _score_by_joins(write_stage(routed, "routed"), model, explain, k)
    table = bayes.log_probs(model).select(
        MODEL, "term", "idf", (F.col("lp_spam") - F.col("lp_ham")).alias("w")).withColumn("peso", F.round("w", 9))
    weights = {m: (terms.to_pylist(), *v.T) for m, (terms, v) in bayes.term_arrays(table.orderBy("term"), ["idf", "w", "peso"]).items()}
    bias = {r[MODEL]: r["sesgo"] for r in bayes.log_priors(model).collect()}
    sent = routed.sparkSession.sparkContext.broadcast((weights, bias))
    rules = {m: (frozenset(stop_words(m)), n) for m, n in (("en", 2), ("es", 1))}
    rows = routed.select(F.struct(*routed.columns).alias("_row"), MODEL, "texto_procesado")
    out = bayes.scored_mails(rows, in_tasks.mail_scorer(sent, rules, explain, k))
    return out if explain else out.drop("tokens_spam", "tokens_ham")


def _score_by_joins(routed: DataFrame, model: bayes.NaiveBayes, explain: bool, k: int) -> DataFrame:
    """The same for models too large to be sent to every task; mails are told apart by their id."""
    out = routed.join(bayes.score(routed_features(routed), model), [MODEL, ID])
    if explain:
        out = out.join(bayes.explain(routed, "texto_procesado", bayes.term_weights(model), model.max_rows, k), [MODEL, ID])
    return out


def predict_batch(routed: DataFrame, model: bayes.NaiveBayes, thresholds: DataFrame,
                  explain: bool = True) -> DataFrame:
    """The full prediction record of routed mails; probabilities keep nine decimals.

    ``thresholds`` has one row per model.
    """
    out = score_mails(routed, model, explain).join(F.broadcast(thresholds.select(MODEL, "umbral")), MODEL)
    out = out.withColumn("p_spam", F.round("p_spam", 9))
    out = certainty(out).withColumn("p_ham", F.round(1.0 - F.col("p_spam"), 9))
    if explain:
        out = out.withColumn("explicacion", F.struct("tokens_spam", "tokens_ham")).drop("tokens_spam", "tokens_ham")
    return out


def bank_audit(cases: DataFrame, expected: str = "etiqueta_esperada") -> DataFrame:
    return cases.withColumn("resultado", F.when(
        F.upper("etiqueta_tentativa") == F.upper(expected), "PASS").otherwise("FAIL"))


def audit_summary(audited: DataFrame, by: str = "categoria") -> DataFrame:
    """(category or TOTAL, aciertos, total, tasa): one aggregate with grouping sets."""
    hit = F.count_if(F.col("resultado") == "PASS")
    out = audited.groupingSets([[], [by]], by).agg(
        F.grouping_id().alias("_g"), hit.alias("aciertos"), F.count(F.lit(1)).alias("total"))
    return out.select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col(by)).alias(by), "aciertos", "total",
                      F.round(F.col("aciertos") * 100.0 / F.col("total"), 1).alias("tasa"))


def pool_validation(cases: DataFrame, expected: str = "esperado") -> DataFrame:
    return cases.withColumn("validacion", F.when(F.col("es_incierto"), "ZONA GRIS")
                            .when(F.col("etiqueta") == F.col(expected), "ACIERTO").otherwise("FALLO"))


def catalogue(df: DataFrame, kind: str = "todos", chars: int = tx.CATALOGUE_CHARS) -> DataFrame:
    """Listing with shortened fields, of one ``subcategoria`` or of all."""
    rows = df if kind == "todos" else df.filter(F.col("subcategoria") == kind)
    return rows.select(ID, "subcategoria", "idioma", F.substring("categoria", 1, chars).alias("categoria"),
                       F.substring("asunto", 1, chars).alias("asunto"))


def catalogue_pick(df: DataFrame, ident: str = ID, seed: int | str = 42) -> DataFrame:
    """One pseudo-random entry (smallest hash position)."""
    return df.orderBy(hash_order(F.col(ident), seed), ident).limit(1)


def uncertain_archive(pred: DataFrame, text: str, timestamp: Column) -> DataFrame:
    """Uncertain cases for review; the model is left alone."""
    return pred.filter("es_incierto").select(
        timestamp.alias("timestamp"), F.upper("idioma_detectado").alias("idioma"),
        F.format_string("%.3f", "p_spam").alias("p_spam"), F.format_string("%.2f", "umbral").alias("umbral"),
        F.col("motivo_incertidumbre").alias("motivo"), F.col(text).alias("texto_original"),
        "texto_procesado")
