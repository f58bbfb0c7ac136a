"""Multinomial Naive Bayes on TF-IDF weights, as aggregates over the long table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartero.functions import terms as in_tasks
from cartero.functions.expressions import BROADCAST_ROWS, ratio
from cartero.functions.text import ngrams
from cartero.operators.features import ID, MAX_FEATURES, MODEL, by_key, term_arrays, tfidf, vocabulary
from cartero.sources.mail import write_stage

ALPHA = 0.1
THRESHOLDS = list(range(20, 86, 5))     # in cents: 0.20 .. 0.85
BETA = 0.5


@dataclass(frozen=True)
class NaiveBayes:
    """``counts``: (modelo, term, idf, w_ham, w_spam); ``priors``: (modelo, n_ham, n_spam).

    Both are additive, so teaching a model is adding rows.  ``max_rows`` is
    models x vocabulary size and bounds the broadcast of the weights.
    """

    counts: DataFrame
    priors: DataFrame
    max_rows: int
    alpha: float = ALPHA

    def save(self, path: str) -> None:
        self.counts.write.mode("overwrite").parquet(f"{path}/counts")
        self.priors.write.mode("overwrite").parquet(f"{path}/priors")
        meta = self.priors.sparkSession.createDataFrame(
            [(self.max_rows, float(self.alpha))], "max_rows long, alpha double")
        meta.write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "NaiveBayes":
        meta = spark.read.parquet(f"{path}/meta").first()
        return NaiveBayes(spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/priors"),
                          meta["max_rows"], meta["alpha"])


def class_sums(rows: DataFrame, keys: list[str], value: Column, label: str = "Label_Code") -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum(F.when(F.col(label) == 0, value).otherwise(0.0)).alias("w_ham"),
        F.sum(F.when(F.col(label) == 1, value).otherwise(0.0)).alias("w_spam"))


def class_counts(features: DataFrame) -> DataFrame:
    return features.groupBy(MODEL).agg(F.count_if(F.col("Label_Code") == 0).alias("n_ham"),
                                       F.count_if(F.col("Label_Code") == 1).alias("n_spam"))


def train(features: DataFrame, max_features: int = MAX_FEATURES, alpha: float = ALPHA,
          models: int = 1, vocab: DataFrame | None = None) -> NaiveBayes:
    """Train every model of the stack.  The small count tables are written once.

    ``vocab`` is the written vocabulary (modelo, term, idf) of the features, if it is known already.
    """
    bound = models * max_features
    if vocab is None:
        vocab = write_stage(vocabulary(features, max_features), "vocab")
    weights = unit_sums(features, vocab, bound)
    side = weights if bound > 1_000_000 else F.broadcast(weights)
    counts = vocab.select(MODEL, "term", "idf").join(side, [MODEL, "term"], "left").na.fill(
        0.0, ["w_ham", "w_spam"])
    return NaiveBayes(write_stage(counts, "nb_counts"), class_counts(features), bound, alpha)


def unit_sums(features: DataFrame, vocab: DataFrame, bound: int) -> DataFrame:
    """(modelo, term, w_ham, w_spam): the TF-IDF weights of unit-length mails, added up by class.

    A mail is weighted where it is and a task sends one row per term; the vocabulary (at most BROADCAST_ROWS
    rows) is sent to every task.  Mails that share their key have one length, and a larger vocabulary is joined.
    """
    def joined(rows: DataFrame) -> DataFrame:
        return class_sums(tfidf(rows, vocab, bound, "Label_Code"), [MODEL, "term"], F.col("x"))

    if bound > BROADCAST_ROWS:
        return joined(features)
    tables = {m: (terms, idf, [-1]) for m, (terms, idf) in term_arrays(vocab, ["idf"]).items()}
    once, shared = by_key(features)
    rows = once.select(MODEL, "Label_Code", F.lit(None).cast("int").alias("pliegue"), "rasgos")
    sent = features.sparkSession.sparkContext.broadcast(tables)
    sums = rows.mapInArrow(in_tasks.class_adder(sent), "modelo string, term string, _0_0 double, _1_0 double").toDF(
        MODEL, "term", "w_ham", "w_spam")
    if shared is not None:
        sums = sums.unionByName(joined(shared))
    return sums.groupBy(MODEL, "term").agg(F.sum("w_ham").alias("w_ham"), F.sum("w_spam").alias("w_spam"))


def log_probs(model: NaiveBayes) -> DataFrame:
    """(modelo, term, idf, lp_ham, lp_spam); unseen terms of a class get alpha."""
    whole = Window.partitionBy(MODEL)
    v = F.count(F.lit(1)).over(whole)

    def lp(w: str) -> Column:
        return F.log((F.col(w) + model.alpha) / (F.sum(w).over(whole) + model.alpha * v))

    return model.counts.select(MODEL, "term", "idf", lp("w_ham").alias("lp_ham"),
                               lp("w_spam").alias("lp_spam"))


def log_priors(model: NaiveBayes) -> DataFrame:
    return model.priors.select(MODEL, F.log(F.col("n_spam") / F.col("n_ham").cast("double")).alias("sesgo"))


def score(features: DataFrame, model: NaiveBayes, *carry: str) -> DataFrame:
    """(modelo, id, carried, p_spam).  Mails without a known term get the prior.

    A mail's two sums are made where the mail is and one narrow row per mail moves; the weights are sent
    to every task, and a larger model is joined instead.
    """
    weights = log_probs(model).select(
        MODEL, "term", "idf", (F.col("lp_spam") - F.col("lp_ham")).alias("peso"))
    if model.max_rows > BROADCAST_ROWS:
        x = (1.0 + F.log(F.col("cnt").cast("double"))) * F.col("idf")
        sums = features.select(MODEL, ID, *carry, F.inline_outer("rasgos")).join(weights, [MODEL, "term"], "left").select(
            MODEL, ID, *carry, (x * F.col("peso")).alias("_d0_0"), (x * x).alias("_q0"))
    else:
        tables = {m: (terms, v[:, :1], v[:, 1:, None]) for m, (terms, v) in term_arrays(weights, ["idf", "peso"]).items()}
        sums = added_mails(features.select(F.struct(MODEL, ID, *carry).alias("_row"), MODEL, "rasgos"), tables, ["_q0", "_d0_0"])
    sums = sums.groupBy(MODEL, ID, *carry).agg(F.sum("_d0_0").alias("_dot"), F.sum("_q0").alias("_sq"))
    margin = F.col("sesgo") + F.coalesce(F.try_divide(F.col("_dot"), F.sqrt("_sq")), F.lit(0.0))
    return sums.join(F.broadcast(log_priors(model)), MODEL).select(
        MODEL, ID, *carry, (1.0 / (1.0 + F.exp(-margin))).alias("p_spam"))


def added_mails(rows: DataFrame, tables: dict, names: list[str]) -> DataFrame:
    """The columns of ``_row`` with the sums of ``terms.mail_adder``."""
    schema = T.StructType([rows.schema["_row"], *[T.StructField(n, T.DoubleType()) for n in names]])
    sent = rows.sparkSession.sparkContext.broadcast(tables)
    return rows.mapInArrow(in_tasks.mail_adder(sent), schema).select("_row.*", *names)


def predict(scored: DataFrame, threshold: Column | float) -> DataFrame:
    """1 where p_spam reaches the threshold (inclusive)."""
    th = F.lit(threshold) if isinstance(threshold, float) else threshold
    return scored.withColumn("pred", (F.col("p_spam") >= th).cast("int"))


def partial_fit(model: NaiveBayes, features: DataFrame) -> NaiveBayes:
    """Add labelled mails to the counts; vocabulary and idf stay as they are."""
    gained = tfidf(features, model.counts, model.max_rows, "Label_Code")
    return add_counts(model, class_sums(gained, [MODEL, "term"], F.col("x")), class_counts(features))


def add_counts(model: NaiveBayes, terms: DataFrame, docs: DataFrame) -> NaiveBayes:
    known = model.counts.select(MODEL, "term", "idf", "w_ham", "w_spam")
    more = terms.select(MODEL, "term", F.lit(None).cast("double").alias("idf"), "w_ham", "w_spam")
    counts = known.unionByName(more).groupBy(MODEL, "term").agg(
        F.max("idf").alias("idf"), F.sum("w_ham").alias("w_ham"), F.sum("w_spam").alias("w_spam")
    ).filter(F.col("idf").isNotNull())
    priors = model.priors.unionByName(docs).groupBy(MODEL).agg(
        F.sum("n_ham").alias("n_ham"), F.sum("n_spam").alias("n_spam"))
    return NaiveBayes(counts, priors, model.max_rows, model.alpha)


# ------------------------------------------------------------------- thresholds
def threshold_table(scored: DataFrame, beta: float = BETA, cents: list[int] | None = None) -> DataFrame:
    """(modelo, umbral, tp, fp, fn, fbeta) for each candidate threshold.

    Scores are counted by the number of thresholds they reach, so the scan
    emits one row per mail and not one per mail and threshold.
    """
    cents = cents or THRESHOLDS
    reached = sum(((F.col("p_spam") >= c / 100.0).cast("int") for c in cents), F.lit(0))
    cells = scored.groupBy(MODEL, reached.alias("_r"), "Label_Code").agg(F.count(F.lit(1)).alias("_n"))
    grid = F.inline(F.array(*[F.struct(F.lit(i + 1).alias("_i"), F.lit(c / 100.0).alias("umbral"))
                              for i, c in enumerate(cents)]))
    hit, spam = F.col("_r") >= F.col("_i"), F.col("Label_Code") == 1
    sums = cells.select("*", grid).groupBy(MODEL, "umbral").agg(
        *[F.sum(F.when(cond, F.col("_n")).otherwise(0)).alias(name) for name, cond in
          (("tp", hit & spam), ("fp", hit & ~spam), ("fn", ~hit & spam))])
    b2 = beta * beta
    return sums.withColumn("fbeta", ratio(
        (1 + b2) * F.col("tp"), (1 + b2) * F.col("tp") + b2 * F.col("fn") + F.col("fp")))


def calibrate_threshold(scored: DataFrame, beta: float = BETA, cents: list[int] | None = None) -> DataFrame:
    """(modelo, umbral, fbeta): best F-beta, smallest threshold on ties."""
    best = F.max_by(F.struct("umbral", "fbeta"),
                    F.struct(F.round("fbeta", 9), -F.col("umbral"))).alias("b")
    return threshold_table(scored, beta, cents).groupBy(MODEL).agg(best).select(
        MODEL, F.col("b.umbral").alias("umbral"), F.round("b.fbeta", 4).alias("fbeta"))


# --------------------------------------------------------------- explainability
def term_weights(model: NaiveBayes) -> DataFrame:
    """(modelo, term, peso): log-odds, fixed at 9 decimals so that ties are ties."""
    return log_probs(model).select(
        MODEL, "term", F.round(F.col("lp_spam") - F.col("lp_ham"), 9).alias("peso"))


def top_terms(weights: DataFrame, k: int = 60) -> DataFrame:
    """(modelo, clase, rango, term, peso): strongest terms per class, ham sign-flipped."""
    out = None
    for clase, sign in (("spam", 1.0), ("ham", -1.0)):
        w = weights.select(MODEL, F.lit(clase).alias("clase"), "term", (F.col("peso") * sign).alias("peso"))
        rank = F.row_number().over(Window.partitionBy(MODEL).orderBy(F.desc("peso"), "term"))
        part = w.withColumn("rango", rank).filter(F.col("rango") <= k)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("peso", F.round("peso", 3))


def explain(mails: DataFrame, text: str, weights: DataFrame, max_rows: int, k: int = 6,
            ident: str = ID) -> DataFrame:
    """(modelo, id, tokens_spam, tokens_ham): the mail's strongest known grams each way.

    Candidates are distinct words and adjacent pairs, stop words included.  They are found where the mail
    is; mails that share their key are explained as one by joins, as all are by a model too large to be sent.
    """
    if max_rows > BROADCAST_ROWS:
        return _explain_by_joins(mails, text, weights, k, ident)
    tables = {}
    for m, (terms, v) in term_arrays(weights.orderBy("term"), ["peso"]).items():
        tables[m] = terms.to_pylist(), np.zeros(len(v)), np.zeros(len(v)), v[:, 0]
    once, shared = by_key(mails if ident == ID else mails.withColumn(ID, F.col(ident)))
    rows = once.select(F.struct(MODEL, ident).alias("_row"), MODEL, F.col(text).alias("texto_procesado"))
    sent = mails.sparkSession.sparkContext.broadcast((tables, {None: 0.0}))
    out = scored_mails(rows, in_tasks.mail_scorer(sent, {None: (frozenset(), 1)}, True, k)).select(MODEL, ident, "tokens_spam", "tokens_ham")
    return out if shared is None else out.unionByName(_explain_by_joins(shared, text, F.broadcast(weights), k, ident))


def scored_mails(rows: DataFrame, scorer) -> DataFrame:
    """The columns of ``_row`` with p_spam, tokens_spam and tokens_ham of ``terms.mail_scorer``."""
    schema = T.StructType([rows.schema["_row"], *T.StructType.fromDDL(f"p_spam double, _spam {in_tasks.GRAMS}, _ham {in_tasks.GRAMS}")])
    out = rows.mapInArrow(scorer, schema).select("_row.*", "p_spam", "_spam", "_ham")
    for side, pattern in (("spam", "%s (+%.2f)"), ("ham", "%s (%.2f)")):
        out = out.withColumn(f"tokens_{side}", F.transform(f"_{side}", lambda s: F.format_string(pattern, s["term"], s["peso"])))
    return out.drop("_spam", "_ham")


def _explain_by_joins(mails: DataFrame, text: str, weights: DataFrame, k: int, ident: str) -> DataFrame:
    found = F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([a-záéíóúñü0-9_]+)"), 1)
    grams = mails.select(MODEL, ident, F.explode_outer(F.array_distinct(ngrams(found, 2))).alias("term"))
    hits = grams.join(weights, [MODEL, "term"], "left").groupBy(MODEL, ident).agg(
        F.collect_list(F.when(F.col("peso").isNotNull(), F.struct("peso", "term"))).alias("_w"))

    def pick(sign: int, pattern: str) -> Column:
        chosen = F.filter("_w", lambda s: s["peso"] * sign > 0)
        keyed = F.transform(chosen, lambda s: F.struct(
            (s["peso"] * -sign).alias("o"), s["term"].alias("t"), s["peso"].alias("p")))
        return F.transform(F.slice(F.array_sort(keyed), 1, k),
                           lambda s: F.format_string(pattern, s["t"], s["p"]))

    return hits.select(MODEL, ident, pick(1, "%s (+%.2f)").alias("tokens_spam"),
                       pick(-1, "%s (%.2f)").alias("tokens_ham"))
