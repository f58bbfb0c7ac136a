"""Every operator of the engine as a query over the given tables.

``SPECS`` states the result columns of each query: l long, s string, b boolean,
dN double with N decimals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartero.functions import lexicons as lx
from cartero.functions import text as tx
from cartero.functions.expressions import hash_order
from cartero.operators import (bayes, clean, diagnostics, evaluate, features, history, logistic,
                               normalise, registry, sampling, score, selection, store, translate)
from cartero.plans.tables import documents, feedback, feedback_events, feedback_texts, keyed_feedback, raw_mail, table
from cartero.sources import mail
from cartero.streaming import feedback as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SPECS: dict[str, str] = {}
ID = "message_id"


def shape(df: DataFrame, spec: str) -> DataFrame:
    """Select and type the result columns."""
    cols = []
    for item in spec.split():
        name, kind = item.split(":")
        c = F.col(name)
        if kind == "l":
            c = c.cast("long")
        elif kind.startswith("d"):
            c = F.round(c.cast("double"), int(kind[1:])) + F.lit(0.0)
        cols.append(c.alias(name))
    return df.select(*cols)


def query(spec: str):
    def register(fn: Query) -> Query:
        name = fn.__name__
        SPECS[name] = spec
        QUERIES[name] = lambda spark, d: shape(fn(spark, d), spec)
        return fn
    return register


def joined(c, sep: str = " | "):
    return F.array_join(c, sep)


def pick(values: list[str]):
    """One of ``values`` by row id, to put rare words into the given texts."""
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col(ID) % len(values)).cast("int"))


def labelled_nlp(spark: SparkSession, d: str) -> DataFrame:
    """Clean and normalised labelled corpus, written once per query."""
    rows = normalise.normalise(clean.clean_corpus(raw_mail(spark, d)))
    return mail.write_stage(rows, "nlp")


# ------------------------------------------------------------ sources and sinks
@query("message_id:l n:l clave:s label:l label_text:s subject:s split:s fuente:s")
def ingest_splits(spark, d):
    raw, paths = raw_mail(spark, d), {}
    for split in ("train", "test"):
        paths[split] = mail.new_path(spark, split)
        raw.filter(F.col("split") == split).select(*mail.RAW_SCHEMA.fieldNames()).write.json(paths[split])
    return mail.read_splits(spark, paths, "jsonl").withColumn("n", F.length("text")).withColumn(
        "clave", F.md5("text"))


@query("doc_id:l lang:s split:s fuente:s")
def ingest_fallback(spark, d):
    return mail.read_first(spark, [f"{d}/no_existe.jsonl", f"{d}/documents.parquet"])


@query("message_id:l lang:s clave:s")
def csv_scan_sink(spark, d):
    path, rows = mail.new_path(spark, "csv"), documents(spark, d)
    mail.write_csv(rows, path)
    return mail.read_csv(spark, path + "/*.csv", rows.schema).withColumn("clave", F.md5("text"))


@query("item_id:l clave:s")
def json_array_scan(spark, d):
    path, rows = mail.new_path(spark, "array"), table(spark, d, "benchmark").select("item_id", "text")
    mail.write_json_array(rows, path)
    return mail.read_json_array(spark, path, rows.schema).withColumn("clave", F.md5("text"))


@query("event_id:l event_type:s value:d4")
def jsonl_permissive_scan(spark, d):
    """One event type is written as broken lines, one as blank lines."""
    ev = table(spark, d, "events").select("event_id", "event_type", "value")
    line = F.to_json(F.struct("*"))
    path = mail.new_path(spark, "log")
    ev.select(F.when(F.col("event_type") == "view", F.substring(line, 1, 20))
              .when(F.col("event_type") == "signup", "").otherwise(line)).write.text(path)
    return mail.read_log(spark, path, ev.schema)


@query("seq:l idioma:s etiqueta_ensenada:s cambio_delta:s")
def jsonl_append(spark, d):
    path, rows = mail.new_path(spark, "append"), history.feedback_records(feedback(spark, d))
    for part in (0, 1):
        mail.append_log(rows.filter(F.col("seq") % 2 == part), path)
    return mail.read_log(spark, path, rows.schema)


@query("origen:s clave:s id:l")
def resolve_aliases(spark, d):
    a = mail.resolve_aliases(table(spark, d, "documents")).select(
        F.lit("documents").alias("origen"), F.md5("Message").alias("clave"), F.col("doc_id").alias("id"))
    talk = table(spark, d, "conversations").withColumnRenamed("text", "message")
    b = mail.resolve_aliases(talk).select(
        F.lit("conversations").alias("origen"), F.md5("Message").alias("clave"), F.col("conv_id").alias("id"))
    return a.unionByName(b)


@query("Category:s filas:l")
def validate_schema(spark, d):
    rows = mail.validate_schema(labelled_nlp(spark, d))
    return rows.groupBy("Category").agg(F.count(F.lit(1)).alias("filas"))


@query("message_id:l subject:s date:s split:s fuente:s")
def keep_present_columns(spark, d):
    return mail.keep_present(raw_mail(spark, d))


@query("message_id:l texto_es:s variante:l")
def best_variant(spark, d):
    docs = documents(spark, d)
    full = translate.translate_fragments(docs.filter(F.col(ID) % 7 == 0), "text")
    neural = translate.translate_fragments(docs.filter(F.col(ID) % 3 == 0), "text")
    lexical = translate.translate_lexical(docs, "text")
    return mail.best_text(docs, [full, neural, lexical])


@query("abreviatura_en:s expansion_en:s equivalente_es:s usos:l")
def glossary_export(spark, d):
    return translate.glossary_export(documents(spark, d))


# --------------------------------------------------------------------- cleaning
@query("message_id:l Category:s")
def drop_null_text(spark, d):
    rows = clean.drop_null_text(mail.resolve_aliases(raw_mail(spark, d)))
    return clean.normalise_label(rows).na.drop(subset=["Category"])


@query("columna:s nulos:l")
def null_profile(spark, d):
    return clean.null_profile(raw_mail(spark, d).drop("lang"))


@query("message_id:l Category:s Label_Code:l Category_heldout:s")
def normalise_label(spark, d):
    raw = raw_mail(spark, d)
    return clean.normalise_label(raw).withColumn("Category_heldout", clean.category(raw, label_first=True))


@query("message_id:l longitud_correo:l")
def length_chars(spark, d):
    return clean.with_length(mail.resolve_aliases(raw_mail(spark, d)))


@query("message_id:l clave:s")
def dedupe_exact(spark, d):
    rows = clean.dedupe_exact(mail.resolve_aliases(documents(spark, d)))
    return rows.withColumn("clave", F.md5("Message"))


@query("filas:l distintos:l duplicados:l")
def duplicate_report(spark, d):
    return clean.duplicate_report(mail.resolve_aliases(documents(spark, d)))


@query("message_id:l longitud_correo:l")
def min_length(spark, d):
    return clean.min_length(clean.with_length(mail.resolve_aliases(raw_mail(spark, d))))


@query("message_id:l longitud_correo:l truncado:l clave:s")
def truncate_long(spark, d):
    rows = clean.with_length(mail.resolve_aliases(documents(spark, d)))
    return clean.truncate_long(rows).withColumn("clave", F.md5("Message"))


@query("Category:s conteo:l")
def long_mail_bias(spark, d):
    return clean.long_mail_bias(raw_mail(spark, d))


@query("etapa:s conteo:l porcentaje:d1")
def cleaning_funnel(spark, d):
    return clean.cleaning_funnel(raw_mail(spark, d))


@query("message_id:l Category:s Label_Code:l subject:s split:s fuente:s longitud_correo:l truncado:l clave:s")
def clean_corpus(spark, d):
    return clean.clean_corpus(raw_mail(spark, d), tx.MAX_CHARS).withColumn("clave", F.md5("Message"))


@query("message_id:l subject:s nulo:b")
def sanitise_text(spark, d):
    return raw_mail(spark, d).select(ID, tx.sanitise(F.col("subject")).alias("subject"),
                                     F.col("subject").isNull().alias("nulo"))


# ----------------------------------------------------------- text normalisation
@query("origen:s id:l texto:s")
def meta_tokens(spark, d):
    docs = table(spark, d, "documents").select(F.lit("documents").alias("origen"), F.col("doc_id").alias("id"), "text")
    urls = table(spark, d, "pages").select(F.lit("pages").alias("origen"), F.col("page_id").alias("id"),
                                           F.concat(F.lit("mira "), "url", F.lit(" y escribe a x"), "page_id",
                                                    F.lit("@correo.es por 20 USD!!!")).alias("text"))
    out = docs.unionByName(urls)
    return out.withColumn("texto", F.regexp_replace(tx.mark_signals(F.col("text")), r"(?U)\s+", " "))


@query("message_id:l texto:s")
def charset_normalise(spark, d):
    return documents(spark, d).select(ID, tx.normalise_charset(F.col("text")).alias("texto"))


@query("message_id:l texto:s")
def expand_abbreviations(spark, d):
    return documents(spark, d).select(ID, tx.expand_abbreviations(
        F.lower(F.concat("text", F.lit(" "), pick(list(lx.ABBREVIATIONS))))).alias("texto"))


@query("message_id:l texto:s")
def fix_typos(spark, d):
    return documents(spark, d).select(ID, tx.fix_typos(
        F.concat(F.lower("text"), F.lit(" ("), pick(list(lx.TYPOS)), F.lit(")"))).alias("texto"))


@query("message_id:l clean_en:s")
def clean_text(spark, d):
    return documents(spark, d).select(ID, tx.clean_text(
        F.concat("text", F.lit(" "), pick(list(lx.TYPOS)))).alias("clean_en"))


@query("message_id:l clean_en:s")
def subject_plus_body(spark, d):
    return raw_mail(spark, d).select(ID, tx.clean_text(
        tx.subject_and_body(F.col("subject"), F.col("text"))).alias("clean_en"))


@query("message_id:l longitud:l palabras:l")
def text_stats(spark, d):
    return documents(spark, d).select(ID, tx.char_count(F.col("text")).alias("longitud"),
                                      tx.word_count(F.col("text")).alias("palabras"))


@query("Category:s token:s ocurrencias:l")
def meta_token_counts(spark, d):
    return normalise.signal_counts(normalise.normalise(clean.clean_corpus(raw_mail(spark, d))))


def _language_model(spark, d):
    """The batch step learns, as it detects, from the first characters of a text."""
    return normalise.train_languages(documents(spark, d))


def _detected(spark, d):
    return normalise.add_language(documents(spark, d), _language_model(spark, d))


@query("message_id:l lang:s idioma_detectado:s pista:s")
def language_detect(spark, d):
    return _detected(spark, d).withColumn("pista", tx.english_hint(F.col("text")))


@query("idioma_iso:s conteo:l porcentaje:d2")
def language_census(spark, d):
    return normalise.language_census(_detected(spark, d))


@query("idioma_iso:s conteo:l")
def top_languages(spark, d):
    pages = table(spark, d, "pages").select(F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("idioma_detectado"))
    langs = documents(spark, d).select(F.col("lang").alias("idioma_detectado")).unionByName(pages)
    return normalise.top_languages(normalise.language_census(langs), 8)


@query("message_id:l Category:s idioma_detectado:s long_clean:l num_palabras_clean:l clave:s")
def nlp_corpus(spark, d):
    out = normalise.nlp_corpus(clean.clean_corpus(raw_mail(spark, d)), _language_model(spark, d))
    return out.withColumn("clave", F.md5("clean_en"))


# ------------------------------------------------------------------ translation
def _with_phrase(spark, d, phrases):
    return documents(spark, d).withColumn("text", F.concat("text", F.lit(". "), pick(list(phrases)), F.lit("!")))


@query("message_id:l texto_es:s")
def lexical_translate(spark, d):
    return translate.translate_lexical(_with_phrase(spark, d, lx.PHRASES), "text")


@query("message_id:l texto_es:s num_fragmentos:l")
def expand_then_translate(spark, d):
    return translate.translate_raw(_with_phrase(spark, d, lx.ABBREVIATIONS), "text")


@query("message_id:l bloques:s n:l mayor:l")
def segment_sentences(spark, d):
    out = documents(spark, d).select(ID, tx.segment(F.col("text")).alias("b"))
    return out.select(ID, F.array_join("b", "¶").alias("bloques"), F.size("b").alias("n"),
                      F.coalesce(F.array_max(F.transform("b", F.length)), F.lit(0)).alias("mayor"))


@query("message_id:l texto_es:s num_fragmentos:l")
def fragment_translate_reassemble(spark, d):
    return translate.translate_fragments(documents(spark, d), "text")


@query("message_id:l texto_es:s num_fragmentos:l")
def fragment_regroup(spark, d):
    rows = translate.fragments(documents(spark, d), "text")
    return translate.regroup_fragments(rows.withColumn("fragmento", tx.lexical_translate(F.col("fragmento"))))


@query("message_id:l texto_es:s num_fragmentos:l")
def translate_prefix(spark, d):
    return translate.translate_prefix(documents(spark, d), "text")


@query("message_id:l texto_es:s")
def post_normalise(spark, d):
    split = [f"{w} token number token email Token URL" for w in lx.RESIDUAL_PHRASES]
    return _with_phrase(spark, d, split).select(ID, tx.post_normalise(F.col("text")).alias("texto_es"))


@query("message_id:l texto_es:s fallo:b")
def safe_translate(spark, d):
    rows = documents(spark, d).withColumn("traducido", F.when(F.col(ID) % 10 != 0, tx.lexical_translate(F.col("text"))))
    return translate.safe_translate(rows, text="text")


def _prior(spark, d):
    """Old translations of every second text, in two versions; some are blank."""
    docs = documents(spark, d).filter(F.col(ID) % 2 == 0)
    version = F.explode(F.array(F.lit(0), F.lit(1))).alias("version")
    old = F.when(F.col(ID) % 10 == 0, "  ").otherwise(F.concat(F.lit("v"), "version", F.lit(":"), "text"))
    return docs.select(ID, "text", version).select(ID, "version", old.alias("texto_es"))


@query("message_id:l texto_es:s num_fragmentos:l rehecho:b")
def incremental_patch(spark, d):
    return translate.incremental_patch(documents(spark, d), translate.latest_prior(_prior(spark, d), "version"), "text")


@query("conservados:l rehechos:l")
def patch_report(spark, d):
    return translate.patch_report(translate.incremental_patch(
        documents(spark, d), translate.latest_prior(_prior(spark, d), "version"), "text"))


@query("message_id:l texto_es:s num_fragmentos:l")
def resume_pending(spark, d):
    docs = documents(spark, d)
    done = docs.filter(hash_order(F.col(ID), "done") % 3 == 0).select(
        ID, F.concat(F.lit("hecho "), "text").alias("texto_es"), F.lit(1).alias("num_fragmentos"))
    return translate.resume(docs, done, lambda rows: translate.translate_lexical(rows, "text"))


def _translated_store(spark, d):
    """(store, counts of three runs): the train split, the test split, then all mails once more."""
    kept = store.TranslationStore(mail.new_path(spark, "translations"))
    raw = mail.write_stage(raw_mail(spark, d).select(ID, "text", "split"), "raw")
    runs = [raw.filter("split = 'train'"), raw.filter("split = 'test'"), raw]
    return kept, raw, [kept.fill(r, lambda rows: translate.translate_fragments(rows, "text"), chunks=2) for r in runs]


@query("corrida:l textos:l reutilizados:l traducidos:l fallidos:l")
def translation_reuse(spark, d):
    """What each run found in the store and what it had to translate; the last run translates nothing."""
    runs = _translated_store(spark, d)[2]
    return spark.createDataFrame([(i, r.textos, r.reutilizados, r.traducidos, r.fallidos) for i, r in enumerate(runs, 1)],
                                 "corrida long, textos long, reutilizados long, traducidos long, fallidos long")


@query("message_id:l texto_es:s num_fragmentos:l fallo:b")
def stored_translations(spark, d):
    kept, raw, _ = _translated_store(spark, d)
    return kept.apply(raw)


@query("n:l correlacion:d6 razon_media:d6 mas_largos:l")
def length_parity(spark, d):
    rows = translate.translate_lexical(documents(spark, d), "text")
    return translate.length_parity(rows, "text")


@query("message_id:l lang:s orden:l")
def examples_per_language(spark, d):
    return translate.examples_per_language(documents(spark, d), "lang")


@query("message_id:l texto_es:s num_fragmentos:l longitud_es:l")
def translated_corpus(spark, d):
    return translate.translated_corpus(normalise.normalise(clean.clean_corpus(raw_mail(spark, d))))


@query("filas:l traducidas:l fragmentos_media:d2 fragmentos_max:l")
def translation_validation(spark, d):
    return translate.translation_validation(translate.translate_fragments(documents(spark, d), "text"))


# --------------------------------------------------------------------- sampling
def _labelled(spark, d):
    return clean.labelled(raw_mail(spark, d)).select(ID, "Category", "Label_Code")


@query("message_id:l Category:s")
def stratified_sample(spark, d):
    return sampling.stratified_sample(_labelled(spark, d), 150)


@query("message_id:l Category:s")
def balanced_sample(spark, d):
    return sampling.balanced_sample(_labelled(spark, d), 100)


@query("message_id:l")
def random_sample(spark, d):
    return sampling.random_sample(documents(spark, d), 200)


@query("message_id:l Category:s parte:s")
def stratified_split(spark, d):
    return sampling.stratified_split(_labelled(spark, d), {"train": 0.64, "val": 0.16, "test": 0.2})


@query("message_id:l Category:s pliegue:l repeticion:l")
def stratified_kfold(spark, d):
    rows = _labelled(spark, d)
    a, b = (sampling.stratified_kfold(rows, 3, seed=f"cv{r}").withColumn("repeticion", F.lit(r)) for r in (0, 1))
    return a.unionByName(b)


@query("message_id:l posicion:l")
def shuffle(spark, d):
    return sampling.shuffle(documents(spark, d))


# --------------------------------------------------------------------- features
@query("message_id:l tokens:s tokens_es:s")
def tokenise_stop(spark, d):
    rows = documents(spark, d).select(ID, tx.clean_text(F.col("text")).alias("c"))
    return rows.select(ID, F.array_join(tx.model_tokens(F.col("c"), features.stop_words("en")), " ").alias("tokens"),
                       F.array_join(tx.model_tokens(F.col("c"), features.stop_words("es")), " ").alias("tokens_es"))


@query("message_id:l gramas:s")
def ngrams(spark, d):
    rows = documents(spark, d).select(ID, tx.clean_text(F.col("text")).alias("c"))
    return rows.select(ID, joined(features.terms(F.col("c"), features.stop_words("en"), 2)).alias("gramas"))


PART = {"train": 0.8, "test": 0.2}


def experiment(spark, d, parts=None) -> DataFrame:
    """Features of the English model with a stratified split, written once."""
    rows = sampling.stratified_split(labelled_nlp(spark, d), parts or PART)
    out = features.featurise(rows, "clean_en", "en", features.stop_words("en"), 2)
    return mail.write_stage(out, "features")


def trained(feats: DataFrame, part: str = "train", k: int = features.MAX_FEATURES, models: int = 1):
    return bayes.train(feats.filter(F.col("parte") == part), k, models=models)


def scored_test(spark, d, part: str = "test") -> DataFrame:
    feats = experiment(spark, d)
    out = bayes.score(feats.filter(F.col("parte") == part), trained(feats), "Label_Code")
    return out.withColumn("p_spam", F.round("p_spam", 6))


def scored_all(spark, d) -> DataFrame:
    feats = experiment(spark, d)
    out = bayes.score(feats, trained(feats), "Label_Code", "parte")
    return out.withColumn("p_spam", F.round("p_spam", 6))


@query("term:s total:l df:l idf:d6 rango:l")
def vocabulary_topk(spark, d):
    return features.vocabulary(experiment(spark, d), 10_000)


@query("message_id:l term:s x:d6")
def tfidf(spark, d):
    feats = experiment(spark, d)
    vocab = mail.write_stage(features.vocabulary(feats, 10_000), "vocab")
    return features.tfidf(feats, vocab, 10_000, in_place=True)


@query("term:s idf:d6 w_ham:d6 w_spam:d6 lp_ham:d6 lp_spam:d6")
def nb_train(spark, d):
    model = trained(experiment(spark, d))
    return model.counts.join(bayes.log_probs(model).select("term", "lp_ham", "lp_spam"), "term")


@query("message_id:l parte:s Label_Code:l p_spam:d6")
def nb_score(spark, d):
    return scored_all(spark, d)


@query("message_id:l p_spam:d6 pred:l")
def threshold_predict(spark, d):
    return bayes.predict(scored_all(spark, d), 0.75)


@query("modelo:s n:l accuracy:d4 precision:d4 recall:d4 f1:d4 roc_auc:d4 pr_auc:d4")
def lr_train_score(spark, d):
    rows = sampling.stratified_split(labelled_nlp(spark, d), PART)
    feats = mail.write_stage(features.featurise(rows, "clean_en", "en", features.stop_words("en"), 2), "features")
    train = feats.filter(F.col("parte") == "train")
    vocab = mail.write_stage(features.vocabulary(train, logistic.LR_FEATURES), "vocab")
    data = logistic.vectors(feats, vocab, logistic.LR_FEATURES, "Label_Code", "parte")
    fit = data.filter(F.col("parte") == "train")
    model = logistic.fit(fit, fit.count(), 4.0)
    out = logistic.score(data.filter(F.col("parte") == "test"), model, "Label_Code")
    return evaluate.evaluate(bayes.predict(out.withColumn("p_spam", F.round("p_spam", 9)), 0.5))


@query("c:d1 f1_medio:d4 mejor:b")
def lr_grid_search(spark, d):
    return selection.logistic_grid(labelled_nlp(spark, d), "clean_en", features.stop_words("en"))


@query("alpha:d1 max_features:l ngram:l f1_medio:d6 mejor:b")
def grid_search(spark, d):
    return selection.grid_search(labelled_nlp(spark, d), "clean_en", features.stop_words("en"))


@query("modelo:s f1:d6")
def cv_folds(spark, d):
    return selection.cross_validate(labelled_nlp(spark, d), "clean_en", features.stop_words("en"), 2, features.MAX_FEATURES)


@query("f1_cv_mean:d4 f1_cv_std:d4")
def cv_repeated(spark, d):
    return selection.cv_summary(selection.cross_validate(
        labelled_nlp(spark, d), "clean_en", features.stop_words("en"), 2, features.MAX_FEATURES))


def _validation_scores(spark, d):
    feats = experiment(spark, d, {"fit": 0.64, "val": 0.16, "test": 0.2})
    out = bayes.score(feats.filter(F.col("parte") == "val"), trained(feats, "fit"), "Label_Code")
    return mail.write_stage(out.withColumn("p_spam", F.round("p_spam", 6)), "val")


@query("beta:d1 umbral:d2 fbeta:d4")
def calibrate_threshold(spark, d):
    val = _validation_scores(spark, d)
    a = bayes.calibrate_threshold(val).withColumn("beta", F.lit(0.5))
    b = bayes.calibrate_threshold(val, 1.0, list(range(20, 81, 5))).withColumn("beta", F.lit(1.0))
    return a.unionByName(b)


@query("umbral:d2 tp:l fp:l fn:l fbeta:d6")
def threshold_sweep(spark, d):
    return bayes.threshold_table(_validation_scores(spark, d))


@query("clase:s rango:l term:s peso:d3")
def top_terms(spark, d):
    return bayes.top_terms(bayes.term_weights(trained(experiment(spark, d))))


@query("message_id:l tokens_spam:s tokens_ham:s")
def explain_mail(spark, d):
    rows = labelled_nlp(spark, d)
    feats = features.featurise(sampling.stratified_split(rows, PART), "clean_en", "en", features.stop_words("en"), 2)
    model = trained(mail.write_stage(feats, "features"))
    out = bayes.explain(rows.withColumn("modelo", F.lit("en")), "clean_en", bayes.term_weights(model), model.max_rows)
    return out.select(ID, joined("tokens_spam").alias("tokens_spam"), joined("tokens_ham").alias("tokens_ham"))


@query("term:s w_ham:d6 w_spam:d6 n_ham:l n_spam:l")
def nb_partial_fit(spark, d):
    feats = experiment(spark, d)
    model = bayes.partial_fit(trained(feats), feats.filter(F.col("parte") == "test"))
    return model.counts.join(F.broadcast(model.priors), "modelo")


@query("message_id:l p_spam:d6")
def model_tables(spark, d):
    feats = experiment(spark, d)
    path = mail.new_path(spark, "model")
    trained(feats).save(path)
    return bayes.score(feats, bayes.NaiveBayes.load(spark, path))


def model_stack(spark, d, parts=None):
    """Features of the English, the word-by-word and the fragment-wise Spanish corpus."""
    rows = sampling.stratified_split(labelled_nlp(spark, d), parts or PART)
    lexical = translate.translated_corpus(rows)
    frag = translate.translate_fragments(rows, "clean_en").select(ID, "texto_es")
    frag = rows.join(frag, ID).withColumn("texto_es", tx.clean_text(F.col("texto_es")))
    stack = features.featurise(rows, "clean_en", "en", features.stop_words("en"), 2)
    for name, df in (("es_lex", lexical), ("es_frag", frag)):
        stack = stack.unionByName(features.featurise(df, "texto_es", name, features.stop_words("es"), 1))
    return mail.write_stage(stack, "stack")


@query("modelo:s umbral:d2 n:l accuracy:d4 precision:d4 recall:d4 f1:d4 roc_auc:d4 pr_auc:d4")
def model_comparison(spark, d):
    stack = model_stack(spark, d, {"fit": 0.64, "val": 0.16, "test": 0.2})
    val = bayes.score(stack.filter(F.col("parte") == "val"), trained(stack, "fit", models=3), "Label_Code")
    best = bayes.calibrate_threshold(val.withColumn("p_spam", F.round("p_spam", 6)))
    full = bayes.train(stack.filter(F.col("parte") != "test"), models=3)
    test = bayes.score(stack.filter(F.col("parte") == "test"), full, "Label_Code")
    test = test.withColumn("p_spam", F.round("p_spam", 6)).join(F.broadcast(best), "modelo")
    pred = mail.write_stage(bayes.predict(test, F.col("umbral")), "pred")
    return evaluate.evaluate(pred).join(best, "modelo")


def _compared(spark, d):
    """The stack of all corpora in three parts, with folds of the mails outside the test part."""
    stack = model_stack(spark, d, {"fit": 0.64, "val": 0.16, "test": 0.2})
    labelled = stack.filter("modelo = 'en' AND parte <> 'test'").select(ID, "Label_Code")
    folds = sampling.stratified_kfold(labelled, selection.FOLDS).select(ID, "pliegue")
    return mail.write_stage(stack.join(folds, ID, "left"), "compared")


@query("modelo:s algoritmo:s parametros:s umbral:d2 f1_cv_mean:d4 f1_cv_std:d4 n:l accuracy:d4 precision:d4 recall:d4 "
       "f1:d4 roc_auc:d4 pr_auc:d4")
def algorithm_comparison(spark, d):
    return selection.compare_models(_compared(spark, d))[0]


@query("modelo:s clase:s rango:l term:s peso:d3")
def lr_top_terms(spark, d):
    """The strongest terms of the logistic model of each corpus at the chosen C."""
    rest = mail.write_stage(_compared(spark, d).filter("parte <> 'test'"), "seen_rows")
    return bayes.top_terms(selection.chosen_coefficients(*selection.chosen_logistic(rest)))


# ------------------------------------------------------------------- evaluation
@query("modelo:s tn:l fp:l fn:l tp:l")
def confusion_matrix(spark, d):
    return evaluate.confusion_matrix(bayes.predict(scored_all(spark, d), 0.5))


@query("modelo:s n:l accuracy:d4 precision:d4 recall:d4 f1:d4")
def classification_metrics(spark, d):
    return evaluate.classification_metrics(bayes.predict(scored_test(spark, d), 0.5))


@query("modelo:s roc_auc:d4")
def roc_auc(spark, d):
    return evaluate.ranking_metrics(scored_test(spark, d))


@query("modelo:s pr_auc:d4")
def average_precision(spark, d):
    return evaluate.ranking_metrics(scored_test(spark, d))


@query("umbral:d6 fpr:d6 tpr:d6")
def roc_curve(spark, d):
    return evaluate.roc_curve(scored_all(spark, d))


@query("umbral:d6 recall:d6 precision:d6")
def pr_curve(spark, d):
    return evaluate.pr_curve(scored_all(spark, d))


@query("message_id:l clave:s real:l p_spam:d3 pred:l tipo:s")
def error_audit(spark, d):
    pred = bayes.predict(scored_all(spark, d), 0.5)
    texts = raw_mail(spark, d).select(ID, "text")
    first = evaluate.first_errors(pred.filter(F.col(ID).isNotNull()))
    return evaluate.error_audit(F.broadcast(first).join(texts, ID), "text").withColumn("clave", F.md5("texto"))


@query("modelo:s falsos_positivos:l falsos_negativos:l")
def error_totals(spark, d):
    return evaluate.error_totals(bayes.predict(scored_all(spark, d), 0.5))


def _heldout_unit(spark, d):
    """(unit, features of the unseen split): trained on the train split, its thresholds calibrated on a fifth of it."""
    raw = raw_mail(spark, d)
    seen = normalise.normalise(clean.clean_corpus(raw.filter("split = 'train'")))
    seen = sampling.stratified_split(mail.write_stage(seen, "seen"), {"fit": 0.8, "val": 0.2})
    unseen = normalise.normalise(clean.heldout_corpus(raw.filter("split = 'test'"))).withColumn("parte", F.lit("test"))
    rows = mail.write_stage(seen.unionByName(unseen, allowMissingColumns=True), "heldout")
    # Training texts are translated whole; the mode under test cuts unseen mails only.
    unseen = F.col("parte") == "test"
    spanish = translate.translate_lexical(rows.filter(~unseen)).unionByName(
        translate.translate_prefix(rows.filter(unseen)), allowMissingColumns=True)
    stack = features.featurise(rows, "clean_en", "en_heldout", features.stop_words("en"), 2).unionByName(
        features.featurise(spanish, "texto_es", "es_heldout", features.stop_words("es"), 1))
    stack = mail.write_stage(stack, "stack")
    # Outside fold 0 is the fit part; fold 1 has no mails, so outside it are all.
    folds = stack.filter("parte <> 'test'").withColumn("pliegue", F.when(F.col("parte") == "val", 0).otherwise(2))
    fitted, model = selection.train_outside_folds(folds, 2, models=2)
    val = bayes.score(stack.filter("parte = 'val'"), fitted, "Label_Code")
    val = mail.write_stage(val.withColumn("p_spam", F.round("p_spam", 6)), "val")
    best = mail.write_stage(bayes.calibrate_threshold(val), "thresholds")
    accepted = evaluate.classification_metrics(bayes.predict(val.join(F.broadcast(best), "modelo"), F.col("umbral")))
    store = registry.ModelStore(mail.new_path(spark, "unit"))
    store.commit(registry.ModelUnit(model, best, accepted, bayes.top_terms(bayes.term_weights(model))))
    return store.load(spark), stack.filter("parte = 'test'")


@query("modelo:s umbral:d2 n:l accuracy:d4 precision:d4 recall:d4 f1:d4 clase:s rango:l term:s peso:d3")
def model_unit(spark, d):
    """What a stored unit says of itself: thresholds, the metrics it was accepted with and its strongest terms."""
    unit, _ = _heldout_unit(spark, d)
    return unit.terms.join(unit.thresholds, "modelo").join(unit.metrics, "modelo")


@query("modelo:s n:l accuracy:d4 precision:d4 recall:d4 f1:d4 roc_auc:d4 pr_auc:d4")
def heldout_evaluation(spark, d):
    """Models trained on the train split, evaluated on the unseen test split with the thresholds stored with them."""
    unit, test = _heldout_unit(spark, d)
    return evaluate.evaluate(mail.write_stage(unit.predict(test, "Label_Code"), "pred"))


@query("modelo:s metrica:s valor:d4 valor_x100:d2")
def metrics_unpivot(spark, d):
    wide = evaluate.classification_metrics(bayes.predict(scored_all(spark, d), 0.5))
    return evaluate.metrics_long(wide, ["accuracy", "precision", "recall", "f1"])


# ---------------------------------------------------------------------- scoring
def _routed(spark, d, truth: DataFrame | None = None):
    """All mails, or those with a known label, routed by the language of their whole text."""
    docs = documents(spark, d)
    model = normalise.train_whole_texts(docs)
    mails = docs.drop("lang") if truth is None else docs.drop("lang").join(truth, ID)
    return score.route(normalise.add_mail_language(mails, model))


@query("message_id:l modelo:s idioma_modelo:s clave:s")
def route_by_language(spark, d):
    return _routed(spark, d).withColumn("clave", F.md5("texto_procesado"))


# FIXED VALUES: thresholds of the served models.
SERVED_THRESHOLDS = [("en", 0.75), ("es", 0.65)]


def served_model(spark, d):
    """English and Spanish model trained on the labelled corpus."""
    rows = labelled_nlp(spark, d)
    en = features.featurise(rows, "clean_en", "en", features.stop_words("en"), 2)
    es = features.featurise(translate.translated_corpus(rows), "texto_es", "es", features.stop_words("es"), 1)
    return bayes.train(mail.write_stage(en.unionByName(es), "served"), models=2)


def served_unit(spark, d) -> registry.ModelUnit:
    """The newest stored version of the served models, with the thresholds it was stored with."""
    model, store = served_model(spark, d), registry.ModelStore(mail.new_path(spark, "served-unit"))
    thresholds = spark.createDataFrame(SERVED_THRESHOLDS, "modelo string, umbral double")
    none = spark.createDataFrame([], "modelo string, n long")
    store.commit(registry.ModelUnit(model, thresholds, none, bayes.top_terms(bayes.term_weights(model))))
    return store.load(spark)


def _predictions(spark, d, explain=False, truth=None):
    unit = served_unit(spark, d)
    return score.predict_batch(_routed(spark, d, truth), unit.model, unit.thresholds, explain)


@query("message_id:l etiqueta:s etiqueta_tentativa:s es_incierto:b motivo_incertidumbre:s")
def certainty_flag(spark, d):
    return _predictions(spark, d)


@query("message_id:l modelo:s etiqueta:s etiqueta_tentativa:s es_incierto:b p_spam:d4 p_ham:d4 umbral:d2 "
       "idioma_detectado:s idioma_modelo:s tokens_spam:s tokens_ham:s")
def predict_batch(spark, d):
    out = _predictions(spark, d, explain=True)
    return out.withColumn("tokens_spam", joined("explicacion.tokens_spam")).withColumn(
        "tokens_ham", joined("explicacion.tokens_ham"))


def _bank(spark, d):
    truth = _labelled(spark, d).select(ID, F.upper("Category").alias("etiqueta_esperada"))
    return _predictions(spark, d, truth=truth).withColumn("categoria", F.col("idioma_detectado"))


@query("categoria:s aciertos:l total:l tasa:d1")
def bank_audit(spark, d):
    return score.audit_summary(score.bank_audit(_bank(spark, d)))


@query("message_id:l validacion:s")
def pool_validation(spark, d):
    return score.pool_validation(_bank(spark, d), "etiqueta_esperada")


def _catalogue(spark, d):
    return documents(spark, d).select(
        ID, F.when(F.col(ID) % 3 == 0, "Camuflado").otherwise("Verídico").alias("subcategoria"),
        F.col("lang").alias("idioma"), F.concat_ws(" / ", "source", "text").alias("categoria"),
        F.col("text").alias("asunto"))


@query("message_id:l subcategoria:s idioma:s categoria:s asunto:s")
def catalog_filter(spark, d):
    return score.catalogue(_catalogue(spark, d), "Camuflado")


@query("message_id:l")
def catalog_pick(spark, d):
    return score.catalogue_pick(_catalogue(spark, d))


@query("timestamp:s idioma:s p_spam:s umbral:s motivo:s clave:s texto_procesado:s")
def uncertain_archive(spark, d):
    found = score.uncertain_archive(_predictions(spark, d), "text", F.lit("2024-01-31 00:00:00"))
    path = mail.new_path(spark, "uncertain")
    mail.append_log(found, path)
    return spark.read.schema(found.schema).json(path).withColumn("clave", F.md5("texto_original"))


# --------------------------------------------------------------------- feedback
RECORD = ("seq:l timestamp:s clave:s texto_resumen:s idioma:s prediccion_previa:s probabilidad_spam_previa:d4 "
          "porcentaje_antes:s prediccion_posterior:s probabilidad_spam_posterior:d4 porcentaje_despues:s "
          "cambio_delta:s umbral:d2 etiqueta_ensenada:s era_correcto:b")


def records(spark, d):
    return history.feedback_records(feedback(spark, d))


@query(RECORD)
def feedback_records(spark, d):
    return records(spark, d).withColumn("clave", F.md5("texto"))


@query("timestamp:s idioma:s etiqueta_asignada:s p_spam_previa:s num_muestras_total:l clave:s texto_procesado:s")
def feedback_log(spark, d):
    ev, texts = keyed_feedback(spark, d, trim=False)
    ev = history.count_samples(ev.withColumn("modelo", score.model_of(F.col("idioma"))), served_model(spark, d).priors)
    texts = mail.write_stage(texts.withColumn("texto_procesado", tx.clean_text(F.col("texto"))), "processed")
    log = history.learning_log(ev.join(texts, "clave"))
    path = mail.new_path(spark, "learning-log")
    mail.append_log(log, path)
    return spark.read.schema(log.schema).json(path).withColumn("clave", F.md5("texto_original"))


def _deliveries(spark, d, path: str, parts: int = 4) -> Iterator[int]:
    """The feedback log as JSON lines in ``path``, delivered in parts of consecutive arrival numbers; yields after each."""
    ev, texts = mail.write_stage(feedback_events(spark, d), "log"), feedback_texts(spark, d)
    ends = ev.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).first()
    lo, width = ends["lo"], -(-(ends["hi"] - ends["lo"] + 1) // parts)
    for i in range(parts):
        part = ev.filter((F.col("seq") >= lo + i * width) & (F.col("seq") < lo + (i + 1) * width)).join(texts, "message_id")
        mail.append_log(part.select(*mail.FEEDBACK_SCHEMA.fieldNames(), "p_posterior"), path)
        yield i


def _taught(spark, d, catalogue: bool = False):
    """The stream of feedback run to its end: (model state, log folder, catalogue, batches).

    The stream is run after every delivery and takes up what is new, so a batch has as many files as its delivery.
    """
    base = served_model(spark, d)
    path, root, done = mail.new_path(spark, "events"), mail.new_path(spark, "stream"), 0
    state = stream.ModelState(f"{root}/model", base.max_rows).start(base)
    kept = stream.CatalogueState(f"{root}/catalogue") if catalogue else None
    for _ in _deliveries(spark, d, path):
        run = stream.learn(stream.read_events(spark, path), state, f"{root}/log", f"{root}/checkpoint", kept)
        run.awaitTermination()
        done = max(done, stream.batches_done(run))
    return state, f"{root}/log", kept, done


@query("modelo:s term:s w_ham:d6 w_spam:d6 n_ham:l n_spam:l")
def online_learning(spark, d):
    """The stream is run to its end; the result is the taught model."""
    state, _, _, done = _taught(spark, d)
    model = state.model_before(spark, done)
    return model.counts.join(F.broadcast(model.priors), "modelo")


@query("seq:l idioma:s probabilidad_spam_posterior:d6 prediccion_posterior:s etiqueta_ensenada:s")
def online_scores(spark, d):
    """Every taught mail with its score right after its own event."""
    _, log, _, _ = _taught(spark, d)
    return spark.read.schema("seq long, idioma string, probabilidad_spam_posterior double, prediccion_posterior string, "
                             "etiqueta_ensenada string").json(log)     # a schema of its own: the texts are not read twice


CATALOGUE = "id:s fecha:s idioma:s etiqueta:s label:l clave:s veces_entrenado:l ultima_fecha:s ultima_probabilidad_spam:d4"


@query(CATALOGUE)
def retrain_catalog(spark, d):
    events, texts = keyed_feedback(spark, d)
    return history.retrain_catalogue(events, texts=texts).withColumn("clave", F.md5("texto"))


@query(CATALOGUE)
def retrain_catalog_stream(spark, d):
    path, root, done = mail.new_path(spark, "events"), mail.new_path(spark, "stream"), 0
    scored = T.StructType([*mail.FEEDBACK_SCHEMA, T.StructField("p_posterior", T.DoubleType())])
    state = stream.CatalogueState(f"{root}/catalogue")
    for _ in _deliveries(spark, d, path):
        run = stream.keep_catalogue(stream.read_events(spark, path, scored), state, f"{root}/checkpoint", "p_posterior")
        run.awaitTermination()
        done = max(done, stream.batches_done(run))
    return state.current(spark, done).withColumn("clave", F.md5("texto"))


@query(CATALOGUE)
def learned_catalog(spark, d):
    """The catalogue kept by the stream that teaches, with the model's own scores."""
    _, _, kept, done = _taught(spark, d, catalogue=True)
    return kept.current(spark, done).withColumn("clave", F.md5("texto"))


def _history(spark, d):
    """The groups of all records; the texts are fetched by key for one row per group."""
    events, texts = keyed_feedback(spark, d)
    return history.history_groups(history.feedback_records(events), texts)


@query("clave:s veces:l primero:l ultimo:l timestamp:s primera_fecha:s tiempo:l insignia:b etiqueta_ensenada:s cambio_delta:s")
def history_groups(spark, d):
    return _history(spark, d).withColumn("clave", F.md5("texto"))


@query("clave:s seq:l iteracion:l es_actual:b porcentaje_antes:s porcentaje_despues:s cambio_delta:s estado:s")
def history_timeline(spark, d):
    events, _ = keyed_feedback(spark, d)
    line = history.history_timeline(history.feedback_records(events))
    return line.withColumn("clave", F.lower(F.hex("clave")))


@query("clave:s veces:l ultimo:l idioma:s")
def history_search(spark, d):
    groups = _history(spark, d)
    return history.history_search(groups, " The ").withColumn("clave", F.md5("texto"))


@query("clave:s veces:l tiempo:l")
def history_page(spark, d):
    groups = mail.write_stage(_history(spark, d), "groups")
    return history.history_page(groups, page=3, size=25).withColumn("clave", F.md5("texto"))


# ------------------------------------------------------------------ diagnostics
@query("Category:s conteo:l porcentaje:d1")
def class_distribution(spark, d):
    return clean.class_distribution(clean.clean_corpus(raw_mail(spark, d)))


@query("medida:s Category:s bin:l desde:d4 conteo:l")
def length_histogram(spark, d):
    rows = clean.clean_corpus(raw_mail(spark, d)).withColumn("num_palabras", tx.word_count(F.col("Message")))
    rows = mail.write_stage(rows.select("Category", "longitud_correo", "num_palabras"), "lengths")
    a = diagnostics.length_histogram(rows, "longitud_correo", "Category", 40).withColumn("medida", F.lit("caracteres"))
    b = diagnostics.length_histogram(rows, "num_palabras", "Category", 60).withColumn("medida", F.lit("palabras"))
    return a.unionByName(b)


@query("Category:s punto:l x:d6 densidad:d6")
def length_density(spark, d):
    return diagnostics.log_density(clean.clean_corpus(raw_mail(spark, d)), "longitud_correo", "Category")


@query("Category:s n:l q1:d4 mediana:d4 q3:d4 bigote_inf:l bigote_sup:l")
def wordcount_boxplot(spark, d):
    rows = normalise.normalise(clean.clean_corpus(raw_mail(spark, d)))
    return diagnostics.boxplot(rows, "num_palabras_clean", "Category")


# --------------------------------------------------------------------- flagship
@query("modelo:s n:l accuracy:d4 precision:d4 recall:d4 f1:d4 roc_auc:d4 pr_auc:d4")
def mail_classifier(spark, d):
    """Clean, normalise, split, train, score and evaluate the English model."""
    pred = bayes.predict(scored_test(spark, d), 0.5)
    return evaluate.evaluate(mail.write_stage(pred, "pred"))
