import collections
import json
import math
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartero.operators import clean, normalise, sampling, translate
from cartero.operators.ranking import top_per_group
from cartero.sources import mail

RAW = "message_id long, text string, label int, label_text string"


def ids(df):
    return sorted(r[0] for r in df.select("message_id").collect())


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([
        (2, "same text here", 0, None), (1, "same text here", None, "HAM"), (3, None, 1, "spam"),
        (4, "abc", 1, "1"), (5, "x" * 10001, 1, "weird"), (6, "no label at all", None, "weird"),
        (7, "long enough", None, "0")], RAW)


def test_clean_corpus(raw):
    rows = {r.message_id: r for r in clean.clean_corpus(raw, 10000).collect()}
    assert sorted(rows) == [1, 5, 7]
    assert rows[1].Category == "ham" and rows[7].Label_Code == 0
    assert (rows[5].longitud_correo, rows[5].truncado, len(rows[5].Message)) == (10000, 1, 10000)


def test_rejects_and_funnel(raw):
    assert ids(clean.unlabelled(raw)) == [6]
    got = {r.etapa: r.conteo for r in clean.cleaning_funnel(raw).collect()}
    assert got == {"inicial": 7, "sin_nulos": 6, "sin_dup": 4, "final": 3, "truncados": 1}


def test_nothing_is_cut_unless_asked(raw):
    for rows in (clean.clean_corpus(raw), clean.heldout_corpus(raw)):
        assert {len(r.Message) for r in rows.filter("message_id = 5").collect()} == {10001}


def test_heldout_keeps_copies_and_length(raw):
    rows = clean.heldout_corpus(raw, 10000).collect()
    assert sorted(r.message_id for r in rows) == [1, 2, 5, 7]
    assert {r.longitud_correo for r in rows if r.message_id == 5} == {10001}


def test_one_text_holding_most_rows(spark):
    df = spark.range(5000).select(F.col("id").alias("message_id"), F.when(
        F.col("id") % 3 > 0, "copy").otherwise(F.concat(F.lit("t"), "id")).alias("Message"))
    kept = clean.dedupe_exact(df)
    assert kept.count() == 1 + 1667 and kept.filter("Message = 'copy'").first()[0] == 1


def test_null_profile(raw):
    assert {r.columna: r.nulos for r in clean.null_profile(raw).collect()} == {
        "message_id": 0, "text": 1, "label": 3, "label_text": 1}


def test_validate_schema(spark):
    ok = spark.createDataFrame([("hola", "ham")], "clean_en string, Category string")
    assert mail.validate_schema(ok) is ok
    with pytest.raises(ValueError, match="clean_en"):
        mail.validate_schema(spark.createDataFrame([("a", "ham")], "otro string, Category string"))
    with pytest.raises(ValueError, match="vacío"):
        mail.validate_schema(ok.limit(0))


def test_sanitise(spark):
    df = spark.createDataFrame([(1, "valid text"), (2, None), (3, "   spaced text \n"), (4, "")], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(translate.tx.sanitise(F.col("t"))).collect()]
    assert got == ["valid text", "", "spaced text", ""]


def test_sources(spark, tmp_path):
    log = tmp_path / "log.jsonl"
    log.write_text('{"seq": 1, "texto": "uno"}\n\n{"seq": 2, "tex\n{"seq": 3, "texto": "tres"}\n')
    assert [r.seq for r in mail.read_log(spark, str(log)).orderBy("seq").collect()] == [1, 3]
    array = tmp_path / "a.json"
    array.write_text(json.dumps([{"id": 1, "t": "a\nb"}, {"id": 2, "t": "ñ"}]))
    df = mail.read_json_array(spark, str(array), "id int, t string")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "a\nb"), (2, "ñ")]
    mail.write_csv(df, str(tmp_path / "csv"))
    back = mail.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a\nb"), (2, "ñ")]
    first = mail.read_first(spark, [str(tmp_path / "none.jsonl"), str(array)], df.schema)
    assert {r.fuente for r in first.collect()} == {"local_fallback"}
    with pytest.raises(FileNotFoundError):
        mail.read_first(spark, [str(tmp_path / "none")])


def test_stratified_sample_shares(spark):
    df = spark.range(100).select(F.col("id").alias("message_id"), F.when(F.col("id") < 80, "ham").otherwise("spam").alias("Category"))
    got = {r.Category: r["count"] for r in sampling.stratified_sample(df, 20).groupBy("Category").count().collect()}
    assert got == {"ham": 16, "spam": 4}
    for n in (1000, 0, -5):
        assert sampling.stratified_sample(df, n).count() == 100
    assert ids(sampling.stratified_sample(df, 20)) == ids(sampling.stratified_sample(df.repartition(7), 20))
    assert sampling.balanced_sample(df, 50).count() == 25 + 20


def test_splits_are_exact(spark):
    df = spark.range(1003).select(F.col("id").alias("message_id"), F.when(F.col("id") % 10 == 0, "spam").otherwise("ham").alias("Category"))
    parts = {(r.Category, r.parte): r["count"] for r in sampling.stratified_split(df, {"a": 0.8, "b": 0.2}).groupBy("Category", "parte").count().collect()}
    assert parts == {("ham", "a"): 722, ("ham", "b"): 180, ("spam", "a"): 81, ("spam", "b"): 20}
    folds = sampling.stratified_kfold(df, 3).groupBy("Category", "pliegue").count().collect()
    for c in ("ham", "spam"):
        sizes = [r["count"] for r in folds if r.Category == c]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
    tiny = df.filter("message_id < 2")
    assert sampling.stratified_split(tiny, {"a": 0.2, "b": 0.8}).filter("parte = 'b'").count() == 2


def test_top_per_group_with_many_ties(spark):
    rows = [("g", f"t{i:04d}", 1) for i in range(500)] + [("g", "z", 9), ("h", "only", 1)]
    df = spark.createDataFrame(rows, "grp string, term string, n int")
    got = [(r.grp, r.term, r.rango) for r in top_per_group(df, "grp", "n", "term", 4).orderBy("grp", "rango").collect()]
    assert got == [("g", "z", 1), ("g", "t0000", 2), ("g", "t0001", 3), ("g", "t0002", 4), ("h", "only", 1)]


def test_language_detection(spark):
    base = {"en": "the quick brown fox is happy with this meeting", "es": "el zorro rápido está contento con esta reunión"}
    train = spark.createDataFrame([(t, k) for k, t in base.items()] * 3, "text string, lang string")
    model = normalise.train_languages(train)
    assert model.languages == ("en", "es")
    df = spark.createDataFrame([(1, "this is the meeting"), (2, "esta reunión está"), (3, "abc"), (4, None)], "message_id long, text string")
    got = {r[0]: r[1] for r in normalise.detect_language(df, model).collect()}
    assert got == {1: "en", 2: "es", 3: "desconocido", 4: "desconocido"}


def test_fragment_forms_agree(spark):
    text = " ".join("please send the report %d." % i for i in range(120))
    df = spark.createDataFrame([(1, text), (2, ""), (3, "hello friend")], "message_id long, clean_en string")
    a = sorted(map(tuple, translate.translate_fragments(df).collect()))
    one = translate.tx.lexical_translate
    b = sorted(map(tuple, translate.regroup_fragments(
        translate.fragments(df).withColumn("fragmento", one(F.col("fragmento")))).collect()))
    c = sorted(map(tuple, translate.translate_fragments_by(df, lambda ts: [t.upper() for t in ts]).collect()))
    assert a == b and [r[2] for r in a] == [7, 1, 1] and c[2][1] == "hola FRIEND"


def test_resume_and_patch(spark):
    df = spark.createDataFrame([(1, "hello"), (2, "win"), (3, "x" * 700)], "message_id long, clean_en string")
    done = spark.createDataFrame([(1, "listo", 1)], "message_id long, texto_es string, num_fragmentos int")
    out = {r[0]: r[1] for r in translate.resume(df, done, translate.translate_lexical).collect()}
    assert out[1] == "listo" and out[2] == "ganar" and len(out) == 3
    prior = spark.createDataFrame([(1, "previo"), (2, " "), (3, "viejo")], "message_id long, texto_es string")
    got = {r.message_id: (r.texto_es, r.rehecho) for r in translate.incremental_patch(df, prior).collect()}
    assert got == {1: ("previo", False), 2: ("ganar", True), 3: ("x" * 700, True)}


def test_first_readable_source_and_removed_stages(spark, tmp_path):
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"no parquet at all")
    good = tmp_path / "good.jsonl"
    good.write_text('{"message_id": 1, "text": "a"}\n')
    schema = "message_id long, text string"
    df = mail.read_first(spark, [str(tmp_path / "none.csv"), str(broken), str(good)], T.StructType.fromDDL(schema))
    assert [r.message_id for r in df.collect()] == [1]
    with mail.stage_scope(spark):
        kept = mail.write_stage(df, "scoped")
        path = kept.inputFiles()[0].removeprefix("file:")
        assert kept.count() == 1 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))


def test_examples_without_a_language_column(spark):
    df = spark.range(50).select(F.col("id").alias("message_id"))
    assert ids(translate.examples_per_language(df)) == list(range(30))


def test_language_at_scoring_time(spark):
    words = {"en": "the quick reply about money was sent this week", "es": "los pagos de esta semana se enviaron ayer",
             "fr": "les paiements de cette semaine ont été envoyés hier"}
    rows = [(i, words[l], l) for i, l in enumerate(words)] + [(9, "sin idioma", None)]
    model = normalise.train_languages(spark.createDataFrame(rows, "message_id long, text string, lang string"))
    assert model.languages == ("en", "es", "fr")
    late = "7 " * 400 + words["fr"] * 20     # the language shows far behind the batch window
    mails = [(1, None), (2, " \n"), (3, "12 345 678"), (4, "the"), (5, late), (6, words["en"])]
    got = normalise.detect_mail_language(spark.createDataFrame(mails, "message_id long, text string"), model)
    assert {r.message_id: r.idioma_detectado for r in got.collect()} == {1: "es", 2: "es", 3: "es", 4: "es", 5: "fr", 6: "en"}


def test_too_many_languages_are_refused(spark):
    df = spark.range(normalise.MAX_LANGUAGES + 1).select(F.lit("texto").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError):
        normalise.train_languages(df)


def test_serving_model_learns_from_whole_texts(spark):
    """All texts open with the same 1,000 characters; only what follows tells the languages apart."""
    head = "xx yy " * 170
    tail = {"en": "the quick reply about money was sent this week ", "es": "los pagos de esta semana se enviaron ayer "}
    rows = [(i, head + tail[lang] * 30, lang) for i, lang in enumerate(["en", "es"] * 5)]
    docs = spark.createDataFrame(rows, "message_id long, text string, lang string")
    model = normalise.train_whole_texts(docs)
    got = {r.message_id: r.idioma_detectado for r in normalise.detect_mail_language(docs, model).collect()}
    assert got == {i: lang for i, _, lang in rows}


def test_language_scores_equal_plain_counts(spark):
    """N-gram sums in batches against dictionaries; characters beyond the first plane, blanks and empty texts too."""
    texts = ["hello there friend", "hola que tal amigo", "\U00020000\U00020001 hello", "", None, "ab", "hola " * 5000]
    rows = [(i, t, "en" if i % 2 == 0 else "es") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "message_id long, text string, lang string").repartition(2)
    model = normalise.train_languages(docs, window=None)
    grams = lambda t: [t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)]
    counts = {lang: collections.Counter(g for _, t, own in rows if own == lang for g in grams((t or "").strip().lower())) for lang in ("en", "es")}
    sizes = len({g for c in counts.values() for g in c})
    for i, t, _ in rows:
        text = (t or "").strip().lower()
        scores = {lang: sum(math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * sizes)) for g in grams(text)) for lang, c in counts.items()}
        want = "desconocido" if len(text) < 6 else max(scores, key=lambda k: round(scores[k], 6))
        got = normalise.detect_language(docs.filter(F.col("message_id") == i), model, window=None).first()["idioma_detectado"]
        assert got == want, (i, scores)


def test_ngrams_by_table_equal_ngrams_by_key(monkeypatch):
    """Counts and gains are the same whether characters are numbered, too many for a table or met in part only."""
    import types

    import numpy as np
    import pyarrow as pa

    from cartero.functions import grams
    texts, langs = ["", "a", "ab", "hello there", "\U00020000\U00020001 hello", "", "tschüß hello", "中文字符"], ["en", "de"] * 4
    plain = collections.Counter((lang, t[i:i + n]) for t, lang in zip(texts, langs) for n in (1, 2, 3) for i in range(len(t) - n + 1))
    key = lambda g: sum((ord(c) + 1) << (42 - 21 * k) for k, c in enumerate(g))
    batch = pa.RecordBatch.from_pydict({"idioma": langs, "_t": texts})
    for table in (1 << 23, 1):
        monkeypatch.setattr(grams, "TABLE", table)
        got = collections.Counter()
        for b in grams.counter((1, 2, 3))([batch]):
            for r in b.to_pylist():
                got[r["idioma"], r["g"]] += r["n"]
        assert got == {(lang, key(g)): n for (lang, g), n in plain.items()}
    known = sorted({key(g): g for lang, g in plain if lang == "en"}.items())
    keys, gains = np.array([k for k, _ in known]), np.arange(2.0 * len(known)).reshape(-1, 2)
    rows = pa.RecordBatch.from_pydict({"_row": list(range(len(texts))), "_t": texts})
    for dense in (160, 3):
        monkeypatch.setattr(grams, "DENSE", dense)
        out = next(grams.scorer((1, 2, 3), types.SimpleNamespace(value=(keys, gains)), 2)([rows])).to_pylist()
        for t, r in zip(texts, out):
            found = [gains[np.searchsorted(keys, key(g))] for n in (1, 2, 3) for g in (t[i:i + n] for i in range(len(t) - n + 1)) if key(g) in keys]
            assert r["_sums"] == list(np.sum(found, axis=0) if found else [0.0, 0.0])
            assert r["_n"] == grams.gram_number(len(t), (1, 2, 3))
