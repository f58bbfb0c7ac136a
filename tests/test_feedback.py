import glob
import math

import pytest
from pyspark.sql import functions as F

from cartero.operators import bayes, features, history, online
from cartero.functions.expressions import text_key
from cartero.plans import tables
from cartero.sources import mail
from cartero.sources.mail import FEEDBACK_SCHEMA
from cartero.streaming import feedback as stream

TEXTS = ["win cash now please friend", "the meeting report is attached today", "  win cash now please friend ", " "]


def events(n=40):
    return [(i, f"2024-01-01 00:{i:02d}:00", TEXTS[i % 4], i % 2, "en" if i % 3 else "es",
             round(i / n, 4), "SPAM" if i % 5 else "HAM", 0.5) for i in range(n)]


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(events(), FEEDBACK_SCHEMA).withColumn("p_posterior", F.col("p_spam") / 2)


def test_records(log):
    rows = {r.seq: r for r in history.feedback_records(log).collect()}
    assert len(rows) == 30 and 3 not in rows
    r = rows[1]
    assert (r.porcentaje_antes, r.porcentaje_despues, r.cambio_delta) == ("2.5%", "1.3%", "-1.2%")
    assert r.etiqueta_ensenada == "SPAM" and r.era_correcto and r.idioma == "EN"
    assert rows[0].cambio_delta == "+0.0%"


def test_long_summary(spark, log):
    long = log.limit(1).withColumn("texto", F.lit("x" * 121))
    assert history.feedback_records(long).first()["texto_resumen"] == "x" * 120 + "..."


def brute_catalogue():
    out = {}
    for seq, ts, text, label, lang, p, _, _ in events():
        key = text.strip()
        if not key:
            continue
        e = out.setdefault(key, [f"fb_{len(out) + 1:03d}", ts, lang.upper(), label, 0, None, None])
        e[3], e[4], e[6] = label, e[4] + 1, p / 2
        e[5] = ts if e[4] > 1 else None
    return sorted((k, *v) for k, v in out.items())


def test_catalogue(log):
    got = history.retrain_catalogue(log, stretch=7).collect()
    assert sorted((r.texto, r.id, r.fecha, r.idioma, r.label, r.veces_entrenado, r.ultima_fecha,
                   r.ultima_probabilidad_spam) for r in got) == brute_catalogue()


def test_catalogue_stream_equals_batch(spark, log, tmp_path):
    rows = spark.createDataFrame(events(), FEEDBACK_SCHEMA)
    rows.repartition(3, F.col("seq") % 3).write.json(str(tmp_path / "in"))
    state = stream.CatalogueState(str(tmp_path / "cat"))
    run = stream.keep_catalogue(stream.read_events(spark, str(tmp_path / "in"), files_per_batch=1), state,
                                str(tmp_path / "ck"), "p_spam")
    run.awaitTermination()
    got = state.current(spark, stream.batches_done(run), stretch=7)
    want = history.retrain_catalogue(rows, posterior="p_spam", stretch=7)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_numbering_across_stretches(spark):
    df = spark.range(1000).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    rows = history.numbered(df, ["k"], stretch=50).filter("k = 'hot'").orderBy("seq").collect()
    assert [r.numero for r in rows] == list(range(1, 335))


def test_groups_timeline_search_page(log):
    records = history.feedback_records(log)
    groups = history.history_groups(records)
    rows = groups.orderBy(*history.history_order()).collect()
    assert [(r.veces, r.primero, r.ultimo) for r in rows] == [(20, 0, 38), (10, 1, 37)]
    line = history.history_timeline(records, stretch=5).filter("seq % 4 = 1").orderBy("seq").collect()
    assert [r.iteracion for r in line] == list(range(1, 11)) and [r.es_actual for r in line] == [False] * 9 + [True]
    assert history.history_search(groups, " MEETING ").count() == 1
    assert history.history_search(groups, "  ").count() == 2
    assert history.history_page(groups, page=9, size=1).first()["primero"] == 1
    assert history.history_page(groups, size="all").count() == 2


def test_unparseable_time_sorts_last(log):
    bad = log.withColumn("timestamp", F.when(F.col("seq") == 38, "ayer").otherwise(F.col("timestamp")))
    rows = history.history_groups(history.feedback_records(bad)).orderBy(*history.history_order()).collect()
    assert [r.tiempo == 0 for r in rows] == [False, True]


def test_online_learning_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame(events(), FEEDBACK_SCHEMA)
    train = spark.createDataFrame([(0, "win cash prize", 1), (1, "meeting report office", 0), (2, "cash now", 1)],
                                  "message_id long, clean_en string, Label_Code int")
    both = [features.featurise(train, "clean_en", m, features.stop_words(m), n) for m, n in (("en", 2), ("es", 1))]
    base = bayes.train(both[0].unionByName(both[1]), 50, models=2)
    rows.repartition(4, F.col("seq") % 4).write.json(str(tmp_path / "in"))
    state = stream.ModelState(str(tmp_path / "model"), base.max_rows).start(base)
    run = stream.learn(stream.read_events(spark, str(tmp_path / "in"), files_per_batch=1), state,
                       str(tmp_path / "log"), str(tmp_path / "ck"))
    run.awaitTermination()
    last = max(p["batchId"] for p in run.recentProgress)
    want = bayes.partial_fit(base, stream.taught_features(rows))
    got = state.model_before(spark, last + 1)
    key = lambda m: {(r.modelo, r.term): (round(r.w_ham, 9), round(r.w_spam, 9)) for r in m.counts.collect()}
    assert key(got) == key(want)
    assert sorted(map(tuple, got.priors.collect())) == sorted(map(tuple, want.priors.collect()))
    assert spark.read.json(str(tmp_path / "log")).count() == 30
    replay = state.teach(spark, last, stream.taught_features(rows.filter(F.col("seq") < 0)))
    assert replay.priors.count() == 2


def test_history_page_equals_plain_order(spark):
    day = "CASE WHEN id % 3 = 0 THEN 1000 ELSE 1000 + (id * 37) % 400000 END"
    groups = spark.range(1, 301).selectExpr("id AS primero", f"{day} AS tiempo", "concat('t', id) AS texto")
    want = [r["primero"] for r in groups.orderBy(*history.history_order()).collect()]
    for page in (1, 7, 12, 30, 99):
        got = [r["primero"] for r in history.history_page(groups, page, 10, stretch=16).collect()]
        first = (min(page, 30) - 1) * 10
        assert got == want[first:first + 10]
    assert history.history_page(groups.limit(0), 3, 10).count() == 0


def test_samples_are_counted_per_model(spark):
    events = spark.createDataFrame([(1, "en"), (2, "es"), (3, "en"), (5, "fr")], "seq long, modelo string")
    priors = spark.createDataFrame([("en", 3, 4), ("es", 1, 1)], "modelo string, n_ham long, n_spam long")
    got = {r["seq"]: r["num_muestras_total"] for r in history.count_samples(events, priors, stretch=2).collect()}
    assert got == {1: 8, 2: 3, 3: 9, 5: 1}


def base_model(spark):
    train = spark.createDataFrame([(0, "win cash prize", 1), (1, "meeting report office", 0), (2, "cash now", 1)],
                                  "message_id long, clean_en string, Label_Code int")
    both = [features.featurise(train, "clean_en", m, features.stop_words(m), n) for m, n in (("en", 2), ("es", 1))]
    return bayes.train(both[0].unionByName(both[1]), 50, models=2)


def one_by_one(spark, base, rows):
    """Teach one event after the other and ask the model for it each time."""
    out, model = {}, base
    counts = {(r.modelo, r.term): [r.idf, r.w_ham, r.w_spam] for r in base.counts.collect()}
    priors = {r.modelo: [r.n_ham, r.n_spam] for r in base.priors.collect()}
    for r in sorted(stream.taught_features(rows).collect(), key=lambda r: r.message_id):
        x = {t.term: (1 + math.log(t.cnt)) * counts[r.modelo, t.term][0] for t in r.rasgos if (r.modelo, t.term) in counts}
        norm = math.sqrt(sum(v * v for v in x.values()))
        priors[r.modelo][r.Label_Code] += 1
        for t, v in x.items():
            counts[r.modelo, t][1 + r.Label_Code] += v / norm
        own = {t: c for (m, t), c in counts.items() if m == r.modelo}
        total = [sum(c[k] for c in own.values()) for k in (1, 2)]
        margin = math.log(priors[r.modelo][1] / priors[r.modelo][0])
        for t, v in x.items():
            ham, spam = ((own[t][k] + model.alpha) / (total[k - 1] + model.alpha * len(own)) for k in (1, 2))
            margin += v / norm * (math.log(spam) - math.log(ham))
        out[r.message_id] = 1 / (1 + math.exp(-margin))
    return out


@pytest.mark.parametrize("files, each", [(1, 1), (8, 4)])
def test_every_event_is_scored_right_after_it(spark, tmp_path, files, each):
    rows, base = spark.createDataFrame(events(), FEEDBACK_SCHEMA), base_model(spark)
    width = -(-40 // files)
    for i in range(files):
        rows.filter((F.col("seq") >= i * width) & (F.col("seq") < (i + 1) * width)).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    state = stream.ModelState(str(tmp_path / "model"), base.max_rows).start(base)
    kept = stream.CatalogueState(str(tmp_path / "cat"))
    run = stream.learn(stream.read_events(spark, str(tmp_path / "in"), files_per_batch=each), state, str(tmp_path / "log"), str(tmp_path / "ck"), kept)
    run.awaitTermination()
    want = one_by_one(spark, base, rows)
    got = {r.seq: r.probabilidad_spam_posterior for r in spark.read.json(str(tmp_path / "log")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    # the catalogue that the stream keeps has these scores
    scored = spark.createDataFrame(list(got.items()), "seq long, p_posterior double").join(rows, "seq")
    batch = history.retrain_catalogue(scored, stretch=7)
    now = kept.current(spark, stream.batches_done(run), stretch=7)
    assert sorted(map(tuple, now.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_running_sums_over_stretches(spark):
    rows = spark.range(1000).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                    (F.col("id") * 0.5).alias("v"))
    got = {r.seq: r.run_v for r in online.running_sums(rows, ["k"], "seq", ["v"], stretch=50).collect()}
    total = 0.0
    for i in range(1000):
        total += i * 0.5 if i % 3 == 0 else 0
        assert got[i] == (total if i % 3 == 0 else i * 0.5)


def test_catalogue_replays_and_snapshots(spark, log, tmp_path, monkeypatch):
    """A replayed batch changes nothing, texts are stored once, and a snapshot stands for the deltas before it."""
    monkeypatch.setattr(stream, "COMPACT_EVERY", 2)
    state = stream.CatalogueState(str(tmp_path / "cat"))
    for b in (0, 1, 1, 2, 0, 3, 4, 4):
        state.add(b, log.filter((F.col("seq") >= b * 8) & (F.col("seq") < b * 8 + 8)), "p_posterior")
    want = history.retrain_catalogue(log, stretch=7)
    got = state.current(spark, 5, stretch=7)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    texts = spark.read.parquet(*[f"{tmp_path}/cat/delta/{b}/texts" for b in range(5)])
    assert texts.count() == texts.select("clave").distinct().count() == 2


def test_history_by_key_equals_history_by_text(log):
    """A log may carry the key of its text; the texts are added to the result."""
    trimmed = log.withColumn("texto", F.trim("texto")).filter("texto <> ''").withColumn("clave", text_key(F.col("texto")))
    narrow, texts = trimmed.drop("texto"), trimmed.select("clave", "texto").dropDuplicates(["clave"])
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    records, plain = history.feedback_records(narrow), history.feedback_records(log)
    assert "texto" not in records.columns and same(history.with_texts(records, texts).select(*plain.columns), plain)
    assert same(history.history_groups(records, texts), history.history_groups(plain))
    assert same(history.retrain_catalogue(narrow, stretch=7, texts=texts), history.retrain_catalogue(log, stretch=7))
    line = history.history_timeline(records, stretch=5)
    assert same(line, history.history_timeline(plain, stretch=5))


@pytest.fixture
def small_tables(spark, tmp_path):
    """300 events over four documents: one null, one blank, two of one trimmed text."""
    docs = [(1, "buy now", "en"), (2, " buy now ", "es"), (3, None, "en"), (4, "  ", "es"), (5, "hola", None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("source", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(300).select(F.col("id").alias("event_id"), F.expr("timestamp_seconds(1700000000 + id * 60)").alias("ts"),
                            F.when(F.col("id") % 4 == 0, "error").otherwise("view").alias("event_type"), (F.col("id") % 7 + 0.5).alias("value"),
                            F.format_string('{"k": %d}', F.col("id") % 100).alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("trim", [True, False])
def test_keyed_feedback_equals_feedback(spark, small_tables, trim):
    """Each different text once, and with it the events of the plain feedback."""
    events, texts = tables.keyed_feedback(spark, small_tables, trim)
    assert texts.count() == (2 if trim else 5) and "texto" not in events.columns
    got, plain = events.join(texts, "clave").drop("clave"), tables.feedback(spark, small_tables)
    if trim:
        plain = plain.withColumn("texto", F.trim("texto")).filter("texto <> ''")
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_log_files_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mail, "LOG_ROWS", 50)
    rows = spark.range(200).select(F.col("id").alias("seq"), F.lit("text " * 100).alias("texto")).coalesce(1)
    mail.append_log(rows, f"{tmp_path}/log")
    mail.append_log(rows, f"{tmp_path}/log")
    files = glob.glob(f"{tmp_path}/log/*.json.lz4")
    assert len(files) == 8
    assert mail.read_log(spark, f"{tmp_path}/log", rows.schema).count() == 400


def test_catalogue_of_repeated_arrival_numbers_is_numbered_by_row(log):
    """Entries that an arrival number repeats keep ids of their own."""
    twice = log.filter("seq < 3").unionByName(log.filter("seq = 1"))
    got = [r["id"] for r in history.retrain_catalogue(twice, stretch=7).collect()]
    assert sorted(got) == [f"fb_{i:03d}" for i in range(1, len(got) + 1)] and len(got) == 5


def test_scores_do_not_depend_on_stretches(spark):
    """Counts at the start of a stretch are prefix sums; a stretch of 3 and of all events give one result."""
    rows, base = spark.createDataFrame(events(), FEEDBACK_SCHEMA), base_model(spark)
    keyed, texts = stream.keyed_batch(rows)
    taught = keyed.select(stream._taught_model(), F.col("seq").alias("message_id"), F.col("label").alias("Label_Code"), "clave")
    vocab, cells = online.text_cells(stream.taught_texts(taught, texts), base)
    weighted, want = online.weighted_events(taught, cells), one_by_one(spark, base, rows)
    assert cells.count() <= 4                                     # models x different texts, not events
    got = {r.message_id: r.p_posterior for r in online.posterior_after_each(weighted, vocab, cells, base, 3).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_texts_are_looked_up_where_they_are(spark, monkeypatch):
    """One packed row per model and text without a shuffle of terms; the joins of a larger model give the same."""
    base = base_model(spark)
    rows = [("en", b"a", "win cash cash prize the meeting"), ("es", b"a", "win cash"), ("en", b"b", "nothing known"), ("en", b"c", None)]
    texts = spark.createDataFrame(rows, "modelo string, message_id binary, texto_procesado string")

    def read(pair):
        names = {(r.modelo, r.i): r.term for r in pair[0].collect()}
        return {(r.modelo, bytes(r.clave)): ({names[r.modelo, i]: n for i, n in zip(memoryview(r.i).cast("i"), memoryview(r.cnt).cast("i"))},
                                             round(r.norma, 9), round(r.masa, 9)) for r in pair[1].collect()}

    got = read(online.text_cells(texts, base))
    assert got.keys() == {("en", b"a"), ("es", b"a")}
    assert got["en", b"a"][0] == {"win": 1, "cash": 2, "prize": 1, "meeting": 1, "win cash": 1, "cash prize": 1}
    assert got["es", b"a"][0] == {"win": 1, "cash": 1}
    monkeypatch.setattr(online, "BROADCAST_ROWS", 0)
    assert read(online.text_cells(texts, base)) == got


def test_stretches_gain_blocks_of_terms(spark, monkeypatch):
    """A stretch sends lists per block of terms and no row per text and term; unlabelled mails are scored and teach nothing."""
    monkeypatch.setattr(online, "BLOCK", 3)
    rows = spark.createDataFrame([(*r[:3], None if r[0] % 5 == 0 else r[3], *r[4:]) for r in events()] + [(None, *events()[1][1:])], FEEDBACK_SCHEMA)
    base, labelled = base_model(spark), rows.filter("label IS NOT NULL AND seq IS NOT NULL")
    keyed, texts = stream.keyed_batch(rows)
    taught = keyed.select(stream._taught_model(), F.col("seq").alias("message_id"), F.col("label").alias("Label_Code"), "clave")
    vocab, cells = online.text_cells(stream.taught_texts(taught, texts), base)
    weighted = online.weighted_events(taught, cells)
    known = online.stretch_texts(weighted, cells, 4)
    added = online.stretch_gains(known)
    assert added.count() <= 2 * 11 * (1 + vocab.count() // 3)
    gained = {(r.modelo, r.term): (r.w_ham, r.w_spam) for r in online.gains(added, vocab).collect()}
    flat = bayes.class_sums(bayes.tfidf(stream.taught_features(rows), base.counts, base.max_rows, "Label_Code"), ["modelo", "term"], F.col("x"))
    want = {(r.modelo, r.term): (r.w_ham, r.w_spam) for r in flat.collect()}
    assert gained.keys() == want.keys()
    assert all(abs(a - b) < 1e-9 for k in want for a, b in zip(gained[k], want[k]))
    scored = online.posterior_after_each(weighted, vocab, cells, base, 4, (known, added)).collect()
    got, alone = {r.message_id: r.p_posterior for r in scored}, one_by_one(spark, base, labelled)
    assert got.keys() == {i for i in range(40) if i % 4 < 3} and all(abs(got[k] - alone[k]) < 1e-9 for k in alone)
    assert all(0 < p < 1 for p in got.values())
