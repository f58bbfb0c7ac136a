import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartero.operators import bayes, cells, evaluate, features, logistic, registry, score, selection
from cartero.sources.mail import write_stage

STOP = ["the"]


def corpus(n=60, seed=3):
    rng, rows = random.Random(seed), []
    for i in range(n):
        y = i % 3 == 0
        pool = ["win", "cash", "prize", "now"] if y else ["meeting", "report", "office", "team"]
        words = [rng.choice(pool + ["the", "hello", "mail", "day"]) for _ in range(rng.randint(3, 12))]
        rows.append((i, " ".join(words), int(y)))
    return rows


def brute_nb(train, docs, k, alpha):
    def grams(t):
        w = [x for x in t.split() if len(x) >= 2 and x not in STOP]
        return Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])

    counts = [grams(t) for _, t, _ in train]
    total, df = Counter(), Counter()
    for c in counts:
        total.update(c)
        df.update(c.keys())
    vocab = [t for t, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:k]]
    idf = {t: math.log((1 + len(train)) / (1 + df[t])) + 1 for t in vocab}

    def vec(c):
        x = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
        return {t: v / norm for t, v in x.items()}

    w = [Counter(), Counter()]
    for c, (_, _, y) in zip(counts, train):
        for t, v in vec(c).items():
            w[y][t] += v
    s = [sum(w[y].values()) + alpha * len(vocab) for y in (0, 1)]
    bias = math.log(sum(r[2] for r in train) / sum(1 - r[2] for r in train))
    out = {}
    for i, t, _ in docs:
        m = bias + sum(v * (math.log((w[1][g] + alpha) / s[1]) - math.log((w[0][g] + alpha) / s[0])) for g, v in vec(grams(t)).items())
        out[i] = 1 / (1 + math.exp(-m))
    return out


@pytest.fixture(scope="module")
def feats(spark):
    df = spark.createDataFrame(corpus(), "message_id long, clean_en string, Label_Code int")
    return write_stage(features.featurise(df, "clean_en", "m", STOP, 2), "test_features")


def test_naive_bayes_against_brute_force(spark, feats):
    rows = corpus()
    extra = [(100, "unknown words only", 0), (101, "", 0)]
    docs = spark.createDataFrame(rows + extra, "message_id long, clean_en string, Label_Code int")
    model = bayes.train(feats, 25, 0.3)
    got = {r.message_id: r.p_spam for r in bayes.score(features.featurise(docs, "clean_en", "m", STOP, 2), model).collect()}
    want = brute_nb(rows, rows + extra, 25, 0.3)
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)
    assert got[100] == pytest.approx(20 / 60)


def test_partial_fit_adds_counts(feats):
    base = bayes.train(feats, 25)
    taught = bayes.partial_fit(base, feats)
    a = {r.term: (r.w_ham, r.w_spam) for r in base.counts.collect()}
    b = {r.term: (r.w_ham, r.w_spam) for r in taught.counts.collect()}
    assert all(b[t] == pytest.approx((2 * a[t][0], 2 * a[t][1])) for t in a)
    assert taught.priors.first()["n_spam"] == 2 * base.priors.first()["n_spam"]


def test_save_and_load(spark, feats, tmp_path):
    model = bayes.train(feats, 25)
    model.save(str(tmp_path / "m"))
    back = bayes.NaiveBayes.load(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, model.counts.collect()))
    assert (back.max_rows, back.alpha) == (25, 0.1)


def test_calibration_prefers_smallest_best_threshold(spark):
    rows = [("m", 1, 0.9), ("m", 1, 0.6), ("m", 0, 0.3), ("m", 0, 0.1), ("one", 0, 0.9)]
    df = spark.createDataFrame(rows, "modelo string, Label_Code int, p_spam double")
    got = {r.modelo: (r.umbral, r.fbeta) for r in bayes.calibrate_threshold(df).collect()}
    assert got == {"m": (0.35, 1.0), "one": (0.2, 0.0)}
    assert bayes.predict(df.filter("p_spam = 0.6"), 0.6).first()["pred"] == 1


def brute_auc(rows):
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    total, ap, n_pos = 0.0, 0.0, sum(y for y, _ in rows)
    for cut in sorted({p for _, p in rows}, reverse=True):
        hit = [y for y, p in rows if p >= cut]
        recall = sum(hit) / n_pos
        ap, total = ap + (recall - total) * sum(hit) / len(hit), recall
    return ap


def test_ranking_metrics_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(700)]
    df = spark.createDataFrame([("m", y, p) for y, p in rows] + [("one", 0, 0.5)], "modelo string, Label_Code int, p_spam double")
    got = {r.modelo: (r.roc_auc, r.pr_auc) for r in evaluate.ranking_metrics(df).collect()}
    assert got == {"m": (round(brute_auc(rows), 4), round(brute_ap(rows), 4)), "one": (0.0, 0.0)}
    curve = evaluate.roc_curve(df.filter("modelo = 'm'")).orderBy("umbral").collect()
    assert (curve[0].fpr, curve[0].tpr) == (1.0, 1.0) and len(curve) == len({p for _, p in rows})


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([("m", 0, 0, 0.1, 1), ("m", 1, 0, 0.2, 2)], "modelo string, Label_Code int, pred int, p_spam double, message_id long")
    r = evaluate.classification_metrics(df).first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (0.5, 0.0, 0.0, 0.0)
    assert [x.tipo for x in evaluate.error_audit(df.withColumn("t", F.lit("x")), "t").collect()] == ["FN"]


def test_grid_search_matches_single_fits(spark):
    df = spark.createDataFrame(corpus(90), "message_id long, clean_en string, Label_Code int")
    grid = {(r.alpha, r.max_features, r.ngram): r.f1_medio for r in selection.grid_search(df, "clean_en", STOP, [10, 30], [1, 2], [0.1, 1.0]).collect()}
    assert len(grid) == 8
    from cartero.operators.sampling import stratified_kfold
    rows = stratified_kfold(df, 3).collect()
    f1s = []
    for f in range(3):
        train = [(r.message_id, r.clean_en, r.Label_Code) for r in rows if r.pliegue != f]
        held = [(r.message_id, r.clean_en, r.Label_Code) for r in rows if r.pliegue == f]
        p = brute_nb(train, held, 30, 1.0)
        tp = sum(p[i] > 0.5 and y for i, _, y in held)
        wrong = sum((p[i] > 0.5) != bool(y) for i, _, y in held)
        f1s.append(2 * tp / (2 * tp + wrong) if tp else 0.0)
    assert grid[(1.0, 30, 2)] == pytest.approx(sum(f1s) / 3, abs=1e-6)


def test_logistic_regression_separates(spark, feats):
    vocab = write_stage(features.vocabulary(feats, 30), "test_vocab")
    data = logistic.vectors(feats, vocab, 30, "Label_Code")
    assert data.count() == 60
    model = logistic.fit(data, 60, 4.0)
    r = evaluate.evaluate(bayes.predict(logistic.score(data, model, "Label_Code"), 0.5)).first()
    assert r.roc_auc > 0.95
    assert logistic.coefficients(model, vocab).count() == vocab.count()


def test_logistic_grid(spark):
    df = spark.createDataFrame(corpus(60), "message_id long, clean_en string, Label_Code int")
    rows = selection.logistic_grid(df, "clean_en", STOP, [0.01, 4.0], 30, 2).collect()
    got = {r.c: (r.f1_medio, r.mejor) for r in rows}
    assert got[4.0][1] and got[4.0][0] > 0.8 and not got[0.01][1]


def newton(x, y, c, steps=50):
    """Logistic regression by Newton steps; the last column of ``x`` is the free intercept."""
    n, w = len(y), np.zeros(x.shape[1])
    decay = np.append(np.full(x.shape[1] - 1, 1 / (c * n)), 0.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x / n + np.diag(decay), x.T @ (p - y) / n + decay * w)
    return w


def design(train, docs, k):
    """Unit-length TF-IDF rows of ``docs`` by the vocabulary of ``train``, and the vocabulary."""
    def grams(t):
        w = [x for x in t.split() if len(x) >= 2 and x not in STOP]
        return Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])

    total, df = Counter(), Counter()
    for _, t, _ in train:
        total.update(grams(t))
        df.update(grams(t).keys())
    vocab = [t for t, _ in sorted(total.items(), key=lambda e: (-e[1], e[0]))[:k]]
    x = np.zeros((len(docs), len(vocab) + 1))
    for i, (_, t, _) in enumerate(docs):
        c = grams(t)
        for j, g in enumerate(vocab):
            x[i, j] = (1 + math.log(c[g])) * (math.log((1 + len(train)) / (1 + df[g])) + 1) if c[g] else 0.0
        x[i] /= np.linalg.norm(x[i]) or 1.0
        x[i, -1] = 1.0
    return x, vocab


@pytest.fixture(scope="module")
def folded(spark):
    """Two corpora with folds by id; mail 100 has no known term and mail 101 no text."""
    out, rows = {}, []
    for name, seed in (("a", 3), ("b", 5)):
        docs = corpus(60, seed) + [(100, "zzz", 1), (101, "", 0)]
        out[name] = docs
        rows += [(name, i, t, y, i // 3 % 3) for i, t, y in docs]
    df = spark.createDataFrame(rows, "modelo string, message_id long, t string, Label_Code int, pliegue int")
    parts = [features.featurise(df.filter(F.col("modelo") == m), "t", m, STOP, 2, ("Label_Code", "pliegue")) for m in out]
    return out, write_stage(parts[0].unionByName(parts[1]), "test_folded")


def test_all_logistic_cells_equal_a_fit_each(spark, folded):
    docs, stack = folded
    grid = [0.5, 4.0]
    fit = cells.fit_cells(stack, 3, grid, 30, tol=1e-7)
    got = {(r.modelo, r.c, r.message_id): r.p_spam for r in fit.score(stack).collect()}
    whole = {(r.modelo, r.c, r.message_id): r.p_spam
             for r in fit.score(stack.withColumn("pliegue", F.lit(None).cast("int"))).collect()}
    coefs = {(r.modelo, r.c, r.term): r.peso for r in fit.coefficients().collect()}
    assert len(got) == len(whole) == 2 * 2 * 62
    for m, rows in docs.items():
        for c in grid:
            for fold in (0, 1, 2, None):
                train = [r for r in rows if fold is None or r[0] // 3 % 3 != fold]
                held = [r for r in rows if fold is None or r[0] // 3 % 3 == fold]
                w = newton(design(train, train, 30)[0], np.array([r[2] for r in train]), c)
                p = 1 / (1 + np.exp(-design(train, held, 30)[0] @ w))
                have = whole if fold is None else got
                assert [have[m, c, r[0]] for r in held] == pytest.approx(p, abs=1e-5)
                if fold is None:
                    vocab = design(train, train, 30)[1]
                    assert [coefs[m, c, t] for t in vocab] == pytest.approx(w[:-1], abs=1e-4)


def f1_of(held, p):
    tp = sum(p[i] > 0.5 and y for i, _, y in held)
    wrong = sum((p[i] > 0.5) != bool(y) for i, _, y in held)
    return 2 * tp / (2 * tp + wrong) if tp else 0.0


def test_ended_columns_are_not_asked_again(spark, folded, monkeypatch):
    asked, whole = [], cells._sums
    monkeypatch.setattr(cells, "_sums", lambda data, tables, points: asked.append(set(points)) or whole(data, tables, points))
    cells.fit_cells(folded[1], 3, [0.01, 100.0], 30)
    assert len(asked[0]) == 2 * 4 * 2 and len(asked[-1]) < len(asked[0])
    assert all(later <= earlier for earlier, later in zip(asked, asked[1:]))


def test_slices_cover_all_rows_and_long_mails(monkeypatch):
    monkeypatch.setattr(cells, "SLICE", 5)
    offsets = np.array([0, 2, 2, 9, 10, 14, 15])
    assert list(cells._slices(offsets)) == [(0, 2), (2, 3), (3, 5), (5, 6)]
    assert list(cells._slices(np.array([0]))) == []


def test_comparison_has_both_algorithms(spark, folded):
    docs, stack = folded
    part = F.when(F.col("message_id") % 5 == 0, "test").when(F.col("message_id") % 5 == 1, "val").otherwise("fit")
    rows = write_stage(stack.withColumn("parte", part).withColumn(
        "pliegue", F.when(F.col("parte") != "test", F.col("pliegue"))), "test_compared")
    out, terms = selection.compare_models(rows, [0.5, 4.0], 30, nb_features=30, models=2)
    got = {r.modelo: r for r in out.collect()}
    assert set(got) == {"a_nb", "a_lr", "b_nb", "b_lr"}
    assert all(r.n == 13 for r in got.values())
    for m, mails in docs.items():
        seen = [r for r in mails if r[0] % 5]
        nb, lr = [], {0.5: [], 4.0: []}
        for f in range(3):
            train, held = [r for r in seen if r[0] // 3 % 3 != f], [r for r in seen if r[0] // 3 % 3 == f]
            nb.append(f1_of(held, brute_nb(train, held, 30, bayes.ALPHA)))
            x, y, z = design(train, train, 30)[0], np.array([r[2] for r in train]), design(train, held, 30)[0]
            for c, out_of in lr.items():
                p = 1 / (1 + np.exp(-z @ newton(x, y, c)))
                out_of.append(f1_of(held, {r[0]: v for r, v in zip(held, p)}))
        assert (got[f"{m}_nb"].f1_cv_mean, got[f"{m}_nb"].f1_cv_std) == pytest.approx((np.mean(nb), np.std(nb)), abs=1e-6)
        best = max(lr, key=lambda c: (round(np.mean(lr[c]), 6), -c))
        assert got[f"{m}_lr"].parametros == f"C={best}"
        assert (got[f"{m}_lr"].f1_cv_mean, got[f"{m}_lr"].f1_cv_std) == pytest.approx((np.mean(lr[best]), np.std(lr[best])), abs=1e-6)
    top = {r.term for r in bayes.top_terms(terms, 4).filter("clase = 'spam' AND modelo = 'a'").collect()}
    assert top & {"win", "cash", "prize", "now"}


def test_explanation(spark):
    weights = spark.createDataFrame([("m", "win", 2.0), ("m", "win cash", 1.5), ("m", "office", -1.0)], "modelo string, term string, peso double")
    mails = spark.createDataFrame([("m", 1, "Win cash, win office!"), ("m", 2, "")], "modelo string, message_id long, t string")
    got = {r.message_id: (r.tokens_spam, r.tokens_ham) for r in bayes.explain(mails, "t", weights, 3).collect()}
    assert got == {1: (["win (+2.00)", "win cash (+1.50)"], ["office (-1.00)"]), 2: ([], [])}


def test_certainty_and_audits(spark):
    df = spark.createDataFrame([
        (1, "a uno dos tres", 0.9, 0.7, "spam", "es"), (2, "uno dos tres cuatro cinco", 0.8, 0.7, "ham", "es"),
        (3, "uno dos tres cuatro cinco", 0.1, 0.7, "ham", "en")],
        "message_id long, texto_procesado string, p_spam double, umbral double, esperado string, categoria string")
    out = score.certainty(df)
    rows = {r.message_id: r for r in out.collect()}
    assert rows[1].motivo_incertidumbre == "Información insuficiente: correo muy escueto (3 tokens tras limpieza)."
    assert rows[2].motivo_incertidumbre.endswith("P(Spam)=0.800 muy cercana al umbral (0.70).")
    assert rows[3].etiqueta == "HAM" and not rows[3].es_incierto and rows[2].etiqueta == score.UNCERTAIN
    summary = {r.categoria: (r.aciertos, r.total, r.tasa) for r in score.audit_summary(score.bank_audit(out, "esperado")).collect()}
    assert summary == {"TOTAL": (2, 3, 66.7), "es": (1, 2, 50.0), "en": (1, 1, 100.0)}
    pool = {r.message_id: r.validacion for r in score.pool_validation(out.withColumn("esperado", F.upper("esperado"))).collect()}
    assert pool == {1: "ZONA GRIS", 2: "ZONA GRIS", 3: "ACIERTO"}


def test_routing(spark):
    df = spark.createDataFrame([(1, "hello no", "en"), (2, "hola no", "es"), (3, "hello win", "fr")], "message_id long, text string, idioma_detectado string")
    rows = {r.message_id: r for r in score.route(df).collect()}
    assert (rows[1].modelo, rows[2].modelo, rows[3].modelo) == ("en", "es", "es")
    assert rows[1].texto_procesado == "hello number" and rows[3].texto_procesado == "hola ganar"
    assert rows[3].idioma_modelo == "Español (Detectado FR, Traducido a ES)"
    assert {r.modelo for r in score.route(df, force_english=True).collect()} == {"en"}


def test_norms_need_no_exchange_of_term_rows(spark):
    rows = spark.createDataFrame([(1, "uno dos dos"), (2, "dos tres")], "message_id long, t string")
    feats = write_stage(features.featurise(rows, "t", "m", [], 1), "features")
    vocab = write_stage(features.vocabulary(feats, 10), "vocab")
    plan = features.tfidf(feats, vocab, 10)._jdf.queryExecution().executedPlan().toString()
    window, generate, dealt = plan.index("Window ["), plan.index("Generate inline"), plan.index("REPARTITION_BY_COL")
    assert window < generate < dealt and "ENSURE_REQUIREMENTS" not in plan[window:generate]


def test_scores_in_place_equal_scores_by_joins(spark, monkeypatch):
    """One pass over the mails against the long table: scores, explanations, ties and mails without known words."""
    train = spark.createDataFrame(corpus(60), "message_id long, clean_en string, Label_Code int")
    both = [features.featurise(train, "clean_en", m, features.stop_words(m), n) for m, n in (("en", 2), ("es", 1))]
    model = bayes.train(both[0].unionByName(both[1]), 500, models=2)
    texts = [r.clean_en for r in train.limit(20).collect()] + ["", "unseen words only", "a b c", "the the the"]
    rows = [(i, m, t) for i, (t, m) in enumerate((t, m) for t in texts for m in ("en", "es"))]
    routed = spark.createDataFrame(rows, "message_id long, modelo string, texto_procesado string").repartition(3)
    for explain in (True, False):
        here = score.score_mails(routed, model, explain)
        monkeypatch.setattr(score, "BROADCAST_ROWS", 0)
        joined = score.score_mails(routed, model, explain)
        monkeypatch.undo()
        a, b = ({r.message_id: r.asDict() for r in df.collect()} for df in (here, joined))
        assert a.keys() == b.keys() == set(range(len(rows)))
        for i in a:
            assert abs(a[i].pop("p_spam") - b[i].pop("p_spam")) < 1e-12 and a[i] == b[i]


def test_units_are_read_whole(spark, tmp_path):
    """A version without a manifest is not there, an old one stays readable, and the thresholds are the unit's own."""
    train = spark.createDataFrame(corpus(60), "message_id long, clean_en string, Label_Code int")
    feats = write_stage(features.featurise(train, "clean_en", "m", STOP, 2), "features")
    store = registry.ModelStore(str(tmp_path / "unit"))
    with pytest.raises(FileNotFoundError):
        store.load(spark)
    metrics = spark.createDataFrame([("m", 0.9)], "modelo string, f1 double")
    for k, umbral in ((10, 0.2), (30, 0.9)):
        model = bayes.train(feats, k)
        th = spark.createDataFrame([("m", umbral)], "modelo string, umbral double")
        assert store.commit(registry.ModelUnit(model, th, metrics, bayes.top_terms(bayes.term_weights(model), 3))) == (1 if k == 10 else 2)
    # a third version whose writer was lost: tables and a manifest folder, but no finished manifest
    (tmp_path / "unit" / "manifests" / "3").mkdir()
    new, old = store.load(spark), store.load(spark, 1)
    assert (new.version, old.version, store.versions(spark)) == (2, 1, [1, 2])
    assert old.model.counts.count() == 10 and new.model.counts.count() > 10 and new.terms.count() == 6
    got = {r.message_id: (r.p_spam, r.pred) for r in new.predict(feats, "Label_Code").collect()}
    assert len(got) == 60 and all(pred == (p >= 0.9) for p, pred in got.values())
    assert sum(p for _, p in got.values()) < old.predict(feats).filter("pred = 1").count()
    assert store.commit(new) == 3 and store.load(spark).version == 3  # the number given up is taken again


def test_mails_are_weighted_where_they_are(spark, feats):
    """Neither training sums nor scores take the terms of mails apart into rows."""
    vocab = write_stage(features.vocabulary(feats, 25), "vocab")
    model = bayes.train(feats, 25)
    for df in (bayes.unit_sums(feats, vocab, 25), bayes.score(feats, model)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "Generate" not in plan and "Window" not in plan


def test_sums_of_mails_equal_sums_by_joins(spark, monkeypatch):
    """Two models, repeated and null keys, a mail without label and one without known terms."""
    rows = [(i, t, y) for i, t, y in corpus(40)] + [(3, "win win mail", 1), (3, "hello mail", 0), (None, "cash now", 1), (None, "day mail", 0),
                                                   (50, "win day", None), (51, "zzz", 1), (52, "", 0)]
    df = spark.createDataFrame(rows, "message_id long, t string, Label_Code int")
    stack = features.featurise(df, "t", "a", STOP, 2).unionByName(features.featurise(df, "t", "b", [], 1))
    stack = write_stage(stack, "stack")
    vocab = write_stage(features.vocabulary(stack, 15), "vocab")
    weights = bayes.term_weights(bayes.train(stack, 15, models=2))
    mails = df.withColumn("modelo", F.lit("a"))

    def found():
        sums = {(r.modelo, r.term): (r.w_ham, r.w_spam) for r in bayes.unit_sums(stack, vocab, 30).collect() if r.w_ham or r.w_spam}
        p = {(r.modelo, r.message_id, r.Label_Code): r.p_spam for r in bayes.score(stack, bayes.train(stack, 15, models=2), "Label_Code").collect()}
        told = {r.message_id: (r.tokens_spam, r.tokens_ham) for r in bayes.explain(mails, "t", weights, 15).collect()}
        return sums, p, told

    here = found()
    monkeypatch.setattr(bayes, "BROADCAST_ROWS", 0)
    by_joins = found()
    assert here[2] == by_joins[2]
    for a, b in zip(here[:2], by_joins):
        assert a.keys() == b.keys()
        assert all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)


def test_counts_of_mails_in_batches(spark, monkeypatch):
    from cartero.functions import terms
    monkeypatch.setattr(terms, "SLICE", 10)
    texts = ["big a red the car big red", "", None, "the", "ñ él él  él", "car red big"]
    df = spark.createDataFrame(list(enumerate(texts)), "message_id long, t string")
    for n in (1, 2):
        got = {r.message_id: r.rasgos for r in features.featurise(df, "t", "m", STOP, n).collect()}
        for i, t in enumerate(texts):
            w = [x for x in (t or "").split(" ") if len(x) >= 2 and x not in STOP]
            want = Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])] * (n == 2))
            assert got[i] is None if t is None else dict((x.term, x.cnt) for x in got[i]) == want


def test_folds_in_batches_equal_folds_by_joins(spark, folded, monkeypatch):
    """Margins of every fold and size; repeated keys and a mail of no fold too."""
    more = [("a", 3, "win win mail", 1, 0), ("a", 70, "cash day", 1, None), ("b", 71, "hello day", 0, 2)]
    df = spark.createDataFrame(more, "modelo string, message_id long, t string, Label_Code int, pliegue int")
    stack = folded[1]
    for m in ("a", "b"):
        stack = stack.unionByName(features.featurise(df.filter(F.col("modelo") == m), "t", m, STOP, 2, ("Label_Code", "pliegue")))
    stack = write_stage(stack, "stack")

    def found():
        rows = selection.fold_margins(stack, 3, [10, 20], [0.1, 1.0], 2)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        return sorted((r.modelo, r.Label_Code, r.alpha, r.max_features, r._m) for r in rows.collect()), plan

    here, plan = found()
    monkeypatch.setattr(selection, "BROADCAST_ROWS", 0)
    by_joins, _ = found()
    assert "MapInArrow" in plan and "Generate inline(rasgos" not in plan
    assert [r[:4] for r in here] == [r[:4] for r in by_joins]
    assert [r[4] for r in here] == pytest.approx([r[4] for r in by_joins], abs=1e-8)


def odd_features(spark):
    """Featurised mails of two corpora with a repeated key, null keys, a null text and a mail of stop words only."""
    rows = [(i, t, y, "fit" if i % 4 else "val") for i, t, y in corpus(40)]
    rows += [(7, "win cash office", 1, "fit"), (None, "win day", 0, "fit"), (None, "hello team", 1, "fit"), (90, None, 0, "fit"), (91, "the the", 1, "fit")]
    df = spark.createDataFrame(rows, "message_id long, clean_en string, Label_Code int, parte string").repartition(3)
    both = [features.featurise(df, "clean_en", m, STOP, n) for m, n in (("a", 2), ("b", 1))]
    return write_stage(both[0].unionByName(both[1]), "odd_features")


def test_tfidf_in_place_equals_dealt_out_mails(spark, monkeypatch):
    feats = odd_features(spark)
    vocab = write_stage(features.vocabulary(feats, 12), "vocab")
    found = []
    for in_place in (True, False):
        out = features.tfidf(feats, vocab, 24, "Label_Code", norm="norma", in_place=in_place)
        found.append(sorted((str(r.modelo), str(r.message_id), r.Label_Code, r.term, round(r.x, 9), round(r.norma, 9)) for r in out.collect()))
    assert found[0] == found[1] and len({r[1] for r in found[0]}) == 41
    single = feats.filter("message_id < 40 AND message_id <> 7")
    plan = features.tfidf(single, vocab, 24, in_place=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    monkeypatch.setattr(features, "BROADCAST_ROWS", 0)
    assert "Window" in features.tfidf(single, vocab, 24, in_place=True)._jdf.queryExecution().executedPlan().toString()


def test_models_of_folds_equal_models_trained_one_by_one(spark, monkeypatch):
    feats = odd_features(spark)
    folds = write_stage(feats.withColumn("pliegue", F.when(F.col("parte") == "val", 0).otherwise(2)), "folds")

    def rows(model):
        counts = sorted((r.modelo, r.term, round(r.idf, 9), round(r.w_ham, 9), round(r.w_spam, 9)) for r in model.counts.collect())
        return counts, sorted((r.modelo, r.n_ham, r.n_spam) for r in model.priors.collect()), model.max_rows

    wanted = [rows(bayes.train(df, 15, models=2)) for df in (feats.filter("parte = 'fit'"), feats)]
    assert [rows(m) for m in selection.train_outside_folds(folds, 2, 15, models=2)] == wanted
    monkeypatch.setattr(selection, "BROADCAST_ROWS", 0)
    assert [rows(m) for m in selection.train_outside_folds(folds, 2, 15, models=2)] == wanted
    alone = write_stage(folds.filter("modelo = 'a' OR pliegue = 0"), "alone")     # outside fold 0 there is no mail of corpus b
    fitted, whole = selection.train_outside_folds(alone, 2, 15, models=2)
    assert {r.modelo for r in fitted.priors.collect()} == {r.modelo for r in fitted.counts.collect()} == {"a"}
    assert {r.modelo for r in whole.priors.collect()} == {"a", "b"}


def test_errors_are_chosen_before_their_texts_are_fetched(spark):
    pred = spark.createDataFrame([(i if i % 9 else None, i % 2, 0.5, 1) for i in range(60)], "message_id long, Label_Code int, p_spam double, pred int")
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(60)] + [(4, "again"), (None, "none")], "message_id long, t string")
    first = evaluate.first_errors(pred.filter("message_id IS NOT NULL"), 10)
    assert [r.message_id for r in first.collect()] == [2, 4, 6, 8, 10, 12, 14, 16, 20, 22]

    def audit(wrong):
        return sorted(tuple(r) for r in evaluate.error_audit(wrong.join(texts, "message_id"), "t", 10).collect())

    assert audit(F.broadcast(first)) == audit(pred) and len(audit(pred)) == 10


def test_stacks_are_fitted_in_the_same_passes(spark, folded, monkeypatch):
    """Columns of all stacks are asked together, and each stack gets what it gets alone."""
    stack, grid = folded[1], [0.5, 4.0]
    some = write_stage(stack.filter("message_id % 5 > 1").withColumn("pliegue", F.lit(None).cast("int")), "test_some")
    alone = [cells.fit_cells(stack, 3, grid, 30), cells.fit_cells(some, 0, grid, 30)]
    asked, whole = [], cells._sums
    monkeypatch.setattr(cells, "_sums", lambda data, tables, points: asked.append(set(points)) or whole(data, tables, points))
    both = cells.fit_together([(stack, 3), (some, 0)], grid, 30)
    assert len(asked[0]) == 2 * 4 * 2 + 2 * 2 and len(asked) == max(f.passes for f in alone)
    for one, got in zip(alone, both):
        assert got.passes == one.passes and got.weights.keys() == one.weights.keys()
        assert all(got.weights[m] == pytest.approx(w, abs=1e-9) for m, w in one.weights.items())


def test_mails_are_coded_where_they_are(spark, folded, monkeypatch):
    """No term row moves; shared keys, unknown models and missing texts give what the joins give."""
    stack = folded[1].select("modelo", "message_id", "Label_Code", "pliegue", "rasgos")
    odd = stack.filter("message_id = 4").unionByName(stack.filter("message_id = 7").withColumn("modelo", F.lit("z"))).unionByName(
        stack.filter("message_id = 8").withColumn("message_id", F.lit(900)).withColumn("rasgos", F.lit(None).cast(stack.schema["rasgos"].dataType)))
    numbered = spark.createDataFrame([("a", "cash", 1), ("a", "win", 0), ("b", "meeting", 0)], "modelo string, term string, i int")
    rows = write_stage(stack.unionByName(odd), "test_odd")

    def read(df):
        return sorted((r.modelo, r.message_id, r.Label_Code, r.pliegue, sorted(map(tuple, r.celdas))) for r in df.collect())

    got = cells.coded(rows, numbered, 3)
    assert "Exchange hashpartitioning(modelo" not in cells.coded(stack, numbered, 3)._jdf.queryExecution().toString()
    found = read(got)
    monkeypatch.setattr(cells, "BROADCAST_ROWS", 0)
    assert found == read(cells.coded(rows, numbered, 3)) and any(r[-1] for r in found)
