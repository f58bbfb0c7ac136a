"""Null and repeated ids, clashing columns, long texts and odd vectors: every operator and every stage of the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartero.llm import common, decontaminate, langid, minhash, packing, permutation, pseudo, queries, rans, suffixes, toxicity, winnow

SMALL = "/root/testdata/sf0.001"
RNG = random.Random(5)
CLASH = ("_doc _id _key _row _starts id key mark row kept first again n_words hits items terms place lines_removed runs_removed "
         "n_shingles component_id score lang_pred found runs copy start length").split()


def some(n, prefix):
    return " ".join(f"{prefix}{RNG.randrange(5000)}" for _ in range(n))


A, B, C = (some(70, x) for x in "abc")
LONG = some(180_000, "the")  # over 1 MB
TEXTS = [(None, A), (None, B), (None, None), (1, A), (2, A), (2, B), (3, C), (3, C), (4, None), (5, ""), (6, LONG), (7, LONG + " end"),
         (8, "x\n" + B + "\ny"), (9, "the of and to in a is " * 10)]


@pytest.fixture(scope="module")
def odd(spark):
    common.ship(spark)
    names = ", ".join(f"`{c}` string" for c in CLASH)
    rows = [(i, t, "en", "src", 1, *["clash"] * len(CLASH)) for i, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}").repartition(3)


@pytest.fixture(scope="module")
def tokenizer():
    return queries.tokenizer_path()


def ids(rows):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"]) for r in rows)


EVERY = sorted(-1 if i is None else i for i, _ in TEXTS)


def test_files_keep_rows_without_an_id(odd, tokenizer):
    got = rans.round_trip(odd, tokenizer).collect()
    assert ids(got) == EVERY
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order[:3]] == [None] * 3
    assert all(b.start == a.start + a.n_tokens for a, b in zip(order, order[1:]))


def test_packing_keeps_rows_without_an_id(odd, tokenizer):
    pieces = packing.pack(odd, tokenizer).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in TEXTS}


def test_near_duplicates_leave_rows_without_an_id(odd):
    got = minhash.near_duplicates(odd).collect()
    assert ids(got) == EVERY and all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert {r.doc_id: r.component_id for r in got if r.doc_id in (6, 7)} == {6: 6, 7: 6}


def test_repeats_leave_rows_without_an_id(odd):
    got = suffixes.remove_repeats(odd, 1).collect()
    assert ids(got) == EVERY and all(r.n_removed == 0 for r in got if r.doc_id is None or r.doc_id == 6)
    long = next(r for r in got if r.doc_id == 7)
    assert long.n_bytes - long.n_removed == len(" end")


def test_anchors_do_not_depend_on_segments(monkeypatch):
    raw = np.frombuffer(("abc" * 200 + some(300, "w") + "abc" * 150).encode(), np.uint8)
    offs = np.array([0, 500, 700, len(raw)])
    whole = suffixes.anchors(raw, offs)
    monkeypatch.setattr(suffixes, "SEGMENT", 64)
    for a, b in zip(whole, suffixes.anchors(raw, offs)):
        assert (a == b).all()


def test_lines_leave_rows_without_an_id(odd):
    got = winnow.delete_runs(odd, words=50).collect()
    assert ids(got) == EVERY
    for r in got:
        assert r["_doc"] == r["_starts"] == r["_row"] == r["id"] == "clash"
        if r.doc_id is None:
            assert r.lines_removed == 0 and r.text in (A, B, None)
    assert {r.text for r in got if r.doc_id == 8} == {"x\ny"}


def test_other_operators_on_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, A, "x"), (None, B, "x"), (2, None, "x")], "item_id long, text string, doc_id string")
    assert ids(decontaminate.report(odd, bench).collect()) == EVERY
    assert ids(langid.predict(odd, langid.fit(odd, odd)).collect()) == EVERY
    labels = spark.createDataFrame([(1, 1, "x"), (2, 0, "x"), (None, 1, "x")], "doc_id long, toxic int, text string")
    assert ids(toxicity.score(odd, toxicity.fit(odd, labels)).collect()) == EVERY
    assert ids(pseudo.score(odd, pseudo.fit(odd)).collect()) == EVERY


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_on_odd_rows(spark, odd, name, stage):
    got = stage(spark, odd, SMALL)
    assert got.columns == odd.columns
    rows = got.collect()
    assert all(r[c] == "clash" for r in rows for c in CLASH)
    assert set(ids(rows)) <= set(EVERY)
    if name != "language ID":  # invented words
        assert sum(r.doc_id is None for r in rows) == 3
    assert stage(spark, odd.limit(0), SMALL).collect() == []


def test_packing_stage_on_odd_rows(spark, odd):
    assert {r.doc_id for r in corpus_pipeline.pack(spark, odd, SMALL).collect()} == {i for i, _ in TEXTS}
    assert corpus_pipeline.pack(spark, odd.limit(0), SMALL).collect() == []


def test_letters_beyond_the_second_plane():
    _, letter = langid._tables()
    assert letter[0x30001] and letter[0x4E00] and not letter[0x31]


def test_language_learns_from_the_end_of_a_text(spark):
    """Every text opens with the same 5,000 characters; only what follows tells the languages apart."""
    common.ship(spark)
    head = "xyz " * 1250
    tail = {"en": "the of and to in that is was he for it with as his on be at by", "de": "der die und in den von zu das mit sich des auf ist"}
    rows = [(i, head + " ".join(RNG.choice(tail[lang].split()) for _ in range(300)), lang) for i, lang in enumerate(["en", "de"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.fit(docs, docs)).collect()
    assert sum(r.lang_pred == rows[r.doc_id][2] for r in got) >= 76


def test_an_odd_vector_does_not_set_the_length(spark):
    common.ship(spark)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)] + [(1000 + i, [1.0] * 3) for i in range(20)]
    for drop in range(3):
        frame = spark.createDataFrame(rows[drop:], "vec_id long, embedding array<double>")
        got = permutation.search(frame, F.col("vec_id") % 20 == 0).collect()
        assert {r.query_id for r in got} >= set(range(20, 200, 20)) and all(r.vec_id < 1000 for r in got)
