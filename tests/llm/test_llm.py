"""Operators against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cartero.llm import (bpe, common, components, decontaminate, langid, minhash, packing, permutation, pseudo, queries, rans,
                         suffixes, toxicity, winnow)

SMALL = "/root/testdata/sf0.001"
RNG = random.Random(3)
WORDS = ["alpha", "beta", "Gamma", "delta!", "straße", "12", "x", "naïve", "the", "of"]


def words(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


PASSAGE = words(70)
TEXTS = [None, "", "   \n\t ", "one two", "one two", PASSAGE, PASSAGE, words(40) + "\n" + PASSAGE, PASSAGE + " " + words(30),
         "a\nb\nc\nd", "zz\na\nb\nc\nq", "\n\na\n\nb\n c \nend", "é" * 150, "é" * 150 + "!", words(3000), "ends <|endoftext|> 日本 it's"]


@pytest.fixture(scope="module")
def docs(spark):
    common.ship(spark)
    rows = [(i, t, "en", f"src{i % 3}", i, "clash") for i, t in enumerate(TEXTS)]
    rows.append((3, "one two", "en", "src0", 3, "clash"))  # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    common.ship(spark)
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def tokenizer():
    return queries.tokenizer_path()


def library(path):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(path)
    tk.encode_special_tokens = True
    return lambda t: tk.encode(t or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ------------------------------------------------------------ tokens, packing
def test_pieces_equal_the_library(tokenizer):
    enc, whole = bpe.encoder(tokenizer), library(tokenizer)
    letters = list("ab'strevmld  \n\t!?,.19é ß 世\x1c²'\xa0")
    texts = ["".join(RNG.choice(letters) for _ in range(RNG.randint(0, 25))) for _ in range(3000)]
    ids, counts = enc.encode(*common.bytes_of(pa.array(texts)))
    at = np.concatenate([[0], np.cumsum(counts)])
    assert all(ids[at[i]:at[i + 1]].tolist() == whole(t)[:-1] for i, t in enumerate(texts))


def test_rans_round_trip(docs, tokenizer):
    got = sorted(map(tuple, rans.round_trip(docs, tokenizer).collect()))
    whole, at, want = library(tokenizer), 0, []
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id, r.text or "")):
        ids = whole(r.text)
        want.append((r.doc_id, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert [(a, b, c, bytes(d)) for a, b, c, d in got] == want


def test_rans_checkpoints_decode_alone():
    ids = np.random.default_rng(1).zipf(1.3, 5000).clip(max=999).astype(np.uint16)
    freq = rans.quantise(np.bincount(ids, minlength=1000))
    assert freq.sum() == 1 << rans.SCALE
    base, symbol = np.cumsum(freq) - freq, np.repeat(np.arange(1000, dtype=np.uint16), freq.astype(int))
    states, stream, marks = rans.encode_block(ids, freq, base, 16)
    assert (rans.decode_block(len(ids), states, stream, freq, base, symbol) == ids).all()
    found = rans.checkpoints_of(marks, 16)
    assert len(found) == (5000 // 16) // rans.CHECKPOINT
    for step, word, at in found:
        assert (rans.decode_block(len(ids), at, stream, freq, base, symbol, step, None, word) == ids[step * 16:]).all()


def test_rans_refuses_a_changed_block(spark, docs, tokenizer):
    path = common.new_path(spark, "test")
    rans.write_tokens(docs, tokenizer, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    blocks.withColumn("words_crc", F.col("words_crc") + 1).write.parquet(f"{path}/bad/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}/bad/table")
    with pytest.raises(Exception, match="checksum"):
        rans.read_tokens(spark, f"{path}/bad").collect()


def check_packing(pieces, docs, tokenizer, window):
    whole = library(tokenizer)
    tokens = collections.Counter(tuple(whole(r.text)) for r in docs)
    assert sum(p.length for p in pieces) == sum(len(t) * n for t, n in tokens.items())
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    texts = collections.defaultdict(list)
    for r in docs:
        texts[r.doc_id].append(whole(r.text))
    for doc, own in by_doc.items():
        ids = texts[doc][0]
        assert sorted((p.start, p.length) for p in own)[0][0] == 0
        assert sum(p.length for p in own) == len(ids) * len(texts[doc])
        assert all(p.ids_crc32 == crc(ids[p.start:p.start + p.length]) and p.doc_tokens == len(ids) for p in own)
    for own in by_seq.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        size = sum(p.length for p in own)
        assert size == window or size < window and size & (size - 1) == 0


@pytest.mark.parametrize("window", [16, 1024])
def test_packing(docs, tokenizer, window):
    check_packing(packing.pack(docs, tokenizer, window).collect(), docs.collect(), tokenizer, window)


def test_plan_fills_every_window():
    for histogram in ({600: 5000}, {1023: 7, 1: 3}, {i: RNG.randint(1, 40) for i in range(1, 1024)}, {}):
        plan = packing.Plan(histogram, 1024)
        filled = collections.Counter()
        for _, _, n, _, length, seq, _ in plan.rows:
            for i in range(n):
                filled[seq + i] += length
        assert sum(filled.values()) == sum(k * n for k, n in histogram.items())
        assert sum(v != 1024 for v in filled.values()) <= 10 and len(filled) == plan.sequences


def test_closest_fill_is_the_best():
    import itertools
    for _ in range(50):
        counts = {RNG.randint(1, 30): RNG.randint(1, 3) for _ in range(4)}
        items = [s for s, n in counts.items() for _ in range(n)]
        room = RNG.randint(1, 60)
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= room)
        used = packing.closest_fill(sorted(counts, reverse=True), counts, room)
        assert sum(s * n for s, n in used.items()) == best and all(n <= counts[s] for s, n in used.items())


# ------------------------------------------------------------- decontamination
def plain_words(text):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("chunk", [10 ** 6, 20])
def test_decontamination(spark, docs, chunk):
    items = [("9", PASSAGE[:200]), ("10", "one two"), ("11", None), ("12", ""), ("9", PASSAGE[:200]), ("13", "no such words here")]
    bench = spark.createDataFrame([(*r, "clash") for r in items], "item_id string, text string, doc_id string")
    got = decontaminate.scan(docs, bench, chunk_words=chunk).collect()
    assert len(got) == docs.count()
    for r in got:
        w, hit, found = plain_words(r.text), set(), set()
        for ident, text in items:
            iw = plain_words(text)
            k = min(13, len(iw))
            grams = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if k else set()
            for i in range(len(w) - k + 1 if k else 0):
                if tuple(w[i:i + k]) in grams:
                    hit |= set(range(i, i + k))
                    found.add(ident)
        assert (r.n_words, r.n_hit, r["items"]) == (len(w), len(hit), sorted(found)), r
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, bench).collect()}
    assert "one" not in cut[3] and cut[9] == TEXTS[9] and cut[0] is None
    assert {r.doc_id for r in decontaminate.remove_documents(docs, bench).collect()} >= {0, 1, 2, 9, 10, 11}


# --------------------------------------------------------------- deduplication
def shingles(text):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return sets, comp


def test_near_duplicates(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets, comp = near_groups(rows)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), comp[r.doc_id], comp[r.doc_id] == r.doc_id)


def test_near_duplicates_of_a_chain(spark, monkeypatch):
    """A chain of texts, each linked with the next alone, and blocks of two members."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    common.ship(spark)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(14):
        base = base[:8 * i] + [f"n{i}_{j}" for j in range(8)] + base[8 * i + 8:]
        texts.append(" ".join(base))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, comp = near_groups(list(enumerate(texts)))
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(frame).collect()} == comp


def test_signature_estimates_similarity():
    a = [f"a{i}" for i in range(800)]
    pair = pa.array([" ".join(a), " ".join(a[:700] + [f"b{i}" for i in range(100)])])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pair], ["doc_id", "text"])
    out = next(minhash._signatures([batch]))
    x, y = minhash._rows(out.column("signature"))
    s, t = minhash.shingle_sets(pair)
    true = len(np.intersect1d(s, t)) / len(np.union1d(s, t))
    assert abs(minhash.estimate(x, y) - true) < 0.12


def test_components(spark):
    links = [(i, i + 1) for i in range(50, 90)] + [(1, 2), (2, 1), (3, 3), (7, 1000), (1000, 5)] + [(200, i) for i in range(300, 340)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(50, 91), 50), 1: 1, 2: 1, 5: 5, 7: 5, 1000: 5, 200: 200, **dict.fromkeys(range(300, 340), 200)}


def test_line_dedup(docs):
    rows = sorted({(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}, key=lambda r: r[0])
    first, grams = {}, {}
    for i, t in rows:
        full = [(n, x.strip(" \t\n\v\f\r")) for n, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\v\f\r")]
        grams[i] = full
        for p in range(len(full) - 2):
            first.setdefault(tuple(x for _, x in full[p:p + 3]), (i, p))
    for r in winnow.delete_runs(docs).collect():
        full, gone = grams[r.doc_id], set()
        for p in range(len(full) - 2):
            if first[tuple(x for _, x in full[p:p + 3])] < (r.doc_id, p):
                gone |= set(range(p, p + 3))
        lines = {full[p][0] for p in gone}
        want = None if r.source is None else TEXTS[r.doc_id]
        if lines:
            want = "\n".join(x for n, x in enumerate(want.split("\n")) if n not in lines)
        assert (r.text, r.lines_removed) == (want, len(lines)) and r.n_words == "clash"


def test_line_dedup_counts_words(spark):
    common.ship(spark)
    long, half, other = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("l", 51), ("h", 26), ("o", 26)))
    short = " ".join(f"s{i}" for i in range(50))
    texts = [f"{long}\nend", f"{half}\n\n{other}", f"first\n {long} ", f"{half}\n{other}\nlast", short, short, long,
             f"{half}\nbetween\n{other}"]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars int")
    got = {r.doc_id: (r.text, r.lines_removed, r.runs_removed) for r in winnow.delete_runs(frame, words=50).collect()}
    want = {i: (t, 0, 0) for i, t in enumerate(texts)}
    assert got == {**want, 2: ("first", 1, 1), 3: ("last", 2, 1), 6: ("", 1, 1)}
    assert {r.doc_id: (r.text, r.lines_removed, r.runs_removed) for r in winnow.delete_runs(frame).collect()} == want
    left = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, frame, SMALL).collect()}
    assert left[2] == "first" and left[3] == "last" and 6 not in left and left[5] == short


@pytest.mark.parametrize("hot", [1, 10 ** 6])
def test_suffix_dedup(docs, hot):
    rows = sorted({(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()})
    seen, want = set(), {}
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 99):
            if t[p:p + 100] in seen:
                gone[p:p + 100] = True
            seen.add(t[p:p + 100])
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0
        want[i] = (len(t), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest())
    got = suffixes.remove_repeats(docs, hot).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id


# ---------------------------------------------------------------------- search
def test_nearest_neighbours(spark):
    common.ship(spark)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 16)) * rng.uniform(0.5, 2, (600, 1))
    x[100:300] = x[100]  # a vector that a third of the rows share
    rows = [(i, v.tolist(), "clash") for i, v in enumerate(x)]
    rows += [(700, None, ""), (720, [0.0] * 16, ""), (740, [float("nan")] * 16, ""), (760, [None] * 16, ""), (780, [1.0], "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = collections.defaultdict(list)
    for r in permutation.search(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 600, 20))
    found = 0
    for q, own in got.items():
        s = x @ x[q]
        best = [i for i in np.lexsort((np.arange(600), -s)) if i != q][:20]
        assert all(abs(score - s[i]) < 1e-9 for i, score in own) and len(own) == 20
        assert own == sorted(own, key=lambda p: (-p[1], p[0]))
        found += len({i for i, _ in own} & set(best))
    assert found >= 0.9 * 20 * len(got)


def test_footrule_gain_is_the_footrule():
    rng, m = np.random.default_rng(4), 5
    near = np.array([rng.permutation(9)[:m] for _ in range(30)])
    row, rank = np.repeat(np.arange(30), m), np.tile(np.arange(m), 30)
    by = np.argsort(near.ravel(), kind="stable")
    starts = np.searchsorted(near.ravel()[by], np.arange(10))
    gain = permutation.footrule_gain(near[0], 30, starts, row[by], rank[by], m)
    place = [{int(p): i for i, p in enumerate(v)} for v in near]
    true = [sum(abs(place[0].get(p, m) - q.get(p, m)) for p in range(9)) for q in place]
    assert (m * (m + 1) - gain).tolist() == true


# ------------------------------------------------------------------ classifiers
def test_language_held_out(spark):
    found = queries.QUERIES["op4_language"](spark, SMALL).join(
        spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found) > 0


def test_language_edges(spark, docs, empty):
    model = langid.fit(docs, docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    assert got[0] == got[1] == got[2] == ("und", 0.0) and got[5][0] == "en"
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty, empty)).collect()} == {"und"}


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 400)
    s = rng.normal(size=(400, 3)) * 8 + 4 * np.eye(3)[y]
    assert langid.fit_temperature(s, y) > 1.5


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES["op1_toxicity"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic, clean = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic) and sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_label_model_discounts_copies():
    rng = np.random.default_rng(6)
    y = rng.random(20000) < 0.2
    v = np.full((20000, toxicity.VOTERS), 2)
    for j, (p, q) in enumerate([(0.8, 0.1), (0.7, 0.2), (0.6, 0.05), (0.7, 0.1)]):
        v[:, j] = rng.random(20000) < np.where(y, p, q)
    v[:, 4] = v[:, 0]  # a voter that repeats another
    codes, back = np.unique((v * 3 ** np.arange(toxicity.VOTERS)).sum(1), return_inverse=True)
    known = np.zeros((len(codes), 2))
    np.add.at(known, (back[:500], y[:500].astype(int)), 1)
    model = toxicity.LabelModel(codes, np.bincount(back).astype(float), known)
    assert model.weights[4] < 0.7 and model.weights[1] > 0.8
    assert abs(model.table[1, 0, 1] - 0.8) < 0.1 and ((model.posterior[back] > 0.5) == y).mean() > 0.9


def test_toxicity_edges(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(empty, toxicity.fit(empty, none)).count() == 0


def test_pseudo_likelihood_learns(spark, docs):
    model = pseudo.fit(docs)
    rows = {r.doc_id: r for r in pseudo.score(docs, model).collect()}
    assert rows[0].n_words == 0 and rows[0].log_likelihood == 0 and rows[14].log_likelihood < 0
    base = (model[0], pseudo.initial())
    before = sum(r.log_likelihood for r in pseudo.score(docs, base).collect())
    assert sum(r.log_likelihood for r in rows.values()) > before
    p = pseudo.unpack(model[1])
    around = np.full((pseudo.VOCAB, 2 * pseudo.SIDE), 3)
    assert abs(np.exp(pseudo.log_probabilities(p, around, np.arange(pseudo.VOCAB))).sum() - 1) < 1e-3


def test_pseudo_likelihood_tells_junk(spark):
    common.ship(spark)
    rng = random.Random(11)
    letter = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    lexicon = ["".join(letter(1, "bdklmnrst") + letter(1, "aeiou") for _ in range(rng.randint(2, 4))) for _ in range(4000)]
    weights = [1 / (i + 10) for i in range(4000)]
    texts = [" ".join(rng.choices(lexicon, weights, k=200)) for _ in range(200)]
    junk = [" ".join(letter(rng.randint(6, 12), "abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(200)) for _ in range(5)]
    rare = " ".join(lexicon[2000:2200])  # outside the vocabulary, but words of the corpus
    docs = spark.createDataFrame(list(enumerate([*texts, rare, *junk])), "doc_id long, text string").repartition(4)
    model = pseudo.fit(docs)
    got = {r.doc_id: r.log_likelihood / r.n_words for r in pseudo.score(docs, model).collect()}
    worst = max(got[i] for i in range(201, 206))
    assert worst < got[200] < min(got[i] for i in range(200)) and got[200] - worst > 3
    hashed = model[0].outside
    assert len(hashed.keys) > 500 and np.exp(hashed.logs).reshape(-1, pseudo.LETTERS).sum(1).max() < 1.001


def test_pseudo_likelihood_trains_on_every_position(spark, monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(["a", None, "b c d", "", " ".join(f"w{i}" for i in range(3001))])], ["text"])
    ids = {w: i for i, w in enumerate(["a", "b", "c", "d", *(f"w{i}" for i in range(1000))], 1)}
    seen = collections.Counter()
    monkeypatch.setattr(pseudo, "step", lambda net, memory, around, words: seen.update(words.tolist()))
    buf, _, s, e, _ = pseudo.words_of(pa.array([" ".join(ids)]))
    vocabulary = pseudo.Vocabulary(pseudo.span_hashes(buf, s, e).view(np.int64).tolist())
    for turn in range(pseudo.ROUNDS):
        list(pseudo._train(vocabulary, pseudo.initial(), turn, [batch]))
    assert seen == {**dict.fromkeys(ids.values(), 1), 0: 2001}


# -------------------------------------------------------------- empty, pipeline
def test_empty_tables(spark, empty, tokenizer):
    assert rans.round_trip(empty, tokenizer).count() == 0
    assert packing.pack(empty, tokenizer).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert winnow.delete_runs(empty).count() == 0
    assert suffixes.remove_repeats(empty).count() == 0
    assert decontaminate.report(empty, empty.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert pseudo.score(empty, pseudo.fit(empty)).count() == 0
    assert permutation.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = common.stage(stage(spark, docs, SMALL), "test")
        after = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r.doc_id for r in after} <= set(before)
        if name == "MinHash near-dedup":
            _, comp = near_groups([(i, r.text) for i, r in before.items()])
            assert {r.doc_id for r in after} == {i for i, c in comp.items() if i == c}
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect(), docs.collect(), tokenizer, 1024)


def test_pipeline_keeps_null_and_repeated_ids(spark):
    common.ship(spark)
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(None, a), (None, b), (1, a), (2, a), (2, b), (3, c), (3, c), (3, c + " end"), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.text or "") for r in corpus_pipeline.near_duplicates(spark, frame, SMALL).collect()))
    assert len(got) == 6 and got[:4] == [(0, a), (0, b), (1, a), (2, b)] and got[4] in [(3, c), (3, c + " end")] and got[5] == (4, "")


def test_queries_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
